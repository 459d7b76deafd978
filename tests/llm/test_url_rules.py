"""Listed rules against string handling in Python, and mined rules on planted tokens."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from visitlake.llm import url_rules
from visitlake.llm.queries import URL_RULES, labelled_urls

URLS = [
    "http://a.net/x", "http://a.net", "http://NET/", "http://example.net/en/1", "http://sub.Example.NET/en/1?q=/",
    "http://badexample.net/en/1", "https://example.com/de/2#x", "https://example.com/DE/2", "http://x.example.com/de",
    "http://org/fr/", "http://a.org/fr/x", "http://a.org?fr/", "http://a.org#/fr/", "ftp://x://net/", "no scheme.net/",
    "://net/", "", None, "http://", "http:///path", "http://net:80/", "http://u@net/x", "http://a.net/\n", "HTTP://É.net/é",
    "http://a.net/x",
]


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def test_listed_rules(spark):
    rows = [(i, url, "x", "y") for i, url in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    none = url_rules.mine_rules(spark.createDataFrame([], "url string, bad boolean"), "url", "bad")
    judged = url_rules.judge(pages, "page_id", "url", URL_RULES, none).collect()
    got = sorted((r["key"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judged)
    assert got == sorted((i, *by_hand(url)) for i, url in enumerate(URLS))


@pytest.fixture(scope="module")
def mined(spark):
    """Hosts of "bad" are bad; part "promo" is bad only together with key "ref"."""
    draw, rows = random.Random(3), []
    for i in range(1500):
        host = draw.choice(["good", "fine", "other", "bad"])
        part, key = draw.choice(["promo", "news", "blog"]), draw.choice(["ref", "page"])
        bad = host == "bad" or (part == "promo" and key == "ref")
        rows.append((f"http://{host}.example.com/{part}/{i}?{key}=1", bad))
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    return rows, url_rules.mine_rules(labelled, "url", "bad", min_confidence=0.9)


def test_mined_rules(spark, mined):
    rows, rules = mined
    found = {frozenset(r["tokens"]) for r in rules.collect()}
    assert {"host=bad.example.com"} in found or {"label=bad"} in found
    assert {"part=promo", "key=ref"} in found
    assert not any("part=promo" in r and len(r) == 1 for r in found)
    hits = {r["url"] for r in url_rules.matched(spark.createDataFrame(rows, "url string, bad boolean"), "url", rules).collect()}
    assert hits == {url for url, bad in rows if bad}


def test_no_rule_covers_another(mined):
    rules = [(frozenset(r["tokens"]), r["confidence"]) for r in mined[1].collect()]
    for a, confidence in rules:
        assert not any(b < a and other >= confidence for b, other in rules)


def test_labels_by_document_number(spark):
    pages = spark.createDataFrame(
        [("http://a/en/7.html",), ("http://a/en/8/?x=9",), ("http://a/en",), (None,), ("http://a/99999999999999999999",)], "url string"
    )
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 1), (9, 1, 0), (None, 0, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    got = {r["url"]: r["bad"] for r in labelled_urls(pages, labels).collect()}
    assert got == {"http://a/en/7.html": True, "http://a/en/8/?x=9": True}


def test_tokens(spark):
    row = spark.range(1).select(url_rules.url_tokens(F.lit("http://a.B.org/x//y.html?k=v&l#frag")).alias("t")).first()
    assert row["t"] == [
        "scheme=http", "host=a.b.org", "label=a", "label=b", "label=org", "part=x", "part=y.html",
        "ending=html", "key=k", "key=l", "fragment=frag",
    ]


def rules_by_hand(rows, tokens_of, min_rows=5, min_confidence=0.6):
    """Rules over all combinations of tokens, without those that a shorter one covers."""
    hits, bads = Counter(), Counter()
    for url, bad in rows:
        for k in range(1, len(tokens_of[url]) + 1):
            for some in itertools.combinations(sorted(tokens_of[url]), k):
                hits[some] += 1
                bads[some] += bad
    common = {t for (t, *rest), n in hits.items() if not rest and n == len(rows)}
    found = {
        some: bads[some] / n for some, n in hits.items()
        if bads[some] >= min_rows and bads[some] / n >= min_confidence and not common & set(some)
    }
    shorter = lambda some: (c for k in range(1, len(some)) for c in itertools.combinations(some, k))
    return {some: c for some, c in found.items() if not any(found.get(s, -1) >= c for s in shorter(some))}


def compare_by_hand(spark, rows, **options):
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    tokens_of = dict(map(tuple, labelled.select("url", url_rules.url_tokens(F.col("url"))).collect()))
    got = {tuple(r["tokens"]): r["confidence"] for r in url_rules.mine_rules(labelled, "url", "bad", **options).collect()}
    expected = rules_by_hand(rows, tokens_of, **options)
    assert got == pytest.approx(expected)
    return got


def test_rule_with_a_common_token(spark):
    """Part "promo" is bad only with the scheme that 60% of the URLs have."""
    draw, rows = random.Random(4), []
    for i in range(400):
        scheme, part = "https" if draw.random() < 0.6 else "http", draw.choice(["promo", "news", "blog"])
        rows.append((f"{scheme}://{draw.choice('ab')}.example.com/{part}/{i}", scheme == "https" and part == "promo"))
    got = compare_by_hand(spark, rows)
    assert got[("part=promo", "scheme=https")] == 1.0


def test_rules_of_tokens_on_the_same_urls(spark):
    rows = [(f"http://bad{i % 2}.example.com/deep/path/of/{i % 2}/x{i}", i % 2 == 0) for i in range(12)]
    rows += [("http://good.example.com/deep/x", False)] * 7 + [("https://good.example.com/of/x", True)] * 5
    assert ("host=bad0.example.com",) in compare_by_hand(spark, rows) and ("part=0",) in compare_by_hand(spark, rows)


def test_small_bad_host_among_many_urls(spark):
    """Support is a number of URLs, so a host with six bad pages has a rule at every size."""
    rows = [(f"http://h{i % 40}.example.com/{i % 7}", False) for i in range(20_000)]
    rows += [(f"http://bad.example.com/{i % 2}", True) for i in range(6)]
    compare_by_hand(spark, rows)
    assert any("host=bad.example.com" in r["tokens"] for r in url_rules.mine_rules(
        spark.createDataFrame(rows, "url string, bad boolean"), "url", "bad").collect())
