"""Block and allow URLs by listed rules and by rules mined from labelled URLs.

Spark's FP-growth finds combinations of tokens that bad URLs share, and their confidence is counted
over all labelled URLs. A combination whose confidence or support is low is dropped, and so is one
that a shorter combination of at least its confidence covers. Each rule is indexed under its rarest token: a URL looks up its tokens and
holds a rule if it has all tokens of it.

At scale: URLs are made distinct before they are matched, so a URL or host with a third of all rows
is one lookup. Tokens that every labelled URL has tell nothing and are left out of mining; tokens that are on the
same URLs are mined as one item and written out again, which shortens transactions without loss, as one
covers the other. The mined rules are written as a table, so Spark broadcasts them only if
their measured size is small. A hot token's lookups are split by adaptive execution.

Defined results: a null URL, or one without "://", has an empty host and path, no listed rule and no
tokens, and is allowed. URLs that repeat share their verdict. Labels may be missing for
any URL, or altogether: then nothing is mined. Columns that are not named do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.scratch import via_table

BLOCK, ALLOW = "block", "allow"
NO_TOKENS = "array<string>"


class ListedRule(NamedTuple):
    """Fits the host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        on_host = (host == self.host) | host.endswith("." + self.host)
        return on_host & path.startswith(self.path)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def url_host(url: Column) -> Column:
    raw = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(raw, ascii_uppercase, ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: Sequence[ListedRule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null without any."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: len(rule.text)):  # the longest is asked first
        fits = rule.fits(host, path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host and its labels, path parts, file ending, query keys, fragment."""
    host, path = url_host(url), url_path(url)
    query = F.regexp_extract(url, "[?]([^#]*)", 1)

    def each(name: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(name), x))

    tokens = F.concat(
        F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))),
        each("host=", F.array(host)),
        each("label=", F.split(host, "[.]")),
        each("part=", F.split(path, "/")),
        each("ending=", F.array(F.regexp_extract(path, "[.]([A-Za-z0-9]+)$", 1))),
        each("key=", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        each("fragment=", F.array(F.regexp_extract(url, "#(.*)$", 1))),
    )
    return F.when(F.locate("://", url) > 0, F.array_distinct(tokens)).otherwise(
        F.array().cast(NO_TOKENS)
    )


def mine_rules(
    labelled: DataFrame,
    url: str,
    bad: str,
    min_rows: int = 5,
    min_confidence: float = 0.6,
) -> DataFrame:
    """Rows (tokens, anchor, confidence, support) from URLs with a boolean column ``bad``.

    ``anchor`` is the rule's rarest token. A rule needs ``min_rows`` bad URLs, however many there are in
    all. Only tokens that every URL has are left out.
    """
    rows = labelled.where(F.col(url).isNotNull() & F.col(bad).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), url_tokens(F.col(url)).alias("tokens"),
        F.col(bad).alias("bad"),
    )
    rows = via_table(rows, "labelled-urls")
    total = rows.count()
    each = rows.select("row", "bad", F.explode("tokens").alias("token"))
    same_rows = [F.bit_xor(F.xxhash64(F.lit(seed), "row")) for seed in (1, 2)]
    counts = each.groupBy("token").agg(
        F.count("*").alias("count"), F.count_if("bad").alias("bad_count"),
        same_rows[0].alias("rows_1"), same_rows[1].alias("rows_2"),
    )
    # Tokens on the same URLs are one item.
    item = F.min("token").over(Window.partitionBy("count", "rows_1", "rows_2"))
    useful = counts.where((F.col("bad_count") >= min_rows) & (F.col("count") < total))
    useful = via_table(useful.select("token", "count", item.alias("item")), "url-tokens")
    items = (
        each.join(useful.where(F.col("token") == F.col("item")), "token")
        .groupBy("row", "bad")
        .agg(F.array_sort(F.collect_set("token")).alias("items"))
        .select("bad", "items")
    )
    items = via_table(items, "url-items")
    bad_items = items.where("bad").select("items")
    seen = bad_items.count()
    if seen < max(min_rows, 1):
        return rows.select(
            "tokens", F.lit("").alias("anchor"), F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support")
        ).limit(0)
    # FP-growth takes a share of the rows that it sees; half a row less, against rounding.
    share = max(min_rows - 0.5, 0) / seen
    sets = FPGrowth(itemsCol="items", minSupport=share).fit(bad_items).freqItemsets
    sets = via_table(sets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad_count")), "url-sets")
    rules = _with_confidence(_anchored(sets, useful), items).where(F.col("confidence") >= min_confidence)
    rules = rules.withColumn("support", F.col("bad_count") / F.lit(float(total))).drop("bad_count")
    rules = _without_covered(via_table(rules, "url-rules"))
    return via_table(_anchored(_by_token(rules, useful), useful), "url-rules")


def _anchored(sets: DataFrame, counts: DataFrame) -> DataFrame:
    """``sets`` with the rarest of their ``tokens`` as ``anchor``."""
    anchors = (
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(counts, "token")
        .groupBy("tokens")
        .agg(F.min_by("token", F.struct("count", "token")).alias("anchor"))
    )
    return sets.join(anchors, "tokens")


def _with_confidence(sets: DataFrame, items: DataFrame) -> DataFrame:
    """``sets`` with the share of bad ones among all rows of ``items`` that hold them."""
    sets = via_table(sets, "url-sets")
    holding = (
        items.groupBy("items").agg(F.count("*").alias("n"))
        .withColumn("token", F.explode("items"))
        .join(sets, F.col("token") == F.col("anchor"))
        .where(F.size(F.array_except("tokens", "items")) == 0)
        .groupBy("tokens")
        .agg(F.sum("n").alias("n"))
    )
    return sets.join(holding, "tokens").withColumn("confidence", F.col("bad_count") / F.col("n")).drop("n")


def _by_token(rules: DataFrame, useful: DataFrame) -> DataFrame:
    """Rules of items as rules of tokens: one for each choice of a token for each item."""
    members = useful.groupBy("item").agg(F.collect_list("token").alias("members"))
    choices = F.aggregate(
        F.collect_list("members"),
        F.array(F.array().cast(NO_TOKENS)),
        lambda found, members: F.flatten(
            F.transform(found, lambda some: F.transform(members, lambda token: F.array_append(some, token)))
        ),
    )
    return (
        rules.withColumn("item", F.explode("tokens"))
        .join(members, "item")
        .groupBy("tokens", "confidence", "support")
        .agg(choices.alias("choices"))
        .select(F.explode("choices").alias("choice"), "confidence", "support")
        .select(F.array_sort("choice").alias("tokens"), "confidence", "support")
    )


def _without_covered(rules: DataFrame) -> DataFrame:
    """Drop rules that hold all tokens of a shorter rule of at least their confidence."""
    longer = rules.select(F.col("tokens").alias("of"), F.col("confidence").alias("own"))
    covered = (
        longer.withColumn("token", F.explode("of"))
        .join(rules, F.col("token") == F.col("anchor"))
        .where((F.size("tokens") < F.size("of")) & (F.col("confidence") >= F.col("own")))
        .where(F.size(F.array_except("tokens", "of")) == 0)
        .select(F.col("of").alias("tokens"))
        .distinct()
    )
    return rules.join(covered, "tokens", "left_anti")


def matched(urls: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """Rows (url, confidence) for each distinct URL that holds a rule: that of its best rule."""
    return (
        urls.where(F.col(url).isNotNull())
        .select(F.col(url).alias("url"))
        .distinct()
        .withColumn("own", url_tokens(F.col("url")))
        .withColumn("token", F.explode("own"))
        .join(rules, F.col("token") == F.col("anchor"))
        .where(F.size(F.array_except("tokens", "own")) == 0)
        .groupBy("url")
        .agg(F.max("confidence").alias("confidence"))
    )


def judge(
    pages: DataFrame, key: str, url: str, listed: Sequence[ListedRule], rules: DataFrame
) -> DataFrame:
    """Rows (key, host, path, rule, verdict, confidence): listed rules first, then mined ones."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    text, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    rows = (
        pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
        .withColumns({"host": host, "path": path})
        .withColumns({"rule": text, "listed": verdict})
    )
    hits = matched(rows.where(F.col("rule").isNull()), "url", rules)
    mined = F.when(F.col("confidence").isNotNull(), BLOCK).otherwise(ALLOW)
    return rows.join(hits, "url", "left").select(
        "key", "host", "path", "rule", F.coalesce("listed", mined).alias("verdict"), "confidence"
    )
