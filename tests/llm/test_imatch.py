"""Fingerprints: texts, edits, equality, plan."""

import hashlib

from visitlake.llm import imatch


def rows_of(docs):
    return [r.asDict() for r in imatch.fingerprints(docs, "doc_id", "text").collect()]


def in_order(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))


def edited(rows):
    out = []
    for i, (key, text) in enumerate(rows):
        quarter, following = len(text) // 4, rows[(i + 1) % len(rows)][1]
        changed = text[: len(text) - quarter] + following[:quarter]
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edge_documents(edge_docs):
    got = rows_of(edge_docs)
    assert sorted(((r["key"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == edited(in_order(edge_docs))
    by_text = {}
    for r, (key, text) in zip(sorted(got, key=lambda r: repr((r["key"], r["n_chars"]))), sorted(in_order(edge_docs), key=lambda r: repr((r[0], len(r[1]))))):
        by_text.setdefault(text, set()).add(r["fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET_BYTES", 1)
    rows = [(i * i * 1000 - 7, f"document number {i} " * (i % 5 + 1)) for i in range(90)] + [(3, "tie b"), (3, "tie a"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = rows_of(docs)
    assert sorted(((r["key"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == edited(in_order(docs))


def test_edits_are_nearer_than_others(spark):
    words = [f"term{i % 97}x{i % 13}" for i in range(5000)]
    rows = [(i, " ".join(words[(i * 37 + j * (i % 7 + 1)) % 5000] for j in range(150))) for i in range(60)]
    got = rows_of(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r["near_edited"] for r in got) > 3 * sum(r["near_next"] for r in got)


def test_one_document_follows_itself(spark):
    row, = rows_of(spark.createDataFrame([(5, "alone here")], "doc_id long, text string"))
    assert row["near_next"] == 1.0


def test_native_plan(edge_docs, no_docs):
    plan = imatch.fingerprints(edge_docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert rows_of(no_docs) == []


def test_near_copies_in_a_rare_language(spark):
    """Two near copies and a text of words of its own among 3,000 documents of another language."""
    rows = [(i, " ".join(f"word{(i * 31 + j * j) % 900}" for j in range(40))) for i in range(3000)]
    rare = [f"seldom{j}" for j in range(300)]
    rows += [(5000, " ".join(rare)), (5001, " ".join([*rare[:150], "changed", *rare[151:]])), (-7, " ".join(f"lone{j}" for j in range(300)))]
    got = {r["key"]: r for r in rows_of(spark.createDataFrame(rows, "doc_id long, text string")) if r["key"] in (5000, 5001, -7)}
    assert 0.8 < got[5000]["near_next"] <= 1 and got[5000]["near_edited"] > 0.4
    assert got[-7]["near_edited"] > 0.4 and got[-7]["near_next"] < 0.1


def likeness_of(a, b):
    """The likeness of two fingerprints, from their texts alone."""
    if a == b:
        return 1.0
    if a.startswith("w:") or b.startswith("w:"):
        return 0.0
    parts = [[part.split(",") for part in one.split(":")[1].split(";")] for one in (a, b)]
    levels = [int(one.split(":")[0]) for one in (a, b)]
    rare = any(not any("".join(part) for part in three[:3]) for three in parts)
    sides = []
    for (low, high, heavy, rare_low, rare_high), step in zip(parts, (levels[0] - levels[1], levels[1] - levels[0])):
        low, high = (rare_low, rare_high) if rare else (low, high)
        sides.append(([] if rare else heavy) + {0: low + high, 1: low, -1: high}.get(step, []))
    told = [x == y for x, y in zip(*sides) if x or y]
    return sum(told) / len(told) if told else 0.0


def check_likeness(rows):
    rows = sorted(rows, key=lambda r: r["key"])
    for r, following in zip(rows, [*rows[1:], rows[0]]):
        assert abs(r["near_edited"] - likeness_of(r["fingerprint"], r["edited_fingerprint"])) < 1e-9
        assert abs(r["near_next"] - likeness_of(r["fingerprint"], following["fingerprint"])) < 1e-9


def test_likeness_is_that_of_the_two_fingerprints(spark):
    words = [f"term{i % 97}x{i % 13}" for i in range(5000)]
    rows = [(i, " ".join(words[(i * 37 + j * (i % 7 + 1)) % 5000] for j in range(5 + i * i % 400))) for i in range(80)]
    rows += [(100, ""), (101, None), (102, "one"), (103, "alone in its words"), (104, " ".join(f"own{j}" for j in range(900)))]
    check_likeness(rows_of(spark.createDataFrame(rows, "doc_id long, text string")))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = rows_of(docs)
    check_likeness(got)
    assert all(r["near_edited"] > 0 for r in got if r["n_chars"] > 500)


def test_repetitive_texts_before_texts_of_many_terms(spark):
    """The edit of a text of few terms brings in many; the text is still like its edit."""
    rows = [(2 * i, " ".join(f"line{i}w{j % (1 + i)}" for j in range(900))) for i in range(40)]
    rows += [(2 * i + 1, " ".join(f"many{i}x{j * 7 % 600}" for j in range(1200))) for i in range(40)]
    got = {r["key"]: r for r in rows_of(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert all(got[2 * i]["near_edited"] > 0.2 for i in range(40))
    assert all(got[i]["near_next"] < 0.1 for i in range(80))
