"""Document fingerprints by I-Match, from DataFrame functions alone.

Terms of at least ``LEAST_DOCUMENTS`` documents and at most a share of ``MOST_SHARE`` of them (a band of
the inverse document frequencies) are the lexicon. A hash of the term splits it into 2^l randomised subsets, and the
first ``SUBSETS`` of these make a fingerprint: the distinct terms of the text that are in a subset are sorted and
hashed. The level l grows with the number of terms, so that a subset holds few terms of a long text too; a
fingerprint has the hashes of two neighbouring levels, so texts that differ somewhat in length can be compared.
Terms that make up at least 1 / ``MOST_HEAVY`` of a text's words and are not above the band are at most ``MOST_HEAVY``
at every length, so they are hashed in as many subsets without levels. They tell a repetitive text of few terms from
others even where an edit brings in many new ones. Terms below the band are hashed apart; they count only where one of
two texts has no others, such as a text in a language of its own. Likeness is the share of equal hashes among the
subsets that two fingerprints have in common, and needs the two fingerprints alone.

At scale: document frequencies are counted with partial sums in each task. The lexicon grows with the
corpus, so it is a table that Spark broadcasts only if its measured size is small. It meets slim rows of a
document's place and one term, of the few terms that lie in its subsets; texts do not move for it.

Defined results: a null text is empty. A text without any term in its subsets is hashed as the sorted list of all
its words, and is like equal texts only. Equal texts have equal fingerprints, and likeness 1. Columns that are not
named do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.scratch import via_table

SUBSETS = 16
FIRST_LEVEL = 4  # 2^4 subsets
#: Distinct terms from which on the level grows with each doubling.
FIRST_TERMS = 32
MOST_SHARE = 0.2
LEAST_DOCUMENTS = 2
#: Most terms that can each be this share's inverse of a text, and number of their subsets.
MOST_HEAVY = 64
HASH_DIGITS = 8
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Text of a bucket of neighbouring documents, about.
BUCKET_BYTES = 32 << 20
QUANTILES = 64


def words(text: Column) -> Column:
    """Sorted hashes of the lower-case words, repeats included."""
    pieces = F.filter(F.split(F.lower(text), WORD_BREAK), lambda word: word != "")
    return F.sort_array(F.transform(pieces, lambda word: F.xxhash64(word)))


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case words."""
    return F.array_distinct(words(text))


def heavy_terms(sorted_words: Column) -> Column:
    """The distinct terms that are at least 1 / MOST_HEAVY of the words: those that repeat so far back."""
    least = F.ceil(F.size(sorted_words) / F.lit(MOST_HEAVY)).cast("int")
    repeated = F.filter(sorted_words, lambda word, i: F.get(sorted_words, i - least + 1) == word)
    return F.array_distinct(repeated)


def lexicon(texts: DataFrame, text: str, documents: int) -> DataFrame:
    """Rows (term, common): terms whose share of the documents is in the band, and common ones above it."""
    return (
        texts.select(F.explode(terms(F.col(text))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_DOCUMENTS)
        .select("term", (F.col("n") / F.lit(max(documents, 1)) > MOST_SHARE).alias("common"))
    )


def _level(term_count: Column) -> Column:
    doublings = F.floor(F.log2(F.greatest(term_count, F.lit(1)) / F.lit(FIRST_TERMS / 2)))
    return (FIRST_LEVEL + F.greatest(doublings, F.lit(0))).cast("int")


def _cell(term: Column, level: Column) -> Column:
    return F.pmod(term, F.call_function("shiftleft", F.lit(1).cast("long"), level))


def _signatures(kept: Column, level: Column, subsets: int = SUBSETS) -> Column:
    """A hash per subset of the sorted terms in it; empty where no term is."""

    def signature(subset: Column) -> Column:
        own = F.filter(kept, lambda term: _cell(term, level) == subset)
        digits = F.substring(F.lpad(F.hex(F.xxhash64(own)), 16, "0"), 1, HASH_DIGITS)
        return F.when(F.size(own) == 0, "").otherwise(digits)

    return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(subsets - 1).cast("long")), signature)


def _all_empty(side: Column, *names: str) -> Column:
    return F.forall(F.concat(*[side[name] for name in names]), lambda x: x == "")


def _fingerprint(side: Column) -> Column:
    """Fingerprint as text, from a struct (level, low, high, heavy, rare_low, rare_high, whole)."""
    names = ("low", "high", "heavy", "rare_low", "rare_high")
    hashed = F.concat(
        side["level"].cast("string"), F.lit(":"), F.concat_ws(";", *[F.array_join(side[name], ",") for name in names])
    )
    return F.when(_all_empty(side, *names), F.concat(F.lit("w:"), F.hex(side["whole"]))).otherwise(hashed)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that hold terms of either text: those of levels that both
    fingerprints have, and those of heavy terms. Rare terms count instead if one text has no others."""
    none = F.array().cast("array<string>")
    rare = _all_empty(a, "low", "high", "heavy") | _all_empty(b, "low", "high", "heavy")

    def compared(one: Column, other: Column) -> Column:
        low, high = (F.when(rare, one[f"rare_{name}"]).otherwise(one[name]) for name in ("low", "high"))
        levels = (
            F.when(one["level"] == other["level"], F.concat(low, high))
            .when(one["level"] == other["level"] + 1, low)
            .when(one["level"] + 1 == other["level"], high)
            .otherwise(none)
        )
        return F.when(rare, levels).otherwise(F.concat(one["heavy"], levels))

    pairs = F.zip_with(
        compared(a, b), compared(b, a), lambda x, y: F.when((x != "") | (y != ""), (x == y).cast("double"))
    )
    told = F.filter(pairs, lambda x: x.isNotNull())
    total = F.aggregate(told, F.lit(0.0), lambda total, x: total + x)
    share = F.when(F.size(told) > 0, total / F.size(told)).otherwise(0.0)
    return F.when(_fingerprint(a) == _fingerprint(b), 1.0).otherwise(share)


def with_next(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """Rows (bucket, place, laid, key, text, next_text), and the number of documents.

    The next document is that of the next larger key (null keys first, then by text); the first follows the
    last. Documents are dealt by ranges of keys, so each task sorts a range. The first document of each range
    is also laid at the end of the range before, so that what follows a document is always in its range.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    quantiles = [i / QUANTILES for i in range(1, QUANTILES)]
    count, size, least, largest, bounds = rows.agg(
        F.count("*"), F.sum(F.octet_length("text")), F.min("key"), F.max("key"),
        F.percentile_approx("key", quantiles, 10_000),
    ).first()
    parts = max(1, -(-(size or 0) // (BUCKET_BYTES * QUANTILES)))
    rows = rows.withColumn("bucket", _bucket(F.col("key"), least, largest, bounds, parts))
    # The first document of each bucket: its key first, which needs no text.
    keys = rows.groupBy("bucket").agg(F.min("key").alias("first_key"), F.count_if(F.col("key").isNull()).alias("nulls"))
    keys = keys.select(
        F.col("bucket").alias("of"), F.when(F.col("nulls") == 0, F.col("first_key")).alias("first_key")
    )
    keys = via_table(keys, "first-keys")  # one row per bucket; a table, so that its size is known
    firsts = (
        rows.join(keys, (F.col("bucket") == F.col("of")) & F.col("key").eqNullSafe(F.col("first_key")))
        .groupBy("bucket")
        .agg(F.min("text").alias("text"))
    )
    by_bucket = Window.orderBy("bucket")
    laid = firsts.select(
        F.coalesce(
            F.lag("bucket").over(by_bucket),
            F.max("bucket").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("bucket"),
        F.lit(None).cast("long").alias("key"),
        "text",
        F.lit(True).alias("laid"),
    )
    own = rows.select("bucket", "key", "text", F.lit(False).alias("laid"))
    order = Window.partitionBy("bucket").orderBy("laid", F.col("key").asc_nulls_first(), "text")
    placed = (
        own.unionByName(laid)
        .withColumn("place", F.row_number().over(order))
        .withColumn("next_text", F.lead("text", 1, "").over(order))
    )
    return placed.select("bucket", "place", "laid", "key", "text", "next_text"), count


def _bucket(key: Column, least: int | None, largest: int | None, bounds: list[int] | None, parts: int) -> Column:
    """Number of the range that a key is in: quantiles of all keys, each cut into equal widths."""
    if least is None:
        return F.lit(0).cast("long")
    edges = [least, *sorted(set(bounds)), largest + 1]
    edges = sorted(set(edges))
    bucket = F.lit(-1).cast("long")
    for number in range(len(edges) - 1):  # the last range that begins at or below the key counts
        low, width = edges[number], max((edges[number + 1] - edges[number]) / parts, 1)
        part = F.least(F.floor((key - F.lit(low)) / F.lit(float(width))), F.lit(parts - 1))
        bucket = F.when(key >= low, number * parts + part).otherwise(bucket)
    return bucket.cast("long")


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last quarter of characters replaced by the first ones of the next document.
    """
    placed, documents = with_next(docs, key, text)
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    rows = (
        placed.withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter),
                F.substring("next_text", F.lit(1), quarter),
            ),
        )
        .withColumn("edited_sha256", F.sha2("edited", 256))
        .withColumns({"words_a": words(F.col("text")), "words_b": words(F.col("edited"))})
        .withColumns({"a": F.array_distinct("words_a"), "b": F.array_distinct("words_b")})
        .withColumns({"level_a": _level(F.size("a")), "level_b": _level(F.size("b"))})
        .withColumns({"whole_a": F.xxhash64("a"), "whole_b": F.xxhash64("b")})
    )

    def used(side: str) -> list[Column]:
        level = F.col(f"level_{side}")
        return [
            F.filter(F.col(side), lambda term: _cell(term, level) < SUBSETS).alias(f"used_{side}"),
            heavy_terms(F.col(f"words_{side}")).alias(f"heavy_{side}"),
        ]

    slim = via_table(
        rows.select(
            "bucket", "place", "laid", "key", "n_chars", "edited_sha256",
            "level_a", "level_b", "whole_a", "whole_b", *used("a"), *used("b"),
        ),
        "imatch-terms",
    )
    counted = via_table(lexicon(docs, text, documents).withColumnRenamed("term", "counted"), "lexicon")
    looked_up = F.array_distinct(F.concat("used_a", "used_b", "heavy_a", "heavy_b"))
    known = (
        slim.select("bucket", "place", F.explode(looked_up).alias("term"))
        .join(counted, F.col("term") == F.col("counted"))
        .groupBy("bucket", "place")
        .agg(
            F.collect_list(F.when(~F.col("common"), F.col("term"))).alias("known"),
            F.collect_list(F.when(F.col("common"), F.col("term"))).alias("common"),
        )
    )
    none = F.array().cast("array<long>")
    found = slim.join(known, ["bucket", "place"], "left").withColumns(
        {name: F.coalesce(name, none) for name in ("known", "common")}
    )

    # Columns of their own, so that each subset does not look all of them up again.
    for name in "ab":
        found = found.withColumns({
            f"kept_{name}": F.array_intersect(f"used_{name}", "known"),
            f"rare_{name}": F.array_except(F.array_except(f"used_{name}", "known"), "common"),
            f"most_{name}": F.array_except(f"heavy_{name}", "common"),
        })

    def side(name: str) -> Column:
        level, kept, rare = F.col(f"level_{name}"), F.col(f"kept_{name}"), F.col(f"rare_{name}")
        return F.struct(
            level.alias("level"),
            _signatures(kept, level).alias("low"),
            _signatures(kept, level + 1).alias("high"),
            _signatures(F.col(f"most_{name}"), F.lit(MOST_HEAVY.bit_length() - 1), MOST_HEAVY).alias("heavy"),
            _signatures(rare, level).alias("rare_low"),
            _signatures(rare, level + 1).alias("rare_high"),
            F.col(f"whole_{name}").alias("whole"),
        )

    signed = found.select(
        "bucket", "place", "laid", "key", "n_chars", "edited_sha256",
        side("a").alias("own"), side("b").alias("changed"),
    )
    following = F.lead("own").over(Window.partitionBy("bucket").orderBy("place"))
    return signed.withColumn("following", following).where(~F.col("laid")).select(
        "key",
        "n_chars",
        "edited_sha256",
        _fingerprint(F.col("own")).alias("fingerprint"),
        _fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
