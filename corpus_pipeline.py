"""Documents to training data: each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm import jaccard_rtree, mixing, queries, runlength_dedup
from visitlake.scratch import via_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = queries.table(spark, sf_dir, "labels")
    scored = queries.quality_scores(docs, labels, COLUMNS)
    return scored.where(F.col("score") >= queries.LEAST_QUALITY).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id, null ids last.

    Documents of one id are ordered by a hash of their text; rows of one id and text by their other columns. A
    text without words is near to nothing: such rows all stay, but those that repeat an id and all else are one.
    """
    docs = docs.select(*COLUMNS)
    has_words = F.coalesce("text", F.lit("")).rlike(mixing.WORD)
    wordless = docs.where(~has_words)
    wordless = wordless.where("doc_id is null").unionByName(wordless.where("doc_id is not null").distinct())
    row = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")
    docs = docs.where(has_words).withColumn("row", row)
    found = via_table(jaccard_rtree.near_duplicates(docs, "row", "text"), "near-duplicates")
    ids = docs.groupBy(F.col("row").alias("key")).agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    rows = via_table(found.select("key", "component_id").distinct().join(ids, "key"), "rows")
    first = (
        rows.groupBy("component_id")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("first"))
        .where("n > 1")
    )
    first = via_table(first.select("component_id", "first"), "first-rows")
    others = rows.join(first, "component_id").where("key <> first").select(F.col("key").alias("row"))
    repeated = rows.where("rows > 1").select(F.col("key").alias("row"))
    others, repeated = via_table(others, "others"), via_table(repeated, "repeated")
    kept = docs.join(others, "row", "left_anti")
    single = kept.join(repeated, "row", "left_anti").select(*COLUMNS)
    united = kept.join(repeated, "row", "left_semi").groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("least"))
    return single.unionByName(united.select("least.*")).unionByName(wordless).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without long strings that occur elsewhere; bytes left of a cut character go too."""
    rest = ["lang", "source"]
    cleaned = runlength_dedup.remove_repeats(docs, "doc_id", "text", keep=rest, as_text=True)
    return cleaned.select(
        F.col("key").alias("doc_id"),
        F.col("kept").alias("text"),
        *rest,
        F.char_length("kept").cast("long").alias("n_chars"),
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    sized = docs.select(*COLUMNS, mixing.word_count(F.col("text")).alias("size"))
    taken = mixing.mix(sized.select("doc_id", "source", "size"))
    times = (
        taken.groupBy("doc_id", "source", "size")
        .agg(F.max("times").alias("times"))
        .where(F.col("times") > 0)
        .select(*[F.col(name).alias(f"of_{name}") for name in ("doc_id", "source", "size")], "times")
    )
    same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in ("doc_id", "source", "size")]
    return (
        sized.join(times, same)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(*COLUMNS)
    )


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of each document, and digest of what they decode to."""
    return queries.bpe_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

#: A trained model and balanced draws are not expressible in SQL; tests/llm checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written as Parquet and read again by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = via_table(stage(spark, docs, sf_dir), "pipeline-stage")
    return STAGES[-1][1](spark, docs, sf_dir)
