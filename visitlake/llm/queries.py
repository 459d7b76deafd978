"""The operators applied to whole tables, as registered by the driver's entry file."""

from __future__ import annotations

from collections.abc import Sequence

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm import (
    byte_bpe,
    collocations,
    imatch,
    jaccard_rtree,
    language,
    mixing,
    quality_fm,
    ranked_search,
    runlength_dedup,
    simhash_vptree,
    url_rules,
    voronoi,
    warc,
)
from visitlake.scratch import new_scratch_path

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_digests(documents: DataFrame) -> DataFrame:
    """Token count and digests of the ids and of the bytes that they decode to."""
    ids = byte_bpe.encode(documents, "text", BPE_RANKS, public_tokenizers.PATTERN, ["doc_id"])
    with_ids = ids.withColumn("ids_sha256", F.sha2("ids", 256)).withColumn(
        "n_tokens", (F.octet_length("ids") / 4).cast("long")
    )
    decoded = byte_bpe.decode(with_ids, "ids", BPE_RANKS, ["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


#: The listed URL rules.
URL_RULES = (
    url_rules.ListedRule("block", "net", "/"),
    url_rules.ListedRule("allow", "example.net", "/en/"),
    url_rules.ListedRule("block", "example.com", "/de/"),
    url_rules.ListedRule("allow", "org", "/fr/"),
)


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (url, bad). A page shows the document whose number ends its path; the page is bad if
    that document is labelled as of low quality or toxic."""
    number = F.regexp_extract(url_rules.url_path(F.col("url")), "/([0-9]{1,18})(?:/|[.]html)?$", 1)
    shown = pages.select("url", number.try_cast("long").alias("doc_id"))
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.select("doc_id", bad.alias("bad")).groupBy("doc_id").agg(F.max("bad").alias("bad"))
    return shown.join(known, "doc_id").select("url", "bad")


def remainder(key: str, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``: which rows are held out from learning."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % by


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents, "doc_id", "text", "lang", remainder("doc_id", 4) != 2)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return language.predict(documents, "doc_id", "text", model).select(
        F.col("key").alias("doc_id"), "lang_pred", "score"
    ).select("doc_id", held_out, "lang_pred", "score")


#: Documents with a lower quality score are rejected.
LEAST_QUALITY = 0.3


def quality_scores(documents: DataFrame, labels: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns in ``keep`` and the score of each document, by a model of the labelled ones."""
    model = quality_fm.train(
        documents, labels, "doc_id", "text", "n_chars", "quality", remainder("doc_id", 5) != 0
    )
    return quality_fm.score(documents, "text", "n_chars", model, keep)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scores = quality_scores(documents, table(spark, sf_dir, "labels"), ["doc_id"])
    return scores.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = url_rules.mine_rules(
        labelled_urls(pages, table(spark, sf_dir, "labels")), "url", "bad"
    )
    return url_rules.judge(pages, "page_id", "url", URL_RULES, rules).select(
        F.col("key").alias("page_id"), "host", "path", "rule", "verdict", "confidence"
    )


def op2_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_rtree.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumnRenamed("key", "doc_id")


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("key").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op9_runlength_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = runlength_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return cleaned.select(
        F.col("key").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("removed"),
    )


def op10_voronoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_query = F.col("vec_id") % 100 == 0
    return voronoi.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", is_query)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size")
    )
    taken = (F.col("times") * F.col("size")).alias("taken")
    return mixing.mix(units).select("doc_id", "size", "source_size", "target", taken)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    records = warc.with_original_keys(warc.read_archives(spark, path))
    return records.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.top_documents(
        table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text"
    )
    return found.select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), "lang", "text")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_vptree.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumnRenamed("key", "doc_id")


QUERIES = {
    "op1_language": op1_language,
    "op2_jaccard_rtree": op2_jaccard_rtree,
    "op3_url_rules": op3_url_rules,
    "op4_imatch": op4_imatch,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_runlength_dedup": op9_runlength_dedup,
    "op10_voronoi": op10_voronoi,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_simhash": op13_simhash,
}

#: DuckDB SQL for the queries that SQL can express; tests/llm compares the others with brute force.
ORACLE_SQL = {
    "op2_jaccard_rtree": """
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(w) >= 5
                     THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
            FROM words),
        sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * k >= 75 * (x.n + y.n - k)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
        JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
    """,
    "op7_warc": """
        WITH stored AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        originals AS (
            SELECT payload_digest, max(page_id) AS original FROM stored
            WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < original THEN original END AS refers_to
        FROM stored LEFT JOIN originals USING (payload_digest)
    """,
    "op10_voronoi": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
            FROM whole q JOIN whole d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
            WHERE q.vec_id % 100 = 0),
        ranked AS (
            SELECT query_id, vec_id, score, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_ranked_search": """
        WITH item_terms AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM benchmark),
        docs AS (
            SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents),
        sized AS (SELECT row_no, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
        totals AS (SELECT CAST(COUNT(*) AS BIGINT) AS docs, CAST(SUM(n) AS BIGINT) AS words FROM sized),
        places AS (SELECT row_no, unnest(terms) AS term FROM sized),
        postings AS (
            SELECT row_no, term, COUNT(*) AS tf FROM places
            WHERE term IN (SELECT term FROM item_terms) GROUP BY row_no, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, COUNT(*) AS df FROM postings GROUP BY term), totals),
        impacts AS (
            SELECT p.row_no, s.doc_id, p.term,
                   w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * s.n * docs) // words))) AS impact
            FROM postings p JOIN sized s ON s.row_no = p.row_no JOIN weights g ON g.term = p.term, totals),
        scored AS (
            SELECT item_id, row_no, doc_id, CAST(SUM(impact) AS BIGINT) AS score
            FROM item_terms t JOIN impacts i ON i.term = t.term GROUP BY item_id, row_no, doc_id
            HAVING SUM(impact) > 0),
        ranked AS (
            SELECT item_id, doc_id, score, CAST(row_number() OVER (
                PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
            FROM scored)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op12_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, size, unnest(list_transform(
                range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
            FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size),
        counts AS (SELECT lang, size, phrase, COUNT(*) AS f FROM grams GROUP BY lang, size, phrase),
        totals AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
        candidates AS (
            SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 30),
        cuts AS (
            SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
            FROM candidates, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
                   CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
            FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
            JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest),
        lowest AS (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
        inside AS (
            SELECT c.lang, c.a AS longer, array_to_string(c.w[i:i + m - 1], ' ') AS phrase
            FROM candidates c, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS m)
            WHERE m < size AND i + m - 1 <= size),
        most AS (SELECT lang, phrase, MAX(longer) AS longer FROM inside GROUP BY lang, phrase),
        kept AS (
            SELECT s.* FROM lowest s LEFT JOIN most m ON m.lang = s.lang AND m.phrase = s.phrase
            WHERE s.place = 1 AND (m.longer IS NULL
                OR CAST(100 AS HUGEINT) * m.longer < CAST(80 AS HUGEINT) * s.a)),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank
            FROM kept)
        SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
        FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
    """,
}
