"""WARC archives in which a payload is stored once and its copies are revisit records.

Headers (key, digest, length) are grouped by payload digest; the payloads stay where they are.
The largest key of a digest is the original response, the others revisit it. The resolved list is
written and joined to the rows again by key and digest, so Spark may broadcast it if its measured
size is small and shuffles otherwise. A digest that a third of all rows share is reduced within
each task before its shuffle, and the join back is split by adaptive execution.

Records are written with Spark's text writer, which ends each with the two line ends that close a
WARC record. They are read by Content-Length, so a payload may hold anything, also record headers.

Defined results: a null payload is an empty one. A null key is always a response and nothing refers to it.
Rows that repeat key and payload of an original are responses too. A null address has no
WARC-Target-URI; control characters in an address become blanks. An empty table gives empty archives.
Columns that are not named do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm.arrow import map_batches
from visitlake.scratch import via_table

CRLF = "\r\n"
END_OF_RECORD = CRLF * 2
RESPONSE, REVISIT = "response", "revisit"
#: Fixed values of the WARC format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "record_id string, key long, record_type string, payload_bytes long, payload_digest string, "
    "refers_to_record string, target_uri string"
)


def with_headers(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Rows (key, url, payload, digest, bytes)."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    return pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
        F.sha1(body.cast("binary")).alias("digest"),
        F.octet_length(body).cast("long").alias("bytes"),
    )


def resolve_revisits(headers: DataFrame, least_bytes: int) -> DataFrame:
    """Rows (key, digest, original) for each header that repeats the payload of a larger key."""
    long_enough = headers.where((F.col("bytes") >= least_bytes) & F.col("key").isNotNull()).select(
        "key", "digest"
    )
    originals = (
        long_enough.groupBy("digest")
        .agg(F.max("key").alias("original"), F.min("key").alias("least"))
        .where(F.col("least") < F.col("original"))
        .select("digest", "original")
    )
    return (
        long_enough.join(originals, "digest")
        .where(F.col("key") < F.col("original"))
        .select("key", "digest", "original")
        .distinct()
    )


def write_archives(
    pages: DataFrame,
    path: str,
    key: str,
    url: str,
    payload: str,
    least_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
    archive_bytes: int = 32 << 20,
) -> None:
    """Write one record per row; payloads shorter than ``least_bytes`` are never revisits.

    ``archive_bytes`` is the aim for the size of a file: it sets the records per file.
    """
    rows = with_headers(pages, key, url, payload)
    revisits = via_table(resolve_revisits(rows, least_bytes), "revisits")
    mean = rows.agg(F.avg(F.col("bytes") + 700)).first()[0] or 1
    (
        rows.join(revisits, ["key", "digest"], "left")
        .select(_record(date).alias("value"))
        .write.option("lineSep", END_OF_RECORD)
        .option("maxRecordsPerFile", max(1, int(archive_bytes / mean)))
        .text(path)
    )


def _record(date: str) -> Column:
    is_revisit = F.col("original").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END_OF_RECORD),
    )
    block_bytes = F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("bytes"))
    uri = F.regexp_replace("url", "[\\x00-\\x1F\\x7F]", " ")
    lines = F.concat_ws(
        CRLF,
        F.lit(VERSION),
        _line("WARC-Type", F.when(is_revisit, REVISIT).otherwise(RESPONSE)),
        _line("WARC-Record-ID", _record_id(F.col("key"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(is_revisit, SAME_PAYLOAD)),
        _line("WARC-Refers-To", F.when(is_revisit, _record_id(F.col("original")))),
        _line("X-Record-Key", F.col("key").cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block_bytes.cast("string")),
    )
    return F.concat(
        lines, F.lit(END_OF_RECORD), http, F.when(is_revisit, "").otherwise(F.col("payload"))
    )


def _line(name: str, value: Column) -> Column:
    """A header line; null, and so left out, where the value is null."""
    return F.concat(F.lit(f"{name}: "), value)


def _record_id(key: Column) -> Column:
    digits = F.md5(F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("")), "digest"))
    shape = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"
    return F.regexp_replace(digits, shape, "<urn:uuid:$1-$2-$3-$4-$5>")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, as ``RECORDS``.

    The digest of a response is taken from the payload that was read and must be that of its
    header; a revisit has the digest and length that its headers state.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return map_batches(files.select("content"), _parse_batches, RECORDS)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in RECORDS.split(", ")]
    kinds = [pa.int64() if name in ("key", "payload_bytes") else pa.string() for name in names]
    for batch in batches:
        for content in batch.columns[0]:
            rows = list(_parse(content.as_buffer()))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names
            )


def _parse(buffer: pa.Buffer) -> Iterator[tuple]:
    data, at = buffer.to_pybytes(), 0
    end_of_head = END_OF_RECORD.encode()
    while at < len(data):
        blank = data.index(end_of_head, at)
        first, *lines = data[at:blank].decode().split(CRLF)
        if first != VERSION:
            raise ValueError(f"no record starts at byte {at}: {first[:40]!r}")
        head = dict(line.split(": ", 1) for line in lines)
        start = blank + len(end_of_head)
        at = start + int(head["Content-Length"])
        payload_start = data.index(end_of_head, start) + len(end_of_head)
        http = data[start:payload_start].decode().split(CRLF)
        stated = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == RESPONSE:
            payload = data[payload_start:at]
            length, digest = len(payload), hashlib.sha1(payload).hexdigest()
            if digest != stated:
                raise ValueError(f"{head['WARC-Record-ID']} holds {digest}, its header says {stated}")
        else:
            length = next(int(x.split(": ")[1]) for x in http if x.startswith("Content-Length"))
            digest = stated
        key = head.get("X-Record-Key")
        yield (
            head["WARC-Record-ID"],
            None if key is None else int(key),
            head["WARC-Type"],
            length,
            digest,
            head.get("WARC-Refers-To"),
            head.get("WARC-Target-URI"),
        )
        at += len(end_of_head)


def with_original_keys(records: DataFrame) -> DataFrame:
    """The records and ``refers_to``, the key of the response that a revisit refers to.

    A response looks up itself, so that no join key is null or shared by all responses.
    """
    responses = (
        records.where(F.col("record_type") == RESPONSE)
        .select(F.col("record_id").alias("__of"), F.col("key").alias("__original"))
        .distinct()
    )
    looked_up = F.coalesce("refers_to_record", "record_id")
    return (
        records.withColumn("__look_up", looked_up)
        .join(responses, F.col("__look_up") == F.col("__of"), "left")
        .withColumn("refers_to", F.when(F.col("record_type") == REVISIT, F.col("__original")))
        .drop("__look_up", "__of", "__original")
    )
