"""Content-addressed WARC archive, by DataFrame functions only.

An archive is two tables below one folder:

- ``payloads``: every distinct payload once, under its SHA-256.  The aggregate
  that stores it also compares the bytes of all copies (their smallest and
  largest must be equal), so that a digest stands for one payload, proven.
- ``records``: one row for each page with the record's exact header bytes (WARC
  header and the captured HTTP header), its address and no payload.

Joins on the address give the original records back; ``export`` writes them as
WARC files and ``read_files`` reads WARC files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, table
from tidemark.session import shared_dir

#: Smaller payloads are always stored as responses.
REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
RECORD_ID = "urn:tidemark:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def sha256(payload: Column) -> Column:
    return F.sha2(payload, 256)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; control characters of
    the value are percent-encoded, so that it can't end the line."""
    safe = value.cast("string")
    for code in (*range(0x20), 0x7F):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{RECORD_ID}"), F.url_encode(page_id.cast("string")), F.lit(">"))


def _heads(page_id: str, first: str, kind: Column, digest: Column, size: Column, date: str) -> Column:
    """WARC header and HTTP header of a record, without payload."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _line("Content-Type", F.lit("text/html; charset=utf-8")),
                    _line("Content-Length", size), F.lit("\r\n"))
    block = F.length(http) + F.when(kind == "response", size).otherwise(0)
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.coalesce(_urn(F.col(page_id)), F.lit(f"<{RECORD_ID}>"))),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(kind == "revisit", F.concat(_line("WARC-Refers-To", _urn(F.col(first))),
                                           _line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block), F.lit("\r\n"), http).cast("binary")


def archive(pages: DataFrame, root: str, address=sha256, date: str = DATE) -> str:
    """Write the archive of ``page_id, url, html`` below ``root``; returns it.

    A null html is an empty payload, a null url gives no target line, a null id an
    empty record id.  Of records with equal payloads of ``REVISIT_BYTES`` or more,
    those with the smallest id that isn't null are responses (rows that repeat an
    id and a payload alike); if no id is there, all are.  The others are revisits
    of it.  Other columns are not read; an empty table gives an archive without
    records.  Different payloads under one address stop the job.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("_payload"))
    rows = rows.withColumn("_address", address(F.col("_payload")))
    # each payload once: copies meet in the tasks that read them, then by address
    same = F.min("_payload") == F.max("_payload")
    stored = rows.groupBy("_address").agg(
        F.min("_payload").alias("payload"), F.min("page_id").alias("first"), same.alias("same"))
    stored.select(
        F.when(F.col("same"), F.col("_address")).otherwise(F.raise_error(F.concat(
            F.lit("different payloads under one address: "), F.col("_address").cast("string")))).alias("address"),
        "first", "payload").write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/payloads")
    firsts = _read(pages.sparkSession, f"{root}/payloads").select(F.col("address").alias("_address"), "first")
    slim = rows.select("page_id", "url", "_address", F.length("_payload").cast("long").alias("_size"),
                       sha256(F.col("_payload")).alias("_digest")).join(firsts, "_address")
    again = (F.col("_size") >= REVISIT_BYTES) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    slim.select("page_id", F.col("_address").alias("address"),
                _heads("page_id", "first", kind, F.col("_digest"), F.col("_size"), date).alias("head")).write.mode(
        "overwrite").option("compression", "zstd").parquet(f"{root}/records")
    return root


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def field(name: str, head: str = "head") -> Column:
    """A line's value in a record's WARC header; null without that line."""
    got = F.regexp_extract(F.col(head).cast("string"), rf"^WARC/1\.1\r\n(?:[^\r\n]+\r\n)*?{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.col(head).cast("string").rlike(rf"^WARC/1\.1\r\n(?:[^\r\n]+\r\n)*?{name}: "), got)


def named(urn: Column, kind: str) -> Column:
    """The page id of a record id."""
    text = F.url_decode(F.regexp_extract(urn, rf"^<{RECORD_ID}(.*)>$", 1))
    return F.when(F.length(text) > 0, text).cast(kind)


def records(spark: SparkSession, root: str) -> DataFrame:
    """The original records: ``page_id, record_type, refers_to`` (as the header
    says), ``head, payload`` (bytes), put together again on the address.  A
    revisit's payload is that of the record it refers to."""
    rows = _read(spark, f"{root}/records")
    kind = dict(rows.dtypes)["page_id"]
    whole = rows.join(_read(spark, f"{root}/payloads").select("address", "payload"), "address")
    return whole.select("page_id", field("WARC-Type").alias("record_type"),
                        named(field("WARC-Refers-To"), kind).alias("refers_to"), "head", "payload")


# ------------------------------------------------------------------ files

def export(spark: SparkSession, root: str, path: str, records_per_file: int = 10_000) -> None:
    """Write the archive as uncompressed WARC files below ``path``: a revisit
    without payload, each record ended by two line ends."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    records(spark, root).select(F.concat("head", block).cast("string").alias("value")).write.mode("overwrite").option(
        "lineSep", _END).option("maxRecordsPerFile", records_per_file).text(path)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, payload) of the records of whole files."""
    for batch in batches:
        for content in batch.column(0):
            data, at = content.as_buffer().to_pybytes(), 0
            while at < len(data):
                end = data.index(_END.encode(), at) + len(_END)
                lines = data[at:end].decode("utf-8", "replace").split("\r\n")
                size = int(next(x for x in lines if x.lower().startswith("content-length:")).split(":")[1])
                stop = end + size
                http = data.index(_END.encode(), end, stop) + len(_END)
                if data[stop: stop + len(_END)] != _END.encode():
                    raise ValueError(f"record at byte {at} has no end at byte {stop}")
                yield pa.RecordBatch.from_arrays([pa.array([data[at:http]], pa.binary()),
                                                  pa.array([data[http:stop]], pa.binary())], ["head", "payload"])
                at = stop + len(_END)


def read_files(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """``page_id, record_type, refers_to, head, payload`` of the WARC files of HTTP
    responses and revisits below ``path`` (a file is read whole: ``records_per_file``
    bounds it); a revisit has an empty payload."""
    rows = arrow(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content"),
                 _parse, "head binary, payload binary")
    return rows.select(named(field("WARC-Record-ID"), kind).alias("page_id"), field("WARC-Type").alias("record_type"),
                       named(field("WARC-Refers-To"), kind).alias("refers_to"), "head", "payload")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = archive(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return records(spark, root).select(
        "page_id", F.length("payload").cast("long").alias("payload_bytes"),
        sha256(F.col("payload")).alias("payload_digest"), "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d,
                  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM p
"""
