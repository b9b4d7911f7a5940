"""WARC archives with revisit records.

Headers (digest, id, size), never payloads, are shuffled by payload digest; the record
with the smallest id of a digest is the response, the others become revisit records that
name it. Payloads meet their decision in one join by page, unless the revisits are few
enough for Spark to broadcast them. Records are written by Spark's text writer: the two line breaks that end a WARC
record are its line separator. So files appear only when their task has committed, and a
lost executor leaves nothing behind. Reading cuts the files by Content-Length.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.operators.joins import own_exchange
from tablemill.spec import col

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this size are not worth a revisit record.
SMALLEST_REVISIT = 100
# Bytes of an archive aimed at, before compression: a task reads one whole file at a time.
FILE_BYTES = 16_000_000
RECORD = (
    "page_id long, record_type string, uri string, date string, payload_bytes long, "
    "payload_digest string, refers_to long, content_bytes long"
)


def record_id(page: Column) -> Column:
    """URI of a record, from the page id alone: the same on every run."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def resolve_revisits(pages: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """Adds ``payload_digest``, ``payload_bytes``, ``original`` and ``revisit`` to rows of
    ``page_id``, ``url``, ``html``.

    The smallest id per digest is one row per digest, aggregated before the shuffle, so a
    payload that a third of all pages share is one row per task. Pages with the digest of
    one that has no id at all, and repeated rows of the original's id, are responses.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("html"),
        F.sha2(payload, 256).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    headers = pages.select(
        "page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size")
    )
    first = (
        headers.where(F.col("size") >= smallest)
        .groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    decided = (
        headers.where(F.col("size") >= smallest)
        .join(own_exchange(first.select("digest", "original")), "digest")
        .where(F.col("page_id") != F.col("original"))
        .select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "original")
        .distinct()
    )
    same = (F.col("page_id") == F.col("__page")) & (F.col("payload_digest") == F.col("__digest"))
    return rows.join(own_exchange(decided), same, "left").select(
        *rows.columns, "original", F.col("original").isNotNull().alias("revisit")
    )


def record(date: str) -> Column:
    """One record without the line breaks that end it."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    # A header is one line: breaks in an address are percent-encoded.
    url = F.coalesce(F.col("url"), F.lit("urn:none"))
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\0", "%00")):
        url = F.replace(url, F.lit(char), F.lit(code))
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html"))
    headers = [
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(
            F.col("revisit"),
            F.concat(
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("WARC-Refers-To", record_id(F.col("original"))),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF),
        body,
    ]
    return F.concat(*headers)


def write_warc(
    pages: DataFrame,
    path: str,
    date: str = "2024-01-01T00:00:00Z",
    smallest: int = SMALLEST_REVISIT,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Deduplicated archives of ``pages`` (page_id, url, html) below ``path``.

    A null html is an empty payload, a null url is ``urn:none``. A file gets as many
    records as the mean size allows, and is compressed as a whole.
    """
    resolved = resolve_revisits(pages, smallest).select(record(date).alias("value"))
    sizes = pages.agg(F.sum(F.octet_length("html")).alias("bytes"), F.count("*").alias("rows")).first()
    mean = (sizes["bytes"] or 0) / max(1, sizes["rows"]) + 400
    per_file = max(1, int(file_bytes / mean))
    writer = resolved.write.option("lineSep", CRLF * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", per_file).text(path)


def parse_records(data: bytes):
    """(headers, payload) of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split(CRLF)
        if first != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        start = end + 4
        yield headers, data[start : start + size]
        at = start + size + 4


def _page(uri: str | None) -> int | None:
    number = uri[len("<urn:page:") : -1] if uri else "null"
    return None if number == "null" else int(number)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (see ``RECORD``); the digest of a response is computed from the
    payload read, and one that differs from its header is an error. A revisit has no
    payload: its size is null here."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, payload in parse_records(gzip.decompress(content.as_py())):
                    revisit = headers["WARC-Type"] == "revisit"
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                    rows.append((
                        _page(headers["WARC-Record-ID"]), headers["WARC-Type"], headers["WARC-Target-URI"],
                        headers["WARC-Date"], None if revisit else len(payload), digest,
                        _page(headers.get("WARC-Refers-To")), len(payload),
                    ))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                columns = list(zip(*rows)) or [[]] * len(kinds)
                names = [x.split()[0] for x in RECORD.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def archive_index(records: DataFrame) -> DataFrame:
    """Records with the full payload's size: revisits take it from the response they name."""
    responses = records.where("record_type = 'response'").select(
        F.col("page_id").alias("__page"), F.col("payload_digest").alias("__digest"),
        F.col("payload_bytes").alias("__bytes"),
    ).dropDuplicates(["__page", "__digest"])
    same = (F.col("refers_to") == F.col("__page")) & (F.col("payload_digest") == F.col("__digest"))
    return records.join(own_exchange(responses), same, "left").select(
        "page_id",
        F.coalesce("payload_bytes", "__bytes").alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to",
    )
