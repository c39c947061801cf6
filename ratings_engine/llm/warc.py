"""WARC archives: write pages, read records, resolve revisits by payload digest.

Archives are folders of gzip files of WARC 1.1 records. Spark's text writer puts the blank line that
ends a record, so files are committed and retried like any Spark output and may lie in any store.
Reading takes whole files (their number of records is bounded on writing) and goes by
Content-Length, so payloads may hold anything.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratings_engine.llm.common import staged
from ratings_engine.sources import storage

RECORDS_PER_FILE = 2000
DATE = "2026-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = ("record_id string, page_id bigint, url string, record_type string, payload_digest string, "
          "payload_bytes bigint, refers_to_record string, refers_to_page bigint, digest_ok boolean, "
          "payload binary")


def base32_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are 20 bits, that is four letters."""
    hexed = F.sha1(payload)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(hexed, 1 + 5 * group, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1))
                    for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def _header(name: str, value: Column) -> Column:
    """A header line; none for null. Line ends in a value would end the header and are escaped."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record(revisit: Column) -> Column:
    """The record of a row with record_id, page_id, url, payload, payload_digest, original_*."""
    block = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    only_revisit = lambda value: F.when(revisit, value)
    urn = lambda name: F.concat(F.lit("<urn:uuid:"), F.col(name), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", urn("record_id")), _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.col("url")), _header("X-Page-ID", F.col("page_id")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", only_revisit(F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", only_revisit(urn("original_record"))),
        _header("X-Refers-To-Page-ID", only_revisit(F.col("original_page"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(block)), F.lit("\r\n"), block)


def _write(records: DataFrame, path: str) -> None:
    (records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def write_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                html: str = "html") -> None:
    """One response record per row; null html is an empty payload, null id or url an absent header."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("payload"))
    rows = rows.withColumns({"record_id": F.uuid(), "payload_digest": base32_digest(F.col("payload")),
                             "original_record": F.lit(None).cast("string"),
                             "original_page": F.lit(None).cast("bigint")})
    _write(rows.select(_record(F.lit(False)).alias("value")), path)


def _records_of(content: bytes, with_payload: bool):
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
        length = int(head["content-length"])
        block = data[end + 4:end + 4 + length]
        at = end + 4 + length + 4
        payload = block.partition(b"\r\n\r\n")[2]
        plain = lambda urn: urn and urn.removeprefix("<urn:uuid:").removesuffix(">")
        number = lambda value: None if value is None else int(value)
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        revisit = head["warc-type"] == "revisit"
        yield {"record_id": plain(head.get("warc-record-id")), "page_id": number(head.get("x-page-id")),
               "url": head.get("warc-target-uri"), "record_type": head["warc-type"], "payload_digest": digest,
               "payload_bytes": None if revisit else len(payload),
               "refers_to_record": plain(head.get("warc-refers-to")),
               "refers_to_page": number(head.get("x-refers-to-page-id")),
               "digest_ok": None if revisit
               else base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest,
               "payload": payload if with_payload and not revisit else None}


ARROW = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                   ("record_type", pa.string()), ("payload_digest", pa.string()),
                   ("payload_bytes", pa.int64()), ("refers_to_record", pa.string()),
                   ("refers_to_page", pa.int64()), ("digest_ok", pa.bool_()), ("payload", pa.binary())])


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all files below path, one row each."""

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                found = list(_records_of(content.as_py(), with_payload))
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def deduplicate(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite an archive so that of records with equal payloads one keeps it and the others revisit it.

    The response with the largest page_id keeps the payload (without ids, or with equal ids, the
    largest record id). Revisits of the input take the new original of their digest; where the
    archive holds no response for it, they stay as they are. Headers decide: only they are shuffled
    by digest, a hot digest is split by adaptive skew joins, and payloads move once, by record id."""
    headers = read(spark, source, with_payload=False)
    originals = (headers.where("record_type = 'response'").groupBy("payload_digest")
                 .agg(F.max(F.struct("page_id", "record_id")).alias("best")))
    decisions = (headers.select("record_id", "payload_digest", "record_type", "refers_to_record",
                                "refers_to_page")
                 .join(originals, "payload_digest", "left")
                 .select("record_id",
                         ((F.col("record_type") == "revisit")
                          | (F.coalesce(F.col("best.record_id"), F.lit("")) != F.col("record_id"))).alias("revisit"),
                         F.coalesce("best.record_id", "refers_to_record").alias("original_record"),
                         F.when(F.col("best").isNull(), F.col("refers_to_page"))
                         .otherwise(F.col("best.page_id")).alias("original_page")))
    records = (read(spark, source).select("record_id", "page_id", "url", "payload_digest",
                                          F.coalesce(F.col("payload").cast("string"), F.lit("")).alias("payload"))
               .join(decisions, "record_id"))
    _write(records.select(_record(F.col("revisit")).alias("value")), target)


def resolve(records: DataFrame) -> DataFrame:
    """Records with payload_bytes of the full payload and refers_to (the response's page_id): every
    revisit joined to the response of its digest."""
    originals = (records.where("record_type = 'response'").groupBy("payload_digest")
                 .agg(F.max(F.struct("page_id", "payload_bytes")).alias("original")))
    revisit = F.col("record_type") == "revisit"
    return (records.drop("payload").join(originals, "payload_digest", "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "original.payload_bytes"))
            .withColumn("refers_to", F.when(revisit, F.coalesce("original.page_id", "refers_to_page")))
            .drop("original", "refers_to_page"))


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                  html: str = "html") -> DataFrame:
    """Write pages as an archive, deduplicate it, read it back and resolve its revisits.

    One row per page. Repeated rows are separate records: one of them is the response. Empty payloads
    are payloads like any other. An empty table gives an empty archive and no rows."""
    spark = pages.sparkSession
    plain, compact = (storage.scratch_path(spark, name) for name in ("warc-pages", "warc"))
    write_pages(pages, plain, page_id, url, html)
    deduplicate(spark, plain, compact)
    return resolve(staged(read(spark, compact, with_payload=False).drop("payload"), "warc-records")
                   .withColumn("payload", F.lit(None)))
