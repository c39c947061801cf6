import base64
import gzip
import hashlib

import pytest

from ratings_engine.llm import warc
from ratings_engine.sources import storage

PAGES = [(1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, None, None), (4, "http://d\r\nX: y", ""),
         (5, "http://e/", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n"), (None, "http://n/", "<p>same</p>"),
         (6, "http://f/", "ü" * 5000), (7, "http://g/", "twice"), (7, "http://g/", "twice")]
SCHEMA = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_pages_survive_the_archive(spark):
    got = warc.archive_pages(spark.createDataFrame(PAGES, SCHEMA)).collect()
    assert len(got) == len(PAGES)
    for r in got:
        html = next(h for p, _, h in PAGES if p == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), digest(html))
        assert r.digest_ok in (True, None)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got)
    assert kinds == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (3, "revisit", 4),
                     (4, "response", None), (5, "response", None), (6, "response", None),
                     (7, "response", None), (7, "revisit", 7)]


def test_archives_are_gzip_files_of_records(spark, tmp_path):
    plain, compact = str(tmp_path / "plain"), str(tmp_path / "compact")
    warc.write_pages(spark.createDataFrame(PAGES, SCHEMA), plain)
    warc.deduplicate(spark, plain, compact)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "compact").glob("part-*"))
    assert data.count(b"WARC-Type: revisit\r\n") == 4 and data.count(b"WARC-Refers-To: <urn:uuid:") == 4
    assert b"\r\nX: y\r\n" not in data and data.endswith(b"\r\n\r\n")
    payloads = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, compact).collect() if r.payload is not None}
    assert payloads[6] == "ü" * 5000 and payloads[5] == PAGES[4][2] and 1 not in payloads
    again = str(tmp_path / "again")
    warc.deduplicate(spark, compact, again)
    key = lambda r: (str(r.page_id), r.record_type, r.payload_bytes, str(r.refers_to))
    first, second = (sorted(map(key, warc.resolve(warc.read(spark, p)).collect())) for p in (compact, again))
    assert first == second


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text", ["", "abc", "é"])
def test_digest(spark, text):
    from pyspark.sql import functions as F
    assert spark.range(1).select(warc.base32_digest(F.lit(text)).alias("d")).first().d == digest(text)
    assert storage.scratch_path(spark, "x")
