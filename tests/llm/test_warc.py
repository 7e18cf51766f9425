import gzip
import glob
import hashlib

import pytest
from helpers import sha

from cardamom.llm.warc import find_revisits, page_records, read_archives, resolve, write_archives
from cardamom.session import shared_dir


def round_trip(spark, pages, **options):
    path = shared_dir(spark, "warc")
    write_archives(page_records(pages), path, **options)
    return path, resolve(read_archives(spark, path))


def test_revisits_and_payloads(spark):
    big, other = "<p>é" * 60, "x\r\n\r\nWARC/1.1\r\n" * 20
    pages = [(5, "http://a/5", big), (2, "http://a/2", big), (9, "http://a/9", big), (3, None, other), (4, "u\r\nX: y", other), (6, "u6", "small"), (7, "u7", "small"), (8, "u8", None), (1, "u1", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path, found = round_trip(spark, df, file_bytes=600)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()}
    first = {big: 2, other: 3}
    for i, _, html in pages:
        html = html or ""
        least = first.get(html, i)
        assert got[i] == (len(html.encode()), sha(html), "response" if least == i else "revisit", None if least == i else least)
    # The stored payloads are those of the responses, byte by byte.
    stored = {r.page_id: bytes(r.payload) for r in read_archives(spark, path).where("type = 'response'").collect()}
    assert stored == {i: (h or "").encode() for i, _, h in pages if got[i][2] == "response"}
    targets = {r.page_id: r.target for r in found.collect()}
    assert targets[2] == "http://a/2" and targets[3] is None and targets[4] == "u%0D%0AX: y"
    files = glob.glob(f"{path}/*.gz")
    raw = [gzip.open(f).read() for f in files]
    assert len(files) > 1 and sum(x.count(b"WARC-Type: revisit\r\n") for x in raw) == 3
    assert all(x.startswith(b"WARC/1.1\r\n") and x.endswith(b"\r\n\r\n") for x in raw if x)


def test_odd_rows(spark):
    same = "y" * 100
    pages = [(1, "u", same), (1, "u", same), (None, "n", same), (None, "m", same), (4, "u", same), (5, "u", "z" * 99), (6, "u", "z" * 99)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as payload")
    _, found = round_trip(spark, df)
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in found.collect()), key=repr)
    assert got == sorted([(1, "response", None), (1, "response", None), (None, "revisit", 1), (None, "revisit", 1), (4, "revisit", 1), (5, "response", None), (6, "response", None)], key=repr)
    _, none = round_trip(spark, df.where("false"))
    assert none.count() == 0
    assert find_revisits(page_records(df.where("page_id is null"))).count() == 0


def test_large_payloads_and_a_missing_response(spark):
    text = hashlib.sha256(b"").hexdigest() * 100_000
    df = spark.createDataFrame([(1, "u", text), (2, "v", text)], "page_id long, url string, html string")
    path, found = round_trip(spark, df)
    assert {(r.page_id, r.payload_bytes, r.refers_to) for r in found.collect()} == {(1, len(text), None), (2, len(text), 1)}
    alone = resolve(read_archives(spark, path).where("type = 'revisit'")).collect()
    assert [(r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in alone] == [(2, None, sha(text), None)]


def test_damaged_archive_stops(spark, tmp_path):
    with gzip.open(tmp_path / "part.gz", "wb") as f:
        f.write(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort")
    with pytest.raises(Exception, match="ends inside"):
        read_archives(spark, str(tmp_path)).collect()
