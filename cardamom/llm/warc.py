"""WARC archives without repeated payloads.

Only headers are shuffled to find repeats: records are grouped by payload
digest, the smallest id of a digest becomes the response, and the others are
joined to it and written as revisit records with fresh headers that refer to
it.  Reading resolves each revisit by joining it to its response's headers.

Archives are written by Spark's text sink (its commit protocol makes lost
tasks harmless): one string per record, and the blank lines between records
are the line separator.  Each file is one gzip stream.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.llm.common import column, row_places, written

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "record_id string, type string, target string, page_id long, digest string, refers_to string, payload binary"


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Records of pages: record_id, page_id, target, payload, payload_bytes, digest.

    A NULL body is empty; bodies are kept whole, however long.  Equal rows of a
    stored table are records with ids of their own; those of other frames share
    one.  An empty table gives no records.
    """
    body = F.coalesce(column(pages, body_col), F.lit("")).cast("string")
    rows = pages.select(
        column(pages, id_col).cast("long").alias("page_id"),
        column(pages, url_col).cast("string").alias("target"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
        F.array(*(x.cast("string") for x in row_places(pages))).alias("place"),
    )
    key = F.md5(F.to_json(F.struct("page_id", "target", "digest", "place")))
    uuid = F.regexp_replace(key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return rows.select(F.concat(F.lit("urn:uuid:"), uuid).alias("record_id"), *rows.columns[:-1])


def find_revisits(records: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(record_id, refers_to, refers_to_target) of the records whose payload a smaller page has.

    Payloads of fewer than ``min_bytes`` are never revisits.  Records without
    a page id come last; records of the same page, or of none, are not revisits
    of each other.
    """
    headers = records.where(F.col("payload_bytes") >= min_bytes).select("record_id", "page_id", "target", "digest", "payload_bytes")
    firsts = (
        headers.groupBy("digest", "payload_bytes")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "record_id", "target")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    return (
        headers.join(firsts.drop("n"), ["digest", "payload_bytes"])
        .where((F.col("record_id") != F.col("first.record_id")) & ~F.col("page_id").eqNullSafe(F.col("first.page_id")))
        .select("record_id", F.col("first.record_id").alias("refers_to"), F.col("first.target").alias("refers_to_target"))
        .dropDuplicates(["record_id"])
    )


def _field(name: str, value: Column) -> Column:
    """A header line, or NULL (left out) where there is no value; control characters are percent-encoded."""
    clean = value.cast("string")
    for code in ("%0D", "%0A"):
        clean = F.replace(clean, F.lit(chr(int(code[1:], 16))), F.lit(code))
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean))


def _record_text(date: str) -> Column:
    revisit = F.col("refers_to").isNotNull()
    http = F.concat_ws(
        CRLF,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        _field("Content-Length", F.col("payload_bytes")),
        F.lit(CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: <"), "record_id", F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        _field("WARC-Target-URI", F.col("target")),
        _field("X-Page-ID", F.col("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <"), "refers_to", F.lit(">"))),
        F.when(revisit, _field("WARC-Refers-To-Target-URI", F.col("refers_to_target"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
    )
    return F.concat(head, block).alias("value")


def write_archives(records: DataFrame, path: str, min_bytes: int = 100, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 32 << 20) -> None:
    """Write records (as of ``page_records``) as WARC files of about ``file_bytes``, repeats as revisits."""
    spark = records.sparkSession
    total = records.agg(F.coalesce(F.sum(F.col("payload_bytes") + 512), F.lit(0))).first()[0]
    parallel = spark.sparkContext.defaultParallelism
    files = max(1, -(-int(total) // file_bytes), min(parallel, int(total) // (file_bytes // 8)))
    revisits = find_revisits(records, min_bytes).repartition(files, "record_id")
    # A third of all payloads may be one; dealing records out by their own id spreads them.
    marked = records.repartition(files, "record_id").join(revisits, "record_id", "left")
    marked.select(_record_text(date)).write.text(path, compression="gzip", lineSep=CRLF * 2)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = pa.schema(list(zip(names, [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()])))
    for batch in batches:
        for content in batch.column("content"):
            rows: list[tuple] = []
            size = 0
            for head, payload in _records(content.as_buffer()):
                uri = head.get("warc-record-id", "").strip("<>")
                page = head.get("x-page-id")
                digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
                refers = head.get("warc-refers-to")
                rows.append((uri, head.get("warc-type"), head.get("warc-target-uri"), int(page) if page else None, digest, refers and refers.strip("<>"), payload))
                size += len(payload)
                if size > 8 << 20:
                    yield pa.record_batch([pa.array(x, k.type) for x, k in zip(zip(*rows), kinds)], schema=kinds)
                    rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array(x, k.type) for x, k in zip(zip(*rows), kinds)], schema=kinds)


def _records(raw) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and payload of each record of a gzipped archive, unpacked bit by bit."""
    source = _Unpacked(raw)
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        block = source.take(int(fields["content-length"]))
        source.take(4)
        yield fields, block[block.index(b"\r\n\r\n") + 4 :]


class _Unpacked:
    """The bytes of a gzip stream (or of several in a row), read forwards."""

    def __init__(self, raw):
        self.raw, self.at, self.data, self.place = memoryview(raw), 0, b"", 0
        self.stream = zlib.decompressobj(31)

    def _more(self) -> bool:
        while self.at < len(self.raw):
            part = self.stream.decompress(self.raw[self.at : self.at + (1 << 18)])
            self.at = min(len(self.raw), self.at + (1 << 18)) - len(self.stream.unused_data)
            if self.stream.eof:
                self.stream = zlib.decompressobj(31)
            if part:
                self.data, self.place = self.data[self.place :] + part, 0
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.data.find(mark, self.place)) < 0:
            if not self._more():
                return None
        out = self.data[self.place : end]
        self.place = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.data) - self.place < n:
            if not self._more():
                raise ValueError("archive ends inside a record")
        out = self.data[self.place : self.place + n]
        self.place += n
        return out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of archives: record_id, type, target, page_id, digest, refers_to, payload (empty for revisits)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_parse, RECORD)


def resolve(records: DataFrame) -> DataFrame:
    """Headers of records as of ``read_archives``, revisits with what their response holds.

    Returns record_id, page_id, target, record_type, payload_bytes and
    payload_digest (of the full payload; checked against the header's digest)
    and refers_to (the response's page id).  A revisit whose response is
    missing has NULL bytes and the digest of its header.
    """
    own = written(
        records.select(
            "record_id", "type", "target", "page_id", "digest", "refers_to",
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha2("payload", 256).alias("found"),
        ),
        "warc-headers",
    )
    full = own.where("type = 'response'")
    responses = full.select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("first_page"), F.col("bytes").alias("first_bytes"), F.col("found").alias("first_found")
    ).dropDuplicates(["refers_to"])
    right = F.when(F.col("found") == F.col("digest"), F.col("found")).otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest: "), "record_id")))
    as_response = full.select(
        "record_id", "page_id", "target", F.col("type").alias("record_type"), F.col("bytes").alias("payload_bytes"), right.alias("payload_digest"), F.lit(None).cast("long").alias("refers_to")
    )
    right = F.when(F.coalesce(F.col("first_found") == F.col("digest"), F.lit(True)), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("revisit does not match its response: "), "record_id"))
    )
    as_revisit = (
        own.where("type = 'revisit'")
        .join(responses, "refers_to", "left")
        .select(
            "record_id", "page_id", "target", F.col("type").alias("record_type"), F.col("first_bytes").alias("payload_bytes"), right.alias("payload_digest"), F.col("first_page").alias("refers_to")
        )
    )
    return as_response.unionByName(as_revisit)
