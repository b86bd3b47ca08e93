"""WARC archives through Spark's file writers, and transaction assembly after reading them back.

A capture is three records: request, response (or revisit) and metadata. Request and metadata name the
response in WARC-Concurrent-To; assembly joins on that identifier and gives one nested row per capture.

Payloads of at least `least` bytes that are equal are stored once, in the capture with the largest id; the
others become revisits that refer to it. A revisit keeps the HTTP header, whose Content-Length is the size of
the full payload. Of several captures with the largest id each stores its payload; revisits name one of them.

Archives are files of at most `RECORDS_A_FILE` records, so that a reading task holds one compressed file of bounded size;
it unpacks and parses the file as a stream and holds one record at a time.

Edge cases: a null or empty payload is a response of 0 bytes; a null url is an empty target; every row is a capture, with a row
number in its identifier where ids repeat or are null; a null id is in no order, so its payload is always stored; a payload of any
length that fits a string is one record; an empty table gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, written

CRLF = "\r\n"
LEAST = 1000
RECORDS_A_FILE = 15_000
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(kind: str | Column, identifier: Column, extra: list[Column], block: Column) -> Column:
    """One record as text; the blank lines that end it are the writer's line separator."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), identifier), F.lit(f"WARC-Date: {DATE}"), *extra, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(CRLF * 2), block)


def _id(kind: str, page: Column, row: Column) -> Column:
    return F.concat(F.lit(f"<urn:siltstone:{kind}:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = LEAST) -> DataFrame:
    """id, row (0 where ids are unique), url, payload, digest, size, refers_to and refers_row (null for responses) of every row."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\r\n]", "").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    )
    odd = rows.groupBy("id").count().filter("id IS NULL OR count > 1").limit(1).count()
    if odd:  # numbers are given once, so they are written
        rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    else:
        rows = rows.withColumn("row", F.lit(0).cast("long"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload").cast("long"))
    # Ids first, without payloads: which capture of a digest holds the payload.
    large = rows.filter((F.col("size") >= least) & F.col("id").isNotNull()).select("id", "row", "digest")
    holder = large.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("holder"), F.count("*").alias("n")).filter("n > 1")
    revisits = large.join(holder.drop("n"), "digest").filter("id < holder.id")
    revisits = revisits.select("id", "row", F.col("holder.id").alias("refers_to"), F.col("holder.row").alias("refers_row"))
    return rows.join(revisits, ["id", "row"], "left")


def records(caught: DataFrame) -> DataFrame:
    """The WARC records of the captures as one column of text."""
    page, row, url = F.col("id"), F.col("row"), F.col("url")
    main = _id("response", page, row)
    uri = F.concat(F.lit("WARC-Target-URI: "), url)
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), main)
    http = F.lit("Content-Type: application/http")
    header = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    is_revisit = F.col("refers_to").isNotNull()
    refers = F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), _id("response", F.col("refers_to"), F.col("refers_row")), F.lit(f"{CRLF}WARC-Profile: {PROFILE}")))
    response = _record(
        F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")), main, [uri, digest, refers, http],
        F.when(is_revisit, header).otherwise(F.concat(header, F.col("payload"))),
    )
    request = _record("request", _id("request", page, row), [uri, concurrent, http], F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{CRLF * 2}")))
    meta = _record("metadata", _id("metadata", page, row), [uri, concurrent, F.lit("Content-Type: application/warc-fields")], F.concat(F.lit("page: "), F.coalesce(page.cast("string"), F.lit("")), F.lit(CRLF)))
    return caught.select(F.explode(F.array(request, response, meta)).alias("value"))


def write_archives(caught: DataFrame, path: str) -> None:
    """Gzip files of WARC records; file sizes follow the partitions' sizes up to a number of records."""
    records(caught).write.option("maxRecordsPerFile", RECORDS_A_FILE).option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


RECORD = "record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, digest string, http_length long, block_sha1 string, block_bytes long, block binary"
_NAMES = ["record_id", "record_type", "target_uri", "concurrent_to", "refers_to", "digest", "http_length", "block_sha1", "block_bytes", "block"]


_CHUNK = 1 << 20


def unpacked(data: memoryview) -> Iterator[bytes]:
    """The content of a plain or gzip file, of one member or many, in pieces."""
    import zlib

    if bytes(data[:2]) != b"\x1f\x8b":
        yield from (bytes(data[k : k + _CHUNK]) for k in range(0, len(data), _CHUNK))
        return
    member, at = zlib.decompressobj(31), 0
    while at < len(data):
        piece = data[at : at + _CHUNK]
        at += len(piece)
        while len(piece):
            yield member.decompress(piece)
            rest = member.unused_data
            if not member.eof:
                break
            member, piece = zlib.decompressobj(31), rest


class _Pieces:
    """Reads forward over pieces of bytes; holds what is not read yet of the piece at hand."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, bytearray()

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to the mark, which is passed over; None if it does not come."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self._more():
                return None
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def take(self, size: int) -> bytes:
        while len(self.held) < size and self._more():
            pass
        out = bytes(self.held[:size])
        del self.held[:size]
        return out


def parse(pieces: Iterator[bytes], keep_block: bool = True) -> Iterator[tuple]:
    """Records of one archive: lengths rule, so payloads may hold any bytes. Blocks of responses are kept on demand."""
    reader = _Pieces(pieces)
    while reader.until(b"WARC/") is not None:
        head = reader.until(b"\r\n\r\n")
        if head is None:
            raise ValueError("an archive ends within a record's header")
        fields = dict(line.split(": ", 1) for line in head.decode().split(CRLF)[1:] if ": " in line)
        size, http_length = int(fields["Content-Length"]), None
        block, kind = reader.take(size), fields["WARC-Type"]
        if len(block) < size:
            raise ValueError("an archive ends within a record")
        if "application/http" in fields.get("Content-Type", "") and kind != "request":
            top, _, block = block.partition(b"\r\n\r\n")
            http_length = next((int(x.split(b":")[1]) for x in top.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
        yield (
            fields["WARC-Record-ID"], kind, fields.get("WARC-Target-URI"), fields.get("WARC-Concurrent-To"), fields.get("WARC-Refers-To"),
            (fields.get("WARC-Payload-Digest") or "").removeprefix("sha1:") or None, http_length, hashlib.sha1(block).hexdigest(), len(block),
            block if keep_block or kind in ("request", "metadata") else None,
        )


def read_archives(spark: SparkSession, path: str, keep_block: bool = True) -> DataFrame:
    """One row per record of the archives (.warc, .warc.gz) under a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.binary() if n == "block" else pa.int64() if n in ("http_length", "block_bytes") else pa.string()) for n in _NAMES])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in rows], schema=schema)

        for batch in batches:
            for content in batch.column(0):
                out, held = [], 0
                for row in parse(unpacked(memoryview(content.as_buffer())), keep_block):
                    out.append(row)
                    held += len(row[-1] or b"")
                    if len(out) == 500 or held > 8 * _CHUNK:
                        yield batch_of(out)
                        out, held = [], 0
                if out:
                    yield batch_of(out)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, and the request and metadata concurrent to it."""
    response = found.filter(F.col("record_type").isin("response", "revisit"))
    response = response.select(F.col("record_id").alias("capture"), F.struct(*(c for c in found.columns if c != "concurrent_to")).alias("response"))
    others = found.filter("concurrent_to IS NOT NULL").groupBy(F.col("concurrent_to").alias("capture"))
    others = others.agg(*(F.max(F.when(F.col("record_type") == k, F.struct("record_id", "target_uri", "block"))).alias(k) for k in ("request", "metadata")))
    return response.join(others, "capture", "left")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", keep_block: bool = True) -> DataFrame:
    """Writes the pages as WARC archives into the shared folder, reads them back and assembles the captures."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/archives"
    write_archives(captures(pages, id_col, url_col, payload_col), path)
    return assemble(read_archives(spark, path, keep_block))


def page_of(identifier: Column) -> Column:
    """Id of the row that a record's identifier names; null for a row without one."""
    return F.nullif(F.regexp_extract(identifier, r":(-?\d*):\d+>$", 1), F.lit("")).cast("long")


def page_told(block: Column) -> Column:
    """Id in a metadata record's fields; null for a row without one."""
    return F.nullif(F.regexp_extract(block.cast("string"), r"(?m)^page: (-?\d*)", 1), F.lit("")).cast("long")
