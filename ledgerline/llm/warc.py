"""WARC archives as a table of chunk rows (operator 10).

A page's payload reaches the writer as rows of at most `piece_bytes`, and goes out as rows of record identifier and chunk number, each a
whole WARC record of at most `chunk_bytes` of payload: the first is the response, the others are its continuation segments. Each row
carries the digest of its own chunk and the running digest of the payload so far, so no writer or reader builds a whole oversized
record. Rows are written by Spark's own text sink, in files of at most `file_records` records that are read in parallel, and read back
by splitting at the version line; a payload that contains that line is cut inside it, so the split is exact.

A revisit names its response. Reading takes its payload's length and digest from that response, as it was read and hashed; a revisit whose
response is missing, or has another digest, fails the read. Revisits of one response are dealt to `_SALTS` keys, so that a very
common page is not one key.

Of equal payloads of at least `min_revisit` bytes the one with the smallest page_id is the response, and the others are
revisits of it. Rows which share that smallest page_id and payload are all responses.

Defined results: a null html is an empty payload and a response; a null page_id comes after all others and revisits them;
a null url is left out; a payload of any length is written in chunks; an empty table gives no record; extra columns are not archived.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, merged, shared_root, text_bytes, tune, written

VERSION = b"WARC/1.1\r\n"
_END = b"\r\n\r\n"
_SALTS = 16
_PARSED = "uid long, segment long, kind string, page_id long, refers_to long, bytes long, digest string, stated_digest string, chunk binary"


def cut_at(rest: bytes, chunk_bytes: int) -> int:
    """Where the first chunk of rest ends: after at most chunk_bytes, between characters, and with no version line inside."""
    end = min(chunk_bytes, len(rest))
    while 1 < end < len(rest) and rest[end] & 0xC0 == 0x80:
        end -= 1
    line = rest.find(VERSION, 0, end)
    return end if line < 0 else line + 4


def _named(page: int | None, digest: str) -> str:
    """A response is named by page and payload, so that a revisit can refer to it wherever it is written."""
    return f"<urn:page:{'' if page is None else page}:{digest}>"


class _Writer:
    """The WARC records of one page, each without its last line feed, from the pieces of its payload; uid tells rows apart."""

    def __init__(self, uid: int, page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None, date: str, chunk_bytes: int):
        self.uid, self.page_id, self.url, self.size, self.digest, self.refers_to = uid, page_id, url, size, digest, refers_to
        self.date, self.chunk_bytes = date, chunk_bytes
        self.rest, self.running, self.done, self.number = b"", hashlib.sha256(), 0, 1

    def feed(self, piece: bytes, is_last: bool) -> Iterator[tuple[int, int, bytes]]:
        if self.refers_to is not None or not self.size:
            if is_last:
                yield self._record(b"", True)
            return
        self.rest += piece
        while len(self.rest) > self.chunk_bytes or (is_last and self.rest):
            end = cut_at(self.rest, self.chunk_bytes)
            chunk, self.rest = self.rest[:end], self.rest[end:]
            yield self._record(chunk, self.done + end == self.size)

    def _record(self, chunk: bytes, is_last: bool) -> tuple[int, int, bytes]:
        self.running.update(chunk)
        self.done += len(chunk)
        number, refers = self.number, self.refers_to is not None
        self.number += 1
        kind = "continuation" if number > 1 else "revisit" if refers else "response"
        name = _named(self.page_id, self.digest) if kind == "response" else f"<urn:row:{self.uid}:{number}>"
        head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", self.date), ("WARC-Row", str(self.uid))]
        if self.url is not None:
            head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", self.url)))
        if self.page_id is not None:
            head.append(("WARC-Page-ID", str(self.page_id)))
        head += [("WARC-Payload-Digest", f"sha256:{self.digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(chunk).hexdigest()}")]
        if refers:
            head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _named(self.refers_to, self.digest)), ("WARC-Refers-To-Page-ID", str(self.refers_to))]
        if number > 1 or not is_last:
            head += [("WARC-Segment-Number", str(number)), ("WARC-Running-Digest", f"sha256:{self.running.hexdigest()}")]
            head += [("WARC-Segment-Origin-ID", _named(self.page_id, self.digest))] if number > 1 else []
            head += [("WARC-Segment-Total-Length", str(self.done))] if is_last else []
        head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(chunk)))]
        return self.uid, number, VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + chunk + _END[:-1]


def _chunk_rows(date: str, chunk_bytes: int):
    """Pieces of payloads, those of a page in order one after another -> (uid, chunk_no, record)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uids = itertools.count(TaskContext.get().partitionId() << 40)
        writer = None
        for b in batches:
            out, size = [], 0
            for page_id, url, length, digest, refers_to, place, n_pieces, piece in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
                if not place:
                    writer = _Writer(next(uids), page_id, url, length, digest, refers_to, date, chunk_bytes)
                for row in writer.feed(piece, place + 1 == n_pieces):
                    out.append(row)
                    size += len(row[2])
                    if size > 8 << 20:
                        yield _batch(out)
                        out, size = [], 0
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], ["uid", "chunk_no", "record"])

    return run


def chunk_table(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", chunk_bytes: int = 1 << 20, min_revisit: int = 100, piece_bytes: int = 4 << 20) -> DataFrame:
    """(uid, chunk_no, record): every page as rows of whole WARC records of bounded size."""
    tune(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_bytes("html").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "length": F.octet_length("payload"), "page": F.coalesce("page_id", F.lit(NO_ID))})
    # Payloads are dealt by page and digest, so that a very common payload is not one key.
    large = rows.where(F.col("length") >= min_revisit).groupBy("page", "page_id", "digest").agg(F.count("*").alias("n"))
    shared = large.groupBy("digest").agg(F.sum("n").alias("n"), F.min("page_id").alias("first_id")).where("n > 1")
    revisits = merged(large.select("page", "page_id", "digest"), shared, "digest").where("first_id is not null and not (page_id <=> first_id)").select("page", "digest", F.col("first_id").alias("refers_to"))
    joined = merged(rows, revisits, ["page", "digest"], "left")
    n_pieces = F.when(F.col("refers_to").isNotNull(), F.lit(1)).otherwise(F.greatest(F.ceil(F.col("length") / piece_bytes), F.lit(1))).cast("int")
    pieces = joined.withColumn("n_pieces", n_pieces).withColumn("place", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    piece = F.when(F.col("refers_to").isNotNull(), F.lit(b"")).otherwise(F.substring("payload", F.col("place") * piece_bytes + 1, F.lit(piece_bytes)))
    out = pieces.select("page_id", "url", F.col("length").cast("long").alias("length"), "digest", "refers_to", "place", "n_pieces", piece.alias("piece"))
    return out.mapInArrow(_chunk_rows(date, chunk_bytes), "uid long, chunk_no long, record binary")


def write_archives(pages: DataFrame, path: str | None = None, compression: str = "gzip", file_records: int = 100_000, **options) -> str:
    """Write the archives under path (default: the cluster's shared folder); the path."""
    path = path or f"{shared_root(pages.sparkSession)}/ledgerline/warc-{uuid.uuid4().hex}"
    chunk_table(pages, **options).select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", compression).option("maxRecordsPerFile", file_records).text(path)
    return path


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record without its version line."""
    head, _, rest = raw.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    n = int(fields["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != _END or fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, block


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["uid", "segment", "kind", "page_id", "refers_to", "bytes", "digest", "stated_digest", "chunk"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    for b in batches:
        out = []
        for raw in b.column(0).to_pylist():
            h, block = parse_record(raw)
            uid, segment = int(h["WARC-Row"]), int(h.get("WARC-Segment-Number", 1))
            whole = "WARC-Segment-Number" not in h
            number = lambda k: int(h[k]) if k in h else None  # noqa: E731, B023
            out.append((uid, segment, h["WARC-Type"], number("WARC-Page-ID"), number("WARC-Refers-To-Page-ID"), len(block), hashlib.sha256(block).hexdigest() if whole else None, h["WARC-Payload-Digest"][7:], None if whole else block))
        columns = list(zip(*out, strict=True)) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _joined_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (uid, segment) -> one row a record; digests are carried from chunk to chunk."""
    names = ["kind", "page_id", "refers_to", "payload_bytes", "payload_digest"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    head, running, size, next_segment, out = None, None, 0, 1, []

    def close() -> None:
        if head is None:
            return
        uid, kind, page_id, refers_to, digest, stated = head
        digest = digest if running is None else running.hexdigest()
        if kind == "response" and digest != stated:
            raise ValueError(f"the payload of record {uid} differs from its digest")
        # A revisit has no payload of its own: the digest that it states is what its response has to have.
        out.append((kind, page_id, refers_to, size, stated if kind == "revisit" else digest))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(names)
        found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        out.clear()
        return found

    for b in batches:
        for uid, segment, kind, page_id, refers_to, n, digest, stated, chunk in zip(*(b.column(i).to_pylist() for i in range(9)), strict=True):
            if head is None or uid != head[0]:
                close()
                head, size, next_segment = (uid, kind, page_id, refers_to, digest, stated), 0, 1
                running = None if chunk is None else hashlib.sha256()
            if segment != next_segment:
                raise ValueError(f"record {uid} lacks segment {next_segment}")
            next_segment += 1
            size += n
            if chunk is not None:
                running.update(chunk)
        if len(out) > 4096:
            yield batch()
    close()
    yield batch()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Read archives back: page_id, payload_bytes, payload_digest, record_type, refers_to for every record."""
    tune(spark)
    raw = spark.read.option("lineSep", VERSION.decode()).text(path).where(F.length("value") > 0).select(F.col("value").cast("binary").alias("raw"))
    parsed = raw.mapInArrow(_parsed, _PARSED)
    # Whole records carry no chunk here; only segments travel with theirs.
    records = parsed.repartition("uid").sortWithinPartitions("uid", "segment").mapInArrow(_joined_segments, "kind string, page_id long, refers_to long, payload_bytes long, payload_digest string")
    records = written(records, "warc-records")
    responses, revisits = records.where("kind = 'response'"), records.where("kind = 'revisit'")
    salt = F.pmod(F.xxhash64("page_id"), F.lit(_SALTS)).cast("int")
    named = revisits.groupBy("refers_to", "payload_digest").agg(F.count("*").alias("n"))
    held = responses.where("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    read = merged(named, held, ["refers_to", "payload_digest"], "left").select("refers_to", "payload_digest", "payload_bytes", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    resolved = merged(revisits.drop("payload_bytes").withColumn("salt", salt), read, ["refers_to", "payload_digest", "salt"], "left")
    missing = F.raise_error(F.concat(F.lit("a revisit refers to a response that is missing or has another payload: page "), F.col("refers_to").cast("string"))).cast("long")
    columns = ["page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"]
    return responses.select(*columns).unionByName(resolved.withColumn("payload_bytes", F.coalesce("payload_bytes", missing)).select(*columns))


def warc_round_trip(pages: DataFrame) -> DataFrame:
    return read_records(pages.sparkSession, write_archives(pages))
