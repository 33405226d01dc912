"""Line deduplication across documents (operator 6).

Every eligible line becomes one narrow row (128-bit hash, document, positions). The rows are range-partitioned
and sorted by (hash, document descending), so that the line's keeper - its largest doc_id - streams past first.
A run of one hash may span partitions (a hot line is split by document): rows whose fate the partition alone can't
tell are emitted as open together with one count per partition edge, and are settled by those counts.
The outcome is a compressed keep bitmap for each document that loses lines, never text.

Defined results: a null or empty text is one empty line; empty lines and keys shorter than `min_chars` always stay;
rows that repeat a doc_id count as one document, and all of them lose or keep a line alike; a null doc_id counts as
one document below all others; a very long text is one row of lines, each a hash; an empty table gives an empty table; extra columns of
any name stay as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, NO_ID, carried, text_bytes, tune, written

_SPACE = ASCII_SPACE.encode()
_LINES = "hi long, lo long, doc long, row_key long, positions array<int>"
_FATES = "kind int, hi long, lo long, doc long, row_key long, positions array<int>, n_docs long, max_doc long"
_DROP, _OPEN, _EDGE = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped, A-Z lower-cased (bytes.lower() touches nothing else)."""
    return line.strip(_SPACE).lower()


def _eligible(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars:
        return False
    return len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars


def _line_rows(min_chars: int):
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc", pa.int64()), ("row_key", pa.int64()), ("positions", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, docs, keys, places = [], [], [], []
            for doc, row_key, raw in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                own: dict[bytes, list[int]] = {}
                for at, line in enumerate(raw.split(b"\n")):
                    key = line_key(line)
                    if _eligible(key, min_chars):
                        own.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
                digests += own
                places += own.values()
                docs += [doc] * len(own)
                keys += [row_key] * len(own)
            halves = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(places, pa.list_(pa.int32()))], schema=schema)

    return run


def _stream_fates(min_docs: int):
    """Rows of a range partition in order of (hash, document descending) -> rows to drop, open rows, edge counts."""
    names = ["kind", "hi", "lo", "doc", "row_key", "positions", "n_docs", "max_doc"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first_run, seen, top, last = None, True, 0, 0, None
        held: list[tuple] = []  # rows of the first min_docs - 1 documents of the run
        out: list[tuple] = []

        def close(at_end: bool) -> None:
            nonlocal held
            if current is None:
                return
            if first_run or at_end:
                out.append((_EDGE, *current, 0, 0, [], seen, top))
                out.extend((_OPEN, *current, *row, 0, 0) for row in held)
            held = []

        for b in batches:
            for hi, lo, *row in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if (hi, lo) != current:
                    close(False)
                    first_run = current is None
                    current, seen, top, last = (hi, lo), 0, row[0], None
                if row[0] != last:
                    last, seen = row[0], seen + 1
                if seen < min_docs:
                    if first_run or row[0] != top:
                        held.append(tuple(row))
                    continue
                out.append((_DROP, hi, lo, *row, 0, 0))
                if held and not first_run:  # no partition before this one can hold a larger document
                    out.extend((_DROP, hi, lo, *h, 0, 0) for h in held)
                    held = []
            if len(out) > 4096:
                yield batch(out)
                out.clear()
        close(True)
        yield batch(out)

    return run


def _bitmaps():
    """Dropped positions in order of (document, row) -> one compressed keep bitmap each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bits, dropped, out = None, bytearray(), 0, []

        def close() -> None:
            if current is not None:
                out.append((*current, zlib.compress(bytes(bits), 6), dropped))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int64())], ["doc", "row_key", "keep_bitmap", "n_dropped"])

        for b in batches:
            for doc, row_key, positions in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if (doc, row_key) != current:
                    close()
                    current, bits, dropped = (doc, row_key), bytearray(), 0
                for p in positions:
                    if p >> 3 >= len(bits):
                        bits.extend(b"\xff" * ((p >> 3) + 1 - len(bits)))
                    if bits[p >> 3] & (128 >> (p & 7)):
                        bits[p >> 3] &= ~(128 >> (p & 7))
                        dropped += 1
            if len(out) > 2048:
                yield batch()
                out.clear()
        close()
        yield batch()

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc, row_key, keep_bitmap, n_dropped) for each document row that loses lines.

    doc is doc_id (NO_ID for null) and row_key a hash of the text, so that rows which repeat a doc_id with another
    text keep bitmaps of their own. Bit i (most significant first) is 1 if line i stays; lines past its end stay.
    """
    spark = docs.sparkSession
    tune(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_bytes()).alias("row_key"), text_bytes().alias("raw"))
    lines = written(rows.mapInArrow(_line_rows(min_chars), _LINES), "lines")
    order = [F.col("hi"), F.col("lo"), F.col("doc").desc()]
    fates = written(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_stream_fates(min_docs), _FATES), "line-fates")
    # At most two rows for each range partition.
    edges = fates.where(F.col("kind") == _EDGE).groupBy("hi", "lo").agg(F.sum("n_docs").alias("n_all"), F.max("max_doc").alias("top")).where(F.col("n_all") >= min_docs)
    settled = fates.where(F.col("kind") == _OPEN).join(F.broadcast(edges), ["hi", "lo"]).where(F.col("doc") != F.col("top"))
    drops = fates.where(F.col("kind") == _DROP).select("doc", "row_key", "positions").unionByName(settled.select("doc", "row_key", "positions"))
    return drops.repartition("doc", "row_key").sortWithinPartitions("doc", "row_key").mapInArrow(_bitmaps(), "doc long, row_key long, keep_bitmap binary, n_dropped long")


def kept_lines(raw: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """The lines that stay, joined; the number of lines before; the number dropped."""
    lines = raw.split(b"\n")
    if bitmap is None:
        return raw, len(lines), 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(lines)]
    keep = [line for i, line in enumerate(lines) if i >= len(bits) or bits[i]]
    return b"\n".join(keep), len(lines), len(lines) - len(keep)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """row (each row of docs whole) and its keep_bitmap (null: all lines stay)."""
    left = carried(docs).withColumns({"doc": F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NO_ID)), "row_key": F.xxhash64(text_bytes("row.text"))})
    return left.join(bitmaps.select("doc", "row_key", "keep_bitmap").hint("shuffle_hash"), ["doc", "row_key"], "left").select("row", "keep_bitmap")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with repeated lines removed from text, and n_chars (if there) counted anew; other columns stay."""

    @F.pandas_udf("string")
    def keep(raw, bitmap):
        import pandas as pd

        return pd.Series([None if b is None else kept_lines(r, b)[0].decode("utf-8", "replace") for r, b in zip(raw, bitmap, strict=True)], dtype=object)

    marked = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    loses = F.col("keep_bitmap").isNotNull()
    # A text that keeps all its lines doesn't go to Python: a null goes in its place.
    out = marked.withColumn("left", keep(F.when(loses, text_bytes("row.text")), F.col("keep_bitmap")))
    row = F.col("row").withField("text", F.when(loses, F.col("left")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(F.coalesce(F.when(loses, F.col("left")).otherwise(F.col("row.text")), F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return out.select(row.alias("row")).select("row.*")


def line_report(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept text for every row of docs."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, raws, maps = (b.column(i).to_pylist() for i in range(3))
            found = [kept_lines(r, m) for r, m in zip(raws, maps, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()), pa.array([hashlib.sha256(x[0]).hexdigest() for x in found], pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("raw"))
    slim = slim.withColumns({"doc": F.coalesce("doc_id", F.lit(NO_ID)), "row_key": F.xxhash64("raw")})
    marked = slim.join(keep_bitmaps(docs, min_chars, min_docs).drop("n_dropped").hint("shuffle_hash"), ["doc", "row_key"], "left")
    return marked.select("doc_id", "raw", "keep_bitmap").mapInArrow(digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
