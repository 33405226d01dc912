"""Exact top-k inner products by block-at-a-time pruning (operator 12).

A vector's components, floor(256 * x), are the weights of its terms. Vectors are numbered by their nearest centre, then by vec_id; a block is a
range of numbers, and its forward index is one row with the vectors whole. A block's summary holds the largest and smallest
weight of each term, so that a query's weights times the fitting extreme, summed, bound every score within. Each query visits blocks in
order of that bound: first the best few, in rounds that raise its k-th score, then every other block whose bound isn't below it. What
is left out is proven to hold no better row, so the result is exact; on vectors without any structure nearly all blocks are scored.

Queries travel in batches and summaries in chunks, each a bounded row; a batch meets each chunk for bounds and each block that it visits for
scores. The centres only order the vectors. They are fitted on at most SAMPLE vectors of at most 4,096 components, taken by a hash of vec_id.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part; a shorter vector has weight 0 for the terms that it
lacks, so an empty vector scores 0 with all; repeated vec_ids are rows of their own, each a candidate for the other; a null
vec_id is no query, and as a candidate comes after others of its score; ties go to the smaller vec_id, then to any row of it; a component beyond
2**53 or a score beyond 64 bits is an error; a block holds fewer vectors the longer the longest is; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import merged, tune, written
from .ranks import ranked

BLOCK, VALUES, BATCH = 512, 1 << 18, 24
CENTRES, SAMPLE = 64, 2048
#: Blocks that each query visits in the rounds before the last.
PROBES = (2, 16)
_NONE = -(1 << 63)
_PACKED = "ids array<long>, marks array<long>, dims int, weights binary"


def _centres(vectors: DataFrame) -> np.ndarray:
    """Centres of a bounded sample, as rows; of the sample's most common length only."""
    rows = vectors.where(F.size("embedding").between(1, 4096)).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select(F.transform("embedding", lambda x: x.cast("double")).alias("x")).collect()
    sample = [np.array([np.nan if v is None else v for v in r.x]) for r in rows]
    sample = [x for x in sample if np.isfinite(x).all()]
    if not sample:
        return np.zeros((0, 0))
    lengths = [len(x) for x in sample]
    x = np.stack([x for x in sample if len(x) == max(set(lengths), key=lengths.count)])
    centres = x[:CENTRES].copy()
    for _ in range(8):
        near = _nearest(x, centres)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = x[near == c].mean(0)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres**2).sum(1), axis=1)


def _weighed(centres: np.ndarray) -> Callable:
    """(vec_id, mark, embedding) -> (cell, vec_id, mark, dims, weights) of the rows that take part."""
    schema = pa.schema([("cell", pa.int32()), ("vec_id", pa.int64()), ("mark", pa.int64()), ("dims", pa.int32()), ("weights", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("embedding")
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            x = lists.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            keep = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[starts])
            scaled = np.floor(256 * x)
            cells, weights = [], []
            for i in np.flatnonzero(keep):
                w = scaled[starts[i] : ends[i]]
                if len(w) and np.abs(w).max() > 2**53:
                    raise ValueError("a vector's component is beyond 2**53 / 256")
                weights.append(w.astype("<i8").tobytes())
                cells.append(int(_nearest(x[None, starts[i] : ends[i]], centres)[0]) if len(w) == centres.shape[1] and len(centres) else -1)
            chosen = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), b.column("vec_id").take(chosen), b.column("mark").take(chosen), pa.array(lengths[keep], pa.int32()), pa.array(weights, pa.binary())], schema=schema)

    return run


def _matrix(weights: list[bytes], dims: int) -> np.ndarray:
    out = np.zeros((len(weights), dims), np.int64)
    for row, w in zip(out, weights, strict=True):
        v = np.frombuffer(w, "<i8")
        row[: len(v)] = v
    return out


def _grid(raw: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(rows, dims)


def _packed(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Rows of a group as one row, and their weights."""
    t = t.sort_by("mark")
    dims = max(t["dims"].to_pylist())
    m = _matrix(t["weights"].to_pylist(), dims)
    row = {"ids": [t["vec_id"].to_pylist()], "marks": [t["mark"].to_pylist()], "dims": [dims], "weights": [m.tobytes()]}
    return pa.table(row, schema=pa.schema([("ids", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("dims", pa.int32()), ("weights", pa.binary())])), m


def _pack_block(t: pa.Table) -> pa.Table:
    row, m = _packed(t)
    row = row.append_column("high", pa.array([m.max(0).tobytes()], pa.binary())).append_column("low", pa.array([m.min(0).tobytes()], pa.binary()))
    return row.add_column(0, "block", t["block"].slice(0, 1).combine_chunks())


def _pack_batch(t: pa.Table) -> pa.Table:
    return _packed(t)[0].add_column(0, "batch", t["batch"].slice(0, 1).combine_chunks())


def _pack_chunk(t: pa.Table) -> pa.Table:
    t = t.sort_by("block")
    dims = max(t["dims"].to_pylist())
    sides = [pa.array([_matrix(t[c].to_pylist(), dims).tobytes()], pa.binary()) for c in ("high", "low")]
    return pa.Table.from_arrays([t["chunk"].slice(0, 1).combine_chunks(), pa.array([t["block"].to_pylist()], pa.list_(pa.int64())), pa.array([dims], pa.int32()), *sides], names=["chunk", "blocks", "chunk_dims", "high", "low"])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a and b, over the terms that both have."""
    d = min(a.shape[1], b.shape[1])
    if not d or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    a, b = a[:, :d], b[:, :d]
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * d
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T if most < 1 << 63 else (a.astype(object) @ b.T.astype(object)).astype(np.int64)


def _state(row: dict, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query of a batch: its k-th score so far, and the bound and number of the last block that it has visited."""
    kth, bound, block = np.full(n, _NONE), np.full(n, (1 << 63) - 1), np.full(n, -1)
    for s in row["state"] or ():
        kth[s["q"]] = _NONE if s["kth"] is None else s["kth"]
        bound[s["q"]], block[s["q"]] = s["bound"], s["block"]
    return kth, bound, block


def _bounds(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of a batch's queries in a chunk's blocks, the blocks, and which of them are still to be visited."""
    n, blocks = len(row["ids"]), np.array(row["blocks"], np.int64)
    q, high, low = _grid(row["weights"], n, row["dims"]), _grid(row["high"], len(blocks), row["chunk_dims"]), _grid(row["low"], len(blocks), row["chunk_dims"])
    bounds = products(np.maximum(q, 0), high) + products(np.minimum(q, 0), low)
    kth, last, last_block = (s[:, None] for s in _state(row, n))
    return bounds, blocks, (bounds >= kth) & ((bounds < last) | ((bounds == last) & (blocks > last_block)))


def _next_blocks(most: int) -> Callable:
    """Batch and chunk -> (batch, q, block, bound) of each query's best `most` blocks of the chunk that it hasn't visited."""
    schema = pa.schema([("batch", pa.int64()), ("q", pa.int32()), ("block", pa.int64()), ("bound", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            bounds, blocks, todo = _bounds(row)
            order = np.argsort(np.where(todo, -bounds, (1 << 63) - 1), axis=1, kind="stable")[:, :most]
            q, j = np.nonzero(np.take_along_axis(todo, order, 1))
            at = order[q, j]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), row["batch"])), pa.array(q.astype(np.int32)), pa.array(blocks[at]), pa.array(bounds[q, at])], schema=schema)

    return run


def _all_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batch and chunk -> (batch, block, qs): every block that a query still has to visit."""
    schema = pa.schema([("batch", pa.int64()), ("block", pa.int64()), ("qs", pa.list_(pa.int32()))])
    for row in (r for b in batches for r in b.to_pylist()):
        _, blocks, todo = _bounds(row)
        at = np.flatnonzero(todo.any(0))
        qs = [np.flatnonzero(todo[:, j]).tolist() for j in at]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["batch"])), pa.array(blocks[at]), pa.array(qs, pa.list_(pa.int32()))], schema=schema)


def _scored(k: int) -> Callable:
    """Batch and block -> (batch, q, query_id, vec_id, mark, score): each visiting query's best k rows of the block."""
    schema = pa.schema([("batch", pa.int64()), ("q", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("mark", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            qs, n = np.array(row["qs"]), len(row["ids"])
            ids, marks = row["block_ids"], np.array(row["block_marks"])
            scores = products(_grid(row["weights"], n, row["dims"])[qs], _grid(row["block_weights"], len(ids), row["block_dims"]))
            least, own = _state(row, n)[0][qs], np.array(row["marks"])[qs]
            rank = np.array([(1 << 63) - 1 if i is None else i for i in ids])
            out = []
            for i, q in enumerate(qs):
                at = np.flatnonzero((scores[i] >= least[i]) & (marks != own[i]))
                at = at[np.lexsort((marks[at], rank[at], -scores[i, at]))[:k]]
                out += [(row["batch"], q, row["ids"][q], ids[j], marks[j], scores[i, j]) for j in at]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * 6, schema, strict=True)], schema=schema)

    return run


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("batch", "q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "mark")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, asked: Column, k: int = 5, probes: tuple[int, ...] = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows by inner product, for each row of vectors (vec_id, embedding) where `asked` holds."""
    spark = vectors.sparkSession
    tune(spark)
    vectors = vectors.select("vec_id", "embedding")
    found = vectors.withColumn("mark", F.monotonically_increasing_id()).mapInArrow(_weighed(_centres(vectors)), "cell int, vec_id long, mark long, dims int, weights binary")
    found = written(ranked(written(found, "weights"), ["cell", "vec_id", "mark"]), "weights")
    longest = found.agg(F.max("dims")).first()[0] or 1
    size = min(BLOCK, max(1, VALUES // longest))
    blocks = found.withColumn("block", F.floor(F.col("place") / size)).groupBy("block").applyInArrow(_pack_block, f"block long, {_PACKED}, high binary, low binary")
    blocks = written(blocks, "blocks")
    chunks = blocks.select(F.floor(F.col("block") / size).alias("chunk"), "block", "dims", "high", "low")
    chunks = written(chunks.groupBy("chunk").applyInArrow(_pack_chunk, "chunk long, blocks array<long>, chunk_dims int, high binary, low binary"), "chunks")
    batches = found.where(asked).withColumn("batch", F.floor(F.col("place") / (BATCH * size))).groupBy("batch").applyInArrow(_pack_batch, f"batch long, {_PACKED}")
    batches = written(batches, "batches")
    n_chunks = -(-blocks.count() // size)
    best, seen, state = None, None, batches.select("batch", F.lit(None).cast("array<struct<q: int, kth: long, bound: long, block: long>>").alias("state"))
    for most in (*probes, None):
        meet = merged(batches, state, "batch", "left")
        pairs = meet.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, n_chunks - 1)).cast("long"))).alias("chunk"))
        pairs = merged(pairs, chunks, "chunk")
        if most is None:
            visits = pairs.mapInArrow(_all_blocks, "batch long, block long, qs array<int>")
        else:
            order = Window.partitionBy("batch", "q").orderBy(F.desc("bound"), "block")
            chosen = pairs.mapInArrow(_next_blocks(most), "batch long, q int, block long, bound long").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
            chosen = written(chosen, "visits")
            visits = chosen.groupBy("batch", "block").agg(F.collect_list("q").alias("qs"))
        asking = merged(visits, meet, "batch")
        forward = blocks.select("block", F.col("ids").alias("block_ids"), F.col("marks").alias("block_marks"), F.col("dims").alias("block_dims"), F.col("weights").alias("block_weights"))
        scores = merged(asking, forward, "block").mapInArrow(_scored(k), "batch long, q int, query_id long, vec_id long, mark long, score long")
        best = written(_best(scores if best is None else scores.unionByName(best.drop("rank")), k), "best")
        if most is not None:
            gone = chosen.select("batch", "q", F.struct("bound", (-F.col("block")).alias("minus")).alias("at"))
            if seen is not None:
                gone = gone.unionByName(seen)
            # In the order of visits the last block has the smallest bound, and of those the largest number.
            seen = written(gone.groupBy("batch", "q").agg(F.min("at").alias("at")), "seen")
            kth = best.where(F.col("rank") == k).select("batch", "q", F.col("score").alias("kth"))
            now = merged(seen, kth, ["batch", "q"], "left").select("batch", F.struct("q", "kth", "at.bound", (-F.col("at.minus")).alias("block")).alias("s"))
            state = written(now.groupBy("batch").agg(F.collect_list("s").alias("state")), "state")
    return best.select("query_id", "rank", "vec_id", "score")


def search_report(vectors: DataFrame) -> DataFrame:
    """The five best rows for each row whose vec_id is divisible by 50."""
    return exact_top_k(vectors, F.col("vec_id") % 50 == 0)
