"""A stored vector index for cosine search: cells of a bounded sample's centres, exact rescoring, exact or measured recall.

`build` fits at most CELLS centres on at most SAMPLE vectors, taken by a hash of their id, and puts each vector into its nearest cell. A cell is a
folder of blocks of some BLOCK normalised vectors; a cell of any size, one vector repeated a million times included, is as many blocks as it
needs. The manifest holds the centres and each cell's radius (the largest angle to its centre).

`search` sends each question to its `probes` nearest cells. With exact=True those give a k-th score, and every other cell is visited too unless its
centre and radius prove that it holds no better vector, so the result equals a full scan; otherwise it ends there, and
recall depends on the vectors. Questions travel in batches of some BATCH; no question or vector passes the driver, only the centres do.

A vector that is null, holds a null or a component that is not finite, or has another length than the sample's most common one is no hit and is
counted in the manifest; such questions have no hits. A vector of zeros has cosine 0 with all and lies in a cell that every question visits. Ties go to
the smaller id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions as V
from .ranking import top_per_key

SCHEMA_VERSION = 1
CELLS, SAMPLE, BLOCK, BATCH, PER_CELL = 1024, 8192, 1024, 256, 512
_ZERO = -1
_SLACK = 1e-6


def normalised(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def fitted_centres(sample: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """n unit centres of unit vectors, by spherical k-means from evenly spaced rows."""
    centres = sample[np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        kept = np.linalg.norm(sums, axis=1) > 1e-9
        centres[kept] = normalised(sums[kept])
    return np.unique(centres.round(12), axis=0)


def _usable(vectors: DataFrame, id_: str) -> DataFrame:
    value = F.transform("embedding", lambda x: x.cast("double"))
    fit = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(id_).isNotNull() & fit).select(id_, value.alias("embedding"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _cells(centres: np.ndarray) -> Callable:
    """(vec_id, embedding) -> (cell, angle, vec_id, unit vector)."""
    schema = pa.schema([("cell", pa.int32()), ("angle", pa.float64()), ("vec_id", pa.int64()), ("unit", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = normalised(_matrix(b.column(1), centres.shape[1]))
            cosines = x @ centres.T
            cell = np.where(x.any(1), cosines.argmax(1), _ZERO).astype(np.int32)
            angle = np.arccos(np.clip(cosines.max(1), -1, 1))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(angle), b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], schema=schema)

    return run


def _pack(t: pa.Table) -> pa.Table:
    t = t.sort_by("vec_id")
    ids, units = t["vec_id"].to_pylist(), b"".join(t["unit"].to_pylist())
    return pa.table({"cell": t["cell"].slice(0, 1).combine_chunks(), "part": t["part"].slice(0, 1).combine_chunks(), "ids": pa.array([ids], pa.list_(pa.int64())), "units": pa.array([units], pa.binary())})


def build(vectors: DataFrame, root: str, key: str | None = None) -> dict:
    """Index vectors (vec_id, embedding) as the current version of root; its manifest."""
    spark, folder = vectors.sparkSession, f"{root}/data-{uuid.uuid4().hex}"
    # Vectors may be dear to make: they are made once.
    stored = V.held(vectors.select("vec_id", "embedding"), "vectors")
    fit = _usable(stored, "vec_id")
    sample = fit.where(F.size("embedding").between(1, 65_536)).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()["embedding"].combine_chunks()
    if not len(sample):
        raise ValueError("an index needs vectors")
    lengths = sample.value_lengths().to_numpy()
    dims = int(np.bincount(lengths).argmax())
    x = normalised(_matrix(sample.filter(pa.array(lengths == dims)), dims))
    x = x[x.any(1)]
    n_all, n_fit = stored.count(), fit.where(F.size("embedding") == dims).count()
    n_cells = min(CELLS, max(1, n_fit // PER_CELL))
    centres = fitted_centres(x, n_cells) if len(x) else np.zeros((1, dims))
    found = fit.where(F.size("embedding") == dims).mapInArrow(_cells(centres), "cell int, angle double, vec_id long, unit binary")
    found = V.held(found.withColumn("mark", F.monotonically_increasing_id()), "cells")
    # A row for each cell, at most CELLS + 1 of them.
    cells = {r.cell: r for r in found.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}
    parts = spark.createDataFrame([(c, -(-r.n // BLOCK)) for c, r in cells.items()], "cell int, parts int")
    blocks = found.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int"))
    blocks = blocks.select("cell", "part", "vec_id", "unit").groupBy("cell", "part").applyInArrow(_pack, "cell int, part int, ids array<long>, units binary")
    blocks.write.partitionBy("cell").parquet(f"{folder}/blocks")
    manifest = {
        "schema_version": SCHEMA_VERSION, "key": key, "folder": folder, "dims": dims, "n_vectors": n_fit, "n_unfit": n_all - n_fit, "centres": centres.tolist(),
        "cells": {str(c): {"n": r.n, "radius": r.radius} for c, r in sorted(cells.items())},
    }
    manifest["version"] = V.commit(spark, root, manifest)
    return manifest


class VectorIndex:
    """The current version of a stored vector index."""

    def __init__(self, spark: SparkSession, root: str):
        self.manifest = V.current(spark, root)
        if self.manifest is None:
            raise FileNotFoundError(f"no index at {root}")
        if self.manifest["schema_version"] != SCHEMA_VERSION:
            raise ValueError(f"unsupported schema version {self.manifest['schema_version']}")
        self.spark, self.dims = spark, self.manifest["dims"]
        self.centres = np.array(self.manifest["centres"])
        self.radius = np.array([self.manifest["cells"].get(str(c), {"radius": -1.0})["radius"] for c in range(len(self.centres))])

    def blocks(self) -> DataFrame:
        return self.spark.read.schema("part int, ids array<long>, units binary, cell int").parquet(f"{self.manifest['folder']}/blocks")


def opened(vectors: DataFrame, root: str) -> VectorIndex:
    """The index of vectors at root; built if the current version was made from other files or there isn't any."""
    spark, key = vectors.sparkSession, V.fingerprint(vectors)
    now = V.current(spark, root)
    if now is None or now.get("key") != key or now.get("schema_version") != SCHEMA_VERSION:
        try:
            build(vectors, root, key)
        except RuntimeError:
            # Another session may have committed the same index meanwhile; then its one will do.
            now = V.current(spark, root)
            if now is None or now.get("key") != key:
                raise
    return VectorIndex(spark, root)


def _pack_questions(t: pa.Table) -> pa.Table:
    ids, x = t["query_id"].to_pylist(), t["embedding"].combine_chunks()
    units = normalised(x.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1))
    return pa.table({"batch": t["batch"].slice(0, 1).combine_chunks(), "query_ids": pa.array([ids], pa.list_(pa.int64())), "questions": pa.array([units.tobytes()], pa.binary())})


def _grid(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw).reshape(rows, -1)


def _visits(centres: np.ndarray, radius: np.ndarray, probes: int, rest: bool) -> Callable:
    """Batches of questions -> (batch, cell, qs, kth): the nearest cells; rest: those others that may hold a vector among the k best."""
    schema = pa.schema([("batch", pa.int64()), ("cell", pa.int32()), ("qs", pa.list_(pa.int32())), ("least", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            q = _grid(row["questions"], len(row["query_ids"]))
            cosines = np.where(radius >= 0, q @ centres.T, -2)
            near = np.zeros(cosines.shape, bool)
            np.put_along_axis(near, np.argsort(-cosines, 1, kind="stable")[:, :probes], True, 1)
            least = np.full(len(q), -1.0)
            for s in row.get("state") or ():
                least[row["query_ids"].index(s["query_id"])] = s["kth"]
            if rest:
                # The nearest point of a cell is an angle of at least (angle to the centre - radius) away; no vector has an angle to zeros.
                best = np.where(q.any(1)[:, None], np.cos(np.maximum(0, np.arccos(np.clip(cosines, -1, 1)) - radius)), 0)
                near = ~near & (1 / (2 - best) + _SLACK >= least[:, None])
            near &= radius >= 0
            at = np.flatnonzero(near.any(0))
            qs = [np.flatnonzero(near[:, c]) for c in at]
            cells = [*at.tolist(), *([] if rest else [_ZERO])]
            qs += [] if rest else [np.arange(len(q))]
            yield pa.RecordBatch.from_arrays([pa.array([row["batch"]] * len(cells), pa.int64()), pa.array(cells, pa.int32()), pa.array([x.tolist() for x in qs], pa.list_(pa.int32())), pa.array([least[x].tolist() for x in qs], pa.list_(pa.float64()))], schema=schema)

    return run


def _scored(k: int, own: bool) -> Callable:
    """Batch and block -> (query_id, vec_id, score): each question's best k vectors of the block."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            asked, ids = np.array(row["query_ids"])[row["qs"]], np.array(row["ids"])
            score = np.round(1 / (2 - _grid(row["questions"], len(row["query_ids"]))[row["qs"]] @ _grid(row["units"], len(ids)).T), 6)
            score[(own & (asked[:, None] == ids)) | (score < np.array(row["least"])[:, None])] = -1
            order = np.lexsort((np.broadcast_to(ids, score.shape), -score))[:, :k]
            kept = np.take_along_axis(score, order, 1)
            keep = kept >= 0
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asked, order.shape[1])[keep.ravel()]), pa.array(ids[order].ravel()[keep.ravel()]), pa.array(kept.ravel()[keep.ravel()])], schema=schema)

    return run


def search(index: VectorIndex, questions: DataFrame, k: int = 10, probes: int = 8, exact: bool = True, rank: str = "dense_rank", own: bool = True) -> DataFrame:
    """query_id, vec_id, score = 1 / (1 + cosine distance), rank of the k best vectors of each question (query_id, embedding).

    own: a question's id is a vector's, which is no hit of it.
    """
    fit = V.held(_usable(questions, "query_id").where(F.size("embedding") == index.dims), "questions")
    n = max(1, -(-fit.count() // BATCH))
    packed = fit.withColumn("batch", F.pmod(F.xxhash64("query_id"), F.lit(n))).groupBy("batch").applyInArrow(_pack_questions, "batch long, query_ids array<long>, questions binary")
    packed = V.held(packed, "batches")
    visited, schema = "batch long, cell int, qs array<int>, least array<double>", "query_id long, vec_id long, score double"
    best = lambda scores: top_per_key(scores, ["query_id"], k, rank, F.desc("score"), F.col("vec_id"))

    def scores(visits: DataFrame) -> DataFrame:
        return visits.join(packed, "batch").join(index.blocks().hint("merge"), "cell").mapInArrow(_scored(k, own), schema)

    near = scores(packed.mapInArrow(_visits(index.centres, index.radius, probes, False), visited))
    if not exact:
        return best(near)
    near = V.held(best(near), "near")
    kth = near.where(F.col(rank) == k).select("query_id", F.col("score").alias("kth"))
    state = packed.select("batch", F.explode("query_ids").alias("query_id")).join(kth, "query_id").groupBy("batch").agg(F.collect_list(F.struct("query_id", "kth")).alias("state"))
    rest = scores(packed.join(state, "batch", "left").mapInArrow(_visits(index.centres, index.radius, probes, True), visited))
    return best(near.drop(rank).unionByName(rest))
