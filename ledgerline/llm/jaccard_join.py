"""Set similarity self-join on five-word shingles by chosen paths (operator 9).

1. Texts of equal shingle sets collapse to one set with a count of copies.
2. A set is embedded as 64 MinHash values (32 bits choose paths; the lowest 8 bits travel to be compared, which can only add candidates). In each run a set chooses paths: at each node of a tree it goes on to
   the children of those of its values that a hash of (path, value) picks, each with probability 1 / (threshold * 64). Similar
   sets pick the same values of those they share. Sets whose estimate by the MinHash values reaches threshold - 0.2 (four standard
   deviations) join one candidate cluster. Two first runs compare within blocks of the first level's buckets only, which joins most of
   any large group. In the runs that count a bucket whose sets are of one cluster needs no look, pairs within a cluster aren't
   compared, and a bucket returns fewer edges than it holds clusters. A level is one shuffle: buckets of at most `bucket` sets are brute-forced as
   they pass, larger ones go out with their sizes; those of at most `bucket` clusters are brute-forced in blocks, the others split on, and what the deepest level leaves too large is brute-forced in pairs of blocks.
3. Every set of a candidate cluster is shipped once for each block of its cluster, and all pairs within the cluster are verified
   exactly by sparse products, block against block. A set's links are counted there and summed: pairs are compared, since a
   link that is counted has to be verified, but never emitted. Verified links give the classes.

The runs are repeated until a pair at the threshold is found with `target_recall`, reckoned for the deepest level that is in use; only sets
whose buckets were split get the further runs. The sketch test alone lets 0.99987 of the pairs at 0.8 through. A cluster
needs no pair to be found more than once, nor all of its pairs. Sets are told apart by 64-bit hashes.

Words are lower-cased and parted by ASCII white space. Defined results: a text of one to four words is one shingle; null, empty and
wordless texts and null doc_ids are linked to nothing and are their own class (class_id = doc_id); a text of any length is one set, and a
set larger than a block is a block of its own; rows that repeat a doc_id and text are copies, of which any one stays; ties at the
threshold are links; an empty table gives an empty table; extra columns of any name stay where documents are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_HASHES, carried, merged, mix64, shingle_sequence, text_bytes, tune, written
from .components import connected_components

N_VALUES = 64
_MULTIPLIERS = mix64(np.arange(101, 101 + N_VALUES, dtype=np.uint64)) | np.uint64(1)
_SALTS = mix64(np.arange(1, N_VALUES + 1, dtype=np.uint64))


def shingle_set(raw: bytes) -> np.ndarray:
    return np.unique(shingle_sequence(raw, WORD_HASHES))


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (32 bits) of non-empty sets, a row each."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    joined = np.concatenate(sets)
    return np.stack([np.minimum.reduceat(joined * m, starts) >> np.uint64(32) for m in _MULTIPLIERS], axis=1).astype(np.uint32)


def _embedded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(r) for r in b.column(2).to_pylist()]
        some = [i for i, s in enumerate(sets) if len(s)]
        values: list[bytes | None] = [None] * len(sets)
        short = list(values)
        if some:
            for i, row in zip(some, sketches([sets[i] for i in some]), strict=True):
                values[i], short[i] = row.tobytes(), row.astype(np.uint8).tobytes()
        ids = [set_id(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(values, pa.binary()), pa.array(short, pa.binary())], ["doc_id", "row_key", "sid", "n_shingles", "sketch", "short"])


def next_paths(tokens: np.ndarray, rows: np.ndarray, paths: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """One level down: for each (row, path) the children that the row's tokens choose, as (row, path)."""
    picked_rows, picked_paths = [], []
    limit = np.uint64(int(2.0**64 / (threshold * N_VALUES)))
    for at in range(0, len(rows), 4096):
        r, p = rows[at : at + 4096], paths[at : at + 4096]
        h = mix64(tokens[r] ^ p[:, None])
        i, j = np.nonzero(h < limit)
        picked_rows.append(r[i])
        picked_paths.append(mix64(h[i, j] + p[i] * np.uint64(3)))
    empty = np.zeros(0, np.int64)
    return (np.concatenate(picked_rows), np.concatenate(picked_paths)) if picked_rows else (empty, empty.astype(np.uint64))


def path_tokens(values: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(values), np.uint32).reshape(-1, N_VALUES).astype(np.uint64)
    return mix64(v ^ _SALTS)


def _least_values(threshold: float) -> int:
    return int(np.ceil((threshold - 0.2) * N_VALUES))


def pair_recall(runs: int, depth: int, threshold: float) -> float:
    """Chance that a pair at the threshold meets at that depth in one of the runs and passes the sketch test."""
    shared = np.arange(N_VALUES + 1)
    chance = np.array([comb(N_VALUES, k) for k in shared], float) * threshold**shared * (1 - threshold) ** (N_VALUES - shared)
    meets = np.ones(N_VALUES + 1)
    for _ in range(depth):
        meets = 1 - (1 - np.minimum(meets / (threshold * N_VALUES), 1)) ** shared
    return float(((1 - (1 - meets) ** runs) * chance)[_least_values(threshold) :].sum())


def runs_for(target_recall: float, depth: int, threshold: float, most: int = 200) -> int:
    for runs in range(1, most + 1):
        if pair_recall(runs, depth, threshold) >= target_recall:
            return runs
    raise ValueError(f"{most} runs of depth {depth} don't reach a recall of {target_recall}")


_PATHS = "path long, sid long, comp long, short binary"


def _path_batch(paths: np.ndarray, rows: np.ndarray, sid: pa.Array, comp: pa.Array, short: pa.Array) -> pa.RecordBatch:
    at = pa.array(rows)
    return pa.RecordBatch.from_arrays([pa.array(paths.astype(np.int64)), sid.take(at), comp.take(at), short.take(at)], ["path", "sid", "comp", "short"])


def _root_paths(runs: range, threshold: float):
    """(sid, comp, sketch, short) -> the paths of the first level."""
    seeds = mix64(np.arange(runs.start + 1, runs.stop + 1, dtype=np.uint64) * np.uint64(7919))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, paths = next_paths(path_tokens(b.column(2).to_pylist()), np.repeat(np.arange(b.num_rows), len(runs)), np.tile(seeds, b.num_rows), threshold)
            yield _path_batch(paths, rows, b.column(0), b.column(1), b.column(3))

    return run


def _deeper_paths(threshold: float):
    """(path, sid, comp, sketch, short) -> the paths of the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, paths = next_paths(path_tokens(b.column(3).to_pylist()), np.arange(b.num_rows), b.column(0).to_numpy().astype(np.uint64), threshold)
            yield _path_batch(paths, rows, b.column(1), b.column(2), b.column(4))

    return run


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows in order of their first n_keys columns -> (key, rows) by key."""
    current, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[:n_keys] != current:
                if rows:
                    yield current, rows
                current, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield current, rows


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*edges, strict=True) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _merge(labels: np.ndarray, i: int, others: np.ndarray) -> list[int]:
    """Give the groups of `others` the label of i; one place of each group that is new to i's."""
    found = []
    for label in np.unique(labels[others]):
        if label != labels[i]:
            found.append(int(others[np.argmax(labels[others] == label)]))
    for j in found:
        labels[labels == labels[j]] = labels[i]
    return found


def new_edges(sid: np.ndarray, comp: np.ndarray, own: np.ndarray, short: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Fewest edges that link sets which agree in at least `least` values, beyond what one comp links already.

    Of two blocks (own differs) only edges from one to the other: each block by itself finds its own.
    """
    order = np.argsort(comp, kind="stable")
    sid, comp, own, short = sid[order], comp[order], own[order], short[order]
    after = np.searchsorted(comp, comp, side="right")  # the sets from there on are of other clusters
    labels = np.searchsorted(comp, comp)
    two = len(np.unique(own)) > 1
    out = []
    for within in (True, False) if two else (True,):
        for i, at in enumerate(after.tolist()):
            near = ((short[at:] == short[i]).sum(1) >= least) & (labels[at:] != labels[i]) & ((own[at:] == own[i]) == within)
            joined = _merge(labels, i, at + np.flatnonzero(near))
            if within != two:
                out += [(int(sid[i]), int(sid[j])) for j in joined]
    return out


def _bucket_edges(least: int):
    """(path, i, j, own, sid, comp, short) in order -> new_edges of each (path, i, j).

    i and j number blocks of a bucket: (0, 0) is a whole bucket, (i, i) one block, (i, j) two blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, rows in _groups(batches, 3):
            rows = sorted(set(rows))  # two paths of a set can meet in one hash
            own, sid, comp = (np.array([r[k] for r in rows], np.int64) for k in range(3))
            out += new_edges(sid, comp, own, np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, N_VALUES), least)
            if len(out) > 8192:
                yield _edge_batch(out)
                out = []
        yield _edge_batch(out)

    return run


_FOUND = pa.schema([(n, pa.int64()) for n in ("u", "v", "path", "sid", "comp", "part")] + [("short", pa.binary())] + [(n, pa.int64()) for n in ("c", "k", "most", "main")])


def _found_batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FOUND], schema=_FOUND)


class _LargeBucket:
    """A bucket whose rows, in order of cluster, only pass by: rows c, clusters k, and the largest one, `main` with `most` rows."""

    def __init__(self, path: int, limit: int):
        self.path, self.limit, self.c, self.k, self.most, self.main, self.last, self.run = path, limit, 0, 0, 0, 0, None, 0

    def rows(self, sid: np.ndarray, comp: np.ndarray, short: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], comp[1:] != comp[:-1]]))
        for cluster, n in zip(comp[starts].tolist(), np.diff(np.append(starts, len(comp))).tolist(), strict=True):
            if cluster != self.last:
                self.k, self.last, self.run = self.k + 1, cluster, 0
            self.run += n
            if self.run > self.most:
                self.most, self.main = self.run, cluster
        part = (self.c + np.arange(len(sid))) // self.limit
        self.c += len(sid)
        return _found_batch(path=np.full(len(sid), self.path), sid=sid, comp=comp, part=part, short=[r.tobytes() for r in short])

    def sizes(self) -> pa.RecordBatch:
        return _found_batch(path=[self.path], c=[self.c], k=[self.k], most=[self.most], main=[self.main])


def _small_buckets(path: np.ndarray, sid: np.ndarray, comp: np.ndarray, short: np.ndarray, limit: int, least: int) -> Iterator[pa.RecordBatch]:
    """What whole buckets, in order of path, comp and sid, give: new_edges, or the rows and sizes of one of more than `limit` rows."""
    if not len(path):
        return
    starts = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
    ends = np.append(starts[1:], len(path))
    mixed = comp[starts] != comp[ends - 1]
    edges: list[tuple[int, int]] = []
    for at, end in zip(starts[mixed].tolist(), ends[mixed].tolist(), strict=True):
        if end - at > limit:
            bucket = _LargeBucket(int(path[at]), limit)
            yield bucket.rows(sid[at:end], comp[at:end], short[at:end])
            yield bucket.sizes()
            continue
        rows = at + np.flatnonzero(np.concatenate([[True], sid[at + 1 : end] != sid[at : end - 1]]))  # two paths of a set can meet in one hash
        edges += new_edges(comp[rows], comp[rows], np.zeros(len(rows), np.int64), short[rows], least)
    if edges:
        u, v = zip(*edges, strict=True)
        yield _found_batch(u=u, v=v)


def _bucket_pass(limit: int, least: int):
    """(path, sid, comp, short) in order of path, comp and sid -> edges (u, v) between clusters of buckets of at most `limit` rows; of larger ones their
    rows (path, sid, comp, short; part numbers runs of `limit` rows) and one row of sizes. At most `limit` rows and a batch are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros((0, N_VALUES), np.uint8))
        large = None
        for b in batches:
            new = (*(b.column(k).to_numpy() for k in range(3)), np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, N_VALUES))
            if not len(new[0]):
                continue
            rows = tuple(np.concatenate(x) for x in zip(held, new, strict=True)) if len(held[0]) else new
            path = rows[0]
            if large is not None:
                n = int(np.searchsorted(path, large.path, side="right"))
                if n:
                    yield large.rows(*(x[:n] for x in rows[1:]))
                if n == len(path):
                    continue
                yield large.sizes()
                large, rows = None, tuple(x[n:] for x in rows)
                path = rows[0]
            last = int(np.searchsorted(path, path[-1]))  # the last bucket may go on
            yield from _small_buckets(*(x[:last] for x in rows), limit, least)
            held = tuple(x[last:] for x in rows)
            if len(held[0]) > limit:
                large = _LargeBucket(int(path[-1]), limit)
                yield large.rows(*held[1:])
                held = tuple(x[:0] for x in held)
        if large is not None:
            yield large.sizes()
        yield from _small_buckets(*held, limit, least)

    return run


def _in_buckets(paths: DataFrame, threshold: float, limit: int) -> DataFrame:
    """_bucket_pass over the buckets of paths: one shuffle, whatever a bucket holds."""
    kinds = "u long, v long, path long, sid long, comp long, part long, short binary, c long, k long, most long, main long"
    return written(paths.repartition("path").sortWithinPartitions("path", "comp", "sid").mapInArrow(_bucket_pass(limit, _least_values(threshold)), kinds), "found")


def _edges(found: DataFrame) -> DataFrame:
    return found.where("u is not null").select("u", "v")


def _rows(found: DataFrame) -> DataFrame:
    return found.where("sid is not null").select("path", "part", "sid", "comp", "short")


def _block_rows(df: DataFrame, block: int) -> DataFrame:
    """Each row of crowded buckets for every pair of blocks (i, j) that its block `own` is in.

    Blocks of a bucket's main cluster (`most` of its `c` sets, if that is more than a block) meet
    those of the other sets only, so that a very large cluster with few sets beside it goes out once.
    """
    inside = F.when(F.col("most") > block, F.col("most")).otherwise(F.lit(0))
    is_main = (inside > 0) & (F.col("comp") == F.col("main"))
    n_rest = F.ceil((F.col("c") - inside) / block).cast("int")
    n_main = F.ceil(inside / block).cast("int")
    dealt = F.xxhash64("sid", "path")
    own = F.when(is_main, n_rest + F.pmod(dealt, F.greatest(n_main, F.lit(1)))).otherwise(F.pmod(dealt, n_rest)).cast("int")
    others = F.sequence(F.lit(0), n_rest - 1 + F.when(is_main, F.lit(0)).otherwise(n_main))
    out = df.withColumns({"own": own, "other": others}).withColumn("other", F.explode("other"))
    return out.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).select("path", "i", "j", "own", "sid", "comp", "short")


def _compared(keyed: DataFrame, threshold: float) -> DataFrame:
    found = keyed.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j").mapInArrow(_bucket_edges(_least_values(threshold)), "u long, v long")
    return written(found, "found")


def _first_edges(sets: DataFrame, threshold: float, runs: range, block: int) -> DataFrame:
    """Edges (u, v) within buckets of the first level, and within blocks of larger ones: enough to join most of a large group."""
    found = _in_buckets(sets.select("sid", "comp", "sketch", "short").mapInArrow(_root_paths(runs, threshold), _PATHS), threshold, block)
    large = _rows(found)
    if large.isEmpty():
        return _edges(found)
    part = F.col("part").cast("int")
    return _edges(found).unionByName(_compared(large.select("path", part.alias("i"), part.alias("j"), part.alias("own"), "sid", "comp", "short"), threshold))


def _edges_of_runs(sets: DataFrame, threshold: float, runs: range, bucket: int, block: int, depth: int) -> tuple[DataFrame, int, DataFrame | None]:
    """New edges (u, v) that these runs find among sets (sid, comp, sketch, short), the deepest level used, and the sets (sid) of split buckets."""
    paths = sets.select("sid", "comp", "sketch", "short").mapInArrow(_root_paths(runs, threshold), _PATHS)
    edges = split = None
    for level in range(1, depth + 1):
        found = _in_buckets(paths, threshold, bucket)
        edges = _edges(found) if edges is None else edges.unionByName(_edges(found))
        crowded = found.where("k > 1").select("path", "c", "k", "most", "main")
        seen = crowded.agg(F.count("*").alias("n"), F.max("k").alias("k")).first()
        if not seen.n:
            break
        marked = _rows(found).join(F.broadcast(crowded), "path") if seen.n <= 20_000 else merged(_rows(found), crowded, "path")
        last = level == depth or seen.k <= bucket
        small = marked if last else marked.where(F.col("k") <= bucket)
        edges = edges.unionByName(_compared(_block_rows(small, block), threshold))
        if last:
            break
        large = marked.where(F.col("k") > bucket).select("path", "sid", "comp")
        split = large.select("sid") if split is None else split.unionByName(large.select("sid"))
        paths = merged(large, sets.select("sid", "sketch", "short"), "sid").select("path", "sid", "comp", "sketch", "short").mapInArrow(_deeper_paths(threshold), _PATHS)
    return edges, level, split


def candidate_clusters(sets: DataFrame, threshold: float, target_recall: float, bucket: int, block: int, depth: int, first_runs: int = 2) -> DataFrame:
    """(node, root) of the sets (sid, sketch, short) that lie in candidate clusters.

    `first_runs` runs, which don't count for the recall, join most sets of large groups. The runs that count follow. Only a pair of
    sets that both were in split buckets has to meet below the first level, so only these sets get the runs for deeper levels.
    """
    own = sets.withColumn("comp", F.col("sid"))
    known = connected_components(_first_edges(own, threshold, range(1_000_000, 1_000_000 + first_runs), block))
    pool = merged(sets, known, sets["sid"] == known["node"], "left").select("sid", F.coalesce("root", "sid").alias("comp"), "sketch", "short")
    pool, split = written(pool, "pool"), None
    edges = known.select(F.col("node").alias("u"), F.col("root").alias("v"))
    done, deepest = 0, 1
    while done < (wanted := runs_for(target_recall, deepest, threshold)):
        at_hand = pool if split is None else written(merged(pool, split.distinct(), "sid", "left_semi"), "split")
        found, level, parted = _edges_of_runs(at_hand, threshold, range(done, wanted), bucket, block, depth)
        edges = edges.unionByName(found)
        if parted is not None:
            split = parted if split is None else split.unionByName(parted)
        deepest, done = max(deepest, level), wanted
    return connected_components(edges)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes, by products over slices of the shingles that at least two sets hold."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    number = np.cumsum(often) - 1
    keep = often[inverse]
    column, row = number[inverse[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    total = np.zeros((n, n), np.float32)
    width = 2048
    for at in range(0, int(often.sum()), width):
        a, b = np.searchsorted(column, [at, at + width])
        x = np.zeros((n, width), np.float32)
        x[row[a:b], column[a:b] - at] = 1
        total += x @ x.T
    return total.astype(np.int32)


def _block_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(comp, n_blocks, sid, copies, text) -> a row for each pair of blocks, with the set; rows whose text isn't the set's go."""
    names = ["comp", "i", "j", "own", "sid", "copies", "whole", "shingles"]
    for b in batches:
        out, size = [], 0
        for comp, n_blocks, sid, copies, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
            shingles = shingle_set(raw)
            if not len(shingles) or set_id(shingles) != sid:
                continue
            own = int(mix64(np.array([sid], np.int64).astype(np.uint64))[0] % np.uint64(n_blocks))
            packed = shingles.tobytes()
            for other in range(n_blocks):
                out.append((comp, min(own, other), max(own, other), own, sid, copies, n_blocks == 1, packed))
                size += len(packed)
                if size > 16 << 20:
                    yield _key_batch(out, names)
                    out, size = [], 0
        yield _key_batch(out, names)


def _key_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _verified(percent: int):
    """Groups (comp, i, j) -> for each set of a group: its links there (counted by copies), the smallest set of its part, and
    whether that group is its whole cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.bool_()], strict=True)], ["sid", "links", "root", "whole"])
            out.clear()
            return found

        for (_, i, j), rows in _groups(batches, 3):
            by_sid = {r[1]: r for r in rows}  # rows that repeat a doc_id give a set again
            rows = [by_sid[s] for s in sorted(by_sid)]
            if len(rows) < 2:
                continue
            own, copies = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
            sets = [np.frombuffer(r[4], np.uint64) for r in rows]
            size = np.array([len(s) for s in sets], np.int32)
            shared = shared_counts(sets)
            near = (100 + percent) * shared.astype(np.int64) >= percent * (size[:, None] + size[None, :])
            np.fill_diagonal(near, False)
            if i != j:
                near &= own[:, None] != own[None, :]
            links = near @ copies
            ids = [r[1] for r in rows]
            labels = np.arange(len(ids))
            for k in range(len(ids)):
                _merge(labels, k, np.flatnonzero(near[k]))
            smallest = {int(x): ids[int(np.argmax(labels == x))] for x in np.unique(labels)}
            out += [(ids[k], int(links[k]), smallest[int(labels[k])], rows[0][3]) for k in range(len(ids)) if links[k]]
            if len(out) > 4096:
                yield batch()
        yield batch()

    return run


def similarity_classes(
    docs: DataFrame, threshold: float = 0.8, target_recall: float = 0.9998, bucket: int = 1024, block: int = 2048, depth: int = 4, block_sets: int = 512, block_shingles: int = 500_000
) -> DataFrame:
    """doc_id, row_key (hash of the text), class_id, n_links and root (the class's set id, null without words or doc_id) for every row of docs."""
    spark = docs.sparkSession
    tune(spark)
    key = F.xxhash64(text_bytes()).alias("row_key")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, text_bytes().alias("raw"))
    rows = written(slim.mapInArrow(_embedded, "doc_id long, row_key long, sid long, n_shingles long, sketch binary, short binary"), "sketches")
    usable = rows.where(F.col("sid").isNotNull() & F.col("doc_id").isNotNull())
    sets = written(usable.groupBy("sid").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch"), F.max("short").alias("short")), "sets")
    clusters = candidate_clusters(sets.select("sid", "sketch", "short"), threshold, target_recall, bucket, block, depth)
    members = merged(clusters.select(F.col("node").alias("sid"), F.col("root").alias("comp")), sets.drop("sketch", "short"), "sid")
    sizes = members.groupBy("comp").agg(F.count("*").alias("g"), F.sum("n_shingles").alias("total"))
    sizes = sizes.select("comp", F.greatest(F.ceil(F.col("g") / block_sets), F.ceil(F.col("total") / block_shingles)).cast("int").alias("n_blocks"))
    wanted = merged(members, sizes, "comp").select(F.col("first_doc").alias("doc_id"), "comp", "n_blocks", "sid", "copies")
    texts = slim.select("doc_id", "raw").join(wanted.hint("shuffle_hash"), "doc_id").select("comp", "n_blocks", "sid", "copies", "raw")
    keyed = texts.mapInArrow(_block_keys, "comp long, i int, j int, own int, sid long, copies long, whole boolean, shingles binary")
    verified = written(keyed.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(_verified(round(100 * threshold)), "sid long, links long, root long, whole boolean"), "links")
    found = verified.groupBy("sid").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    parts = verified.where("not whole").select(F.col("sid").alias("u"), F.col("root").alias("v"))
    if not parts.isEmpty():  # clusters of several blocks: what the pairs of blocks found apart is joined
        across = connected_components(parts).select(F.col("node").alias("sid"), F.col("root").alias("joined"))
        found = merged(found, across, "sid", "left").select("sid", "links", F.coalesce("joined", "root").alias("root"))
    info = merged(sets.select("sid", "first_doc", "copies"), found, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = info.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    by_set = merged(info, least, "root").select("sid", "root", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = merged(rows.select("doc_id", "row_key", F.when(F.col("doc_id").isNotNull(), F.col("sid")).alias("sid")), by_set, "sid", "left")
    return out.select("doc_id", "row_key", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "root")


def join_report(docs: DataFrame) -> DataFrame:
    return similarity_classes(docs).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of docs for each class, its smallest doc_id's; rows with a null doc_id and texts without words all stay."""
    marked = similarity_classes(docs, **options)
    # A class is told by its root: two classes can share a doc_id that has two texts, and so a class_id.
    least = marked.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct("doc_id", "row_key")).alias("least")).select("least.*")
    alone = marked.where(F.col("root").isNull() & F.col("doc_id").isNotNull()).select("doc_id", "row_key")
    keep = least.unionByName(alone).distinct()
    left = carried(docs).withColumns({"doc_id": F.col("row.doc_id").cast("long"), "row_key": F.xxhash64(text_bytes("row.text"))})
    held = merged(left.where(F.col("doc_id").isNotNull()), keep, ["doc_id", "row_key"], "left_semi")
    wordless = ~F.coalesce("row.text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    single = held.where(~wordless).dropDuplicates(["doc_id", "row_key"]).unionByName(held.where(wordless))
    return single.unionByName(left.where(F.col("doc_id").isNull())).select("row.*")
