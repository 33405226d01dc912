"""Stored indexes: versions and manifests, the inverted index and the vector index, against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import inverted as IX
from ledgerline.operators import retrieval as R
from ledgerline.operators import vector_index as VX
from ledgerline.sources import versions as V


def test_versions(spark, tmp_path):
    root = f"{tmp_path}/store"
    assert V.current(spark, root) is None and V.committed(spark, root) == []
    assert V.commit(spark, root, {"folder": "a", "text": "é"}) == 1 and V.commit(spark, root, {"folder": "b"}) == 2
    # A writer that ends before its commit leaves a folder and a staged file that no reader looks at.
    spark.range(3).write.parquet(f"{root}/data-broken")
    V._write_text(spark, f"{root}/.staged-x", "{")
    assert V.current(spark, root) == {"folder": "b", "version": 2}
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, s string")
    assert V.counts_by(rows, "s") == {"": 1, "a": 2}
    assert V.digest(rows) == V.digest(rows.repartition(2).select("s", "x")) != V.digest(rows.distinct())
    with pytest.raises(ValueError):
        V.counts_by(rows, "x", 1)


def tokens(text):
    return re.findall(r"[a-z0-9@._'\-]+", (text or "").lower())


def brute_bm25(docs, questions, k):
    bags = [(i, tokens(t)) for i, t in docs]
    avgdl = sum(len(b) for _, b in bags) / len(bags)
    df = Counter(t for _, b in bags for t in set(b))
    idf = {t: math.log(len(bags) - n + 0.5) - math.log(n + 0.5) for t, n in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf) if idf else 0
    out = []
    for q, text in questions:
        scores = []
        for i, bag in bags:
            tf = Counter(bag)
            part = lambda t: (floor if idf[t] < 0 else idf[t]) * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(bag) / avgdl))  # noqa: B023, E731
            scores.append((-round(sum(part(t) for t in tokens(text) if tf[t]), 6), i))
        out += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def same(got, want):
    got, want = sorted(map(tuple, got)), sorted(want)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert all(abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, want, strict=True))


def test_inverted_index(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    words = ["the"] * 30 + [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(3000)]
    docs += [(9000, None), (9001, ""), (9002, "Unique@Word.x the the"), (9003, "w1 " * 5000)]
    questions = [(1, "w1 w2 w2"), (2, "the"), (3, "unique@word.x"), (4, "nothing-known"), (5, ""), (6, "w5 the w7 w9 w11"), (7, "W1 w3 w1")]
    df = spark.createDataFrame(docs, "chunk_id long, text string").withColumn("kind", F.lit("k")).repartition(2)
    df.write.parquet(f"{tmp_path}/docs")
    stored = spark.read.parquet(f"{tmp_path}/docs")
    index = IX.opened(stored, f"{tmp_path}/index")
    asked = spark.createDataFrame(questions, "query_id long, text string")
    # Over 3,000 documents there are several ranges, so that bounds leave some out.
    assert index.postings(list(range(5000))).select("range").distinct().count() > 4
    for k in (1, 10):
        same(IX.search(index, asked, k, first=1).collect(), brute_bm25(docs, questions, k))
    assert index.documents().columns[:2] == ["chunk_id", "kind"] and "text" not in index.documents().columns
    assert IX.opened(stored, f"{tmp_path}/index").manifest["version"] == 1
    stored.limit(5).write.mode("append").parquet(f"{tmp_path}/docs")
    assert IX.opened(spark.read.parquet(f"{tmp_path}/docs"), f"{tmp_path}/index").manifest["version"] == 2
    with pytest.raises(ValueError):
        IX.build(stored.where("false"), f"{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        IX.Index(spark, f"{tmp_path}/none")


def test_index_reads_only_its_buckets(spark, tmp_path):
    index_of = spark.createDataFrame([(i, f"word{i} common") for i in range(200)], "chunk_id long, text string")
    IX.build(index_of, f"{tmp_path}/i")
    plan = IX.search(IX.Index(spark, f"{tmp_path}/i"), spark.createDataFrame([(1, "word7")], "query_id long, text string"), 3)
    assert "tokens" not in plan._jdf.queryExecution().toString().split("Physical Plan")[1].split("questions")[0]
    one = IX.Index(spark, f"{tmp_path}/i").postings([3])
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()


def brute_nearest(rows, asked, k, own=True):
    unit = lambda x: np.array(x, float) / max(np.linalg.norm(np.array(x, float)), 1e-300)
    out = []
    for q, x in asked:
        scores = sorted((-round(float(1 / (2 - unit(x) @ unit(y))), 6), i) for i, y in rows if not (own and i == q))
        out += [(q, i, -s, r) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


VECTORS = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("spread", [0.05, 5.0])
def test_vector_index(spark, tmp_path, monkeypatch, spread):
    monkeypatch.setattr(VX, "PER_CELL", 25)
    monkeypatch.setattr(VX, "BLOCK", 16)
    monkeypatch.setattr(VX, "BATCH", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 12))
    rows = [(i, [float(v) for v in (centres[i % 9] + spread * rng.normal(size=12)).astype(np.float32)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(500, 640)] + [(700, [0.0] * 12)]  # One vector many times, and zeros.
    odd = [(800, None), (801, [1.0, None] + [0.0] * 10), (802, [float("nan")] * 12), (803, [1.0, 2.0]), (None, rows[1][1]), (804, [])]
    VX.build(spark.createDataFrame(rows + odd, VECTORS).repartition(3), f"{tmp_path}/v")
    index = VX.VectorIndex(spark, f"{tmp_path}/v")
    assert (index.manifest["n_vectors"], index.manifest["n_unfit"]) == (len(rows), len(odd))
    asked = [r for r in rows if r[0] % 20 == 0] + [(9999, [1.0] * 12), (9998, [0.0] * 12)]
    questions = spark.createDataFrame(asked + [(9997, [1.0]), (9996, None)], VECTORS.replace("vec_id", "query_id"))
    same(VX.search(index, questions, 10, probes=2).collect(), brute_nearest(rows, asked, 10))
    same(VX.search(index, questions, 3, probes=1, own=False).collect(), brute_nearest(rows, asked, 3, own=False))
    near = {tuple(r)[:2] for r in VX.search(index, questions, 10, probes=8, exact=False).collect()}
    want = {r[:2] for r in brute_nearest(rows, asked, 10)}
    assert len(near & want) >= (0.95 if spread < 1 else 0.5) * len(want)


def test_cells_are_left_out():
    """A far cell that can't hold a better vector isn't visited, one that may is."""
    centres, radius = np.array([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]]), np.array([0.1, 0.1, 3.0])
    row = {"batch": 0, "query_ids": [5], "questions": np.array([[1.0, 0.0]]).tobytes(), "state": [{"query_id": 5, "kth": 0.9}]}
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([row])
    assert [b.column("cell").to_pylist() for b in VX._visits(centres, radius, 1, True)(iter([batch]))] == [[2]]
    assert [b.column("cell").to_pylist() for b in VX._visits(centres, radius, 1, False)(iter([batch]))] == [[0, -1]]


def test_hashed_vectors(spark):
    rows = [(1, "a b a"), (2, None), (3, " "), (4, "A  B\na")]
    got = {r.doc_id: r.embedding for r in R.hashed_vectors(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == got[4] and not any(got[2]) and not any(got[3]) and abs(sum(v * v for v in got[1]) - 1) < 1e-9 and len(got[1]) == 384


def test_eval_passes_search_the_indexes_once(spark, monkeypatch):
    from ledgerline.operators import retrieval
    from ledgerline.plans.catalog import QUERIES

    calls = []
    for module in (IX, VX):
        monkeypatch.setattr(module, "search", lambda *a, f=module.search, name=module.__name__, **options: (calls.append(name), f(*a, **options))[1])
    assert retrieval.inverted is IX and QUERIES["eval_passes"](spark, "/root/testdata/sf0.001").count() == 6
    assert sorted(calls) == sorted(m.__name__ for m in (IX, VX))


def test_a_bucket_of_few_documents_is_one_file(spark, tmp_path):
    """However many tasks have read the documents: at 6 GB a file for each task and bucket would be some hundred thousand files."""
    docs = spark.range(4000, numPartitions=8).select(F.col("id").alias("chunk_id"), F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), F.col("id") % (7 + k)) for k in range(12)]).alias("text"))
    IX.build(docs, f"{tmp_path}/i")
    folders = list(tmp_path.glob("i/data-*/postings/bucket=*"))
    assert len(folders) > 8 and {len(list(f.glob("*.parquet"))) for f in folders} == {1}
