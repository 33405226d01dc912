"""Merkle manifest, exact search and prefix trie against brute force, with odd rows and uneven groups."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import blockmax, merkle, prefix_trie
from tests.llm.test_operators import DOCS, corpus


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def brute_manifest(rows):
    """rows: doc_id, text, lang, source, n_chars -> report rows, sorted."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(field(r[0]) + field(r[3]) + field(r[2]) + field(r[4]) + field(text))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = brute_levels([leaf(r, r[1]) for r in by[s]])
    top = brute_levels([trees[s][-1][0] for s in sources]) if rows else [[sha("")]]
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            chosen = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            fold, siblings = leaf(r, r[1].translate(lower) if chosen else r[1]), ""
            for tree, j in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    left, right = "".join(level[j // 16 * 16 : j]), "".join(level[j + 1 : j // 16 * 16 + 16])
                    fold, siblings, j = sha(left + fold + right), siblings + left + right, j // 16
            out.append((str(r[0]), leaf(r, r[1]), trees[s][-1][0], top[-1][0], sha(siblings), fold, fold == top[-1][0]))
    return sorted(out)


def manifest(spark, rows):
    found = merkle.manifest_report(spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], DOCS.replace("row string", "tree string").replace("row_key", "place").replace("__doc", "merkle_row")).repartition(3))
    return sorted((str(r.doc_id), *r[1:]) for r in found.collect())


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, "b": 1}, {"a": 17, None: 3, "": 1, "é": 16, "z": 2}, {"hot": 600, None: 257, "w": 256, **{f"s{i}": 1 for i in range(40)}}])
def test_manifest(spark, sizes):
    rows = [(7 * i, f"Text {i} of {s}", None if i % 3 else "en", s, i) for s, n in sizes.items() for i in range(n)]
    assert manifest(spark, rows) == brute_manifest(rows)


def test_manifest_of_odd_rows(spark):
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in corpus()] + [(None, None, None, None, None)] * 300 + [(5, "Same Text", "en", "s", 1)] * 20
    assert manifest(spark, rows) == brute_manifest(rows)
    assert manifest(spark, []) == []


def test_proofs_fold_to_the_root(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(300)]
    found, root = merkle.inclusion_proofs(spark.createDataFrame([(*r, None, None, None, None) for r in rows], DOCS))
    top = found.select(merkle.folded(found["digest"], found["proof"]).alias("root"), "subroot").distinct().collect()
    assert [(r.root, r.subroot) for r in top] == [(root, root)]
    assert found.selectExpr("max(size(proof)) AS n").first().n == 3


VECTORS = "vec_id long, embedding array<float>, mark string, place int, block string, q int"


def brute_search(rows, every=50, k=5):
    fit = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (i, x) in enumerate(fit):
        if i is not None and i % every == 0:
            scores = sorted((-sum(u * v for u, v in zip(x, y, strict=False)), j is None, j or 0) for b, (j, y) in enumerate(fit) if a != b)
            out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def search(spark, rows):
    found = blockmax.search_report(spark.createDataFrame([(*r, "m", 1, "b", 2) for r in rows], VECTORS).repartition(3))
    return sorted(map(tuple, found.collect()), key=str)


def vectors(n, dims, spread, seed=3):
    """n vectors about 12 directions; the smaller spread, the tighter."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dims))
    return [(i, [float(v) for v in row.astype(np.float32)]) for i, row in enumerate(x)]


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_search(spark, monkeypatch, spread):
    monkeypatch.setattr(blockmax, "BLOCK", 16)
    rows = vectors(700, 8, spread)
    assert search(spark, rows) == brute_search(rows)


def test_search_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(blockmax, "BLOCK", 8)
    rows = vectors(150, 6, 0.3)
    rows += [(i, rows[50][1]) for i in range(200, 400)]  # One vector many times: ties go to the smaller id.
    rows += [(1000, None), (1050, [None, 1.0]), (1100, [float("nan")] * 6), (1150, [float("inf"), 1.0]), (1200, []), (1250, [2.0]), (1300, [1.0] * 40), (None, [9.0] * 6), (None, rows[0][1]), (50, rows[3][1]), (-50, [-300.0] * 6)]
    assert search(spark, rows) == brute_search(rows)
    assert search(spark, []) == [] and search(spark, [(1000, None)]) == [] and search(spark, [(0, [1.0])]) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    q, near, far = rng.integers(-400, 400, (4, 10)), rng.integers(-50, 50, (30, 10)), rng.integers(-50, 50, (30, 10))
    near = near + 5 * q[0]
    sides = {"high": np.stack([near.max(0), far.max(0)]).tobytes(), "low": np.stack([near.min(0), far.min(0)]).tobytes()}
    kth = int(np.sort(blockmax.products(q[:1], near)[0])[-5])
    row = {"ids": [0, 50, 100, 150], "blocks": [0, 1], "weights": q.tobytes(), "dims": 10, "chunk_dims": 10, **sides, "state": [{"q": 0, "kth": kth, "bound": (1 << 63) - 1, "block": -1}]}
    bounds, _, todo = blockmax._bounds(row)
    assert (bounds[:, 0] >= blockmax.products(q, near).max(1)).all() and (bounds[:, 1] >= blockmax.products(q, far).max(1)).all()
    assert todo.tolist() == [[True, False]] + [[True, True]] * 3


def test_products_are_exact():
    a, b = np.array([[2**40, 3], [-(2**31), 1]]), np.array([[2**20, 5], [2**31, -7]])
    assert blockmax.products(a[1:], b).tolist() == [[-(2**51) + 5, -(2**62) - 7]]
    assert blockmax.products(a[:1], b[:1]).tolist() == [[2**60 + 15]]
    with pytest.raises(OverflowError):
        blockmax.products(a[:1], b[1:])


TURNS = "conv_id long, turn long, role string, text string, place int, p string, mark long, base int"


def brute_trie(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    first = lambda c: (c is not None, c or 0)
    by = {c: [t[1:] for t in sorted(v)] for c, v in by.items()}
    members = defaultdict(list)
    for c, own in by.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        walk = tuple(([] if c is None else by.get(c - int(math.fmod(c, 5)), [])[:h]) + own[h:])
        for d in range(len(walk) + 1):
            members[hash(walk[:d]), d].append((c, walk, len(walk) == d))
    total, kids, above = {}, defaultdict(set), {}
    for node, found in members.items():
        if node[1]:
            above[node] = hash(found[0][1][: node[1] - 1]), node[1] - 1
            kids[above[node]].add(node)
    for node in sorted(members, key=lambda n: -n[1]):
        own = (len(members[node]) - 1) * len(members[node][0][1][node[1] - 1][1].encode()) if node[1] else 0
        total[node] = (sum(total[k][0] for k in kids[node]) or 1, own + sum(total[k][1] for k in kids[node]))
    least = lambda node: min((m[0] for m in members[node]), key=first)
    out = []
    for node, found in members.items():
        ends = sorted((c for c, _, end in found if end), key=first)
        out.append((least(node), node[1], least(above[node]) if node[1] else None, len(found), len(kids[node]), *total[node], sha(",".join("null" if c is None else str(c) for c in ends))))
    return sorted(out, key=str)


def trie(spark, rows):
    found = prefix_trie.trie_report(spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], TURNS).repartition(3))
    return sorted(map(tuple, found.collect()), key=str)


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)  # So that walks and paths span blocks.
    rng = random.Random(5)
    rows = []
    for c in range(-12, 120):
        # Few different texts, so that conversations share turns at any depth; some have none after their family's.
        rows += [(c, t, rng.choice(("user", "assistant", None)), rng.choice(("a", "bb", "é", "", None))) for t in range(rng.choice((1, 2, 3, 9, 12)))]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_odd_rows(spark):
    long = [(t, "user", f"turn {t} é") for t in range(2500)]
    rows = [(c, *t) for c in (5, 9, 10, 14, 200, 204) for t in long]
    rows += [(c, 0, "user", "the same") for c in range(1000, 1400)]  # One conversation many times.
    rows += [(None, t % 7, "user", f"{t % 50}") for t in range(300)] + [(77, None, None, None)] * 3 + [(77, 0, "user", "x" * 200_000), (81, 0, "user", "y"), (81, 0, "assistant", "y")]
    assert trie(spark, rows) == brute_trie(rows)
    assert trie(spark, []) == []
