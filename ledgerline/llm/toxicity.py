"""Toxicity by subword-bag embeddings and a linear softmax (operator 5), trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5, with word ends) and itself, hashed to buckets; its vector is their mean,
a passage's vector the mean of its words' vectors, and a linear softmax over two classes reads it. Misspellings unseen in
training share most n-grams with words that were seen. A document is read as overlapping passages of WINDOW words, since a few
words may make a long text toxic: in training, after a first phase, each document stands for its currently most
toxic passage; in scoring, its most toxic passage, the third of its most toxic different words and the number of passages go through
a calibration fitted on a part of the training rows that the embeddings never saw. Every word of every document counts.

Fitting takes at most `max_toxic` toxic and `max_clean` clean labelled documents, the first by a hash of doc_id, none of the held-out
fold. Labels, lang, source and doc_id are no inputs of a score.

Defined results: of the texts of a repeated doc_id one is trained on; a text of any length is scored whole; a score that ties with 0.5 is
toxic; null or empty texts score the calibrated value of a passage without evidence; with no labelled rows of both
classes every score is 0; repeated rows score alike; a null doc_id is not held out; an empty table gives an empty table.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import decode, text_bytes, tune

WINDOW, STRIDE, STRONGEST = 4, 2, 3
BUCKETS, SIZE, MIN_DOCS = 1 << 17, 16, 3
_PART = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return decode(raw).lower().encode().translate(_PART).split()


def subwords(word: bytes) -> list[int]:
    """Buckets of a word's n-grams and of the word."""
    marked = f"<{decode(word)}>"
    n = len(marked)
    grams = {marked} | {marked[i : i + k] for k in (3, 4, 5) for i in range(n - k + 1)}
    return [xxhash.xxh32_intdigest(g) & (BUCKETS - 1) for g in sorted(grams)]


def passage_bounds(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the passages of a text of n words; the last one ends with the text."""
    if n <= WINDOW:
        return np.array([0]), np.array([n])
    starts = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    starts[-1] = n - WINDOW
    return starts, starts + WINDOW


def top_passage(logits: np.ndarray) -> tuple[float, int, int]:
    """The largest mean over passages, its passage's start, and the number of passages."""
    if not len(logits):
        return 0.0, 0, 1
    starts, ends = passage_bounds(len(logits))
    total = np.concatenate([[0.0], np.cumsum(logits)])
    means = (total[ends] - total[starts]) / (ends - starts)
    best = int(means.argmax())
    return float(means[best]), int(starts[best]), len(starts)


def third_word(logits: np.ndarray) -> float:
    """The STRONGEST-th largest logit of a document's different words (the least one if it has fewer; 0 without words)."""
    n = len(logits)
    return float(np.partition(logits, max(n - STRONGEST, 0))[max(n - STRONGEST, 0)]) if n else 0.0


class Model:
    """What executors need: the logit of each bucket, and the calibration."""

    def __init__(self, bucket_logits: np.ndarray, bias: float, calibration: np.ndarray):
        self.bucket_logits, self.bias, self.calibration = bucket_logits, bias, calibration

    def word_logit(self, word: bytes) -> float:
        return float(self.bucket_logits[subwords(word)].mean())

    def score(self, top: float, third: float, n_passages: int) -> float:
        z = self.calibration @ [top + self.bias, third + self.bias, np.log(n_passages), 1.0]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; x has a column of ones last."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[bytes], labels: list[int], steps: int | None = None, seed: int = 11) -> Model | None:
    """Train embeddings and softmax together by Adagrad on balanced batches; None without rows of both classes."""
    y = np.array(labels, np.int64)
    if len(y) == 0 or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    index: dict[bytes, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int32) for t in texts]
    buckets_of, sizes = array("i"), array("i")  # flat: a list of lists of numbers would take ten times the memory
    for w in index:
        own = subwords(w)
        buckets_of.extend(own)
        sizes.append(len(own))
    index.clear()
    lengths = np.array(sizes, np.int64)
    flat = np.array(buckets_of, np.int32)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
    emb = (rng.standard_normal((BUCKETS, SIZE)) / SIZE).astype(np.float32)
    soft, bias = np.zeros((2, SIZE), np.float32), np.zeros(2, np.float32)
    g_emb, g_soft = np.full(BUCKETS, 1e-4, np.float32), np.full((2, SIZE), 1e-4, np.float32)
    kept_out = rng.random(len(docs)) < 0.25
    train = np.flatnonzero(~kept_out & (np.array([len(d) for d in docs]) > 0))
    by_class = [train[y[train] == c] for c in (0, 1)]
    if not all(map(len, by_class)):
        return None
    # An n-gram of fewer than MIN_DOCS training documents says nothing: its vector stays zero.
    spread = np.zeros(BUCKETS, np.int64)
    for d in train:
        own = np.unique(docs[d])
        n_own = lengths[own]
        spread[np.unique(flat[np.repeat(first[own] - np.concatenate([[0], np.cumsum(n_own)[:-1]]), n_own) + np.arange(n_own.sum())])] += 1
    known = spread >= MIN_DOCS
    emb[~known] = 0
    steps = steps or int(np.clip(800 + len(by_class[1]), 1000, 2500))
    refresh = 60  # steps between two choices of passages

    def word_logits() -> np.ndarray:
        per_bucket = emb @ (soft[1] - soft[0])
        return np.add.reduceat(per_bucket[flat], first) / lengths if len(first) else np.zeros(0)

    logits = None
    for step in range(steps):
        if step >= steps // 3 and (logits is None or step % refresh == 0):
            logits = word_logits()
        rate = 0.5 * (1 - step / steps) + 0.02
        batch = np.concatenate([rng.choice(rows, 32) for rows in by_class])
        bags = []
        for d in batch:
            if logits is None:
                bags.append(rng.choice(docs[d], 4 * WINDOW))
            else:
                at = top_passage(logits[docs[d]])[1]
                bags.append(docs[d][at : at + WINDOW])
        size = np.array([len(b) for b in bags])
        used, inverse = np.unique(np.concatenate(bags), return_inverse=True)
        share = np.repeat(1 / size, size).astype(np.float32)
        row = np.repeat(np.arange(len(bags)), size)
        # Subwords of the words used: flat positions by ranges.
        n_sub = lengths[used]
        at = np.repeat(first[used] - np.concatenate([[0], np.cumsum(n_sub)[:-1]]), n_sub) + np.arange(n_sub.sum())
        buckets = flat[at]
        starts = np.concatenate([[0], np.cumsum(n_sub)[:-1]])
        vectors = np.add.reduceat(emb[buckets], starts) / n_sub[:, None]
        hidden = np.add.reduceat(vectors[inverse] * share[:, None], np.concatenate([[0], np.cumsum(size)[:-1]]))
        z = hidden @ soft.T + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(bags)), y[batch]] -= 1
        d_z = (p / len(bags)).astype(np.float32)
        d_hidden = d_z @ soft
        g = d_z.T @ hidden
        g_soft += g * g
        soft -= rate * g / np.sqrt(g_soft)
        bias -= rate * d_z.sum(0)
        d_word = np.zeros_like(vectors)
        np.add.at(d_word, inverse, d_hidden[row] * share[:, None])
        d_sub = np.repeat(d_word / n_sub[:, None], n_sub, axis=0)
        order_b = np.argsort(buckets, kind="stable")
        ids, where = np.unique(buckets[order_b], return_index=True)
        d_bucket = np.add.reduceat(d_sub[order_b], where)
        d_bucket[~known[ids]] = 0
        g_emb[ids] += (d_bucket * d_bucket).mean(1)
        emb[ids] -= rate * d_bucket / np.sqrt(g_emb[ids])[:, None]
    logits = word_logits()
    shift = float(bias[1] - bias[0])
    tops = [top_passage(logits[d]) for d in docs]
    x = np.array([[t + shift, third_word(logits[np.unique(d)]) + shift, np.log(n), 1.0] for (t, _, n), d in zip(tops, docs, strict=True)])
    calibration = _logistic(x[kept_out], y[kept_out].astype(float)) if 0 < y[kept_out].sum() < kept_out.sum() else np.array([1.0, 0.0, 0.0, 0.0])
    return Model((emb @ (soft[1] - soft[0])).astype(np.float32), shift, calibration)


class _Logits(dict):
    def __init__(self, model: Model, most: int = 400_000):
        super().__init__()
        self.model, self.most = model, most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        z = self[word] = self.model.word_logit(word)
        return z


_by_fit: dict[str, _Logits] = {}


def logits_of(model: Model, key: str) -> _Logits:
    """The word cache of a worker; another model replaces it."""
    if key not in _by_fit:
        _by_fit.clear()
        _by_fit[key] = _Logits(model)
    return _by_fit[key]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def first_by_hash(rows: DataFrame, most: int) -> DataFrame:
    """The `most` rows with the smallest hashes of doc_id. Rows beyond a threshold that the count gives are left out before they are
    sorted, so that no task sends on more than its share."""
    n = rows.count()
    share = min(1.0, (1.5 * most + 1000) / max(n, 1))
    place = F.xxhash64("doc_id")
    return rows.where(place <= min(int(share * 2**64) - 2**63, 2**63 - 1)).orderBy(place, "doc_id").limit(most)


def labelled_sample(labels: DataFrame, label: str, most_1: int, most_0: int) -> DataFrame:
    """(doc_id, y) of at most most_1 + most_0 rows outside the held-out fold; a document labelled both ways counts as 1."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    return first_by_hash(known.where("y = 1"), most_1).unionByName(first_by_hash(known.where("y = 0"), most_0))


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = 4000, max_clean: int = 8000) -> Model | None:
    sample = labelled_sample(labels, "toxic", max_toxic, max_clean)
    # At most max_toxic + max_clean rows of two numbers, and as many texts: one for a doc_id that has several.
    rows = docs.select("doc_id", text_bytes().alias("raw")).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.min_by("raw", F.xxhash64("raw")).alias("raw"))
    rows = rows.select("doc_id", "raw", "y").toPandas().sort_values("doc_id")
    return fit([bytes(r) for r in rows["raw"]], rows["y"].tolist())


def score_documents(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs."""
    spark = docs.sparkSession
    tune(spark)
    model = train(docs, labels, **bounds)
    shared = spark.sparkContext.broadcast(model)
    key = str(shared._jbroadcast.id()) + spark.sparkContext.applicationId

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        logits = logits_of(model, key) if model else None
        for b in batches:
            out = []
            for raw in b.column(2).to_pylist():
                if model is None:
                    out.append(0.0)
                    continue
                words = words_of(raw)
                own = np.fromiter(map(logits.__getitem__, words), float, len(words))
                top, _, n = top_passage(own)
                different = set(words)
                third = third_word(np.fromiter(map(logits.__getitem__, different), float, len(different)))
                out.append(model.score(top, third, n))
            s = pa.array(out, pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), s, pa.array([int(x >= 0.5) for x in out], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("raw")).mapInArrow(scores, "doc_id long, held_out boolean, score double, predicted int")
