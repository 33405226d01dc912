"""Quality classifier by co-training (operator 3).

Two logistic classifiers see a document apart: one its text content (hashed counts of its three-byte runs, ratios of words, symbols
and repetition), one its page metadata (source, language, length). Both start from labelled rows; in each round each of them labels every unlabelled
row of which it is sure, and the other is fitted anew on the labelled rows and these. In the end each view is calibrated, and a
logistic combination of both is fitted, on labelled rows that neither was trained on; that scores all documents.

All unlabelled rows take part in each round: Newton's method needs only sums over the rows (loss, gradient, Hessian), and a task
returns one row of sums. The pseudo-labels of a class weigh together no more than its labelled rows, so that the views don't drift
from the labels as the corpus grows. Fitting takes at most `max_labelled` labelled documents of each class, the first by a hash of
doc_id; only their features reach the driver, never texts. Features and scores are made for every document, from whole texts.

Defined results: a null or empty text has zero counts; null lang or source are values of their own; with no labelled rows
of both classes every score is 1 (no evidence against any document); a text of any length is counted whole; a score that ties with 0.5
is good; of the texts of a repeated doc_id one is trained on; repeated rows score alike; an empty table gives an empty table;
extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, text_bytes, tune, written
from .quality_rules import text_statistics
from .toxicity import _logistic, first_by_hash

_HASHED = 64
_TEXT = ["n_words", "word_chars", "n_symbols", "n_repeat_words", "n_distinct", "n_upper", "n_bangs", "n_long_words"]
_META = ["n_chars", "lang_slot", "source_slot"]
_RUNS = 64


def hashed_runs(raw: bytes) -> np.ndarray:
    """Counts of a text's runs of three bytes, by bucket."""
    a = np.frombuffer(raw, np.uint8).astype(np.uint64)
    if len(a) < 3:
        return np.zeros(_RUNS, np.int64)
    h = mix64((a[:-2] << np.uint64(16)) | (a[1:-1] << np.uint64(8)) | a[2:])
    return np.bincount((h & np.uint64(_RUNS - 1)).astype(np.int64), minlength=_RUNS)


def text_runs(raw: Column) -> Column:
    """hashed_runs() of a text, from its bytes."""

    @F.arrow_udf("array<long>")
    def counted(raw: pa.Array) -> pa.Array:
        return pa.array([hashed_runs(r) for r in raw.to_pylist()], pa.list_(pa.int64()))

    return counted(raw)


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the raw numbers of both views for every row of docs."""
    column = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    slot = lambda c: F.pmod(F.xxhash64(F.lit(c), column(c)), F.lit(_HASHED)).cast("long")
    q = F.col("q")
    tune(docs.sparkSession)
    counted = docs.select("doc_id", "text", slot("lang").alias("lang_slot"), slot("source").alias("source_slot")).withColumn("q", text_statistics(text_bytes()))
    size = F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars")
    return counted.select("doc_id", *(q[c].alias(c) for c in _TEXT), size, "lang_slot", "source_slot", text_runs(text_bytes()).alias("runs"))


def text_view(x: dict[str, np.ndarray]) -> np.ndarray:
    n = np.maximum(x["n_words"], 1)
    ratio = {c: x[c] / n for c in _TEXT[1:]}
    columns = [np.log1p(x["n_words"]), x["n_words"] < 50, x["n_words"] < 20, *ratio.values()]
    columns += [ratio["n_symbols"] > 0.1, ratio["n_repeat_words"] > 0.4, ratio["n_distinct"] < 0.2, ratio["n_upper"] > 0.4, ratio["n_bangs"] > 0.2, np.log1p(ratio["word_chars"])]
    share = np.log1p(1000 * x["runs"] / np.maximum(x["runs"].sum(1, keepdims=True), 1))
    return np.column_stack([*(np.asarray(c, float) for c in columns), share, np.ones(len(n))])


def metadata_view(x: dict[str, np.ndarray]) -> np.ndarray:
    size = np.log1p(x["n_chars"])
    columns = [size, size**2, x["n_chars"] < 300]
    one_hot = np.eye(_HASHED)
    return np.column_stack([*(np.asarray(c, float) for c in columns), one_hot[x["lang_slot"]] * 0.5, one_hot[x["source_slot"]] * 0.5, np.ones(len(size))])


_VIEWS = (text_view, metadata_view)


class _View:
    """Standardised logistic regression."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, w: np.ndarray):
        self.mean, self.scale, self.w = mean, scale, w

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.standard(x) @ self.w, -12, 12)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)])


def _newton_sums(x: np.ndarray, y: np.ndarray | float, w: np.ndarray) -> np.ndarray:
    """Number of rows, log loss, its falling gradient and its Hessian at w."""
    z = x @ w
    p = _sigmoid(z)
    return np.concatenate([[len(x), (np.logaddexp(0, z) - y * z).sum()], x.T @ (y - p), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])


def _columns(b: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in _TEXT + _META}
    return out | {"runs": b.column(b.schema.get_field_index("runs")).flatten().to_numpy(zero_copy_only=False).reshape(-1, _RUNS)}


class _Unlabelled:
    """Sums over all unlabelled rows; each task returns one row of them."""

    def __init__(self, found: DataFrame):
        self.found = found.select(*_TEXT, *_META, "runs")

    def _total(self, sums) -> list[np.ndarray]:
        """sums: features of a batch -> list of arrays, by place added up over all batches and tasks."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for b in batches:
                if b.num_rows:
                    own = sums(_columns(b))
                    out = own if out is None else [a + o for a, o in zip(out, own, strict=True)]
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes() for a in out], pa.binary()), pa.array(range(len(out)), pa.int32())], ["sums", "place"])

        total: dict[int, np.ndarray] = {}
        for r in self.found.mapInArrow(run, "sums binary, place int").collect():
            total[r.place] = total.get(r.place, 0.0) + np.frombuffer(r.sums)
        return [total[i] for i in sorted(total)]

    def moments(self) -> list[np.ndarray]:
        return self._total(lambda x: [_moments(f(x)) for f in _VIEWS])

    def newton_sums(self, teachers: list[_View], weights: list[np.ndarray], sure: float) -> list[np.ndarray]:
        """For each view and label 0 and 1: _newton_sums at its weights over the rows that the other view is sure of."""

        def sums(x: dict[str, np.ndarray]) -> list[np.ndarray]:
            seen, out = [f(x) for f in _VIEWS], []
            for k in (0, 1):
                p = _sigmoid(teachers[1 - k].logit(seen[1 - k]))
                own = teachers[k].standard(seen[k])
                out += [_newton_sums(own[by >= sure], label, weights[k]) for label, by in ((0.0, 1 - p), (1.0, p))]
            return out

        return self._total(sums)


def _retrained(views: list[_View], at_hand: list[np.ndarray], y: np.ndarray, unlabelled: _Unlabelled, sure: float, ridge: float = 1.0, steps: int = 15) -> list[_View]:
    """Both views fitted by Newton's method (a step that raises the loss is halved); one pass over the unlabelled rows a step."""
    w = [v.w for v in views]
    step = [np.zeros(len(v)) for v in w]
    best = [np.inf, np.inf]
    for _ in range(steps):
        trial = [v + s for v, s in zip(w, step, strict=True)]
        given = unlabelled.newton_sums(views, trial, sure)
        for k in (0, 1):
            sums = _newton_sums(views[k].standard(at_hand[k]), y, trial[k])
            for label in (0, 1) if given else ():
                own = given[2 * k + label]
                sums = sums + own * min(1.0, (y == label).sum() / max(own[0], 1))
            d = len(trial[k])
            loss = sums[1] + ridge / 2 * trial[k] @ trial[k]
            if loss > best[k] + 1e-9 * abs(best[k]):
                step[k] = step[k] / 2
                continue
            w[k], best[k] = trial[k], loss
            step[k] = np.linalg.solve(sums[2 + d :].reshape(d, d) + ridge * np.eye(d), sums[2 : 2 + d] - ridge * trial[k])
        if max(np.abs(s).max() for s in step) < 1e-3:
            break
    return [_View(v.mean, v.scale, own) for v, own in zip(views, w, strict=True)]


class CoTrained:
    def __init__(self, views: list[_View], calibrations: list[np.ndarray], mix: np.ndarray):
        self.views, self.calibrations, self.mix = views, calibrations, mix

    def scores(self, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = [c[0] * v.logit(f(x)) + c[1] for v, c, f in zip(self.views, self.calibrations, _VIEWS, strict=True)]
        both = np.column_stack([*z, np.ones(len(z[0]))]) @ self.mix
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (*z, both))


def cotrain(labelled: dict[str, np.ndarray], y: np.ndarray, unlabelled: _Unlabelled, rounds: int = 4, sure: float = 0.95) -> CoTrained | None:
    """Fit both views; None without labelled rows of both classes. Each round a view hands over all rows of which it is `sure`."""
    n = len(y)
    if n < 8 or y.min() == y.max():
        return None
    fold = np.random.default_rng(5).random(n) < 0.3  # for calibration
    if len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
        fold = np.arange(n) % 2 == 0
        if len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
            return None
    at_hand = [f(labelled) for f in _VIEWS]
    trained = [x[~fold] for x in at_hand]
    views = []
    for x, free in zip(trained, unlabelled.moments() or [0.0, 0.0], strict=True):
        total = _moments(x) + free
        d = x.shape[1]
        mean = total[1 : 1 + d] / total[0]
        scale = np.maximum(np.sqrt(np.maximum(total[1 + d :] / total[0] - mean**2, 0)), 1e-3)
        mean[-1], scale[-1] = 0, 1
        views.append(_View(mean, scale, _logistic((x - mean) / scale, y[~fold], ridge=1.0)))
    for _ in range(rounds):
        views = _retrained(views, trained, y[~fold], unlabelled, sure)
    z = [v.logit(x[fold]) for v, x in zip(views, at_hand, strict=True)]
    ones = np.ones(int(fold.sum()))
    calibrations = [_logistic(np.column_stack([v, ones]), y[fold], ridge=0.1) for v in z]
    calibrated = [c[0] * v + c[1] for c, v in zip(calibrations, z, strict=True)]
    return CoTrained(views, calibrations, _logistic(np.column_stack([*calibrated, ones]), y[fold], ridge=0.1))


def _arrays(rows) -> dict[str, np.ndarray]:
    runs = np.array(rows["runs"].tolist(), np.int64).reshape(-1, _RUNS)
    return {c: rows[c].to_numpy(np.int64) for c in _TEXT + _META} | {"runs": runs}


def score_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000) -> DataFrame:
    """doc_id, text_probability, metadata_probability, score (probability of good), predicted and kept for every row."""
    spark = docs.sparkSession
    found = written(features(docs), "cotraining-features")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    take = lambda y: first_by_hash(known.where(F.col("y") == y), max_labelled)
    # Bounded by max_labelled of each class; an inner join with one row a doc_id.
    labelled = found.dropDuplicates(["doc_id"]).join(F.broadcast(take(1).unionByName(take(0))), "doc_id").toPandas().sort_values("doc_id")
    free = written(found.join(known.select("doc_id"), "doc_id", "left_anti"), "cotraining-unlabelled")
    model = spark.sparkContext.broadcast(cotrain(_arrays(labelled), labelled["y"].to_numpy(float), _Unlabelled(free)))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _columns(b)
            n = b.num_rows
            text, meta, both = model.value.scores(x) if model.value is not None and n else (np.ones(n),) * 3
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(text), pa.array(meta), pa.array(both), pa.array((both >= 0.5).astype(np.int32)), pa.array(both >= 0.5)], ["doc_id", "text_probability", "metadata_probability", "score", "predicted", "kept"])

    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    return found.select(doc_id, *_TEXT, *_META, "runs").mapInArrow(scores, "doc_id long, text_probability double, metadata_probability double, score double, predicted int, kept boolean")
