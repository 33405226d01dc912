"""Quality rules by weak supervision (operator 8).

Each rule votes bad (0), good (1) or abstains on a document's statistics. Expectation-maximisation over the counts of
vote patterns of ALL documents estimates each rule's accuracy (each rule has two outcomes, so at most 2 ** len(RULES) patterns
reach the driver, however many documents there are), and the posterior probability of good replaces all-must-pass filtering.
A document goes at a posterior under 0.25: it has to be three times as likely bad as good, since a good one lost costs more.

Defined results: a null or text without words has no words, fails the base test and is not kept; a text of any length is counted whole; a
posterior that ties with the threshold is kept; an empty table gives an empty table; repeated rows are scored one by one; extra
columns of any name stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, decode, text_bytes, tune, written

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_bangs", "n_long_words"]
STATS = "struct<" + ",".join(f"{c}:long" for c in _COUNTS) + ">"
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"


def repeated_word_count(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of `width` words found twice or more in the text, the first time included."""
    n = len(words)
    if n <= width:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    m = len(ids)
    key, size = a[: n - width + 1], m
    for j in range(1, width):
        if size * m >= 2**62:  # number the windows anew before the product leaves 64 bits
            key = np.unique(key, return_inverse=True)[1]
            size = n
        key = key * m + a[j : n - width + 1 + j]
        size *= m
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for j in range(width):
        covered[j : n - width + 1 + j] |= twice
    return int(covered.sum())


def text_stats(raw: bytes) -> tuple[int, ...]:
    words = raw.split()
    text = decode(raw)
    n_space = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in raw.split(b"\n"):
        if line.strip(_SPACE):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    upper = sum(map(str.isupper, text.split())) if words else 0
    return (
        len(words), len(text) - n_space, len(raw) - len(raw.translate(None, _SYMBOLS)), n_dup, repeated_word_count(words), n_lines,
        len(set(words)), upper, len(raw) - len(raw.translate(None, b"!")), sum(len(w) > 40 for w in words),
    )


def text_statistics(raw: Column) -> Column:
    """The struct of a text's statistics, from its bytes."""

    @F.arrow_udf(STATS)
    def stats(raw: pa.Array) -> pa.Array:
        found = np.array([text_stats(r) for r in raw.to_pylist()], np.int64).reshape(-1, len(_COUNTS))
        return pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(_COUNTS))], _COUNTS)

    return stats(raw)


def base_failed() -> Column:
    q = F.col("q")
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def _vote(bad: Column, good: Column | None = None) -> Column:
    v = F.when(bad, F.lit("0"))
    return (v if good is None else v.when(good, F.lit("1"))).otherwise(F.lit("-"))


def votes() -> Column:
    """One character by rule: 0 bad, 1 good, - abstains."""
    q = F.col("q")
    n = F.greatest(q["n_words"], F.lit(1))
    lines = F.greatest(q["n_lines"], F.lit(1))
    per_word = lambda c: q[c] / n
    clean = (q["n_words"] >= 50) & (per_word("n_symbols") < 0.05) & (per_word("n_repeat_words") < 0.5) & (per_word("n_upper") < 0.3) & (per_word("n_bangs") < 0.1)
    return F.concat(
        _vote(q["n_words"] < 20),
        _vote(per_word("n_symbols") > 0.15),
        _vote(per_word("n_repeat_words") > 0.5),
        _vote(q["n_dup_lines"] / lines > 0.5),
        _vote((q["n_words"] >= 50) & (per_word("n_distinct") < 0.15)),
        _vote((per_word("word_chars") < 2) | (per_word("word_chars") > 14)),
        _vote(per_word("n_upper") > 0.4),
        _vote(per_word("n_bangs") > 0.2),
        _vote(per_word("n_long_words") > 0.05),
        _vote(F.lit(False), clean),
    )


RULES = ("length", "symbols", "repeats", "duplicate_lines", "distinct_words", "word_length", "upper_case", "exclamations", "long_words", "clean_prose")
#: Before any data: how often a rule votes bad and good among bad documents, and among good ones.
_EXPECTED = {"bad": (0.2, 0.02), "good": (0.01, 0.3)}


def fit_label_model(patterns: dict[str, int], prior_good: float = 0.85, rounds: int = 50, strength: float = 0.02) -> dict:
    """Expectation-maximisation over vote patterns and their counts (three outcomes by rule and class).

    Priors worth `strength` of all documents hold each rule near _EXPECTED, so that rules which seldom vote, and which
    of the two classes is the good one, stay settled. `right`: of a rule's votes, the part that agrees with the class.
    """
    keys = list(patterns)
    if not keys:
        return {"prior_good": prior_good, "right": {}, "posterior": {}}
    count = np.array([patterns[k] for k in keys], float)
    outcome = np.array([[["0", "1", "-"].index(c) for c in k] for k in keys])
    one_hot = np.eye(3)[outcome]  # pattern, rule, outcome
    expected = np.array([[b, g, 1 - b - g] for b, g in (_EXPECTED["bad"], _EXPECTED["good"])])
    rate = np.repeat(expected[:, None, :], len(RULES), axis=1)  # class, rule, outcome
    prior, weight = prior_good, strength * count.sum()
    for _ in range(rounds):
        log = np.einsum("pjo,yjo->py", one_hot, np.log(rate))
        p = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + log[:, 1] - log[:, 0], -50, 50)))
        prior = float(np.clip(((p * count).sum() + prior_good * weight) / (count.sum() + weight), 0.02, 0.98))
        for y, of in ((0, (1 - p) * count), (1, p * count)):
            rate[y] = (np.einsum("p,pjo->jo", of, one_hot) + weight * expected[y]) / (of.sum() + weight)
    mass = np.array([1 - prior, prior])[:, None, None] * rate
    right = {r: float((mass[0, j, 0] + mass[1, j, 1]) / mass[:, j, :2].sum()) for j, r in enumerate(RULES)}
    return {"prior_good": prior, "right": right, "posterior": dict(zip(keys, p.tolist(), strict=True))}


def with_votes(docs: DataFrame) -> DataFrame:
    """row (each row of docs whole), q (its statistics) and votes."""
    tune(docs.sparkSession)
    return carried(docs).withColumn("q", text_statistics(text_bytes("row.text"))).withColumn("votes", votes())


def with_verdict(counted: DataFrame, threshold: float = 0.25) -> DataFrame:
    """counted, which has q and votes, with base_failed, p (probability of good) and kept."""
    patterns = {r["votes"]: r["n"] for r in counted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    table = counted.sparkSession.createDataFrame(list(fit_label_model(patterns)["posterior"].items()), "votes string, p double")
    # At most 2 ** len(RULES) rows.
    out = counted.join(F.broadcast(table), "votes", "left").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("p", F.lit(0.0)) >= threshold))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns of docs."""
    return with_verdict(written(with_votes(docs), "quality-votes")).where("kept").select("row.*")


def quality_report(docs: DataFrame) -> DataFrame:
    q = F.col("q")
    counted = with_votes(docs.select("doc_id", "text")).select(F.col("row.doc_id").alias("doc_id"), "q", "votes")
    return with_verdict(written(counted, "quality-stats")).select(
        "doc_id", q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"), q["n_dup_lines"].alias("n_dup_lines"),
        q["n_repeat_words"].alias("n_repeat_words"), "base_failed", "kept", F.col("p").alias("quality_probability"),
    )
