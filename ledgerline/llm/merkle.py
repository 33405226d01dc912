"""Merkle manifest of a dataset by superblocks (operator 11).

Each row is a leaf. The leaves of a source, in order of doc_id, form a tree of fan-out 16; the trees' roots (subroots), in order of source,
form one more tree, whose root stands for the dataset. A superblock is a bucket of FANOUT ** LEVELS neighbouring nodes: one
applyInPandas call collapses that many levels of it, and the buckets' roots are reduced likewise until each tree has one node. A proof comes
down the same way: the lower part is made within a bucket and followed by the upper part of the bucket's own root.

A superblock holds at most 256 nodes whatever a source's size, and only the number of the largest source's rows and
the root reach the driver. Places of leaves come from a range partitioning, so a source of any size is spread over many tasks.

Defined results: a null field is `-`; a null source is a source of its own, before all others; a null doc_id comes before the others of
its source; ties and repeated rows are leaves of their own, in order of their digests; texts of any length are hashed
whole within the scan and never shuffled; an empty table has no leaves and the root of no nodes, H of nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import merged, written
from .ranks import ranked

FANOUT, LEVELS = 16, 2
BLOCK = FANOUT**LEVELS
_SIBLINGS = "array<struct<left: string, right: string>>"
_SIBLINGS_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def counted(value: Column) -> Column:
    """A field of a leaf: its UTF-8 length, a colon and itself; `-` if it is null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*[counted(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf has by its proof."""
    return F.aggregate(proof, leaf, lambda digest, level: F.sha2(F.concat(level["left"], digest, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """H of all siblings of a proof, from the leaf's to the root's."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def _height(n: int) -> int:
    """Levels above n nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _levels(digests: list[str], n: int) -> list[list[str]]:
    """The nodes of a bucket of a tree of n nodes, level by level from the given ones to the bucket's root."""
    out = [digests]
    for _ in range(min(LEVELS, _height(n))):
        out.append([hashlib.sha256("".join(out[-1][i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(out[-1]), FANOUT)])
    return out


def _collapse(frame: pd.DataFrame) -> pd.DataFrame:
    """(tree, place, n, digest, bucket) of one bucket -> its root as a node of the next table."""
    n = int(frame["n"].iat[0])
    root = _levels(frame.sort_values("place")["digest"].tolist(), n)[-1]
    return pd.DataFrame({"tree": frame["tree"].iloc[:1], "place": frame["bucket"].iloc[:1], "n": 1 if n <= BLOCK else -(-n // BLOCK), "digest": root})


def _siblings(level: list[str]) -> list[dict[str, str]]:
    """For each node of a level, the others of its run."""
    out = []
    for i in range(0, len(level), FANOUT):
        run = level[i : i + FANOUT]
        out += [{"left": "".join(run[:j]), "right": "".join(run[j + 1 :])} for j in range(len(run))]
    return out


def _descend(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """A bucket's nodes with their whole proofs: lower parts from the bucket, the upper part from its root."""
    nodes = nodes.sort_by("place")
    sides = [_siblings(level) for level in _levels(nodes["digest"].to_pylist(), nodes["n"][0].as_py())[:-1]]
    upper = above["proof"][0].as_py()
    proofs = [[level[i // FANOUT**k] for k, level in enumerate(sides)] + upper for i in range(nodes.num_rows)]
    subroot = pa.array([above["subroot"][0].as_py()] * nodes.num_rows, pa.string())
    return nodes.drop_columns(["bucket"]).append_column("subroot", subroot).append_column("proof", pa.array(proofs, _SIBLINGS_ARROW))


def superblocks(nodes: DataFrame) -> list[DataFrame]:
    """Tables (tree, place, n, digest) from the given nodes to the last roots; a tree's root is its one row of n = 1."""
    tables, most = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        low = tables[-1].where("n > 1").select("tree", "place", "n", "digest", F.floor(F.col("place") / BLOCK).alias("bucket"))
        tables.append(written(low.groupBy("tree", "bucket").applyInPandas(_collapse, "tree string, place long, n long, digest string"), "merkle"))
        most = -(-most // BLOCK)
    return tables


def roots(tables: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree."""
    out = None
    for t in tables:
        found = t.where("n = 1").select("tree", "digest")
        out = found if out is None else out.unionByName(found)
    return out


def proofs(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first table's columns with `subroot` and `proof`; above: tree, subroot, and the proof of each tree's root."""
    found = None
    for nodes in reversed(tables):
        single = merged(nodes.where("n = 1"), above, "tree").select(*nodes.columns, "subroot", "proof")
        if found is not None:
            low = nodes.where("n > 1").withColumn("bucket", F.floor(F.col("place") / BLOCK))
            upper = found.select("tree", F.col("place").alias("bucket"), "subroot", "proof")
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + f", subroot string, proof {_SIBLINGS}"
            single = single.unionByName(low.groupBy("tree", "bucket").cogroup(upper.groupBy("tree", "bucket")).applyInArrow(_descend, schema))
        found = single
    return found


def inclusion_proofs(docs: DataFrame, also: dict[str, Column] | None = None) -> tuple[DataFrame, str]:
    """Each row's doc_id, tree, place, n, leaf (`digest`), subroot and proof (siblings left and right, level by level), and the dataset's root.

    also: more columns, computed from docs' rows and carried along by name; they may not have the names above. Tree is `s` and
    the source, or empty without one.
    """
    also = also or {}
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("tree")
    leaf = leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("digest")
    leaves = written(docs.select(tree, "doc_id", leaf, *[c.alias(k) for k, c in also.items()], F.monotonically_increasing_id().alias("merkle_row")), "leaves")
    leaves = written(ranked(leaves, ["tree", "doc_id", "digest", "merkle_row"], "tree").drop("merkle_row"), "leaves")
    tables = superblocks(leaves)
    subroots = written(ranked(written(roots(tables), "subroots"), ["tree"]).select(F.lit("").alias("tree"), "place", "n", "digest", F.col("tree").alias("source_tree")), "subroots")
    top = superblocks(subroots)
    root = roots(top).first()
    none = subroots.sparkSession.range(1).select(F.lit("").alias("tree"), F.lit("").alias("subroot"), F.array().cast(_SIBLINGS).alias("proof"))
    above = written(proofs(top, none).select(F.col("source_tree").alias("tree"), F.col("digest").alias("subroot"), "proof"), "subroots")
    return proofs(tables, above), root["digest"] if root else hashlib.sha256(b"").hexdigest()


def manifest_report(docs: DataFrame) -> DataFrame:
    """Each row's digests, and whether its leaf still folds to the root when the text of every fifth document, by crc32 of its id, is lower-cased.

    Rows without a doc_id are not tampered with.
    """
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found, root = inclusion_proofs(docs, {"seen": F.when(chosen, tampered)})
    found = found.withColumn("folded_root", folded(F.coalesce("seen", "digest"), F.col("proof")))
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"))
