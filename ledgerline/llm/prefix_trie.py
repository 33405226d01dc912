"""Conversation prefix trie with subtree totals by heavy-path decomposition (operator 13).

Conversations are first rebuilt from their family's first turns (`rebuilt`). A node is a distinct sequence of first turns; its key is
the exclusive or of 120 bits of SHA-256 of each (depth, role, text), so keys of all prefixes are running sums, taken in blocks
of BLOCK turns and put together from the blocks' totals: no conversation needs one task. Texts are read once and never shuffled.

Each node chooses its child of most conversations; the chosen edges are heavy and form paths, each of which ends in one leaf. A conversation
that ends in that leaf walks the whole path, so the path is the part of its walk below its last light edge, found by joins
without following pointers. A light edge at least halves the number of conversations, so there are at most log2(conversations) + 1
levels of paths. From the deepest level up, each round lays the level's paths out as arrays in blocks, takes suffix sums along them and
adds each light path's total, summed by parent, to the array of the level above.

Defined results: turns are in order of turn, null first, and of digest where turns are equal, so ties and repeated rows each
stay a turn; a null role or text is empty; rows with a null conv_id form one conversation that isn't rebuilt, counts as smaller than all others
and is written `null` among members; the remainder of a negative conv_id has its sign; texts of any length are digested whole; an
empty table has no nodes; extra columns are ignored. -2**63 isn't a conv_id. The digest of a node's members is one serial
SHA-256 by its definition: they are streamed in lists of at most 4,096.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, made, merged, shared_root, written
from .ranks import ranked

BLOCK = 1024
NODE = ["depth", "p", "q"]
_UP = ["depth", "up_p", "up_q"]


def _two(digest: Column, *names: str) -> list[Column]:
    """120 bits of a hexadecimal digest as two whole numbers."""
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(n) for at, n in zip((1, 16), names, strict=True)]


def _digested(table: DataFrame) -> DataFrame:
    """Each turn's conversation, place there, number of turns there, digest and bytes of text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = table.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"), "turn", F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("mark"), digest.alias("digest"))
    turns = written(turns.select("conv", "turn", "bytes", "mark", *_two(F.col("digest"), "a", "b")), "turns")
    return written(ranked(turns, ["conv", "turn", "a", "b", "mark"], "conv").drop("turn", "mark"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth, total, a, b, bytes) of the rebuilt conversations, and (conv, total) of all of them, turnless ones too.

    Conversation c has the first h turns of c - c % 5, h = crc32(c) % 9, and then its own after its first h.
    """
    known = F.col("conv") != NO_ID
    sizes = turns.where("place = 0").select("conv", "n", F.when(known, F.crc32(F.col("conv").cast("string").cast("binary")) % 9).otherwise(0).alias("h"), F.when(known, F.col("conv") - F.col("conv") % 5).alias("base"))
    sizes = written(sizes, "sizes")
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    plan = merged(sizes, bases, "base", "left").select("conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    plan = written(plan, "plan")
    own = merged(turns, plan.select("conv", "h", "taken", "total"), "conv").where("place >= h").select("conv", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "total", "a", "b", "bytes")
    heads = turns.where("place < 8").select(F.col("conv").alias("base"), "place", "a", "b", "bytes")
    heads = merged(plan.where("taken > 0").select("conv", "base", "h", "total"), heads, "base").where("place < h").select("conv", (F.col("place") + 1).alias("depth"), "total", "a", "b", "bytes")
    return own.unionByName(heads), plan.select("conv", "total")


def _running(rows: DataFrame, group: str, order: Column, block: Column, columns: list[str], agg: Callable, add: Callable) -> DataFrame:
    """rows with `run_` columns: running aggregates of columns within `group` in `order`.

    block: the column's place in `order`, in blocks of BLOCK rows; rows are aggregated within a block, and only totals of blocks across a group.
    """
    rows = rows.withColumn("block", block)
    inside = Window.partitionBy(group, "block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(group, "block").agg(*[agg(c).alias(c) for c in columns])
    carry = totals.select(group, "block", *[agg(c).over(before).alias(f"before_{c}") for c in columns]).where(F.col(f"before_{columns[0]}").isNotNull())
    found = merged(rows.withColumns({f"run_{c}": agg(c).over(inside) for c in columns}), carry, [group, "block"], "left")
    return found.withColumns({f"run_{c}": add(F.col(f"run_{c}"), F.coalesce(f"before_{c}", F.lit(0))) for c in columns}).drop("block", *[f"before_{c}" for c in columns])


def walks(turns: DataFrame) -> DataFrame:
    """(conv, depth, p, q, up_p, up_q, bytes, last): the node that each turn of a conversation leads to, and the node above."""
    digest = F.sha2(F.concat_ws(":", "depth", "a", "b"), 256)
    steps = turns.withColumn("digest", digest).select("conv", F.col("depth").cast("long").alias("depth"), "bytes", (F.col("depth") == F.col("total")).alias("last"), *_two(F.col("digest"), "x", "y"))
    found = _running(steps, "conv", F.col("depth"), F.floor((F.col("depth") - 1) / BLOCK), ["x", "y"], F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    return written(found.select("conv", "depth", "bytes", "last", F.col("run_x").alias("p"), F.col("run_y").alias("q"), F.col("run_x").bitwiseXOR(F.col("x")).alias("up_p"), F.col("run_y").bitwiseXOR(F.col("y")).alias("up_q")), "walks")


def _above(nodes: DataFrame) -> DataFrame:
    """The key of the node above, under the names of a node's own."""
    return nodes.select((F.col("depth") - 1).alias("depth"), F.col("up_p").alias("p"), F.col("up_q").alias("q"), *[c for c in nodes.columns if c not in ("depth", "p", "q", "up_p", "up_q")], F.col("p").alias("own_p"), F.col("q").alias("own_q"))


def trie(walk: DataFrame, sizes: DataFrame) -> DataFrame:
    """Nodes with smallest member, members, parent, children, and whether the edge above is light."""
    nodes = walk.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"), F.min("up_p").alias("up_p"), F.min("up_q").alias("up_q"))
    zero = F.lit(0).cast("long")
    root = sizes.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(zero.alias("depth"), zero.alias("p"), zero.alias("q"), "conv", "n_convs", zero.alias("bytes"), F.lit(None).cast("long").alias("up_p"), F.lit(None).cast("long").alias("up_q"))
    nodes = written(nodes.unionByName(root), "nodes")
    heaviest = F.max(F.struct("n_convs", "own_p", "own_q"))
    kids = _above(nodes.where("depth > 0")).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"), heaviest.alias("heavy"))
    nodes = written(merged(nodes, kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    below = nodes.where("depth > 0").drop("heavy")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p").alias("up_p"), F.col("q").alias("up_q"), F.col("conv").alias("parent_conv"), "heavy")
    light = ~((F.col("p") == F.col("heavy.own_p")) & (F.col("q") == F.col("heavy.own_q")))
    tree = merged(below, parents, _UP).select(*below.columns, "parent_conv", light.alias("light"))
    top = nodes.where("depth = 0").drop("heavy").withColumns({"parent_conv": F.lit(None).cast("long"), "light": F.lit(False)})
    return written(tree.unionByName(top), "tree")


def _by_level(df: DataFrame) -> str:
    """Write df with a folder for each level; its path."""
    path = f"{shared_root(df.sparkSession)}/ledgerline/paths-{uuid.uuid4().hex}"
    made.append(path)
    df.write.partitionBy("level").option("compression", "zstd").parquet(path)
    return path


def heavy_paths(walk: DataFrame, tree: DataFrame) -> DataFrame:
    """(path, level, top, node): each node on its one heavy path, named by a conversation that walks it to its leaf."""
    ends = tree.where("n_children = 0").select(F.col("conv").alias("path"))
    steps = written(merged(walk.select(F.col("conv").alias("path"), *NODE), ends, "path"), "steps")
    marks = merged(steps, tree.where("light").select(*NODE), NODE).groupBy("path").agg(F.max("depth").alias("top"), F.count(F.lit(1)).alias("level"))
    zero = F.lit(0).cast("long")
    info = written(merged(ends, marks, "path", "left").select("path", F.coalesce("top", zero).alias("top"), F.coalesce("level", zero).alias("level")), "info")
    on = merged(steps, info, "path").where("depth >= top")
    return on.unionByName(info.where("level = 0").select("path", zero.alias("depth"), zero.alias("p"), zero.alias("q"), "top", "level"))


def subtree_sums(walk: DataFrame, tree: DataFrame) -> DataFrame:
    """(node, n_leaves, saved): totals over each node's subtree, path level by path level from the deepest."""
    spark = tree.sparkSession
    own = tree.select(*NODE, "up_p", "up_q", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    laid = merged(heavy_paths(walk, tree), own, NODE)
    path = _by_level(laid)
    laid = spark.read.schema(laid.schema).parquet(path)
    levels = laid.agg(F.max("level")).first()[0]
    sums, found, light = ["leaves", "saved"], [], None
    for level in range(-1 if levels is None else levels, -1, -1):
        now = laid.where(F.col("level") == level)
        if light is not None:
            more = merged(now, light, NODE, "left")
            now = more.select(*[c for c in now.columns if c not in sums], *[(F.col(c) + F.coalesce(f"light_{c}", F.lit(0))).alias(c) for c in sums])
        now = _running(now, "path", F.desc("depth"), -F.floor(F.col("depth") / BLOCK), sums, F.sum, lambda a, b: a + b)
        now = written(now.select(*NODE, "up_p", "up_q", "top", "run_leaves", "run_saved"), "sums")
        light = _above(now.where("depth = top and depth > 0")).groupBy(*NODE).agg(F.sum("run_leaves").alias("light_leaves"), F.sum("run_saved").alias("light_saved"))
        found.append(now.select(*NODE, F.col("run_leaves").alias("n_leaves"), F.col("run_saved").alias("saved_tokens")))
    out = found[0] if found else own.select(*NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _hash_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of members in order of node and member -> (node, ends)."""
    schema = pa.schema([("depth", pa.int64()), ("p", pa.int64()), ("q", pa.int64()), ("ends", pa.string())])
    node, digest, out = None, None, []
    for b in batches:
        for depth, p, q, members in zip(*(b.column(c).to_pylist() for c in ("depth", "p", "q", "members")), strict=True):
            text = ",".join("null" if m == NO_ID else str(m) for m in members)
            if node == (depth, p, q):
                digest.update(b"," + text.encode())
                continue
            if node is not None:
                out.append((*node, digest.hexdigest()))
            node, digest = (depth, p, q), hashlib.sha256(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*node, digest.hexdigest()), schema, strict=True)], schema=schema)


def ends(walk: DataFrame, sizes: DataFrame) -> DataFrame:
    """(node, ends): digest of the conversations that end at a node, for the nodes that have any."""
    zero = F.lit(0).cast("long")
    last = walk.where("last").select(*NODE, "conv").unionByName(sizes.where("total = 0").select(zero.alias("depth"), zero.alias("p"), zero.alias("q"), "conv"))
    lists = last.groupBy(*NODE, F.shiftright("conv", 12).alias("part")).agg(F.sort_array(F.collect_list("conv")).alias("members"))
    return lists.repartition(*NODE).sortWithinPartitions(*NODE, "part").mapInArrow(_hash_members, "depth long, p long, q long, ends string")


def trie_report(table: DataFrame) -> DataFrame:
    """Each node of the trie of the rebuilt conversations with members, children, subtree totals and the digest of who ends there."""
    turns, sizes = rebuilt(_digested(table))
    walk = walks(turns)
    tree = trie(walk, sizes)
    found = merged(merged(tree, subtree_sums(walk, tree), NODE), ends(walk, sizes), NODE, "left")
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(named("conv").alias("conv_id"), "depth", named("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
