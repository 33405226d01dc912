"""Chat formatting as a prefix tree (operator 1).

Conversations that begin with the same turns share the nodes of a tree: a node is a turn together with all turns before it,
named by a chained digest. Each node is formatted and tokenized once, and all nodes form one depth-first stream: a
node has its place in the stream (start), its tokens' position ids within its own conversation, and the merged intervals of
the stream that its tokens may attend to - its ancestors and, causally, itself. Loss falls on assistant texts.

The order comes from a path key that grows only where a conversation leaves others behind, so a key, like the interval list, is as
long as the number of branchings above a node, not its depth. Conversations are streamed turn by turn; shared prefixes of any number
of conversations are counted by partial aggregation. Stream offsets are summed by partition; only a total for each partition
reaches the driver.

Template: <|im_start|>role\\ntext<|im_end|>\\n. In texts and roles "<", any number of backslashes, "|" gets one more
backslash, so no control string can occur; in roles backslash and line feed are escaped too. Both are reversible.

Defined results: a null text or role is empty; turns are in order of turn, then role, then text, so ties and repeated rows
each stay a turn; rows with a null conv_id form one conversation; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, tune, written

START, END = "<|im_start|>", "<|im_end|>"
_NODES = "node binary, parent binary, depth int, owner long, shared long, role string, start_id int, tokens array<int>, loss_start int, loss_end int"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


class Template:
    """Token ids of turns and back; the two control tokens follow the tokenizer's own ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.start = self.model.get_vocab_size()
        self.end = self.start + 1
        self.line_feed = self.model.encode("\n", add_special_tokens=False).ids

    def encode(self, turns: list[tuple[str, str]]) -> list[tuple[list[int], int, int]]:
        """Of each (role, text): ids, and the range of the text's ids."""
        parts = self.model.encode_batch([p for role, text in turns for p in (escape_role(role) + "\n", escape(text))], add_special_tokens=False)
        out = []
        for head, body in zip(parts[::2], parts[1::2], strict=True):
            a = 1 + len(head.ids)
            out.append(([self.start, *head.ids, *body.ids, self.end, *self.line_feed], a, a + len(body.ids)))
        return out

    def decode(self, ids: list[int]) -> str:
        """The formatted text of ids."""
        out, run = [], []
        for i in [*ids, None]:
            if i is None or i >= self.start:
                out.append(self.model.decode(run, skip_special_tokens=False))
                run = []
                out.append("" if i is None else START if i == self.start else END)
            else:
                run.append(i)
        return "".join(out)


_templates: dict[str, Template] = {}


def template(path: str) -> Template:
    if path not in _templates:
        _templates[path] = Template(path)
    return _templates[path]


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not (formatted.startswith(START) and formatted.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    role, _, text = formatted[len(START) : -len(END) - 1].partition("\n")
    return unescape_role(role), unescape(text)


def _rows(b: pa.RecordBatch):
    return zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    found = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    rows.clear()
    return found


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, role, text) in order -> (conv, idx, node, parent, role, text)."""
    schema = pa.schema([("conv", pa.int64()), ("idx", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("role", pa.string()), ("text", pa.string())])
    conv, node, idx, out = None, None, 0, []
    for b in batches:
        for c, role, text in _rows(b):
            if c != conv:
                conv, node, idx = c, None, 0
            h = hashlib.blake2b(node or b"", digest_size=16)
            for part in (role.encode(), text.encode()):
                h.update(len(part).to_bytes(8, "little") + part)
            parent, node = node, h.digest()
            out.append((c, idx, node, parent, role, text))
            idx += 1
        yield _batch(out, schema)


def _tokenized(path: str):
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("owner", pa.int64()), ("shared", pa.int64()), ("role", pa.string()), ("start_id", pa.int32()), ("tokens", pa.list_(pa.int32())), ("loss_start", pa.int32()), ("loss_end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = template(path)
        for b in batches:
            rows = list(_rows(b))
            encoded = t.encode([(r[5], r[6]) for r in rows])
            out = [(*r[:6], t.start, ids, *((a, z) if r[5] == "assistant" else (0, 0))) for r, (ids, a, z) in zip(rows, encoded, strict=True)]
            yield _batch(out, schema)

    return run


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, idx, node, n_tokens, shared, owner) in order -> for each node, from its owner: path key and first position."""
    schema = pa.schema([("node", pa.binary()), ("path_key", pa.binary()), ("depth", pa.int32()), ("n_tokens", pa.int64()), ("position", pa.int64())])
    conv, key, at, crowd, out = None, b"", 0, 0, []
    for b in batches:
        for c, idx, node, n_tokens, shared, owner in _rows(b):
            if c != conv:
                conv, key, at, crowd = c, b"", 0, -1
            if shared != crowd:  # others branched off, or ended, above this node
                key, crowd = key + node[:8], shared
            if owner == c:
                out.append((node, key, idx, n_tokens, at))
            at += n_tokens
        yield _batch(out, schema)


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes in depth-first order -> their offsets within the partition."""
    schema = pa.schema([("node", pa.binary()), ("part", pa.int32()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("position", pa.int64())])
    part, local, out = TaskContext.get().partitionId(), 0, []
    for b in batches:
        for node, n_tokens, position in _rows(b):
            out.append((node, part, local, n_tokens, position))
            local += n_tokens
        yield _batch(out, schema)


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, idx, node, start, n_tokens, owner) in order -> for each node, from its owner: merged intervals down to its end."""
    schema = pa.schema([("node", pa.binary()), ("attends", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    conv, merged, out = None, [], []
    for b in batches:
        for c, _, node, start, n_tokens, owner in _rows(b):
            if c != conv:
                conv, merged = c, []
            if merged and merged[-1][1] == start:
                merged[-1] = (merged[-1][0], start + n_tokens)
            else:
                merged.append((start, start + n_tokens))
            if owner == c:
                out.append((node, [{"start": a, "end": z} for a, z in merged]))
        yield _batch(out, schema)


def prefix_tree(conversations: DataFrame, tokenizer_path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, members).

    nodes: node, parent, depth, owner, shared (conversations through it), role, start_id (of the control tokens), tokens,
    loss_start, loss_end (range within tokens), start (place in the depth-first stream), position_ids, attends.
    members: conv, idx, node for every turn.
    """
    tune(conversations.sparkSession)
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"), F.col("turn").cast("long").alias("turn"), empty("role"), empty("text"))
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    chained = written(ordered.mapInArrow(_chained, "conv long, idx int, node binary, parent binary, role string, text string"), "chat-turns")
    members = chained.select("conv", "idx", "node")
    owners = members.groupBy("node").agg(F.min("conv").alias("owner"), F.count("*").alias("shared"))
    firsts = chained.join(owners, "node").where(F.col("conv") == F.col("owner")).select("node", "parent", F.col("idx").alias("depth"), "owner", "shared", "role", "text")
    # _tokenized reads role and text as columns 5 and 6.
    nodes = written(firsts.mapInArrow(_tokenized(tokenizer_path), _NODES), "chat-nodes")
    slim = nodes.select("node", F.size("tokens").cast("long").alias("n_tokens"), "shared", "owner")
    along = members.join(slim, "node").select("conv", "idx", "node", "n_tokens", "shared", "owner").repartition("conv").sortWithinPartitions("conv", "idx")
    keyed = written(along.mapInArrow(_paths, "node binary, path_key binary, depth int, n_tokens long, position long"), "chat-paths")
    depth_first = keyed.repartitionByRange("path_key", "depth").sortWithinPartitions("path_key", "depth").select("node", "n_tokens", "position")
    placed = written(depth_first.mapInArrow(_offsets, "node binary, part int, local long, n_tokens long, position long"), "chat-places")
    totals = placed.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row a partition: what the partitions before it hold.
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    places = placed.join(F.broadcast(before), "part").select("node", (F.col("local") + F.col("base")).cast("long").alias("start"), "n_tokens", "position")
    spots = members.join(places.join(owners.select("node", "owner"), "node"), "node").select("conv", "idx", "node", "start", "n_tokens", "owner")
    attends = spots.repartition("conv").sortWithinPartitions("conv", "idx").mapInArrow(_intervals, "node binary, attends array<struct<start:long,end:long>>")
    ids = F.sequence(F.col("position"), F.col("position") + F.col("n_tokens") - 1).alias("position_ids")
    out = nodes.join(places.select("node", "start", ids), "node").join(attends, "node")
    return out, members


def _read_back(path: str):
    """(conv, idx, tokens, loss range, position_ids, attends) in order -> digests of each conversation as formatted."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, conv, n, out = template(path), None, 0, []
        turns = loss = None
        loss_chars = chars = at = 0

        def close() -> None:
            if n:
                out.append((None if conv == NO_ID else conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, at))

        for b in batches:
            for c, _, tokens, loss_start, loss_end, position_ids, attends in _rows(b):
                if c != conv or not n:
                    close()
                    conv, n, loss_chars, chars, at = c, 0, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                if position_ids[0] != at or sum(i["end"] - i["start"] for i in attends) != at + len(tokens):
                    raise ValueError(f"conversation {c}: positions or attention intervals don't cover its turns")
                formatted = t.decode(tokens)
                role, text = parse_turn(formatted)
                turns.update(f"{role}\n{text}\n".encode())
                under_loss = unescape(t.decode(tokens[loss_start:loss_end]))
                loss.update(under_loss.encode())
                loss_chars, chars, at, n = loss_chars + len(under_loss), chars + len(formatted), at + len(tokens), n + 1
            yield _batch(out, schema)
        close()
        yield _batch(out, schema)

    return run


def read_conversations(nodes: DataFrame, members: DataFrame, tokenizer_path: str) -> DataFrame:
    """Every conversation, read back from its nodes along its path."""
    along = members.join(nodes.select("node", "tokens", "loss_start", "loss_end", "position_ids", "attends"), "node")
    along = along.select("conv", "idx", "tokens", "loss_start", "loss_end", "position_ids", "attends").repartition("conv").sortWithinPartitions("conv", "idx")
    return along.mapInArrow(_read_back(tokenizer_path), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long")


def chat_report(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    nodes, members = prefix_tree(conversations, tokenizer_path)
    return read_conversations(nodes, members, tokenizer_path)
