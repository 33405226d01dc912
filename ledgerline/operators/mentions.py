"""Which records of a large table a text mentions: multi-pattern matching by automata over bounded blocks of records.

Strategies, of which the first that holds counts for a record: its whole name stands in the text; one of its identifiers does; all of the first
three of its name's tokens of more than two characters do, if it has two; one of its numbers does. All are substrings of the
lower-cased text, so a token join can't find them.

Records are dealt to blocks of some RECORDS records, texts to parts of some PART_BYTES bytes; block and part meet in one task, which builds one
Aho-Corasick automaton of all the block's patterns and reads each text once. A record is tried by tokens only where its rarest token was
found. So memory is bounded by a block and a part, texts are read once for each block, and no pair that doesn't match is made.

A record without a name has no mention; a null text mentions nobody; repeated texts and records are rows of their own.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..functions.blanks import existing
from ..sources.versions import held
from .ranking import top_per_key

RECORDS, PART_BYTES = 50_000, 32 << 20
IDENTIFIED, NUMBERED = 80, 50


def with_hosts(identifiers: Column) -> Column:
    """Identifiers with, for each that holds a dot, its host."""
    hosts = F.transform(F.filter(identifiers, lambda v: existing(v).contains(".")), lambda v: U.domain(v))
    return F.array_distinct(F.filter(F.transform(F.concat(identifiers, hosts), lambda v: F.lower(existing(v))), lambda v: v != ""))


class _Block:
    """The automaton of a block's records."""

    def __init__(self, records: list[dict]):
        import ahocorasick

        self.records = records
        uses: dict[str, list[tuple[int, int]]] = defaultdict(list)
        common = Counter(t for r in records for t in set(r["tokens"][:3]) if len(r["tokens"]) >= 2)
        for i, r in enumerate(records):
            uses[r["low"]].append((0, i))
            for v in r["identifiers"]:
                uses[v].append((1, i))
            if len(r["tokens"]) >= 2:
                rarest = min(r["tokens"][:3], key=lambda t: (common[t], t))
                for t in set(r["tokens"][:3]):
                    uses[t] += [(2, i)] if t == rarest else []
            for v in r["numbers"]:
                uses[v].append((3, i))
        self.found = ahocorasick.Automaton()
        for pattern, by in uses.items():
            self.found.add_word(pattern, (pattern, by))
        self.found.make_automaton()

    def mentions(self, text: str) -> list[tuple[int, int]]:
        """(record, weight) of those that a text mentions."""
        seen = dict(value for _, value in self.found.iter(text))
        held_by: dict[int, tuple[int, int]] = {}
        for pattern, by in seen.items():
            for kind, i in by:
                r = self.records[i]
                if kind == 0:
                    weight = len(r["low"])
                elif kind == 1:
                    weight = IDENTIFIED
                elif kind == 2:
                    if not all(t in text for t in r["tokens"][:3]):
                        continue
                    weight = sum(map(len, r["tokens"]))
                else:
                    weight = max(map(len, r["numbers"])) + NUMBERED
                held_by[i] = min(held_by.get(i, (9, 0)), (kind, weight))
        return [(i, weight) for i, (_, weight) in held_by.items()]


def _matched(kind: pa.DataType):
    schema = pa.schema([("text_id", kind), ("mark", pa.int64()), ("record_id", pa.string()), ("name", pa.string()), ("weight", pa.int64())])

    def run(texts: pa.Table, records: pa.Table) -> pa.Table:
        out = []
        if texts.num_rows and records.num_rows:
            block = _Block(records.select(["record_id", "name", "low", "identifiers", "tokens", "numbers"]).to_pylist())
            for id_, mark, text in zip(*(texts[c].to_pylist() for c in ("text_id", "mark", "text")), strict=True):
                out += [(id_, mark, block.records[i]["record_id"], block.records[i]["name"], weight) for i, weight in block.mentions(text)]
        columns = zip(*out, strict=True) if out else [()] * 5
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def mentions(texts: DataFrame, records: DataFrame) -> DataFrame:
    """text_id, record_id, weight, place: the records that each text (text_id, text) mentions, the heaviest first; ties go to the larger record_id, then name.

    records: record_id, name, identifiers and numbers (arrays).
    """
    name = existing(F.col("name"))
    none = F.array().cast("array<string>")
    texts_of = lambda c: F.filter(F.transform(F.coalesce(c, none), lambda v: F.lower(existing(v))), lambda v: v != "")
    tokens = F.filter(X.words(F.col("name")), lambda w: F.length(w) > 2)
    numbers = texts_of(F.col("numbers"))
    known = records.where(name != "").select("record_id", name.alias("name"), F.lower(name).alias("low"), F.array_distinct(F.concat(with_hosts(F.coalesce("identifiers", none)), numbers)).alias("identifiers"), tokens.alias("tokens"), numbers.alias("numbers"))
    known = held(known.withColumn("mark", F.monotonically_increasing_id()), "records")
    asked = held(texts.where("text is not null").select("text_id", F.lower("text").alias("text")).withColumn("mark", F.monotonically_increasing_id()), "texts")
    n_blocks = max(1, -(-known.count() // RECORDS))
    n_parts = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    deal = lambda n: F.pmod(F.xxhash64("mark"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("part", deal(n_parts)).withColumn("block", each(n_blocks))
    right = known.withColumn("block", deal(n_blocks)).withColumn("part", each(n_parts))
    kind = texts.schema["text_id"].dataType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(_matched(arrow), f"text_id {kind.simpleString()}, mark long, record_id string, name string, weight long")
    return top_per_key(found, ["mark"], 1 << 30, "place", F.desc("weight"), F.desc("record_id"), F.desc("name")).select("text_id", "record_id", "weight", "place")
