"""Records to retrievable chunks, and answers copied from records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import existing, is_blank

MISSING = "not evidenced in the locked dataset"


def shown(c: Column) -> Column:
    return F.when(is_blank(c), F.lit(MISSING)).otherwise(existing(c.cast("string")))


def chunks(df: DataFrame, key: str, templates: dict[str, Column], fields: dict[str, Column], activity: Column | None = None) -> DataFrame:
    """chunk_id, record id, chunk_type, field_name, text: one by template, one for activity if there is any, one by filled field.

    An array of structs is exploded once, so a record is read once and nothing is shuffled."""
    key_text = F.col(key).cast("string")
    kind = "struct<chunk_type:string,field_name:string,text:string>"
    entry = lambda t, f, c: F.struct(F.lit(t).alias("chunk_type"), F.lit(f).alias("field_name"), c.alias("text")).cast(kind)
    parts = [entry(t, "", c) for t, c in templates.items()]
    if activity is not None:
        parts.append(F.when(~is_blank(activity), entry("recent_activity", "", F.concat(F.lit("Recent activity: "), existing(activity)))))
    parts += [F.when(~is_blank(c), entry("field_evidence", f, F.concat(F.lit(f"{f}: "), existing(c.cast("string"))))) for f, c in fields.items()]
    rows = df.select(key, F.explode(F.array_compact(F.array(*parts))).alias("c")).select(key, "c.*")
    chunk_id = F.concat_ws("_", key_text, "chunk_type", F.nullif("field_name", F.lit("")))
    return rows.select(chunk_id.alias("chunk_id"), key, "chunk_type", "field_name", "text")


def copied_answer(name: Column, facts: dict[str, Column], sensitive: Column) -> tuple[Column, Column, Column]:
    """(answer, abstain, missing): present facts are copied, blank ones listed; no fact, or a personal question, abstains."""
    have = F.concat_ws("; ", *(F.when(~is_blank(c), F.concat(F.lit(f"{f}: "), existing(c.cast("string")))) for f, c in facts.items()))
    lacks = F.concat_ws(", ", *(F.when(is_blank(c), F.lit(f)) for f, c in facts.items()))
    abstain = sensitive | (have == "")
    return F.when(abstain, F.concat(name, F.lit(f": {MISSING}"))).otherwise(F.concat(name, F.lit(" — "), have)), abstain, lacks
