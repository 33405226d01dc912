"""Text, CSV and JSON lines with physical line numbers, read in parallel however large a file is.

Spark splits a file at line ends. A line's number is its place within its split plus the lines of the splits before it; only a row for
each split meets in a window. Whether a line begins a CSV record follows from the quotes before it: their number in the splits before and in the lines
before, of which an odd one means that the line lies within a quoted field. So records with quoted line feeds are put together after the split,
and only a record's own lines ever meet.

Lines end with \\n; a \\r before it belongs to the end of a record, and to the text within a quoted field. Quotes must be doubled within
quoted fields and stand nowhere else, or what follows them is misread; a quote that is never closed is an error.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .versions import held


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1), value of all lines below path, and `quotes`, the number of quote characters in the lines of the file before."""
    text = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    rows = text.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    rows = held(rows.withColumn("own", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))), "lines")
    in_split = Window.partitionBy("file", "start").orderBy("at")
    rows = rows.withColumns({"nth": F.row_number().over(in_split), "inside": F.coalesce(F.sum("own").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("file", "start").agg(F.count("*").alias("n"), F.sum("own").alias("q"))
    splits = splits.select("file", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.coalesce(F.sum("q").over(before), F.lit(0)).alias("q_before"))
    return rows.join(splits, ["file", "start"]).select("file", (F.col("n_before") + F.col("nth")).alias("line_no"), "value", (F.col("q_before") + F.col("inside")).alias("quotes"), "own", "start", "at")


def read_numbered_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """file, row_no (the header is row 1), line_no (where the record begins) and the columns, all text and blank where the file has nothing.

    Every file has a header; `columns` must be its names, or it names the columns. Another header, or an open quote, is an error. Lines without a character are no records.
    """
    lines = held(numbered_lines(spark, path), "lines")
    starts = lines.withColumn("first", (F.col("quotes") % 2 == 0).cast("int"))
    # Records are numbered like lines: within the split, and by the splits before it.
    in_split = Window.partitionBy("file", "start").orderBy("at")
    starts = starts.withColumn("nth", F.sum("first").over(in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = starts.groupBy("file", "start").agg(F.sum("first").alias("n")).select("file", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))
    numbered = starts.join(splits, ["file", "start"]).withColumn("record", F.col("n_before") + F.col("nth"))
    open_ = lines.groupBy("file").agg(F.max(F.struct("line_no", (F.col("quotes") + F.col("own")).alias("q"))).alias("m")).where("m.q % 2 = 1").head(1)
    if open_:
        last = numbered.where((F.col("file") == open_[0].file) & (F.col("first") == 1)).agg(F.max("line_no")).first()[0]
        raise ValueError(f"{open_[0].file}: the quoted field that begins in the record of line {last} is never closed")
    parts = F.array_sort(F.collect_list(F.struct("line_no", "value")))
    records = numbered.groupBy("file", "record").agg(F.min("line_no").alias("line_no"), F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"))
    records = held(records.withColumn("text", F.regexp_replace("text", "\r$", "")), "records")
    heads = [r.text for r in records.where("record = 1").select(F.regexp_replace("text", "^﻿", "").alias("text")).distinct().limit(2).collect()]
    if not heads:
        return spark.createDataFrame([], "file string, row_no long, line_no long" + "".join(f", `{c}` string" for c in columns or ()))
    names = next(csv.reader([heads[0]]))
    if len(heads) > 1 or (columns is not None and names != columns):
        raise ValueError(f"headers differ: {heads if len(heads) > 1 else names}")
    schema = ", ".join(f"`{c}` string" for c in names)
    body = records.where((F.col("record") > 1) & (F.col("text") != ""))
    parsed = body.select("file", F.col("record").alias("row_no"), "line_no", F.from_csv("text", schema, {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select("file", "row_no", "line_no", *[F.coalesce(F.col(f"r.`{c}`"), F.lit("")).alias(c) for c in names])


def read_numbered_json(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines: (file, line_no and the fields) of the lines that are JSON, and (file, line_no, value) of those that aren't. Blank lines are neither."""
    lines = numbered_lines(spark, path).where(F.trim(F.regexp_replace("value", "\r$", "")) != "").select("file", "line_no", "value")
    lines = held(lines.withColumn("ok", F.try_parse_json("value").isNotNull()), "json")
    good = lines.where("ok").select("file", "line_no", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("file", "line_no", "r.*")
    return good, lines.where("not ok").select("file", "line_no", "value")


def first_errors(errors: DataFrame, most: int = 20) -> str:
    """The first errors (file, line_no, field, code) as text for a message; the number of the others."""
    n = errors.count()
    rows = errors.orderBy("file", "line_no", "field").limit(most).collect()
    shown = [f"line {r.line_no}: {r.field}: {r.code}" for r in rows]
    return "\n".join(shown + ([f"and {n - most} more"] if n > most else []))


def column_or_blank(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit("")
