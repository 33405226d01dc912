"""One large JSON list as records, read in parallel: the file is cut at closing braces, wherever they stand.

Spark splits the file at `}`. Whether a piece begins within a string follows from the quotes before it, and how deep it lies from the
braces before it, both by sums over splits and within them, as in numbered.py. A record ends with the piece that closes its object, so only a record's own
pieces meet, and a list of any length in a single line is read by as many tasks as it has splits.

A file is a list of objects, or an object with such a list under `data`; what else the object has is left out, and so are elements of the list
that aren't objects. A file that ends within a string or an object is an error; broken JSON within a record is left to the reader of the record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .versions import held

_DATA = r'"data"\s*:\s*\['


def _before(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows (file, start, at) with `c_before`, the sum of column c over all rows of the file before."""
    inside = Window.partitionBy("file", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file", "start").agg(*[F.sum(c).alias(c) for c in columns])
    totals = totals.select("file", "start", *[F.coalesce(F.sum(c).over(splits), F.lit(0)).alias(f"{c}_split") for c in columns])
    rows = rows.withColumns({f"{c}_own": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in columns}).join(totals, ["file", "start"])
    return rows.withColumns({f"{c}_before": F.col(f"{c}_own") + F.col(f"{c}_split") for c in columns}).drop(*[f"{c}_{x}" for c in columns for x in ("own", "split")])


def read_json_list(spark: SparkSession, path: str) -> DataFrame:
    """file, pos (from 0, in order of the list) and text of each object of the lists below path."""
    meta = F.col("_metadata")
    pieces = spark.read.option("lineSep", "}").text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    # An escaped character is neither a quote nor a brace; an escape never spans a cut, as no escape ends in a brace.
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = held(pieces.withColumn("quotes", F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))), "pieces")
    pieces = _before(pieces, ["quotes"])
    quoted = F.col("quotes_before") % 2 == 1
    plain = F.regexp_replace(F.concat(F.when(quoted, '"').otherwise(""), F.regexp_replace("value", r"(?s)\\.", "")), r'"[^"]*("|$)', "")
    many = lambda c: F.length(plain) - F.length(F.replace(plain, F.lit(c), F.lit("")))
    closes = ((F.col("quotes_before") + F.col("quotes")) % 2 == 0).cast("int")
    pieces = pieces.withColumns({"opened": many("{"), "closed": closes, "square": many("[") - many("]"), "plain": plain})
    pieces = held(_before(pieces, ["opened", "closed", "square"]), "pieces")
    place, deep = F.struct("start", "at"), F.col("opened_before") - F.col("closed_before")
    first = F.min_by(F.trim(F.regexp_replace("value", "^﻿", "")), place)
    begin = F.when(first.startswith("["), F.min(place)).otherwise(F.min(F.when(F.col("value").rlike(_DATA), place)))
    end = F.max(F.struct("start", "at", (deep + F.col("opened")).alias("deep"), ((F.col("quotes_before") + F.col("quotes")) % 2).alias("odd")))
    files = pieces.groupBy("file").agg(F.when(first.startswith("["), 0).otherwise(1).alias("base"), begin.alias("begin"), end.alias("end"))
    bad = files.where("end.odd = 1 or end.deep > base").select("file").head(1)
    if bad:
        raise ValueError(f"{bad[0].file} ends within a string or an object")
    pieces = pieces.join(files.select("file", "base", "begin"), "file").where(place >= F.col("begin"))
    # Between two records a piece begins with a comma; a bracket before the next brace ends the list.
    pieces = pieces.withColumn("over", ((deep == F.col("base")) & (place > F.col("begin")) & F.col("plain").rlike(r"^[^{]*\]")).cast("int"))
    pieces = _before(pieces, ["over"])
    ends = (F.col("closed") == 1) & (deep + F.col("opened") - 1 == F.col("base")) & ((F.col("square_before") + F.col("square")) > 0) & (F.col("over_before") + F.col("over") == 0)
    pieces = _before(pieces.withColumn("ends", ends.cast("int")), ["ends"])
    cut = F.array_sort(F.collect_list(F.struct("start", "at", "value")))
    records = pieces.groupBy("file", F.col("ends_before").alias("pos"), "base").agg(F.max("ends").alias("whole"), cut.alias("cut")).where("whole = 1")
    text = F.concat(F.array_join(F.transform("cut", lambda p: p["value"]), "}"), F.lit("}"))
    records = records.select("file", "pos", "base", text.alias("text"))
    bare = F.when((F.col("pos") == 0) & (F.col("base") == 1), F.regexp_replace("text", f"(?s)^.*?{_DATA}", "")).otherwise(F.col("text"))
    return records.select("file", "pos", F.regexp_replace(bare, r"^[^{]*", "").alias("text"))
