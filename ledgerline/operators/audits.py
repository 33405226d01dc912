"""Data-quality checks; each returns rows of check_id, severity, ok, observed, so that results can be united."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import is_blank

CHECK = ("check_id", "severity", "ok", "observed")


def check(df: DataFrame, name: str, observed: Column, ok, severity: str = "issue") -> DataFrame:
    """One row: an aggregate of df and whether it is as it should be."""
    return df.agg(observed.cast("bigint").alias("observed")).select(F.lit(name).alias("check_id"), F.lit(severity).alias("severity"), ok(F.col("observed")).alias("ok"), "observed")


def unique_ids(df: DataFrame, key: str) -> DataFrame:
    """Blank ids and ids that occur more than once."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    blank = check(df, f"{key}_blank", F.count_if(is_blank(F.col(key))), lambda o: o == 0)
    twice = check(counted.where(~is_blank(F.col(key)) & (F.col("n") > 1)), f"{key}_duplicates", F.count("*"), lambda o: o == 0)
    return blank.unionByName(twice)


def missing_references(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct keys of df that parent lacks."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def too_few_children(parent: DataFrame, key: str, child: DataFrame, child_key: str, least: int) -> DataFrame:
    n = child.groupBy(F.col(child_key).alias(key)).agg(F.count("*").alias("n"))
    return parent.select(key).join(n, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") < least)


def pairing(df: DataFrame, name: str, value: Column, *proofs: Column) -> DataFrame:
    """Values without all of their proofs."""
    proved = reduce(lambda a, b: a & b, (~is_blank(p) for p in proofs))
    return check(df, name, F.count_if(~is_blank(value) & ~proved), lambda o: o == 0)


def filled_cells(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, n_rows, n_filled of every column: how many rows hold a value. One pass over each table."""
    out = None
    for name, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*[F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias("n_filled")) for c in df.columns]).alias("cells"))
        one = counts.select(F.lit(name).alias("table_name"), "n_rows", F.explode("cells").alias("c")).select("table_name", "c.column_name", "n_rows", "c.n_filled")
        out = one if out is None else out.unionByName(one)
    return out


def column_states(filled: DataFrame, want: dict[str, list[str]], defined: Column) -> DataFrame:
    """(table_name, column_name, state, n_filled): wanted columns without a value in any row are missing, others that hold values are extra; columns that hold values but have no definition are undefined."""
    wanted = filled.sparkSession.createDataFrame([(t, c) for t, names in want.items() for c in names], "table_name string, column_name string").withColumn("wanted", F.lit(True))
    rows = filled.join(F.broadcast(wanted), ["table_name", "column_name"], "full_outer").withColumns({"n_filled": F.coalesce("n_filled", F.lit(0)), "wanted": F.coalesce("wanted", F.lit(False))})
    has = F.col("n_filled") > 0
    states = F.array_compact(F.array(F.when(F.col("wanted") & ~has, F.lit("missing")), F.when(~F.col("wanted") & has, F.lit("extra")), F.when(has & ~defined, F.lit("undefined"))))
    return rows.select("table_name", "column_name", F.explode(states).alias("state"), "n_filled")


def dataset_checks(df: DataFrame, n_rows: int, columns: list[str], full: list[str], rules: dict[str, Column]) -> DataFrame:
    """Checks of a whole table in one pass: its number of rows, wanted columns, columns that every row must fill, and rules that every row must meet (observed: what fails)."""
    missing = [c for c in columns if c not in df.columns]
    blanks = {f"{c}_filled": F.count_if(is_blank(F.col(c))) for c in full if c in df.columns}
    failed = {name: F.count_if(~F.coalesce(test, F.lit(False))) for name, test in rules.items()}
    observed = df.agg(F.count(F.lit(1)).alias("row_count"), *[c.alias(name) for name, c in (blanks | failed).items()])
    entry = lambda name, value, ok: F.struct(F.lit(name).alias("check_id"), F.lit("issue").alias("severity"), ok.alias("ok"), value.cast("bigint").alias("observed"))
    rows = [entry("row_count", F.col("row_count"), F.col("row_count") == n_rows), entry("missing_columns", F.lit(len(missing)), F.lit(not missing))]
    rows += [entry(name, F.col(name), F.col(name) == 0) for name in blanks | failed]
    return observed.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def quota(df: DataFrame, key: str, wanted: DataFrame, test: Column, least: int) -> DataFrame:
    """check_id, severity, ok, observed: for each wanted key, whether it has at least `least` rows that pass."""
    n = df.where(test).groupBy(key).agg(F.count("*").alias("n"))
    rows = wanted.join(n, key, "left").withColumn("observed", F.coalesce("n", F.lit(0)).cast("bigint"))
    return rows.select(F.concat_ws("_", F.lit("quota"), F.col(key).cast("string")).alias("check_id"), F.lit("issue").alias("severity"), (F.col("observed") >= least).alias("ok"), "observed")


def column_difference(spark, have: dict[str, list[str]], want: dict[str, list[str]]) -> DataFrame:
    """(table, column, state): columns that are missing and columns that nobody asked for."""
    rows = [(t, c, "missing") for t in want for c in want[t] if c not in have.get(t, [])]
    rows += [(t, c, "extra") for t in have for c in have[t] if c not in want.get(t, [])]
    return spark.createDataFrame(rows, "table_name string, column_name string, state string")


def suspicious(text: Column, must: str, any_of: tuple[str, ...]) -> Column:
    """Texts that hold one word and either of others, in any case; a null text holds none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return low.contains(must) & reduce(lambda a, b: a | b, (low.contains(w) for w in any_of))


def exit_status(checks: DataFrame) -> DataFrame:
    """0 if no issue failed, else 1."""
    return checks.agg(F.coalesce(F.max(F.when((F.col("severity") == "issue") & ~F.col("ok"), 1)), F.lit(0)).cast("bigint").alias("exit_status"))
