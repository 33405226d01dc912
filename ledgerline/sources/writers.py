"""Sinks: tables, CSV, JSON, JSONL, index tables, append-only logs, manifests, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tables(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """A Parquet table for each 'sheet'; empty tables are skipped. The names written."""
    done = []
    for name, df in tables.items():
        if df.head(1):
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            done.append(name)
    return done


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV in a fixed order of columns; arrays and structs as JSON."""
    df = df.select(*(columns or df.columns))
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_log(spark: SparkSession, path: str, header: list[str], row: dict[str, str]) -> None:
    """One more row in a run log; unknown keys go, missing ones are blank."""
    spark.createDataFrame([tuple(str(row.get(h, "")) for h in header)], ", ".join(f"{h} string" for h in header)).coalesce(1).write.mode("append").option("header", True).csv(path)


def write_bm25_index(docs: DataFrame, path: str, version: int = 1) -> None:
    """Postings (term, doc_id, tf, dl) clustered by term; an empty corpus is an error."""
    from ..functions.text import search_tokens

    if not docs.head(1):
        raise ValueError("an index needs documents")
    tokens = docs.select("doc_id", search_tokens(F.col("text")).alias("t")).withColumn("dl", F.size("t"))
    postings = tokens.select("doc_id", "dl", F.explode("t").alias("term")).groupBy("term", "doc_id", "dl").agg(F.count("*").alias("tf"))
    postings.withColumn("schema_version", F.lit(version)).repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id").write.mode("overwrite").parquet(path)


def write_dense_index(vectors: DataFrame, path: str) -> None:
    """Vectors with scalar metadata: lists as JSON, null as ''."""
    flat = [c if t.startswith("array<float") or t.startswith("array<double") else F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.coalesce(c, F.lit("")).alias(c) if t == "string" else c for c, t in vectors.dtypes]
    vectors.select(*flat).write.mode("overwrite").parquet(path)


def manifest(tables: dict[str, DataFrame], artifacts: DataFrame | None = None) -> DataFrame:
    """table_name, n_rows, n_columns, sha256: counts of tables, and digests of input files."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(None).cast("string").alias("sha256"))
        out = one if out is None else out.unionByName(one)
    if artifacts is not None:
        files = artifacts.select(F.col("path").alias("table_name"), F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("int").alias("n_columns"), "sha256")
        out = files if out is None else out.unionByName(files)
    return out


def markdown_report(title: str, sections: dict[str, DataFrame], most: int = 50) -> str:
    """A report of small aggregates, at most `most` rows a section."""
    lines = [f"# {title}"]
    for name, df in sections.items():
        lines += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join(str(x) for x in row) + " |" for row in df.limit(most).collect()]
    return "\n".join(lines) + "\n"
