"""Versioned tables: a folder of data per version and a manifest that makes it the current one.

A writer puts its tables into a folder of its own and commits last, by renaming a manifest into place. A run that ends before leaves the
old version as it was, a run that is repeated writes another folder, and readers hold on to the folder that they have looked up.
All file work goes through Hadoop's file systems, so any store that Spark writes to will do.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_root: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; a temporary one on a single machine only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_root:
            _own_root[app] = tempfile.mkdtemp(prefix="ledgerline-")
        named = _own_root[app]
    return f"{named.rstrip('/')}/ledgerline"


def held(df: DataFrame, name: str = "table") -> DataFrame:
    """df written to the shared folder and read back, for what two consumers read."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, name: str) -> str:
    path, fs = _path(spark, name)
    with_charset = spark.sparkContext._jvm.java.util.Scanner(fs.open(path), "UTF-8").useDelimiter("\\A")
    try:
        return with_charset.next() if with_charset.hasNext() else ""
    finally:
        with_charset.close()


def _write_text(spark: SparkSession, name: str, text: str) -> None:
    path, fs = _path(spark, name)
    out = fs.create(path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def fingerprint(df: DataFrame) -> str:
    """Digest of name, size and time of the files that df is read from."""
    spark = df.sparkSession
    seen = []
    for name in sorted(df.inputFiles()):
        path, fs = _path(spark, name)
        status = fs.getFileStatus(path)
        seen.append([name, status.getLen(), status.getModificationTime()])
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()


def root_for(df: DataFrame, name: str) -> str:
    """A place in the shared folder for what is made from the files of df, the same for the same file names."""
    return f"{shared_folder(df.sparkSession)}/{name}-{hashlib.sha256(json.dumps(sorted(df.inputFiles())).encode()).hexdigest()[:16]}"


def committed(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Numbers and names of the manifests of a root, in order."""
    path, fs = _path(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted((int(n[9:-5]), f"{root}/{n}") for n in names if n.startswith("manifest-") and n.endswith(".json"))


def current(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the current version, None if there isn't any."""
    found = committed(spark, root)
    return json.loads(read_text(spark, found[-1][1])) if found else None


def commit(spark: SparkSession, root: str, manifest: dict) -> int:
    """Make the version that a manifest describes the current one; its number. Of two writers of one number the later one fails."""
    number = max([0, *(n for n, _ in committed(spark, root))]) + 1
    manifest = manifest | {"version": number}
    staged = f"{root}/.staged-{uuid.uuid4().hex}"
    _write_text(spark, staged, json.dumps(manifest, sort_keys=True))
    source, fs = _path(spark, staged)
    target, _ = _path(spark, f"{root}/manifest-{number:08d}.json")
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, False)
        raise RuntimeError(f"another writer has committed version {number} of {root}")
    return number


def counts_by(df: DataFrame, column: str, most: int = 10_000) -> dict[str, int]:
    """Rows by value of a column of few values; more than `most` values are an error."""
    rows = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("k")).count().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values")
    return {r.k: r["count"] for r in sorted(rows)}


def digest(df: DataFrame) -> str:
    """Digest of a table's rows that doesn't depend on their order; repeated rows count."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    # Four sums of 32 bits each; a sum of so many rows as a table can have fits 64 bits.
    lanes = [F.sum(F.conv(F.substring(row, 8 * i + 1, 8), 16, 10).cast("long")).alias(f"s{i}") for i in range(4)]
    total = df.agg(*lanes, F.count(F.lit(1)).alias("n")).first()
    return hashlib.sha256(json.dumps(list(total)).encode()).hexdigest()
