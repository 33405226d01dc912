"""A keyed table that is changed in batches, by copy-on-write of the buckets that a batch touches.

Rows lie in buckets by a hash of their key. A batch reads the buckets that it touches, replaces the rows of its keys, writes those buckets to a new
folder and commits a manifest (versions.py) that names, for each bucket, the folder that holds it and what is in it: rows, rows by kind, filled cells by
column, and sums of row digests, which add up over buckets. So the manifest of a large table costs what the batch touches; readers see all of a
batch or nothing, a run that ends half-way leaves the version before, and a batch that has been committed is passed over when it is replayed.

Null keys and a key that stands twice in a batch are errors; columns must stay the same but for a reset; an empty batch commits nothing.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions as V

#: Buckets of a new table; fixed in its manifest from then on.
BUCKETS = 64
#: Row digests add up within 48 bits of a lane each; 2**48 is the modulus of the sum.
_LANES, _MODULUS = 4, 1 << 48


def _stats(rows: DataFrame, kind: str | None) -> list:
    """bucket, n, digest lanes, filled cells by column, rows by kind; a row for each bucket and kind reaches the driver."""
    body = [c for c in rows.columns if c != "bucket"]
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(body)]), {"ignoreNullFields": "false"}), 256)
    lane = lambda i: F.sum(F.conv(F.substring(digest, 9 * i + 1, 9), 16, 10).cast("long")).alias(f"lane{i}")
    text = lambda c: F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
    scalar = [c for c, t in rows.dtypes if c in body and not t.startswith(("array", "map", "struct", "binary"))]
    of = F.coalesce(F.col(kind).cast("string"), F.lit("")) if kind else F.lit("")
    return rows.groupBy("bucket", of.alias("kind")).agg(F.count("*").alias("n"), *[lane(i) for i in range(_LANES)], *[F.count_if(text(c) != "").alias(f"filled_{c}") for c in scalar]).collect()


def _entries(stats: list, folder: str) -> dict[str, dict]:
    out: dict[str, dict] = {}
    for r in stats:
        e = out.setdefault(str(r.bucket), {"folder": folder, "n": 0, "kinds": {}, "filled": {}, "lanes": [0] * _LANES})
        e["n"] += r.n
        e["kinds"][r.kind] = r.n
        e["lanes"] = [(a + r[f"lane{i}"]) % _MODULUS for i, a in enumerate(e["lanes"])]
        for c, v in r.asDict().items():
            if c.startswith("filled_"):
                e["filled"][c[7:]] = e["filled"].get(c[7:], 0) + v
    return out


def _summary(buckets: dict[str, dict]) -> dict:
    n = sum(b["n"] for b in buckets.values())
    kinds, filled, lanes = {}, {}, [0] * _LANES
    for b in buckets.values():
        lanes = [(x + y) % _MODULUS for x, y in zip(lanes, b["lanes"], strict=True)]
        for target, part in ((kinds, b["kinds"]), (filled, b["filled"])):
            for k, v in part.items():
                target[k] = target.get(k, 0) + v
    coverage = {c: round(v / n, 6) for c, v in sorted(filled.items())} if n else {}
    return {"n_rows": n, "counts": dict(sorted(kinds.items())), "coverage": coverage, "digest": hashlib.sha256(json.dumps(lanes).encode()).hexdigest()}


def read_table(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """The current version's rows, of some buckets or of all, with their `bucket`."""
    now = V.current(spark, root)
    if now is None:
        raise FileNotFoundError(f"no table at {root}")
    paths = [f"{e['folder']}/bucket={b}" for b, e in sorted(now["buckets"].items()) if buckets is None or int(b) in buckets]
    schema = f"{now['schema']}, bucket int"
    if not paths:
        return spark.createDataFrame([], schema)
    # Folders of several versions are read as one; a bucket's number is the end of its path.
    rows = spark.read.schema(now["schema"]).parquet(*paths)
    return rows.withColumn("bucket", F.regexp_extract(F.col("_metadata.file_path"), r"/bucket=(\d+)/", 1).cast("int"))


def upsert(rows: DataFrame, root: str, batch: str, key: str = "chunk_id", kind: str | None = None, reset: bool = False) -> dict:
    """Add rows to the table at root, replacing those of the same key; the manifest of the version that holds them.

    batch: the batch's name; one that has been committed isn't applied again. reset: begin a new table; old versions' folders stay.
    """
    spark, old = rows.sparkSession, V.current(rows.sparkSession, root)
    if old and not reset and batch in old["batches"]:
        return old
    fresh = old is None or reset
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    if not fresh and old["schema"] != schema:
        raise ValueError(f"the table has {old['schema']}, the batch {schema}")
    n_buckets = BUCKETS if fresh else old["n_buckets"]
    new = V.held(rows.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(n_buckets)).cast("int")), "batch")
    check = new.groupBy(key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("twice"), F.count_if(F.col(key).isNull()).alias("none"), F.sum("n").alias("n")).first()
    if check.twice or check.none:
        raise ValueError(f"{check.twice} keys stand twice in the batch, {check.none} are null")
    if not check.n and not fresh:
        return old
    touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
    folder, replaced, kept_n, out = f"{root}/data-{uuid.uuid4().hex}", 0, 0, new
    if not fresh:
        before = read_table(spark, root, touched)
        kept = before.join(new.select(key), key, "left_anti").select(new.columns)
        kept_n = sum(old["buckets"].get(str(b), {"n": 0})["n"] for b in touched)
        replaced = before.join(new.select(key), key, "left_semi").count()
        out = new.unionByName(kept)
    out.repartition("bucket").write.partitionBy("bucket").parquet(folder)
    written = spark.read.schema(f"{schema}, bucket int").parquet(folder) if check.n else new
    entries = _entries(_stats(written, kind), folder)
    # Parity: what lies in the folder is what was there, less what was replaced, and the batch.
    found, expected = sum(e["n"] for e in entries.values()), kept_n - replaced + (check.n or 0)
    if found != expected:
        raise RuntimeError(f"{folder} holds {found} rows instead of {expected}; nothing is committed")
    buckets = entries if fresh else old["buckets"] | entries
    manifest = {"schema": schema, "n_buckets": n_buckets, "buckets": buckets, "batches": [batch] if fresh else [*old["batches"], batch], **_summary(buckets)}
    return manifest | {"version": V.commit(spark, root, manifest)}
