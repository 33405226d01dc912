"""Exact places in an order of all rows, or of each group's rows, without a window over a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import merged, written


def ranked(df: DataFrame, order: list[str], group: str | None = None, name: str = "ranked") -> DataFrame:
    """df with `place`, from 0 in the order of the columns `order`, and `n`, the number of rows; both within `group` if one is named.

    df must be cheap to read twice (a written table) and must hold no columns ledgerline_at, ledgerline_part, place, n. `group` leads `order`
    and is never null. Rows are range-partitioned, so a large group lies in many partitions; only a row for each partition and
    group meets in a window. Rows equal in all of `order` share a partition: end it with a key of the row.
    """
    at, part = "ledgerline_at", "ledgerline_part"
    held = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), name)
    # The upper bits of such an id are the partition's number, the lower ones count its rows.
    held = held.withColumn(part, F.shiftright(F.col(at), 33)).withColumn("ledgerline_group", F.col(group) if group else F.lit(0))
    keys = [part, "ledgerline_group"]
    parts = held.groupBy(*keys).agg(F.min(at).alias("ledgerline_first"), F.count(F.lit(1)).alias("ledgerline_rows"))
    within = Window.partitionBy("ledgerline_group")
    before = F.sum("ledgerline_rows").over(within.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*keys, (F.coalesce(before, F.lit(0)) - F.col("ledgerline_first")).alias("ledgerline_shift"), F.sum("ledgerline_rows").over(within).alias("n"))
    found = merged(held, parts, keys)
    return found.withColumn("place", F.col(at) + F.col("ledgerline_shift")).drop(at, part, "ledgerline_group", "ledgerline_shift")
