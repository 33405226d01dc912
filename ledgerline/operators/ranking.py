"""Rankings within a key: quotes, slots, first and last rows, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row by key, the first in order. A max over a struct would do for narrow rows; the window keeps all columns."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def top_per_key(df: DataFrame, keys: list[str], n: int, rank: str, *order: Column) -> DataFrame:
    """The first n rows by key, with their place as `rank`. Spark prunes each partition to n rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("bigint"))


def ranked_quotes(docs: DataFrame, key: str, primary: str, secondary: str, most: int = 2) -> DataFrame:
    """The best sentences of a text, cut to 25 words; ranked within the row's own array, so nothing is shuffled."""
    score = lambda s: F.when(F.lower(s).rlike(primary), 2).otherwise(0) + F.when(F.lower(s).rlike(secondary), 1).otherwise(0)
    entry = lambda s, i: F.struct((-score(s)).alias("minus"), F.length(s).alias("size"), i.alias("pos"), s.alias("s"), F.size(F.split(s, " ")).alias("n_words"))
    signature = lambda e: F.substring(F.lower(e["s"]), 1, 80)
    ordered = F.array_sort(F.filter(F.transform(X.sentences(F.col("text")), entry), lambda e: e["n_words"].between(5, 60) & (e["minus"] < 0)))
    none = F.array().cast("array<struct<minus:int,size:int,pos:int,s:string,n_words:int>>")
    # One pass with the kept ones in hand: a second reference to the sorted array would be computed again for each element.
    add = lambda kept, e: F.when((F.size(kept) < most) & ~F.exists(kept, lambda k: signature(k) == signature(e)), F.array_append(kept, e)).otherwise(kept)
    kept = docs.select(key, F.aggregate(ordered, none, add).alias("q"))
    cut = lambda e: F.when(e["n_words"] > 25, F.concat(F.array_join(F.slice(F.split(e["s"], " "), 1, 25), " "), F.lit("…"))).otherwise(e["s"])
    out = kept.select(key, F.posexplode("q").alias("at", "e"))
    return out.select(key, (F.col("at") + 1).cast("bigint").alias("quote_rank"), (-F.col("e.minus")).cast("bigint").alias("score"), cut(F.col("e")).alias("quote"))
