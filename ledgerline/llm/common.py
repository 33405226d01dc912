"""Shared helpers: table access, scratch tables in the cluster's shared folder, Arrow batches, word shingles."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only white space that these operators know.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Stands for a null identifier inside an operator.
NO_ID = -(2**63)

_own_root: dict[str, str] = {}
#: Scratch tables written in this session, in order.
made: list[str] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Small Arrow batches: a batch of long texts must fit beside the other tasks of an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def carried(docs: DataFrame) -> DataFrame:
    """Each row of docs whole in one column `row`, so that no column of an operator can clash with one of the table."""
    return docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row"))


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only where all runs on one machine, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_root:
            _own_root[app] = tempfile.mkdtemp(prefix="ledgerline-")
        named = _own_root[app]
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    It cuts the lineage, lets two consumers share one computation, and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/ledgerline/{name}-{uuid.uuid4().hex}"
    made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def purge_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables that this session has written (those after the first `since`); call it when no result reads them any more."""
    while len(made) > since:
        delete_path(spark, made.pop())


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty: what the Python side works on."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the corpus: neither is ever broadcast, so the plan is the same at every size."""
    return left.join(right.hint("merge"), on, how)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def decode(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


class WordHashes(dict):
    """64-bit hash by word; holds short words only, and forgets all at `most`, so that memory stays bounded."""

    def __init__(self, most: int = 100_000, longest: int = 64):
        super().__init__()
        self.most, self.longest = most, longest

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = h
        return h


#: One for all operators that a Python worker serves.
WORD_HASHES = WordHashes()


_MIX = np.uint64(0x9E3779B97F4A7C15)
_S29, _S32 = np.uint64(29), np.uint64(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher."""
    x = (x ^ (x >> _S32)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> _S32
    return x * np.uint64(0xD6E8FEB86659FD93)


def chain_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, width):
        h *= _MIX
        h ^= h >> _S29
        h += words[j : j + n]
    return mix64(h)


def word_array(raw: bytes, hashes: WordHashes) -> np.ndarray:
    """Hashes of the ASCII-space separated, lower-cased words of a text."""
    words = decode(raw).lower().encode().split()
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def shingle_sequence(raw: bytes, hashes: WordHashes, width: int = 5) -> np.ndarray:
    """Shingle hashes in text order; a text of 1 to width - 1 words is one shingle, one without words has none."""
    words = word_array(raw, hashes)
    if 0 < len(words) < width:
        return chain_hashes(words, len(words)) ^ np.uint64(len(words))
    return chain_hashes(words, width)
