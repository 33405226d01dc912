"""A stored inverted index for BM25: postings with block maxima, partitioned by term.

`build` numbers the documents as they are read and cuts the numbers into ranges of RANGE documents. A posting row is one term in one range: who holds it, how
often, and the largest share that it can add to a score there. Rows lie in folders by bucket of the term; the documents' metadata lie
beside them, texts nowhere. Everything is committed by a manifest (sources/versions.py) with the corpus statistics.

`search` reads the buckets of its questions' terms alone. It bounds each question's score in each range by the sum of its terms' maxima,
scores the best few ranges, and then those others whose bound still reaches the k-th score; the rest are proven to hold no better
document. Documents that share no term with a question score 0 and fill up its k, in order of chunk_id.

Null texts are empty documents; a repeated chunk_id is a document of its own; a question without terms gets the first documents; an empty corpus is an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import search_tokens
from ..sources import versions as V
from .ranking import top_per_key

K1, B, EPSILON = 1.5, 0.75, 0.25
SCHEMA_VERSION = 2
#: Documents in a range, tokens in a bucket of terms, and ranges that a question tries first.
RANGE, BUCKET_TOKENS, FIRST = 512, 200_000, 4
#: Documents whose postings in a bucket lie in one file.
FILE_DOCUMENTS = 1_000_000
_SLACK = 1e-6


def _bucket(n: int):
    return F.pmod(F.xxhash64("term"), F.lit(n))


def _posted(avgdl: float) -> Callable:
    """(at, chunk_id, dl, tokens) -> (term, range, holders, most, n), by one sort of a batch's codes.

    Documents of a range follow each other, so a term's holders in it meet without a shuffle; a range that two batches share has a row of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, at = b.column("tokens"), b.column("at").to_numpy()
            flat = lists.flatten().dictionary_encode()
            if not len(flat):
                continue
            n_terms, n_rows = len(flat.dictionary), b.num_rows
            row = np.repeat(np.arange(n_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            ranges, local = np.unique(at // RANGE, return_inverse=True)
            pair, tf = np.unique((local[row] * n_terms + flat.indices.to_numpy(zero_copy_only=False)) * n_rows + row, return_counts=True)
            block, of = pair // n_rows, pair % n_rows
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            dl = b.column("dl").to_numpy()[of]
            share = tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avgdl))
            holder = pa.StructArray.from_arrays([pa.array(at[of]), b.column("chunk_id").take(pa.array(of)), pa.array(share)], ["at", "chunk_id", "share"])
            ends = np.append(starts, len(pair)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [flat.dictionary.take(pa.array(block[starts] % n_terms)), pa.array(ranges[block[starts] // n_terms]), pa.ListArray.from_arrays(pa.array(ends), holder), pa.array(np.maximum.reduceat(share, starts)), pa.array(np.diff(ends).astype(np.int64))],
                ["term", "range", "holders", "most", "n"],
            )

    return run


def build(docs: DataFrame, root: str, key: str | None = None) -> dict:
    """Index docs (chunk_id, text, and metadata columns that stay) as the current version of root; its manifest. key: what it was made from."""
    spark = docs.sparkSession
    folder = f"{root}/data-{uuid.uuid4().hex}"
    tokens = search_tokens(F.col("text"))
    meta = [c for c in docs.columns if c not in ("chunk_id", "text")]
    docs.select("chunk_id", *meta, tokens.alias("tokens")).withColumns({"at": F.monotonically_increasing_id(), "dl": F.size("tokens")}).write.parquet(f"{folder}/tokens")
    stored = spark.read.parquet(f"{folder}/tokens")
    stored.drop("tokens").write.parquet(f"{folder}/documents")
    whole = spark.read.parquet(f"{folder}/documents").agg(F.count("*").alias("n"), F.sum("dl").alias("tokens")).first()
    if not whole.n:
        raise ValueError("an index needs documents")
    avgdl, n_buckets = whole.tokens / whole.n, min(4096, max(16, whole.tokens // BUCKET_TOKENS))
    kind = stored.schema["chunk_id"].dataType.simpleString()
    rows = stored.select("at", "chunk_id", "dl", "tokens").mapInArrow(_posted(max(avgdl, 1e-300)), f"term string, range long, holders array<struct<at:bigint,chunk_id:{kind},share:double>>, most double, n long")
    rows = rows.withColumn("bucket", _bucket(n_buckets).cast("int"))
    # A frequent term is held by many documents, so a bucket is dealt by range, a million documents to a file; more files would take longer to commit and list than to fill.
    rows.repartition("bucket", F.pmod("range", F.lit(-(-whole.n // FILE_DOCUMENTS)))).sortWithinPartitions("bucket", "term", "range").write.partitionBy("bucket").parquet(f"{folder}/postings")
    postings = spark.read.schema(rows.schema).parquet(f"{folder}/postings")
    df = postings.groupBy("bucket", "term").agg(F.sum("n").alias("df"))
    idf = F.log(F.lit(whole.n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    df.withColumn("idf", idf).repartition("bucket").write.partitionBy("bucket").parquet(f"{folder}/terms")
    vocabulary = spark.read.schema("term string, df long, idf double, bucket int").parquet(f"{folder}/terms").agg(F.count("*").alias("n"), F.avg("idf").alias("mean")).first()
    manifest = {
        "schema_version": SCHEMA_VERSION, "key": key, "folder": folder, "n_documents": whole.n, "n_tokens": whole.tokens, "n_terms": vocabulary.n, "n_buckets": n_buckets,
        "floor": EPSILON * (vocabulary.mean or 0.0), "metadata": meta,
    }
    manifest["version"] = V.commit(spark, root, manifest)
    V._path(spark, f"{folder}/tokens")[1].delete(V._path(spark, f"{folder}/tokens")[0], True)
    return manifest


class Index:
    """The current version of a stored index."""

    def __init__(self, spark: SparkSession, root: str):
        self.manifest = V.current(spark, root)
        if self.manifest is None:
            raise FileNotFoundError(f"no index at {root}")
        if missing := {"schema_version", "folder", "n_buckets", "floor"} - set(self.manifest):
            raise ValueError(f"the index's manifest lacks {sorted(missing)}")
        if self.manifest["schema_version"] != SCHEMA_VERSION:
            raise ValueError(f"unsupported schema version {self.manifest['schema_version']}")
        self.spark, self.folder = spark, self.manifest["folder"]

    def documents(self) -> DataFrame:
        """chunk_id, the metadata, at, dl."""
        return self.spark.read.parquet(f"{self.folder}/documents")

    def postings(self, buckets: list[int]) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/postings").where(F.col("bucket").isin(buckets))

    def terms(self, buckets: list[int]) -> DataFrame:
        return self.spark.read.schema("term string, df long, idf double, bucket int").parquet(f"{self.folder}/terms").where(F.col("bucket").isin(buckets))


def opened(docs: DataFrame, root: str) -> Index:
    """The index of docs at root; built if the current version was made from other files or there isn't any."""
    spark, key = docs.sparkSession, V.fingerprint(docs)
    now = V.current(spark, root)
    if now is None or now.get("key") != key or now.get("schema_version") != SCHEMA_VERSION:
        try:
            build(docs, root, key)
        except RuntimeError:
            # Another session may have committed the same index meanwhile; then its one will do.
            now = V.current(spark, root)
            if now is None or now.get("key") != key:
                raise
    return Index(spark, root)


def _scored(pairs: DataFrame, weights: DataFrame, postings: DataFrame) -> DataFrame:
    """query_id, at, chunk_id, score of the documents in (query_id, range)."""
    asked = pairs.select("query_id", "range").join(weights, "query_id").join(postings.select("bucket", "term", "range", "holders"), ["bucket", "term", "range"])
    found = asked.select("query_id", "w", F.explode("holders").alias("h"))
    return found.groupBy("query_id", F.col("h.at").alias("at"), F.col("h.chunk_id").alias("chunk_id")).agg(F.round(F.sum(F.col("w") * F.col("h.share")), 6).alias("score"))


def search(index: Index, questions: DataFrame, k: int = 10, rank: str = "bm25_rank", first: int = FIRST) -> DataFrame:
    """query_id, chunk_id, score, rank: the k best documents of each question (query_id, text); ties go to the smaller chunk_id. A repeated token counts again."""
    asked = V.held(questions.select("query_id", search_tokens(F.col("text")).alias("tokens")), "questions")
    terms = asked.select("query_id", F.explode("tokens").alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times")).withColumn("bucket", _bucket(index.manifest["n_buckets"]).cast("int"))
    # At most n_buckets numbers reach the driver; they choose the folders that are read.
    buckets = sorted(r.bucket for r in terms.select("bucket").distinct().collect())
    w = F.when(F.col("idf") < 0, F.lit(index.manifest["floor"])).otherwise(F.col("idf")) * F.col("times")
    weights = V.held(terms.join(index.terms(buckets), ["bucket", "term"]).select("query_id", "bucket", "term", w.alias("w")), "weights")
    postings = index.postings(buckets)
    bound = F.sum(F.greatest(F.col("w"), F.lit(0.0)) * F.col("most"))
    bounds = V.held(weights.join(postings.select("bucket", "term", "range", "most"), ["bucket", "term"]).groupBy("query_id", "range").agg(bound.alias("bound")), "bounds")
    tried = top_per_key(bounds, ["query_id"], first, "place", F.desc("bound"), F.col("range"))
    kth = top_per_key(_scored(tried, weights, postings), ["query_id"], k, "place", F.desc("score"), F.col("chunk_id")).where(F.col("place") == k).select("query_id", F.col("score").alias("kth"))
    left = bounds.join(kth, "query_id", "left").where(F.col("kth").isNull() | (F.col("bound") + _SLACK >= F.col("kth")))
    scored = _scored(left, weights, postings)
    hits = V.held(top_per_key(scored, ["query_id"], k, "place", F.desc("score"), F.col("chunk_id"), F.col("at")).drop("place"), "hits")
    # Without negative weights a document beyond the k best can't be taken for one that scores 0.
    seen = hits if index.manifest["floor"] >= 0 else scored
    # Of 2k documents in order of chunk_id at least k are no hits of a question with fewer than k hits.
    head = index.documents().select("chunk_id", "at").orderBy("chunk_id", "at").limit(2 * k)
    short = asked.join(hits.where("score > 0").groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left").where(F.coalesce("n", F.lit(0)) < k).select("query_id")
    fill = short.join(F.broadcast(head), how="cross").join(seen.select("query_id", "at"), ["query_id", "at"], "left_anti").withColumn("score", F.lit(0.0))
    return top_per_key(hits.unionByName(fill), ["query_id"], k, rank, F.desc("score"), F.col("chunk_id"), F.col("at")).select("query_id", "chunk_id", "score", rank)
