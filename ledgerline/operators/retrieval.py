"""Hashed embeddings, reciprocal-rank fusion, seeds, caps and scores of retrieval; the indexes are in inverted.py and vector_index.py."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import search_tokens
from ..sources.versions import held
from . import hits, inverted, vector_index
from .intent import kept_registered_filter
from .ranking import top_per_key

DIMENSION = 384
RRF_K = 60


def _codes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Component and sign of each token, by its SHA-256."""
    digests = [hashlib.sha256(t.encode()).digest() for t in tokens]
    at = np.array([int.from_bytes(d[:4]) % DIMENSION for d in digests], np.int64)
    return at, np.array([1.0 if d[4] % 2 == 0 else -1.0 for d in digests])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tokens) -> (id, embedding); each distinct token of a batch is hashed once."""
    for b in batches:
        lists = b.column(1)
        flat = lists.flatten().dictionary_encode()
        at, sign = _codes(flat.dictionary.to_pylist())
        token = flat.indices.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(b.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        x = np.bincount(row * DIMENSION + at[token], sign[token], b.num_rows * DIMENSION).reshape(-1, DIMENSION) if len(token) else np.zeros((b.num_rows, DIMENSION))
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), DIMENSION).cast(pa.list_(pa.float64()))], [b.schema.names[0], "embedding"])


def hashed_vectors(docs: DataFrame, id_: str = "doc_id") -> DataFrame:
    """id, embedding: the L2-normalised signed counts of hashed tokens of each row's own text, without a shuffle; zeros for a text without tokens."""
    tokens = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    kind = docs.schema[id_].dataType.simpleString()
    return docs.select(id_, tokens.alias("tokens")).mapInArrow(_hashed, f"{id_} {kind}, embedding array<double>")


def fuse(dense: DataFrame, bm25: DataFrame, boost: Column | None = None, meta: DataFrame | None = None) -> DataFrame:
    """Full outer merge of two ranked lists (query_id, chunk_id, dense_rank / bm25_rank) by reciprocal ranks and a boost.

    meta: columns by chunk_id, which the boost may read; chunks without any stay. Ties: first in order of the dense list, then of the other."""
    both = dense.join(bm25, ["query_id", "chunk_id"], "full_outer")
    both = both if meta is None else both.join(meta, "chunk_id", "left")
    rrf = lambda c: F.coalesce(1 / (RRF_K + F.col(c)), F.lit(0.0))
    return both.withColumn("fused", F.round(rrf("dense_rank") + rrf("bm25_rank") + (F.lit(0.0) if boost is None else boost), 9))


FUSED_ORDER = (F.desc, "fused"), (F.asc_nulls_last, "dense_rank"), (F.asc_nulls_last, "bm25_rank"), (F.asc, "chunk_id")


def fused_order() -> list[Column]:
    return [f(c) for f, c in FUSED_ORDER]


def ranked(hits: DataFrame, rank: str = "final_rank", most: int = 1 << 30) -> DataFrame:
    return top_per_key(hits, ["query_id"], most, rank, *fused_order())


def cap_per_record(hits: DataFrame, record: str, most: int | Column, rank: str) -> DataFrame:
    """At most `most` hits by query and record, in order, and ranks anew. most: a number, or a column of hits of at most 1,000."""
    kept = top_per_key(hits, ["query_id", record], most if isinstance(most, int) else 1000, "__place", F.col(rank))
    kept = kept if isinstance(most, int) else kept.where(F.col("__place") <= most)
    return top_per_key(kept.withColumnRenamed(rank, "__old"), ["query_id"], 1 << 30, rank, F.col("__old")).drop("__old", "__place")


def with_seeds(seeds: DataFrame, hits: DataFrame, rank: str) -> DataFrame:
    """Seeds (query_id, chunk_id, seed_rank) first, then the hits that are no seeds."""
    rest = hits.join(seeds.select("query_id", "chunk_id"), ["query_id", "chunk_id"], "left_anti").select("query_id", "chunk_id", F.lit(1).alias("__group"), F.col(rank).alias("__place"))
    first = seeds.select("query_id", "chunk_id", F.lit(0).alias("__group"), F.col("seed_rank").alias("__place"))
    return top_per_key(first.unionByName(rest), ["query_id"], 1 << 30, rank, F.col("__group"), F.col("__place")).drop("__group", "__place")


def ranked_lists(index: inverted.Index, vectors: vector_index.VectorIndex | None, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What both indexes find for questions (query_id, t): (query_id, chunk_id, dense_rank), none without vectors, and (query_id, chunk_id, bm25_rank)."""
    text = asked.select("query_id", F.col("t").alias("text"))
    if vectors is not None:
        near = vector_index.search(vectors, hashed_vectors(text, "query_id"), 80, own=False).select("query_id", F.col("vec_id").alias("chunk_id"), "dense_rank")
    else:
        near = index.documents().where("false").select(F.lit(0).cast("long").alias("query_id"), "chunk_id", F.lit(0).cast("long").alias("dense_rank"))
    return near, inverted.search(index, text, 120).select("query_id", "chunk_id", "bm25_rank")


def retrieved(
    index: inverted.Index, vectors: vector_index.VectorIndex, asked: DataFrame, dense: bool = True, seeded: bool = True, lists: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """query_id, intent, chunk_id, record_id, final_rank: the hits of questions by both indexes and their own rules, before the cut.

    index has the chunks' metadata: record_id, chunk_type, field_name, field_value_text, state_region, city, country, entity_type, sec_registered. asked: query_id, t (lower case),
    and what the rules of intent.py read from it: f, intent, chunk_types and the filters. A record whose id stands in a question is matched.
    dense, seeded: whether vectors are searched and seeds come first. lists: ranked_lists of the same questions, for passes that share them.
    """
    chunks = index.documents()
    named = asked.select("query_id", F.explode(F.array_distinct(search_tokens(F.col("t")))).alias("record_id")).join(chunks.select("record_id").distinct(), "record_id")
    matched = named.groupBy("query_id").agg(F.sort_array(F.collect_list("record_id"), False).alias("matched"))
    preferred = F.split("chunk_types", ",").alias("preferred")
    asked = asked.join(matched, "query_id", "left").withColumn("matched", F.coalesce("matched", F.array().cast("array<string>")))
    registered = kept_registered_filter(F.col("intent"), F.size("matched"), F.col("sec_registered"))
    wanted = {"state_region": F.col("state").alias("want_state"), "state_or_city": F.col("state_or_city").alias("want_city"), "country": F.col("country").alias("want_country"), "entity_type": F.col("entity_type").alias("want_type"), "sec_registered": registered.alias("want_sec")}
    asked = held(asked.select("query_id", "t", "f", "intent", preferred, "matched", *wanted.values(), "has_linkedin"), "asked")
    names = {"state_region": "want_state", "state_or_city": "want_city", "country": "want_country", "entity_type": "want_type", "sec_registered": "want_sec", "has_linkedin": "has_linkedin"}
    linkedin = hits.chunk_linkedin(F.col("field_name"), F.col("field_value_text"))
    meets = hits.filters_match({k: F.col(c) for k, c in names.items()}, {k: F.col(k) for k in ("state_region", "city", "country", "entity_type", "sec_registered")}, linkedin)
    near, bm25 = lists or ranked_lists(index, vectors if dense else None, asked)
    near = near if dense else near.where("false")
    boost = F.when(F.array_contains("matched", F.col("record_id")), 0.10).otherwise(0.0) + F.when(F.array_contains("preferred", F.col("chunk_type")), 0.04).otherwise(0.0)
    boost += hits.field_boost(F.col("chunk_type"), F.col("field_name"), F.col("f"))
    meta = chunks.select("chunk_id", "record_id", "chunk_type", "field_name")
    both = near.join(bm25, ["query_id", "chunk_id"], "full_outer").join(asked.select("query_id", "f", "preferred", "matched"), "query_id").join(meta, "chunk_id")
    rrf = lambda c: F.coalesce(1 / (RRF_K + F.col(c)), F.lit(0.0))
    fused = ranked(both.withColumn("fused", F.round(rrf("dense_rank") + rrf("bm25_rank") + boost, 9)))
    listing = F.col("intent") == "filtered_listing"
    some = F.coalesce(*[F.col(c).cast("string") for c in names.values()]).isNotNull()
    seeds = hits.record_seeds(chunks, asked.where(~listing)).select("query_id", "chunk_id", "seed_rank")
    listed = hits.listing_seeds(chunks, asked.where(listing & some).select("query_id", *names.values()), meets).select("query_id", "chunk_id", "seed_rank")
    seeds = seeds.unionByName(listed) if seeded else seeds.where("false")
    found = with_seeds(seeds, fused, "final_rank").join(asked.select("query_id", "intent", *names.values()), "query_id").join(chunks, "chunk_id").where(meets)
    return cap_per_record(found, "record_id", F.when(F.col("intent") == "comparison", 4).otherwise(3), "final_rank").select("query_id", "intent", "chunk_id", "record_id", "final_rank")


def retrieval_scores(hits: DataFrame, queries: DataFrame, rank: str) -> DataFrame:
    """hit_at_3, reciprocal_rank and recall_at_5 by query. hits: query_id, rank, record, relevant. queries: query_id, n_gold, abstained.

    hit@3 and reciprocal rank go by hits, recall@5 by the first five distinct records; without gold all three are
    1 for an abstention and 0 otherwise."""
    r = F.col(rank)
    firsts = hits.groupBy("query_id", "record").agg(F.min(r).alias("at"), F.bool_or("relevant").alias("relevant"))
    five = top_per_key(firsts, ["query_id"], 5, "place", F.col("at")).groupBy("query_id").agg(F.count_if("relevant").alias("found"))
    best = hits.where("relevant").groupBy("query_id").agg(F.min(r).alias("best"))
    rows = queries.join(best, "query_id", "left").join(five, "query_id", "left")
    none = F.when(F.col("n_gold") == 0, F.col("abstained").cast("double"))
    return rows.select(
        "query_id", F.coalesce(none, (F.coalesce("best", F.lit(99)) <= 3).cast("double")).alias("hit_at_3"), F.coalesce(none, F.coalesce(1 / F.col("best"), F.lit(0.0))).alias("reciprocal_rank"),
        F.coalesce(none, F.coalesce("found", F.lit(0)) / F.col("n_gold")).alias("recall_at_5"),
    )
