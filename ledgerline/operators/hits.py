"""Typed hits: metadata filters, boosts by requested field, seeds of matched records and of listings, scores of an evaluation.

Chunks have chunk_id, record_id, chunk_type, field_name and field_value_text beside their metadata. Questions are a bounded table, one
row each; rows that a question asks nothing of (null filters, empty lists) pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import existing, truth
from .intent import SINGLE_RECORD_INTENTS
from .ranking import top_per_key

#: The order of chunk types after those that a question prefers.
TYPE_ORDER = ("record_profile", "regulatory", "contact_policy", "recent_activity", "field_evidence")
#: What a field chunk that was asked for adds, and what a chunk of a type adds for fields of its group.
FIELD_BOOST = 0.04
GROUP_BOOST = 0.03
GROUPS = {
    "contact_policy": ("primary_email", "primary_phone", "principal_linkedin_url", "aum_text"),
    "regulatory": ("sec_registered", "sec_crd_number"),
    "recent_activity": ("recent_activity",),
}
#: One of these says that something is not there.
HONEST = ("not evidenced", "no matching", "no evidence", "not in the locked dataset")


def _same(value: Column, wanted: Column) -> Column:
    return F.lower(existing(value)) == F.lower(existing(wanted))


def _placed(wanted: dict[str, Column], state: Column, city: Column) -> Column:
    """A state by its code, or by its code or a city's name when both are asked for."""
    either = _same(state, wanted["state_region"]) | _same(city, wanted["state_or_city"])
    return F.when(wanted["state_or_city"].isNotNull(), either).otherwise(wanted["state_region"].isNull() | _same(state, wanted["state_region"]))


def filters_match(wanted: dict[str, Column], has: dict[str, Column], linkedin: Column) -> Column:
    """Whether the columns `has` meet the nullable filters `wanted`; every other key than the named ones is compared as text."""
    test = _placed(wanted, has["state_region"], has["city"])
    test &= wanted["sec_registered"].isNull() | (truth(has["sec_registered"]) == wanted["sec_registered"])
    test &= wanted["has_linkedin"].isNull() | (linkedin == wanted["has_linkedin"])
    for key in wanted.keys() - {"state_region", "state_or_city", "sec_registered", "has_linkedin"}:
        test &= wanted[key].isNull() | _same(has[key], wanted[key])
    return test


def chunk_linkedin(field_name: Column, value: Column) -> Column:
    """On a chunk: it is the company page's field, and holds a value."""
    return (existing(field_name) == "corporate_linkedin_url") & (existing(value) != "")


def record_linkedin(url: Column) -> Column:
    return existing(url) != ""


def field_boost(chunk_type: Column, field_name: Column, requested: Column) -> Column:
    """A chunk of a requested field, else a chunk whose type goes with a requested field."""
    boost = F.when(F.array_contains(requested, existing(field_name)) & (existing(field_name) != ""), F.lit(FIELD_BOOST))
    for kind, fields in GROUPS.items():
        boost = boost.when((chunk_type == kind) & F.arrays_overlap(requested, F.array(*map(F.lit, fields))), F.lit(GROUP_BOOST))
    return F.coalesce(boost, F.lit(0.0))


def record_seeds(chunks: DataFrame, asked: DataFrame, each: int = 4) -> DataFrame:
    """query_id, chunk_id, record_id, seed_rank: of each matched record the first chunks by type, then chunk_id; records in the order of the match.

    asked: query_id, matched (array of record ids), preferred (array of chunk types).
    """
    order = F.concat(F.coalesce("preferred", F.array().cast("array<string>")), F.array(*map(F.lit, TYPE_ORDER)))
    wanted = asked.select("query_id", order.alias("order"), F.posexplode("matched").alias("at", "record_id"))
    wanted = wanted.groupBy("query_id", "record_id").agg(F.min("at").alias("at"), F.first("order").alias("order"))
    place = F.array_position("order", F.col("chunk_type"))
    found = chunks.select("chunk_id", "record_id", "chunk_type").join(wanted, "record_id").withColumn("place", F.when(place > 0, place).otherwise(F.lit(999)))
    first = top_per_key(found, ["query_id", "record_id"], each, "within", F.col("place"), F.col("chunk_id"))
    return top_per_key(first, ["query_id"], 1 << 30, "seed_rank", F.col("at"), F.col("within")).select("query_id", "chunk_id", "record_id", "seed_rank")


def listing_seeds(chunks: DataFrame, asked: DataFrame, matches: Column, order: str = "chunk_id", most: int = 50) -> DataFrame:
    """query_id, chunk_id, record_id, seed_rank: of each record the first chunk in `order` that meets a listing's filters; the first `most` records.

    asked: query_id, has_linkedin and what else `matches` reads; only questions with filters belong in it. Chunks meet each different
    set of filters once. Those come from the rules' fixed tables, so there are a few thousand at most however many questions there are.
    """
    wanted = [c for c in asked.columns if c != "query_id"]
    allowed = F.col("chunk_type").isin("record_profile", "regulatory") | (F.col("has_linkedin").eqNullSafe(F.lit(True)) & (F.col("chunk_type") == "field_evidence"))
    found = chunks.join(F.broadcast(asked.select(*wanted).distinct()), F.lit(True)).where(allowed & matches)
    # The least chunk of a record combines map-side, so a large record sends one row a task.
    first = found.groupBy(*wanted, "record_id").agg(F.min(F.struct(F.col(order).alias("at"), "chunk_id")).alias("m")).select(*wanted, "record_id", "m.*")
    first = top_per_key(first, wanted, most, "seed_rank", F.col("at"), F.col("chunk_id")).alias("f")
    same = F.lit(True)
    for c in wanted:
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"q.{c}"))
    return asked.alias("q").join(first, same).select("query_id", "chunk_id", "record_id", "seed_rank")


def decoded_urls(value: Column) -> Column:
    """A list of URLs written as JSON, or a bare one, as an array; null and blank give an empty one."""
    text = existing(value)
    listed = F.from_json(text, "array<string>")
    return F.when(text == "", F.array().cast("array<string>")).when(text.startswith("["), F.coalesce(listed, F.array(text))).otherwise(F.array(text))


def citation_score(abstained: Column, cited: Column, retrieved: Column) -> Column:
    """1 for an abstention, else whether something is cited and all of it was retrieved."""
    return F.when(abstained | ((F.size(cited) > 0) & (F.size(F.array_except(cited, retrieved)) == 0)), 1.0).otherwise(0.0)


def entity_score(intent: Column, gold: Column, matched: Column) -> Column:
    """Whether a gold record was matched, or none where there is none; null for intents that aren't about one record."""
    right = F.when(F.size(gold) == 0, F.size(matched) == 0).otherwise(F.arrays_overlap(gold, matched))
    return F.when(intent.isin(*SINGLE_RECORD_INTENTS), right.cast("double"))


def listing_score(expected: Column, found: Column, should_abstain: Column, abstained: Column, gold: Column, ranked: Column) -> Column:
    """For expected listings: an abstention where one is due; else a listing with a gold record among the first five records."""
    hit = ~abstained & (found == "filtered_listing") & ((F.size(gold) == 0) | F.arrays_overlap(F.slice(F.array_distinct(ranked), 1, 5), gold))
    return F.when(expected == "filtered_listing", F.when(should_abstain, abstained).otherwise(hit).cast("double"))


def control_score(should_abstain: Column, gold: Column, abstained: Column, text_ok: Column) -> Column:
    """For questions without an answer: abstained, and with the right words; null for others."""
    return F.when(should_abstain & (F.size(gold) == 0), (abstained & text_ok).cast("double"))


def honesty_score(should_abstain: Column, body: Column) -> Column:
    said = F.lit(False)
    for marker in HONEST:
        said = said | F.lower(body).contains(marker)
    return F.when(~should_abstain | said, 1.0).otherwise(0.0)
