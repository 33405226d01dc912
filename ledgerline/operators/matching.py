"""Entity resolution of records against a registry: candidate queries, a similarity search by rare tokens, scores, early exit.

A record asks its candidate queries in order: its name, the name without generic words, the first two words of that. A query's hits are the
registry entries of which the name or an alias has a token set similar to the query's (Jaccard of at least `similar`). A hit scores 0.75 if the
names are equal without generic words, else the best Jaccard of the record's name with name and aliases; 0.25 more if city and
state agree. Queries end with the first at which the best hit so far reaches `threshold`; of equal hits the first query's counts, then the smallest entry.

The search is a prefix-filter join: a set meets another of a size class only by so many of its rarest tokens as two similar sets can't
both lack, so a frequent token joins only sets that consist of frequent tokens. Equal names collapse to one token set, and records and
entries that score alike to one each before they meet, so copies never meet copies. Nothing is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.blanks import existing
from ..sources.versions import held
from .evidence import first_match

THRESHOLD, REVIEW, SIMILAR = 0.6, 0.45, 0.5


def candidate_queries(name: Column, plain: Column, simple: Column) -> Column:
    """The queries that a name asks, in order, without repeats or blanks. plain: its words; simple: the words that aren't generic, joined."""
    other = F.when((simple != "") & (simple != F.array_join(plain, " ")), simple)
    short = F.when(simple != "", F.array_join(F.slice(F.split(simple, " "), 1, 2), " "))
    # The first of those that are equal but for case counts.
    add = lambda kept, q: F.when((q == "") | F.exists(kept, lambda k: F.lower(k) == F.lower(q)), kept).otherwise(F.array_append(kept, q))
    return F.when(name == "", F.array().cast("array<string>")).otherwise(F.aggregate(F.array_compact(F.array(name, other, short)), F.array().cast("array<string>"), add))


def token_set(name: Column) -> Column:
    return F.array_sort(F.array_distinct(X.words(name)))


def _size_class(n: Column) -> Column:
    return F.floor(F.log2(n)).cast("int")


def _prefixes(sets: DataFrame, rarity: DataFrame, similar: float, own: str, other: str) -> DataFrame:
    """(tokens, token, own class, other class): the tokens by which a set meets sets of another size class."""
    ranked = sets.select("tokens", F.explode("tokens").alias("token")).join(rarity, "token", "left").groupBy("tokens").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("rare"))
    n = F.size("tokens")
    classes = F.sequence(_size_class(F.ceil(n * similar - 1e-9)), _size_class(F.floor(n / similar + 1e-9)))
    found = ranked.select("tokens", "rare", n.alias("n"), _size_class(n).alias(own), F.explode(classes).alias(other))
    least = F.greatest(F.pow(F.lit(2.0), F.col(other)), F.ceil(F.col("n") * similar - 1e-9))
    overlap = F.ceil(similar * (F.col("n") + least) / (1 + similar) - 1e-9)
    met = F.slice("rare", F.lit(1), F.greatest(F.lit(1), F.col("n") - overlap + 1).cast("int"))
    return found.select("tokens", own, other, F.explode(F.transform(met, lambda r: r["token"])).alias("token"))


def similar_sets(left: DataFrame, right: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(l, r): the pairs of different token sets (column tokens, sorted, not empty) of two tables with a Jaccard of at least `similar`."""
    left, right = (held(side.where(F.size("tokens") > 0).select("tokens").distinct(), "sets") for side in (left, right))
    rarity = held(right.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df")), "rarity")
    met = _prefixes(left, rarity, similar, "lc", "rc").withColumnRenamed("tokens", "l").join(_prefixes(right, rarity, similar, "rc", "lc").withColumnRenamed("tokens", "r"), ["token", "lc", "rc"])
    return met.select("l", "r").distinct().where(X.token_jaccard(F.col("l"), F.col("r")) >= similar - 1e-12)


def _scored(record: Column, entry: Column) -> Column:
    """A struct: score, best Jaccard, the name that it belongs to, and whether names and places are equal. A name equal but for generic words names the match, the last such."""
    best = F.aggregate(
        entry["names"], F.struct(F.lit(0.0).alias("jaccard"), F.lit("").alias("name"), F.lit(False).alias("same")),
        lambda acc, n: F.struct(
            F.greatest(acc["jaccard"], X.token_jaccard(record["tokens"], n["tokens"])).alias("jaccard"),
            F.when((record["simple"] != "") & (record["simple"] == n["simple"]), n["name"]).when(X.token_jaccard(record["tokens"], n["tokens"]) > acc["jaccard"], n["name"]).otherwise(acc["name"]).alias("name"),
            (acc["same"] | ((record["simple"] != "") & (record["simple"] == n["simple"]))).alias("same"),
        ),
    )
    place = (record["city"] != "") & (record["city"] == entry["city"]) & (record["state"] != "") & record["state"].isin(entry["state"], F.substring(entry["state"], 1, 2))
    return F.struct(best.alias("best"), place.alias("place"))


def resolve(records: DataFrame, registry: DataFrame, threshold: float = THRESHOLD, review: float = REVIEW, similar: float = SIMILAR) -> DataFrame:
    """record_id, entry_id, score, verdict, reason, n_queries for each record (record_id, name, city, state).

    registry: entry_id, name, aliases (array), city, state. Without a hit, or a name, the score is 0 and entry_id null; null cells are blank.
    """
    low = lambda c: F.lower(existing(F.col(c)))
    named = lambda n: F.struct(n.alias("name"), token_set(n).alias("tokens"), X.registry_name(n).alias("simple"))
    aliases = F.filter(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: existing(a) != "")
    entries = registry.select("entry_id", F.struct(F.transform(F.concat(F.array(existing(F.col("name"))), aliases), named).alias("names"), low("city").alias("city"), low("state").alias("state")).alias("entry"))
    entries = held(entries.groupBy("entry").agg(F.min("entry_id").alias("entry_id")), "entries")
    asked = records.select("record_id", F.struct(existing(F.col("name")).alias("name"), low("city").alias("city"), low("state").alias("state")).alias("r"))
    asked = held(asked, "records")
    words = asked.select("r").distinct().withColumns({"plain": X.words(F.col("r.name")), "simple": X.registry_name(F.col("r.name"))})
    record = F.struct(F.array_sort(F.array_distinct("plain")).alias("tokens"), "simple", F.col("r.city").alias("city"), F.col("r.state").alias("state"))
    classes = held(words.select("r", record.alias("record"), candidate_queries(F.col("r.name"), F.col("plain"), F.col("simple")).alias("asks")), "classes")
    queries = held(classes.select("r", "record", F.posexplode("asks").alias("ordinal", "q")).withColumn("l", token_set(F.col("q"))), "queries")
    sets = entries.select("entry", "entry_id", F.explode(F.array_distinct(F.transform("entry.names", lambda n: n["tokens"]))).alias("r_set"))
    pairs = held(similar_sets(queries.select(F.col("l").alias("tokens")), sets.select(F.col("r_set").alias("tokens")), similar), "pairs")
    hits = queries.select("r", "record", "ordinal", "l").join(pairs.withColumnRenamed("r", "r_set"), "l")
    hits = hits.select("r", "record", "ordinal", "r_set").join(sets, "r_set")
    s = hits.select("r", "ordinal", "entry_id", _scored(F.col("record"), F.col("entry")).alias("s"))
    score = F.round(F.when(F.col("s.best.same"), 0.75).otherwise(F.col("s.best.jaccard")) + F.when(F.col("s.place"), 0.25).otherwise(0.0), 6)
    reason = F.concat_ws(
        "; ", F.format_string("name_jaccard=%.2f (vs '%s')", F.col("s.best.jaccard"), F.col("s.best.name")), F.when(F.col("s.best.same"), "simplified_name_exact_match"), F.when(F.col("s.place"), "address_match=city+state")
    )
    s = s.select("r", "ordinal", "entry_id", score.alias("score"), reason.alias("reason")).where("score > 0")
    # One row for each class of records and query; the rest of the work is on a few rows a record.
    first = s.groupBy("r", "ordinal").agg(F.min(F.struct((-F.col("score")).alias("minus"), "entry_id", "reason")).alias("b"))
    stop = first.where(F.col("b.minus") <= -threshold).groupBy("r").agg(F.min("ordinal").alias("stop"))
    best = first.join(stop, "r", "left").where(F.col("stop").isNull() | (F.col("ordinal") <= F.col("stop"))).groupBy("r").agg(F.min(F.struct("b.minus", "ordinal", "b.entry_id", "b.reason")).alias("b"), F.min("stop").alias("stop"))
    out = asked.join(classes.select("r", F.size("asks").alias("n_asks")), "r").join(best, "r", "left").withColumn("score", F.coalesce(-F.col("b.minus"), F.lit(0.0)))
    verdict = first_match([(F.col("score") >= threshold, "matched"), (F.col("score") >= review, "needs_review")], "unmatched")
    n_queries = F.coalesce(F.col("stop") + 1, F.col("n_asks")).cast("bigint")
    return out.select("record_id", F.col("b.entry_id").alias("entry_id"), "score", verdict.alias("verdict"), F.coalesce("b.reason", F.lit("")).alias("reason"), n_queries.alias("n_queries"))
