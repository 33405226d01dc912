"""Promotion as one fold: sources with rules of their own, in order of precedence, onto the blank cells of records.

A source says which of its rows count, what key it has with a record, which row of a key stands (the first or the last), what
evidence it gives, and a value for each cell that it may fill. Each source gives at most one offer a key, picked by an
aggregate that combines map-side; the offers of all sources meet at the record in one array, as long as there are sources, and every
cell takes the first offer in order of precedence. So any number of sources costs one join of the records.

A cell that a record fills stays. A cell that is filled by an offer gets the source's evidence and confidence in the source's pair of columns;
`cells` tells for each cell where its value is from, how many sources offer the same (corroboration) and how many another one (conflict). Records
without a key get no offer; null cells are blank; two sources of one name are an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..functions.blanks import existing

_CELL = "struct<value:string,source:string,evidence:string,confidence:string,same:int,other:int>"


@dataclass(frozen=True)
class Source:
    """Where values come from. bare: an offer without evidence counts too."""

    name: str
    confidence: str
    pair: tuple[str, str]
    key: Column
    order: str
    evidence: Column
    values: dict[str, Column]
    accept: Column | None = None
    policy: str = "first"
    bare: bool = False


def offers(source: Source, rows: DataFrame, precedence: int) -> DataFrame:
    """key and offer: the row that stands for each key."""
    rows = rows if source.accept is None else rows.where(source.accept)
    cells = F.array(*[F.struct(F.lit(f).alias("field"), existing(v.cast("string")).alias("value")) for f, v in source.values.items()])
    usable = F.lit(True) if source.bare else existing(source.evidence) != ""
    offer = F.struct(
        F.lit(precedence).alias("precedence"), F.lit(source.name).alias("source"), existing(source.evidence).alias("evidence"), F.lit(source.confidence).alias("confidence"),
        F.when(usable, F.filter(cells, lambda c: c["value"] != "")).otherwise(F.slice(cells, 1, 0)).alias("cells"),
    )
    pick = F.min_by if source.policy == "first" else F.max_by
    return rows.select(source.key.alias("key"), offer.alias("offer"), F.col(source.order).alias("at")).where("key <> ''").groupBy("key").agg(pick("offer", "at").alias("offer"))


def fold(records: DataFrame, key: Column, sources: list[tuple[Source, DataFrame]]) -> DataFrame:
    """records with the sources' cells filled, their pairs, and `cells`: map of field to where its value is from; fields without a value aren't in it."""
    if len({s.name for s, _ in sources}) < len(sources):
        raise ValueError("sources must have names of their own")
    united = None
    for i, (source, rows) in enumerate(sources):
        one = offers(source, rows, i)
        united = one if united is None else united.unionByName(one)
    by_key = united.groupBy("key").agg(F.sort_array(F.collect_list("offer")).alias("offers"))
    fields = list(dict.fromkeys(f for s, _ in sources for f in s.values))
    pairs = list(dict.fromkeys(c for s, _ in sources for c in s.pair))
    records = records.withColumns({c: F.lit("") for c in (*fields, *pairs) if c not in records.columns})
    names = records.columns
    joined = records.withColumn("fold_key", key).join(by_key.withColumnRenamed("key", "fold_key"), "fold_key", "left")

    def cell(f: str) -> Column:
        values = F.transform("offers", lambda o: F.struct(F.get(F.filter(o["cells"], lambda c: c["field"] == f), F.lit(0))["value"].alias("value"), o["source"].alias("source"), o["evidence"].alias("evidence"), o["confidence"].alias("confidence")))
        given = F.coalesce(F.filter(values, lambda v: v["value"].isNotNull()), F.array().cast("array<struct<value:string,source:string,evidence:string,confidence:string>>"))
        own = existing(F.col(f).cast("string"))
        blank = F.lit(None).cast("string")
        first = F.when(own != "", F.struct(own.alias("value"), F.lit("record").alias("source"), blank.alias("evidence"), blank.alias("confidence"))).otherwise(F.get(given, F.lit(0)))
        rest = F.filter(given, lambda v: v["source"] != first["source"])
        same = F.size(F.filter(rest, lambda v: F.lower(v["value"]) == F.lower(first["value"])))
        return F.when(first.isNotNull(), F.struct(first["value"].alias("value"), first["source"].alias("source"), first["evidence"].alias("evidence"), first["confidence"].alias("confidence"), same.alias("same"), (F.size(rest) - same).alias("other")).cast(_CELL))

    held = joined.withColumns({f"fold_{f}": cell(f) for f in fields})
    out = {f: F.coalesce(F.col(f"fold_{f}.value"), F.lit("")) for f in fields}
    for pair in dict.fromkeys(s.pair for s, _ in sources):
        mine = [(s, f) for s, _ in sources if s.pair == pair for f in s.values]
        wrote = [F.when(F.col(f"fold_{f}.source") == s.name, F.struct(F.col(f"fold_{f}.evidence").alias("e"), F.col(f"fold_{f}.confidence").alias("c"))) for s, f in mine]
        out |= {c: F.coalesce(F.coalesce(*wrote)[x], existing(F.col(c))) for c, x in zip(pair, ("e", "c"), strict=True)}
    entries = F.filter(F.array(*[F.struct(F.lit(f).alias("key"), F.col(f"fold_{f}").alias("value")) for f in fields]), lambda e: e["value"].isNotNull())
    return held.withColumn("cells", F.map_from_entries(entries)).withColumns(out).select(*names, "cells")


def wrote(source: str) -> Column:
    """Whether a folded record has a cell from a source."""
    return F.exists(F.map_values("cells"), lambda c: c["source"] == source)


def phone_agrees(primary: Column, offered: Column) -> Column:
    """'True' or 'False' where both are there: whether they are one number; else ''."""
    both = (existing(primary) != "") & (existing(offered) != "")
    return F.when(both, F.when(X.phones_match(primary, offered), "True").otherwise("False")).otherwise("")


def rating_text(c: Column) -> Column:
    """A number with one decimal; other text as it is."""
    return F.coalesce(F.format_string("%.1f", existing(c).try_cast("double")), existing(c))


#: Columns of social pages, the columns that they are found in, and the hosts that each may have.
PLATFORMS = (
    ("twitter_url", "twitters", ("twitter.com", "x.com")), ("instagram_url", "instagrams", ("instagram.com",)), ("facebook_url", "facebooks", ("facebook.com", "fb.com")),
    ("youtube_url", "youtubes", ("youtube.com", "youtu.be")), ("tiktok_url", "tiktoks", ("tiktok.com",)),
)


def _c(name: str) -> Column:
    return F.col(name)


def is_open() -> Column:
    """A listing that isn't closed."""
    closed = lambda c: F.lower(existing(_c(c).cast("string"))) == "true"
    return ~closed("temporarily_closed") & ~closed("permanently_closed")


def company_page(url: Column) -> Column:
    return F.lower(existing(url)).rlike(r"linkedin\.com/company/")


def places(order: str = "at") -> Source:
    phone = F.when(existing(_c("phone")) != "", _c("phone")).otherwise(_c("phone_unformatted"))
    values = {"google_places_phone": phone, "google_places_reviews_count": X.integer_text(_c("reviews_count")), "google_places_rating": rating_text(_c("total_score")), "google_places_category": _c("category_name"), "google_maps_url": _c("url")}
    return Source("google_places", "google_places_domain_match", ("google_places_evidence_url", "google_places_confidence"), U.domain(_c("website"), "any"), order, _c("url"), values, is_open())


def company(order: str = "at") -> Source:
    listed = F.from_json(existing(_c("specialties")), "array<string>", {"allowSingleQuotes": "true"})
    special = F.when(existing(_c("specialties")).rlike(r"^\[.*\]$"), F.coalesce(F.array_join(F.filter(F.transform(listed, existing), lambda x: x != ""), "; "), existing(_c("specialties")))).otherwise(_c("specialties"))
    number = lambda c: X.integer_text(_c(c))
    values = {
        "linkedin_employee_count": number("employeeCount"), "linkedin_follower_count": number("followerCount"), "linkedin_specialties": special, "linkedin_company_size_band": _c("companySize"), "linkedin_industry": _c("industry"),
        "linkedin_founded_year": number("foundedYear"), "linkedin_headquarters_full": X.joined(*[_c(c) for c in ("street", "city", "state", "country", "postalCode")]),
    }
    return Source("company_page", "linkedin_company_page", ("linkedin_evidence_url", "linkedin_confidence"), U.domain(_c("website"), "any"), order, _c("linkedinUrl"), values, company_page(_c("linkedinUrl")))


def social(order: str = "at") -> Source:
    start = F.when(existing(_c("originalStartUrl")) != "", _c("originalStartUrl")).otherwise(_c("domain"))
    evidence = F.when(existing(_c("originalStartUrl")) != "", _c("originalStartUrl")).otherwise(F.concat(F.lit("https://"), U.domain(start, "any")))
    values = {column: U.first_on(U.url_list(_c(raw)), hosts) for column, raw, hosts in PLATFORMS}
    return Source("social", "linked_from_official_site", ("social_media_evidence_url", "social_media_confidence"), U.domain(start, "any"), order, evidence, values)


def addresses(order: str = "at") -> tuple[Source, Source]:
    """Streets of listings, and of company pages for those without; both may lack evidence."""
    pair, key = ("street_address_evidence_url", "street_address_confidence"), U.domain(_c("website"), "dotted")
    street = {"street_address": _c("street")}
    there = existing(_c("street")) != ""
    return (
        Source("places_street", "google_places_domain_match", pair, key, order, _c("url"), street, is_open() & there, bare=True),
        Source("company_street", "linkedin_company_page", pair, key, order, _c("linkedinUrl"), street, there & company_page(_c("linkedinUrl")), bare=True),
    )


def fill_slots(records: DataFrame, key: str, people: DataFrame, most: int = 3) -> DataFrame:
    """records with principal_1_name ... of their most senior people (key, rank, name, role, source_url); a slot that has a name stays, and its person is passed over."""
    person = F.struct("rank", F.lower("name").alias("low"), "name", "role", "source_url")
    by_record = people.where(existing(F.col("name")) != "").groupBy(key).agg(F.slice(F.array_sort(F.collect_list(person)), 1, most).alias("people"))
    out = records.withColumns({f"principal_{i}_{c}": F.lit("") for i in range(1, most + 1) for c in ("name", "role", "source_url", "confidence") if f"principal_{i}_{c}" not in records.columns}).join(by_record, key, "left")
    new = {}
    for i in range(1, most + 1):
        p = F.get("people", F.lit(i - 1))
        free = p.isNotNull() & (existing(F.col(f"principal_{i}_name")) == "")
        for c in ("name", "role", "source_url"):
            new[f"principal_{i}_{c}"] = F.when(free & (existing(p[c]) != ""), existing(p[c])).otherwise(existing(F.col(f"principal_{i}_{c}")))
        new[f"principal_{i}_confidence"] = F.when(free, F.lit("corporate_team_page")).otherwise(existing(F.col(f"principal_{i}_confidence")))
    return out.withColumns(new).drop("people")


def news(records: DataFrame, key: str, signals: DataFrame, today: str) -> DataFrame:
    """records with recent_activity and what is known of it. signals: key, title, source_name, url, pub_date - the one that stands for each record.

    An activity that is there stays, and its blank details are read from it; a record without any signal says so, with a note of the day; a signal fills all and removes such notes.
    """
    detail = ("date", "outlet", "url", "type", "confidence")
    names = ["recent_activity", *[f"recent_activity_{d}" for d in detail], "uncertainty_notes"]
    rows = records.withColumns({c: F.lit("") for c in names if c not in records.columns}).join(signals.select(key, F.struct("title", "source_name", "url", "pub_date").alias("s")), key, "left")
    own, form = existing(F.col("recent_activity")), r"\((.*?),\s*(\d{4}-\d{2}-\d{2})\)(?:\s+—\s+(\S+))?"
    read = {"outlet": existing(F.regexp_extract(own, form, 1)), "date": F.regexp_extract(own, form, 2), "url": F.regexp_extract(own, form, 3), "type": F.lit("news"), "confidence": F.lit("previously_promoted_news_signal")}
    has, kept, found = own != "", own.rlike(form), F.col("s").isNotNull()
    source = F.when(existing(F.col("s.source_name")) != "", existing(F.col("s.source_name")))
    head = F.concat(existing(F.col("s.title")), F.lit(" ("), F.coalesce(source, F.lit("news")), F.lit(", "), F.col("s.pub_date"), F.lit(")"))
    url = existing(F.col("s.url"))
    new = {"recent_activity": F.when(has, own).when(found, F.when(url != "", F.concat(head, F.lit(" — "), url)).otherwise(head)).otherwise("")}
    fresh = {"date": F.col("s.pub_date"), "outlet": F.coalesce(source, F.lit("")), "url": url, "type": F.lit("news"), "confidence": F.lit("name_token_date_filtered")}
    none = {"type": F.lit("none_found"), "confidence": F.lit("no_qualifying_public_signal")}
    for d in detail:
        before = existing(F.col(f"recent_activity_{d}"))
        new[f"recent_activity_{d}"] = F.when(has, F.when(kept & (before == ""), read[d]).otherwise(before)).when(found, fresh[d]).otherwise(none.get(d, before))
    notes, note = F.coalesce("uncertainty_notes", F.lit("")), f"no recent public signal as of {today}"
    cleaned = F.regexp_replace(F.regexp_replace(notes, r"\s*;?\s*no recent public signal as of \d{4}-\d{2}-\d{2}", ""), r"^[ ;]+|[ ;]+$", "")
    noted = F.when(notes.contains(note), notes).when(notes != "", F.concat(notes, F.lit(f"; {note}"))).otherwise(note)
    new["uncertainty_notes"] = F.when(has, notes).when(found, cleaned).otherwise(noted)
    return rows.withColumns(new).drop("s")
