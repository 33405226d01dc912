"""Lookups with a duplicate policy, promotion of values onto blank cells, claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..functions.blanks import existing, is_blank, is_filled


def lookup(df: DataFrame, key: str, order: str, policy: str = "first", where: Column | None = None) -> DataFrame:
    """One row by key: the first or the last in order. A min or max over a struct aggregates map-side, so a hot key
    never meets in one task."""
    rows = df if where is None else df.where(where)
    rest = [c for c in rows.columns if c not in (key, order)]
    pick = F.min_by if policy == "first" else F.max_by
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(pick(F.struct(order, *rest), F.col(order)).alias("__r")).select(key, "__r.*")


def promote(df: DataFrame, values: dict[str, Column], evidence: Column, confidence: str, pair: tuple[str, str]) -> DataFrame:
    """Write candidates onto blank cells only, and only with evidence; if any is written, evidence and confidence too.

    values: target column -> candidate. pair: names of the evidence and confidence columns, which are made if missing.
    """
    for c in (*values, *pair):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    usable = ~is_blank(evidence)
    writes = {t: usable & is_blank(F.col(t)) & ~is_blank(v) for t, v in values.items()}
    any_write = F.lit(False)
    for w in writes.values():
        any_write = any_write | w
    new = {t: F.when(writes[t], existing(v)).otherwise(existing(F.col(t))) for t, v in values.items()}
    new |= {pair[0]: F.when(any_write, existing(evidence)).otherwise(existing(F.col(pair[0]))), pair[1]: F.when(any_write, F.lit(confidence)).otherwise(existing(F.col(pair[1])))}
    return df.withColumns(new)


def claims(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A row for each field that is filled: key, field_name, claim_value. One pass, no shuffle."""
    cells = F.array(*(F.struct(F.lit(f).alias("field_name"), existing(F.col(f).cast("string")).alias("claim_value")) for f in fields))
    return df.select(key, F.explode(F.filter(cells, lambda c: c["claim_value"] != "")).alias("c")).select(key, "c.*")


def replace_claims(old: DataFrame, new: DataFrame, marker: str = "_augmented_") -> DataFrame:
    """old without rows that an earlier run added, and new: running it twice changes nothing."""
    return old.where(~F.col("claim_id").contains(marker)).unionByName(new)


def filled_count(fields: list[Column]) -> Column:
    total = F.lit(0)
    for f in fields:
        total = total + is_filled(f).cast("int")
    return total


def first_match(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """Ordered rules: the value of the first that holds."""
    (test, value), *rest = rules
    out = F.when(test, F.lit(value))
    for test, value in rest:
        out = out.when(test, F.lit(value))
    return out if default is None else out.otherwise(F.lit(default))


def all_matches(rules: list[tuple[Column, str]], by: str = "; ") -> Column:
    """The values of all rules that hold, in order."""
    return F.concat_ws(by, *(F.when(test, F.lit(value)) for test, value in rules))


def source_registry(records: DataFrame, checks: DataFrame, key: str) -> DataFrame:
    """A row for each source of a record, with what its check found; a source that wasn't checked wasn't reached.

    records: key, website_url, source_urls (array). checks: url, ok, status_code, final_url, one row a URL.
    """
    sources = records.select(key, "website_url", F.posexplode("source_urls").alias("at", "source_url"))
    kind = U.source_type(F.col("source_url"), F.col("website_url"))
    rows = sources.join(checks.withColumnRenamed("url", "source_url"), "source_url", "left").withColumn("source_type", kind)
    owner = F.when(U.domain(F.col("source_url")) == U.domain(F.col("website_url")), "first_party").otherwise("third_party_or_regulator")
    return rows.select(
        F.format_string("%s_src_%02d", F.col(key).cast("string"), F.col("at") + 1).alias("source_id"), key, "source_url", U.domain(F.col("source_url")).alias("source_domain"), "source_type", U.source_rank(F.col("source_type")).alias("source_rank"),
        owner.alias("source_owner"), F.coalesce("ok", F.lit(False)).alias("http_ok"), F.col("status_code").alias("http_status_code"), F.coalesce("final_url", F.lit("")).alias("final_url"),
    )


def crawl_evidence(registry: DataFrame, crawl: DataFrame, keywords: str) -> DataFrame:
    """source_id, matched, crawled_url, is_pdf, markdown_chars, snippet and note for each source: the last crawled page of its URL without fragment.

    registry: source_id, source_url. crawl: at (order), url, markdown, text; pages without a URL don't count.
    """
    pages = crawl.where(existing(F.col("url")) != "").select(U.canonical(F.col("url")).alias("base"), "at", F.col("url").alias("crawled_url"), F.when(F.coalesce("markdown", F.lit("")) != "", F.col("markdown")).otherwise(F.coalesce("text", F.lit(""))).alias("body"))
    last = pages.groupBy("base").agg(F.max_by(F.struct("crawled_url", "body"), "at").alias("p"))
    rows = registry.withColumn("base", U.canonical(F.col("source_url"))).join(last, "base", "left")
    pdf, matched = F.lower("source_url").endswith(".pdf"), F.col("p").isNotNull()
    note = first_match([
        (pdf, "PDF excluded from website-content-crawler"), (matched & (F.col("base") != F.regexp_replace("source_url", "/+$", "")), "Matched by canonical URL without fragment"), (~matched, "No Apify crawl item returned"),
    ], "Matched")
    body = F.coalesce("p.body", F.lit(""))
    return rows.select("source_id", matched.alias("matched"), F.coalesce("p.crawled_url", F.lit("")).alias("crawled_url"), pdf.alias("is_pdf"), F.length(body).cast("bigint").alias("markdown_chars"), X.snippet(body, keywords).alias("snippet"), note.alias("note"))
