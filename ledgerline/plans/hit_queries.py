"""Queries over typed hits: filters, boosts, seeds, decoded metadata, seniority and the scores of an evaluation.

Documents stand for chunks: the source is the record, the language gives the type, what the text holds gives the field.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hits as H
from ..operators import intent as I
from ..operators import sequences as S
from .registry import query

CHUNKS_SQL = """c AS (SELECT doc_id AS chunk_id, source AS record_id, CASE lang WHEN 'en' THEN 'record_profile' WHEN 'fr' THEN 'regulatory' WHEN 'de' THEN 'recent_activity' WHEN 'es' THEN 'contact_policy' ELSE 'field_evidence' END AS chunk_type,
  CASE WHEN contains(text, '@') THEN 'primary_email' WHEN contains(text, '+') THEN 'primary_phone' WHEN n_chars % 5 = 0 THEN 'corporate_linkedin_url' ELSE '' END AS field_name, CASE WHEN n_chars > 300 THEN ' x ' ELSE ' ' END AS field_value_text,
  CASE WHEN source IN ('src1', 'src2') THEN 'ca' WHEN source = 'src3' THEN 'NY' END AS state_region, CASE WHEN source = 'src4' THEN 'California ' ELSE '' END AS city, CASE WHEN n_chars > 500 THEN 'Yes' WHEN n_chars > 200 THEN 'no' END AS sec_registered,
  CASE WHEN lang = 'fr' THEN 'Switzerland' ELSE 'United States' END AS country,
  CASE WHEN source IN ('src0', 'src5') THEN 'multi_family_office' WHEN source = 'src6' THEN 'single_family_office' END AS entity_type FROM documents)"""
_WANTED = """q AS (SELECT * FROM (VALUES (1, 'CA', 'California', NULL, NULL, NULL), (2, 'NY', NULL, NULL, true, NULL), (3, NULL, NULL, 'switzerland', NULL, NULL), (4, NULL, NULL, NULL, false, true), (5, NULL, NULL, NULL, NULL, false))
  v(query_id, want_state, want_city, want_country, want_sec, want_linkedin))"""
_MEETS = """(CASE WHEN want_city IS NOT NULL THEN lower(coalesce(state_region, '')) = lower(want_state) OR lower(trim(city)) = lower(want_city) ELSE want_state IS NULL OR lower(coalesce(state_region, '')) = lower(want_state) END)
  AND (want_country IS NULL OR lower(country) = want_country) AND (want_sec IS NULL OR (coalesce(lower(sec_registered), '') IN ('yes', 'true', '1', 'y', 'registered')) = want_sec)"""
_CHUNK_MEETS = _MEETS + " AND (want_linkedin IS NULL OR (field_name = 'corporate_linkedin_url' AND trim(field_value_text) <> '') = want_linkedin)"


def document_chunks(t, *more):
    n, text, source, lang = F.col("n_chars"), F.col("text"), F.col("source"), F.col("lang")
    kind = F.when(lang == "en", "record_profile").when(lang == "fr", "regulatory").when(lang == "de", "recent_activity").when(lang == "es", "contact_policy").otherwise("field_evidence")
    field = F.when(text.contains("@"), "primary_email").when(text.contains("+"), "primary_phone").when(n % 5 == 0, "corporate_linkedin_url").otherwise("")
    return t("documents").select(
        F.col("doc_id").alias("chunk_id"), source.alias("record_id"), kind.alias("chunk_type"), field.alias("field_name"), F.when(n > 300, " x ").otherwise(" ").alias("field_value_text"),
        F.when(source.isin("src1", "src2"), "ca").when(source == "src3", "NY").alias("state_region"), F.when(source == "src4", "California ").otherwise("").alias("city"),
        F.when(n > 500, "Yes").when(n > 200, "no").alias("sec_registered"), F.when(lang == "fr", "Switzerland").otherwise("United States").alias("country"),
        F.when(source.isin("src0", "src5"), "multi_family_office").when(source == "src6", "single_family_office").alias("entity_type"), *more,
    )


def _wanted(t):
    rows = [(1, "CA", "California", None, None, None), (2, "NY", None, None, True, None), (3, None, None, "switzerland", None, None), (4, None, None, None, False, True), (5, None, None, None, None, False)]
    return t("region").sparkSession.createDataFrame(rows, "query_id int, want_state string, want_city string, want_country string, want_sec boolean, has_linkedin boolean")


def _meets(linkedin):
    wanted = {"state_region": F.col("want_state"), "state_or_city": F.col("want_city"), "country": F.col("want_country"), "sec_registered": F.col("want_sec"), "has_linkedin": F.col("has_linkedin")}
    return H.filters_match(wanted, {c: F.col(c) for c in ("state_region", "city", "country", "sec_registered")}, linkedin)


@query("chunk_filters", f"WITH {CHUNKS_SQL}, {_WANTED} SELECT query_id, chunk_id FROM c, q WHERE {_CHUNK_MEETS}")
def chunk_filters(t):
    """Typed filters on the metadata of chunks; the filters are five literal rows."""
    found = document_chunks(t).join(F.broadcast(_wanted(t)), _meets(H.chunk_linkedin(F.col("field_name"), F.col("field_value_text"))))
    return found.select("query_id", "chunk_id")


@query("record_filters", f"""
WITH c AS (SELECT c_custkey, CASE n_name WHEN 'UNITED STATES' THEN 'ca' WHEN 'CANADA' THEN 'NY' END AS state_region, CASE c_mktsegment WHEN 'BUILDING' THEN 'California ' ELSE '' END AS city, CASE WHEN c_acctbal > 5000 THEN 'Yes' WHEN c_acctbal > 0 THEN 'no' END AS sec_registered,
  CASE n_name WHEN 'FRANCE' THEN 'Switzerland' ELSE 'United States' END AS country, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name ELSE ' ' END AS linkedin FROM customer JOIN nation ON n_nationkey = c_nationkey), {_WANTED}
SELECT query_id, c_custkey FROM c, q WHERE {_MEETS} AND (want_linkedin IS NULL OR (trim(linkedin) <> '') = want_linkedin)""")
def record_filters(t):
    """The same filters on records, which hold the company page in a column of their own."""
    n, seg, b = F.col("n_name"), F.col("c_mktsegment"), F.col("c_acctbal")
    records = t("customer").join(F.broadcast(t("nation")), F.col("n_nationkey") == F.col("c_nationkey")).select(
        "c_custkey", F.when(n == "UNITED STATES", "ca").when(n == "CANADA", "NY").alias("state_region"), F.when(seg == "BUILDING", "California ").otherwise("").alias("city"),
        F.when(b > 5000, "Yes").when(b > 0, "no").alias("sec_registered"), F.when(n == "FRANCE", "Switzerland").otherwise("United States").alias("country"), F.when(seg == "MACHINERY", F.col("c_name")).otherwise(" ").alias("linkedin"),
    )
    return records.join(F.broadcast(_wanted(t)), _meets(H.record_linkedin(F.col("linkedin")))).select("query_id", "c_custkey")


@query("field_boosts", f"""
WITH {CHUNKS_SQL}, a AS (SELECT * FROM (VALUES (1, ['primary_email']), (2, ['primary_phone', 'recent_activity']), (3, ['sec_crd_number']), (4, ['corporate_linkedin_url']), (5, ['aum_text', 'sec_registered'])) v(query_id, fields))
SELECT query_id, chunk_id, CASE WHEN field_name <> '' AND list_contains(fields, field_name) THEN 0.04
  WHEN chunk_type = 'contact_policy' AND query_id IN (1, 2, 5) OR chunk_type = 'regulatory' AND query_id IN (3, 5) OR chunk_type = 'recent_activity' AND query_id = 2 THEN 0.03 ELSE 0 END::DOUBLE AS boost FROM c, a""")
def field_boosts(t):
    """What the fields of a question add to each chunk's score, for five literal questions."""
    asked = [(1, ["primary_email"]), (2, ["primary_phone", "recent_activity"]), (3, ["sec_crd_number"]), (4, ["corporate_linkedin_url"]), (5, ["aum_text", "sec_registered"])]
    asked = t("region").sparkSession.createDataFrame(asked, "query_id int, fields array<string>")
    boost = H.field_boost(F.col("chunk_type"), F.col("field_name"), F.col("fields"))
    return document_chunks(t).join(F.broadcast(asked), F.lit(True)).select("query_id", "chunk_id", boost.alias("boost"))


@query("record_seeds", f"""
WITH {CHUNKS_SQL}, a AS (SELECT * FROM (VALUES (1, ['src2', 'src0'], ['contact_policy']), (2, ['src5'], ['recent_activity', 'record_profile']), (3, ['nowhere'], ['regulatory'])) v(query_id, matched, preferred)),
m AS (SELECT query_id, unnest(matched) AS record_id, unnest(range(1, len(matched) + 1)) AS nth, preferred FROM a),
r AS (SELECT query_id, chunk_id, record_id, nth, row_number() OVER (PARTITION BY query_id, record_id ORDER BY list_position(preferred || ['record_profile', 'regulatory', 'contact_policy', 'recent_activity', 'field_evidence'], chunk_type), chunk_id) AS k FROM c JOIN m USING (record_id) QUALIFY k <= 4)
SELECT query_id, chunk_id, record_id, row_number() OVER (PARTITION BY query_id ORDER BY nth, k)::BIGINT AS seed_rank FROM r""")
def record_seeds(t):
    """The first four chunks of each matched record by type."""
    asked = [(1, ["src2", "src0"], ["contact_policy"]), (2, ["src5"], ["recent_activity", "record_profile"]), (3, ["nowhere"], ["regulatory"])]
    return H.record_seeds(document_chunks(t), t("region").sparkSession.createDataFrame(asked, "query_id int, matched array<string>, preferred array<string>"))


@query("listing_seeds", f"""
WITH {CHUNKS_SQL}, {_WANTED}, f AS (SELECT query_id, record_id, min(chunk_id) AS chunk_id FROM c, q WHERE (chunk_type IN ('record_profile', 'regulatory') OR chunk_type = 'field_evidence' AND want_linkedin) AND {_CHUNK_MEETS} GROUP BY ALL)
SELECT query_id, chunk_id, record_id, row_number() OVER (PARTITION BY query_id ORDER BY chunk_id)::BIGINT AS seed_rank FROM f QUALIFY seed_rank <= 50""")
def listing_seeds(t):
    """The first chunk of each record that meets a listing's filters, 50 records at most."""
    return H.listing_seeds(document_chunks(t), _wanted(t), _meets(H.chunk_linkedin(F.col("field_name"), F.col("field_value_text"))))


@query("hit_urls", """
WITH p AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, length(url) AS n FROM pages)
SELECT page_id, CASE n % 4 WHEN 0 THEN 2 WHEN 3 THEN 0 ELSE 1 END::BIGINT AS n_urls, CASE n % 4 WHEN 0 THEN 'https://a.example/x' WHEN 1 THEN '[not a list' WHEN 2 THEN url END AS last_url FROM p""")
def hit_urls(t):
    """A hit's list of URLs: JSON, broken JSON, a bare URL, blank, by the length of a page's URL."""
    u, n = F.col("url"), F.length("url") % 4
    cell = F.when(n == 0, F.concat(F.lit('["'), u, F.lit('", "https://a.example/x"]'))).when(n == 1, F.lit("[not a list")).when(n == 2, u).otherwise(F.lit(" "))
    found = t("pages").select("page_id", H.decoded_urls(cell).alias("urls"))
    return found.select("page_id", F.size("urls").cast("bigint").alias("n_urls"), F.try_element_at("urls", F.lit(-1)).alias("last_url"))


@query("registered_filter_kept", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN NULL ELSE o_totalprice > 1000 END AS sec_registered FROM orders""")
def registered_filter_kept(t):
    """A matched record drops the filter for single-record intents only."""
    kinds = {"1-URGENT": "entity_lookup", "2-HIGH": "contact_lookup", "3-MEDIUM": "regulatory", "4-NOT SPECIFIED": "comparison", "5-LOW": "recent_activity"}
    kind = F.lit("filtered_listing")
    for priority, name in kinds.items():
        kind = F.when(F.col("o_orderpriority") == priority, F.lit(name)).otherwise(kind)
    matched = (F.col("o_orderstatus") == "F").cast("int")
    return t("orders").select("o_orderkey", I.kept_registered_filter(kind, matched, F.col("o_totalprice") > 1000).alias("sec_registered"))


_ROLES = (
    ("Founder & CEO", 1), ("Co-Founder", 1), ("Chairwoman", 999), ("Chair", 2), ("Vice President", 3), ("Chief of Staff", 4), ("CIO", 4), ("Managing Director", 5), ("Senior Partner", 6), ("Partner", 7),
    ("Principal", 8), ("Senior Director", 9), ("Director", 11), ("Head of Research", 12), ("Trustee", 13), ("Senior Advisor", 14), ("Analyst", 15), ("Gardener", 999), ("", 999),
)


@query("role_seniority", "SELECT p_partkey, role, rank::INTEGER AS rank FROM part JOIN (VALUES " + ", ".join(f"({i}, '{r}', {k})" for i, (r, k) in enumerate(_ROLES)) + f") v(i, role, rank) ON i = p_size % {len(_ROLES)}")
def role_seniority(t):
    """The seniority of roles, dealt to parts by size; the expected ranks of the SQL are stated role by role."""
    roles = F.array(*(F.lit(r) for r, _ in _ROLES))
    rows = t("part").select("p_partkey", F.element_at(roles, F.col("p_size") % len(_ROLES) + 1).alias("role"))
    return rows.select("p_partkey", "role", S.seniority(F.col("role")).alias("rank"))


@query("evaluation_scores", """
WITH e AS (SELECT c_custkey, c_mktsegment AS s, c_acctbal < 0 AS due, c_acctbal < 1000 AS abst, c_nationkey AS n FROM customer)
SELECT c_custkey, CASE WHEN abst OR n < 20 AND n <> 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS citation, CASE WHEN s IN ('BUILDING', 'MACHINERY') THEN CASE WHEN n < 5 THEN n >= 3 ELSE n % 2 = 0 END::INTEGER::DOUBLE END AS entity,
  CASE WHEN s = 'AUTOMOBILE' THEN (CASE WHEN due THEN abst ELSE NOT abst AND (n < 5 OR n % 2 = 0) END)::INTEGER::DOUBLE END AS listing, CASE WHEN due AND n < 5 THEN (abst AND n <> 2)::INTEGER::DOUBLE END AS control,
  CASE WHEN NOT due OR n % 3 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS honesty FROM e""")
def evaluation_scores(t):
    """Citation, entity, listing, negative-control and honesty scores of one question a customer, put together from its columns."""
    n, s, b = F.col("c_nationkey"), F.col("c_mktsegment"), F.col("c_acctbal")
    due, abstained = b < 0, b < 1000
    intent = F.when(s.isin("BUILDING", "MACHINERY"), F.lit("contact_lookup")).when(s == "AUTOMOBILE", F.lit("filtered_listing")).otherwise(F.lit("comparison"))
    none = F.array().cast("array<string>")
    gold = F.when(n < 5, none).otherwise(F.array(F.lit("r1"), F.lit("r2")))
    matched = F.when(n < 3, F.array(F.lit("r9"))).when((n >= 5) & (n % 2 == 0), F.array(F.lit("r2"))).when(n < 5, none).otherwise(F.array(F.lit("r8")))
    ranked = F.when(n % 2 == 0, F.array(*map(F.lit, ("r9", "r9", "r8", "r7", "r6", "r1")))).otherwise(F.array(*map(F.lit, ("r9", "r8", "r7", "r6", "r5", "r1"))))
    cited = F.when(n == 0, none).when(n >= 20, F.array(F.lit("x"), F.lit("z"))).otherwise(F.array(F.lit("x")))
    body = F.when(n % 3 == 0, F.lit("It is Not Evidenced here")).otherwise(F.lit("It is there"))
    return t("customer").select(
        "c_custkey", H.citation_score(abstained, cited, F.array(F.lit("x"), F.lit("y"))).alias("citation"), H.entity_score(intent, gold, matched).alias("entity"),
        H.listing_score(intent, intent, due, abstained, gold, ranked).alias("listing"), H.control_score(due, gold, abstained, n != 2).alias("control"), H.honesty_score(due, body).alias("honesty"),
    )
