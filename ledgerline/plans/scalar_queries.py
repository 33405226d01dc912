"""Queries over URL, text, name, number and date expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from .registry import query

_HOST = r"regexp_replace(lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"


def host_sql(u: str) -> str:
    return _HOST.replace("{u}", u)


@query("url_domain", f"""
SELECT page_id, {host_sql('url')} AS domain, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS canonical_url FROM pages""")
def url_domain(t):
    return t("pages").select("page_id", U.domain(F.col("url")).alias("domain"), U.canonical(F.col("url")).alias("canonical_url"))


@query("url_variants", r"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 1 THEN regexp_replace(url, '^https?://', '') ELSE url END AS u FROM pages),
f AS (SELECT *, CASE WHEN contains(u, '://') THEN u ELSE 'http://' || u END AS full_url FROM p),
h AS (SELECT *, regexp_extract(full_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
  regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS strict_host FROM f)
SELECT page_id, regexp_replace(lower(strict_host), '^www\.', '') AS strict_domain, regexp_replace(lower(host), '^www\.', '') AS any_domain,
  CASE WHEN contains(u, '.') THEN regexp_replace(lower(host), '^www\.', '') ELSE '' END AS dotted_domain,
  regexp_replace(host, '^www\.', '') AS cased_domain, lower(host) AS www_domain,
  regexp_replace(regexp_replace(regexp_replace(lower(host), '^www\.', ''), '\.[^.]*$', ''), '[^a-z0-9]', '', 'g') AS domain_base,
  CASE WHEN contains(u, '://') THEN lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://)', 1)) || regexp_replace(lower(strict_host), '^www\.', '')
    || CASE WHEN regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') = '' THEN '/'
       ELSE regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') END
    || regexp_extract(u, '^[^?#]*([?#].*)$', 1)
  ELSE regexp_replace(replace(u, '\', '/'), '^[./]+', '') END AS audit_url
FROM h""")
def url_variants(t):
    u = F.when(F.col("page_id") % 2 == 1, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    return t("pages").select(
        "page_id", U.domain(u).alias("strict_domain"), U.domain(u, "any").alias("any_domain"), U.domain(u, "dotted").alias("dotted_domain"),
        U.domain(u, "any", lower=False).alias("cased_domain"), U.domain(u, "any", keep_www=True).alias("www_domain"),
        U.domain_base(u).alias("domain_base"), U.audit_form(u).alias("audit_url"),
    )


_SOURCED = (
    ("https://adviserinfo.sec.gov/a", "regulator"), ("https://www.businesswire.com/b", "press_release"), ("https://find-and-update.company-information.service.gov.uk/c", "registry"),
    ("https://example.org/d.PDF", "official_disclosure"), ("https://www.example.org/", "official_site"), ("https://elsewhere.test/e.pdf", "secondary_source"),
)
_SITE = "https://example.org/"


def _with_cases(t, cases):
    """All pages, and literal URLs under page_ids below 0."""
    pages = t("pages").select("page_id", "url")
    return pages.unionByName(pages.sparkSession.createDataFrame([(-1 - i, c[0]) for i, c in enumerate(cases)], "page_id long, url string"))


def _stated(cases) -> str:
    return ", ".join(f"({-1 - i}, '{c[1]}')" for i, c in enumerate(cases))


@query("url_source_type", f"""
WITH k AS (SELECT page_id, CASE WHEN {host_sql('url')} = 'example.org' THEN CASE WHEN ends_with(lower(url), '.pdf') THEN 'official_disclosure' ELSE 'official_site' END ELSE 'secondary_source' END AS source_type FROM pages
  UNION ALL SELECT * FROM (VALUES {_stated(_SOURCED)}))
SELECT page_id, source_type, CASE source_type WHEN 'press_release' THEN 'secondary' WHEN 'secondary_source' THEN 'tertiary' ELSE 'primary' END AS source_rank FROM k""")
def url_source_type(t):
    """Every page against one site, and literal URLs whose kinds the SQL states one by one."""
    kind = _with_cases(t, _SOURCED).select("page_id", U.source_type(F.col("url"), F.lit(_SITE)).alias("source_type"))
    return kind.select("page_id", "source_type", U.source_rank(F.col("source_type")).alias("source_rank"))


_CLAIMED = (
    ("reports/page", "methodology"), ("data/x.csv", "local_evidence_artifact"), ("", "unknown"), ("https://maps.google.com/a", "google_places"), ("https://www.linkedin.com/company/a", "linkedin"),
    ("https://youtu.be/b", "social_platform"), ("https://reports.adviserinfo.sec.gov/c", "regulator"), ("https://www.example.org/x", "official_site"),
)


@query("url_claim_type", f"""
SELECT page_id, CASE WHEN {host_sql('url')} = 'example.org' THEN 'official_site' ELSE 'secondary_source' END AS claim_source_type FROM pages UNION ALL SELECT * FROM (VALUES {_stated(_CLAIMED)})""")
def url_claim_type(t):
    """Every page against one site, and literal URLs whose kinds the SQL states one by one."""
    return _with_cases(t, _CLAIMED).select("page_id", U.claim_source_type(F.col("url"), F.lit(_SITE)).alias("claim_source_type"))


@query("url_quality_label", """
WITH c AS (SELECT page_id, page_id % 11 <> 0 AS ok, CASE page_id % 7 WHEN 0 THEN '200' WHEN 1 THEN '204.0' WHEN 2 THEN '301' WHEN 3 THEN '404' WHEN 4 THEN '500' WHEN 5 THEN NULL ELSE 'none' END AS code FROM pages),
n AS (SELECT page_id, ok, CAST(try_cast(code AS DOUBLE) AS INTEGER) AS n FROM c)
SELECT page_id, CASE WHEN NOT ok THEN 'Failed' WHEN n IS NULL THEN 'Unknown' WHEN n = 200 THEN 'Highest' WHEN n BETWEEN 201 AND 299 THEN 'High'
  WHEN n BETWEEN 300 AND 399 THEN 'Medium' WHEN n BETWEEN 400 AND 499 THEN 'Low' ELSE 'Failed' END AS url_quality FROM n""")
def url_quality_label(t):
    code = F.element_at(F.array(F.lit("200"), F.lit("204.0"), F.lit("301"), F.lit("404"), F.lit("500"), F.lit(None).cast("string"), F.lit("none")), (F.col("page_id") % 7 + 1).cast("int"))
    return t("pages").select("page_id", U.quality(F.col("page_id") % 11 != 0, code).alias("url_quality"))


@query("url_list_parse", """
WITH c AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN list_distinct([url, 'https://a.org/x']) WHEN 1 THEN list_distinct([url, 'https://twitter.com/y']) ELSE [url] END AS urls FROM pages)
SELECT page_id, len(urls)::BIGINT AS n_urls, url AS first_url, CASE page_id % 3 WHEN 1 THEN 'https://twitter.com/y' END AS first_social FROM c JOIN pages USING (page_id)""")
def url_list_parse(t):
    cell = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("['"), F.col("url"), F.lit("', 'https://a.org/x', '"), F.col("url"), F.lit("']"))).when(F.col("page_id") % 3 == 1, F.concat(F.col("url"), F.lit(" ; https://twitter.com/y;"))).otherwise(F.col("url"))
    parsed = t("pages").select("page_id", U.url_list(cell).alias("urls"))
    return parsed.select("page_id", F.size("urls").cast("bigint").alias("n_urls"), F.try_element_at("urls", F.lit(1)).alias("first_url"), U.first_on(F.col("urls"), ("twitter.com",)).alias("first_social"))


@query("url_template", """
SELECT page_id, 'https://reports.adviserinfo.sec.gov/reports/ADV/' || page_id || '/PDF/' || page_id || '.pdf' AS brochure_url, 'https://adviserinfo.sec.gov/firm/summary/' || page_id AS summary_url FROM pages""")
def url_template(t):
    key = F.col("page_id").cast("string")
    return t("pages").select("page_id", U.brochure_url(key).alias("brochure_url"), U.summary_url(key).alias("summary_url"))


_TOKENS = "list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda w: w <> '')"
_STOPS = "['" + "','".join(X.NAME_STOPWORDS) + "']"


@query("name_tokens_match", f"""
WITH n AS (SELECT p_partkey, {_TOKENS} AS w, list_filter(string_split_regex(lower(p_type), '[^a-z0-9]+'), lambda w: w <> '') AS v FROM part),
k AS (SELECT p_partkey, w, array_to_string(list_filter(w, lambda x: NOT list_contains(['ag','co','company','corp','corporation','inc','limited','llc','lp','ltd','plc','pte'], x)), ' ') AS entity_name,
  list_filter(list_distinct(list_filter(w, lambda x: NOT list_contains({_STOPS}, x))), lambda x: length(x) > 2) AS a, list_filter(list_distinct(list_filter(v, lambda x: NOT list_contains({_STOPS}, x))), lambda x: length(x) > 2) AS b FROM n)
SELECT p_partkey, entity_name, len(a)::BIGINT AS n_tokens, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0 END, 6) AS jaccard,
  len(list_filter(a, lambda x: NOT contains(entity_name, x))) = 0 AND len(a) > 0 AS all_in_name FROM k""")
def name_tokens_match(t):
    named = t("part").select("p_partkey", X.entity_name(F.col("p_name")).alias("entity_name"), X.informative_tokens(F.col("p_name")).alias("a"), X.informative_tokens(F.col("p_type")).alias("b"))
    every = (F.size("a") > 0) & F.forall("a", lambda w: F.col("entity_name").contains(w))
    return named.select("p_partkey", "entity_name", F.size("a").cast("bigint").alias("n_tokens"), F.round(X.token_jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"), every.alias("all_in_name"))


@query("entity_normalise_overlap", r"""
WITH n AS (SELECT p_partkey, array_to_string(list_filter(string_split_regex(lower(p_name || CASE WHEN p_partkey % 2 = 0 THEN ' LLC' ELSE ', Inc.' END), '[^a-z0-9]+'), lambda w: w <> '' AND NOT list_contains(['ag','co','company','corp','corporation','inc','limited','llc','lp','ltd','plc','pte'], w)), ' ') AS entity_name FROM part),
b AS (SELECT DISTINCT array_to_string(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda w: w <> ''), ' ') AS entity_name FROM part WHERE p_brand = 'Brand#11')
SELECT p_partkey, entity_name FROM n SEMI JOIN b USING (entity_name)""")
def entity_normalise_overlap(t):
    """Names whose normal form is among the normal forms of a blocked list."""
    part = t("part")
    name = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, F.lit(" LLC")).otherwise(F.lit(", Inc.")))
    blocked = part.where("p_brand = 'Brand#11'").select(X.entity_name(F.col("p_name")).alias("entity_name")).distinct()
    return part.select("p_partkey", X.entity_name(name).alias("entity_name")).join(blocked, "entity_name", "left_semi").select("p_partkey", "entity_name")


@query("name_split_location", r"""
WITH c AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Ada B. ' || substr(c_name, 1, 8) WHEN 1 THEN 'Ada ' || substr(c_name, 1, 8) || ' Jr.' WHEN 2 THEN 'Solo' ELSE 'Stone family' END AS person, n_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Ada B.' WHEN 1 THEN 'Ada' ELSE '' END AS first_name, CASE WHEN c_custkey % 4 < 2 THEN split_part(person, ' ', CASE c_custkey % 4 WHEN 0 THEN 3 ELSE 2 END) ELSE '' END AS last_name,
  concat_ws(', ', n_name, CASE WHEN c_custkey % 3 > 0 THEN r_name END) AS location FROM c""")
def name_split_location(t):
    base = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    short = F.substring("c_name", 1, 8)
    person = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("Ada B. "), short)).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("Ada "), short, F.lit(" Jr."))).when(F.col("c_custkey") % 4 == 2, F.lit("Solo")).otherwise(F.lit("Stone family"))
    first, last = X.person_name(person)
    region = F.when(F.col("c_custkey") % 3 == 0, F.lit("nan")).otherwise(F.col("r_name"))
    return base.select("c_custkey", first.alias("first_name"), last.alias("last_name"), X.joined(F.col("n_name"), F.lit(" "), region).alias("location"))


@query("number_text", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE p_size::VARCHAR END AS size_text, p_size::VARCHAR AS stripped, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 2 END::BIGINT AS n_variants,
  round_even(p_retailprice / 7, 1) AS rating, array_to_string(['a', 'b', p_brand], '; ') AS specialties, 3::BIGINT AS n_parts FROM part""")
def number_text(t):
    text = F.when(F.col("p_partkey") % 5 == 0, F.lit("n/a")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".0")))
    plain = F.concat(F.col("p_size").cast("string"), F.lit(".0"))
    literal = F.concat(F.lit("['a', 'b', '"), F.col("p_brand"), F.lit("']"))
    return t("part").select(
        "p_partkey", X.integer_text(text).alias("size_text"), X.without_zero_decimal(plain).alias("stripped"), F.size(X.identifier_variants(text)).cast("bigint").alias("n_variants"),
        X.rating((F.col("p_retailprice") / 7).cast("string")).alias("rating"), F.array_join(U.url_list(literal), "; ").alias("specialties"), F.size(X.parts(F.lit(" a; b ;;c "))).cast("bigint").alias("n_parts"),
    )


@query("phone_email_extract", r"""
WITH c AS (SELECT doc_id, regexp_extract_all(text, '[\w.+-]+@[\w-]+\.[\w.-]+') AS emails, regexp_extract_all(text, '\+?[0-9][0-9() .-]{6,}[0-9]') AS phones FROM documents)
SELECT doc_id, len(emails)::BIGINT AS n_emails, lower(emails[1]) AS first_email, list_filter(phones, lambda p: length(regexp_replace(p, '[^0-9]', '', 'g')) >= 7)[1] AS first_phone,
  right(regexp_replace(coalesce(phones[1], ''), '[^0-9]', '', 'g'), 10) AS last_digits FROM c""")
def phone_email_extract(t):
    found = t("documents").select("doc_id", F.regexp_extract_all("text", F.lit(r"[\w.+-]+@[\w-]+\.[\w.-]+"), F.lit(0)).alias("emails"), F.regexp_extract_all("text", F.lit(r"\+?[0-9][0-9() .-]{6,}[0-9]"), F.lit(0)).alias("phones"))
    one = F.lit(1)
    return found.select("doc_id", F.size("emails").cast("bigint").alias("n_emails"), F.lower(F.try_element_at("emails", one)).alias("first_email"), X.first_phone(F.col("phones")).alias("first_phone"), X.last_digits(F.try_element_at("phones", one)).alias("last_digits"))


@query("mailbox_choice", """
WITH e AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN ['joe@x.org', 'Info@x.org'] WHEN 1 THEN ['info@y.org', 'irene@x.org'] WHEN 2 THEN ['joe@x.org'] ELSE ['bad', 'team@y.org'] END AS emails FROM customer)
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'info@x.org' WHEN 1 THEN 'irene@x.org' WHEN 3 THEN 'team@y.org' END AS email FROM e""")
def mailbox_choice(t):
    arrays = [F.array(*map(F.lit, a)) for a in (["joe@x.org", "Info@x.org"], ["info@y.org", "irene@x.org"], ["joe@x.org"], ["bad", "team@y.org"])]
    k = F.col("c_custkey") % 4
    emails = F.when(k == 0, arrays[0]).when(k == 1, arrays[1]).when(k == 2, arrays[2]).otherwise(arrays[3])
    return t("customer").select("c_custkey", X.corporate_email(emails, F.lit("x.org")).alias("email"))


@query("recency_bucket", """
WITH d AS (SELECT o_orderkey, greatest(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02'), 0) AS n FROM orders)
SELECT o_orderkey, n::BIGINT AS age_days, CASE WHEN n <= 90 THEN 'fresh' WHEN n <= 365 THEN 'moderate' ELSE 'stale' END AS recency FROM d""")
def recency_bucket(t):
    days = X.age_days(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm"), "1998-08-02")
    return t("orders").select("o_orderkey", days.cast("bigint").alias("age_days"), X.recency_label(days).alias("recency"))


@query("activity_text", """
SELECT event_id, event_type || ' by ' || user_id || ' (outlet' || user_id % 5 || ', ' || strftime(ts, '%Y-%m-%d') || ') — https://e.org/' || event_id AS activity,
  event_type || ' by ' || user_id AS title, 'outlet' || user_id % 5 AS outlet, strftime(ts, '%Y-%m-%d') AS date, 'https://e.org/' || event_id AS url, event_id || '_augmented_event_type' AS claim_id FROM events""")
def activity_text(t):
    user = F.col("user_id").cast("string")
    text = X.activity_text(F.concat("event_type", F.lit(" by "), user), F.concat(F.lit("outlet"), (F.col("user_id") % 5).cast("string")), F.date_format("ts", "yyyy-MM-dd"), F.concat(F.lit("https://e.org/"), F.col("event_id").cast("string")))
    made = t("events").select("event_id", text.alias("activity"))
    return made.select("event_id", "activity", *(c.alias(k) for k, c in X.parse_activity(F.col("activity")).items()), X.claim_id(F.col("event_id"), F.lit("event-type")).alias("claim_id"))


@query("regex_ladder", r"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN 'Regulatory Assets Under Management ' || text || ' Total: (c) $ 1,234,' || (doc_id % 900 + 100) ELSE text || ' Asset-based fees and hourly charges' END AS body, doc_id % 7 = 0 AS missing FROM documents)
SELECT doc_id, CASE WHEN missing THEN 'no_form_adv_url' WHEN body = '' THEN 'text_extract_failed' WHEN doc_id % 5 = 1 THEN 'parsed_with_aum' ELSE 'parsed_no_reliable_aum_pattern' END AS status,
  CASE WHEN doc_id % 5 = 1 THEN '1234' || (doc_id % 900 + 100) ELSE '' END AS aum, CASE WHEN doc_id % 5 > 1 THEN 'asset_based_fees; hourly_fees' ELSE '' END AS fees FROM d""")
def regex_ladder(t):
    k = F.col("doc_id") % 5
    body = F.when(k == 0, F.lit("")).when(k == 1, F.concat(F.lit("Regulatory Assets Under Management "), F.col("text"), F.lit(" Total: (c) $ 1,234,"), (F.col("doc_id") % 900 + 100).cast("string"))).otherwise(F.concat("text", F.lit(" Asset-based fees and hourly charges")))
    read = t("documents").select("doc_id", body.alias("body")).select("doc_id", "body", X.regulatory_assets(F.col("body")).alias("aum"))
    status = F.when(F.col("doc_id") % 7 == 0, F.lit("no_form_adv_url")).when(F.col("body") == "", F.lit("text_extract_failed")).when(F.col("aum") != "", F.lit("parsed_with_aum")).otherwise(F.lit("parsed_no_reliable_aum_pattern"))
    return read.select("doc_id", status.alias("status"), "aum", X.fee_labels(F.col("body")).alias("fees"))


SENTENCES_SQL = r"string_split(regexp_replace(regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([.!?]) ([A-Z])', '\1' || chr(1) || '\2', 'g'), '([.!?]) ([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1))"


@query("quote_rank", rf"""
WITH s AS (SELECT doc_id, unnest({SENTENCES_SQL}) AS s, generate_subscripts({SENTENCES_SQL}, 1) AS pos FROM documents),
q AS (SELECT doc_id, pos, s, len(string_split(s, ' ')) AS n_words, CASE WHEN regexp_matches(lower(s), '(^| )(and|und|et|y)( |$)') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(lower(s), '(^| )(the|die|la)( |$)') THEN 1 ELSE 0 END AS score FROM s),
d AS (SELECT * FROM q WHERE n_words BETWEEN 5 AND 60 AND score > 0 QUALIFY row_number() OVER (PARTITION BY doc_id, substr(lower(s), 1, 80) ORDER BY score DESC, length(s), pos) = 1)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, length(s), pos)::BIGINT AS quote_rank, score::BIGINT AS score,
  CASE WHEN n_words > 25 THEN array_to_string(string_split(s, ' ')[1:25], ' ') || '…' ELSE s END AS quote FROM d QUALIFY quote_rank <= 2""")
def quote_rank(t):
    """The two best sentences of 5 to 60 words, cut to 25, no two alike in their first 80 characters."""
    from ..operators.ranking import ranked_quotes

    return ranked_quotes(t("documents"), "doc_id", r"(^| )(and|und|et|y)( |$)", r"(^| )(the|die|la)( |$)")


@query("evidence_snippet", rf"""
WITH d AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat, list_filter({SENTENCES_SQL}, lambda s: regexp_matches(lower(s), '(tion|heit|ment)'))[1] AS hit FROM documents)
SELECT doc_id, substr(coalesce(hit, flat), 1, 600) AS snippet FROM d""")
def evidence_snippet(t):
    return t("documents").select("doc_id", X.snippet(F.col("text"), "(tion|heit|ment)").alias("snippet"))


@query("sensitive_scan", r"""
SELECT doc_id, len(list_distinct(list_concat(list_concat(regexp_extract_all(text, '[\w.+-]+@[\w-]+\.[\w.-]+'), regexp_extract_all(text, '\+?[0-9][0-9() .-]{6,}[0-9]')), regexp_extract_all(text, 'https?://[^\s)]+'))))::BIGINT AS n_sensitive FROM documents""")
def sensitive_scan(t):
    return t("documents").select("doc_id", F.size(X.sensitive_tokens(F.col("text"))).cast("bigint").alias("n_sensitive"))
