"""Queries over the columns of an entity record: records are made of customers, a cell each by number, blank for every third."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import urls as L
from ..operators import audits as A
from ..operators import evidence as E
from ..operators import record_chunks as C
from ..operators import records as Q
from ..sources import upsert as U
from ..sources import versions as V
from .registry import query

#: All columns of a record, numbered by their place; the cell of field i of customer k is blank if (k + i) % 3 = 0.
FIELDS = (
    "primary_email primary_email_smtp_verified primary_email_evidence_url primary_email_confidence primary_phone primary_phone_evidence_url primary_phone_confidence corporate_linkedin_url corporate_linkedin_evidence_url "
    "corporate_linkedin_confidence linkedin_employee_count linkedin_follower_count linkedin_specialties linkedin_company_size_band linkedin_industry linkedin_founded_year linkedin_headquarters_full linkedin_company_evidence_url "
    "linkedin_company_confidence twitter_url instagram_url facebook_url youtube_url tiktok_url social_media_evidence_url social_media_confidence google_places_phone google_places_reviews_count google_places_rating "
    "google_places_category google_maps_url primary_phone_corroborated_by_places primary_phone_conflict_with_places primary_phone_canonical_source google_places_evidence_url google_places_confidence street_address "
    "street_address_evidence_url street_address_confidence sec_crd_number sec_file_number sec_registration_status sec_firm_name_iapd sec_firm_other_names sec_branches_count form_adv_brochure_url sec_summary_url sec_address_city "
    "sec_address_state sec_address_country sec_near_match_review_status sec_near_match_notes sec_evidence_url sec_confidence sec_aum_usd sec_fee_structure sec_listed_officers sec_business_address sec_form_adv_parse_status "
    "sec_form_adv_evidence_path principal_1_name principal_1_role principal_1_source_url principal_1_confidence principal_1_linkedin_url principal_1_linkedin_confidence principal_2_name principal_2_role principal_2_source_url "
    "principal_2_confidence principal_2_linkedin_url principal_2_linkedin_confidence principal_3_name principal_3_role principal_3_source_url principal_3_confidence principal_3_linkedin_url principal_3_linkedin_confidence "
    "recent_activity recent_activity_date recent_activity_outlet recent_activity_url recent_activity_type recent_activity_age_days recent_activity_recency_label recent_activity_confidence contact_first_name contact_last_name "
    "contact_full_name contact_location data_completion_score_text data_completion_score_visual secondary_email_validation_code email_code_explanation_secondary email_quality_assessment_secondary source_content_review_status "
    "source_content_review_notes family_office_name family_office_type description investment_thesis investing_sectors aum_text city state_region country principal_name principal_title source_urls sec_registered "
    "principal_linkedin_url contact_secondary_email contact_secondary_phone source_notes confidence uncertainty_notes"
).split()
_NUMBER = {f: i for i, f in enumerate(FIELDS)}


def _records(t):
    k = F.col("c_custkey")
    given = {"sec_registered": F.when(k % 2 == 0, "False").otherwise("True"), "source_urls": F.concat(F.lit("['https://s.test/"), k, F.lit("', 'https://x.test']"))}
    cells = [F.when((k + i) % 3 == 0, F.lit("")).otherwise(given.get(f, F.concat(F.lit(f"{f}:"), k))).alias(f) for f, i in _NUMBER.items()]
    return t("customer").select(k.alias("record_id"), F.lit("https://firm.test").alias("website_url"), *cells)


_CELLS = "cells AS MATERIALIZED (SELECT c_custkey AS k, f, CASE WHEN (c_custkey + i) % 3 = 0 THEN '' WHEN f = 'sec_registered' THEN CASE WHEN c_custkey % 2 = 0 THEN 'False' ELSE 'True' END WHEN f = 'source_urls' THEN 'https://s.test/' || c_custkey ELSE f || ':' || c_custkey END AS v FROM customer, (SELECT unnest([{names}]) AS f, generate_subscripts([{names}], 1) - 1 AS i))".replace("{names}", ", ".join(f"'{f}'" for f in FIELDS))


@query("seed_claims", f"""
WITH {_CELLS}, s AS (SELECT k, v FROM cells WHERE f = 'source_urls')
SELECT cells.k || '_' || f AS claim_id, cells.k AS record_id, f AS field_name, cells.v AS claim_value, s.v AS source_url, 'secondary_source' AS source_type,
  CASE WHEN f IN ('family_office_name', 'city', 'state_region', 'country', 'principal_name', 'principal_title') THEN 'fact' ELSE 'normalized_summary' END AS claim_type
FROM cells JOIN s USING (k) WHERE cells.v <> '' AND f IN ('family_office_name', 'family_office_type', 'description', 'investment_thesis', 'investing_sectors', 'aum_text', 'city', 'state_region', 'country', 'principal_name', 'principal_title', 'recent_activity')
UNION ALL SELECT k || '_website_url', k, 'website_url', 'https://firm.test', v, 'secondary_source', 'fact' FROM s""")
def seed_claims(t):
    """The thirteen seed fields of each record, as claims on its first source."""
    return Q.seed_claims(_records(t), "record_id")


@query("augmented_claims", f"""
WITH {_CELLS}, g AS (SELECT * FROM (VALUES ('^primary_email(_smtp_verified)?$', 'primary_email_evidence_url', 'primary_email_confidence', 'promoted_contact'), ('^primary_phone$', 'primary_phone_evidence_url', 'primary_phone_confidence', 'promoted_contact'),
  ('^corporate_linkedin_url$', 'corporate_linkedin_evidence_url', 'corporate_linkedin_confidence', 'promoted_linkedin_company'), ('^linkedin_(employee_count|follower_count|specialties|company_size_band|industry|founded_year|headquarters_full)$', 'linkedin_company_evidence_url', 'linkedin_company_confidence', 'linkedin_company_enrichment'),
  ('^(twitter|instagram|facebook|youtube|tiktok)_url$', 'social_media_evidence_url', 'social_media_confidence', 'official_site_social_link'), ('^(google_places_(phone|reviews_count|rating|category)|google_maps_url|primary_phone_(corroborated_by|conflict_with)_places|primary_phone_canonical_source)$', 'google_places_evidence_url', 'google_places_confidence', 'google_places_corroboration'),
  ('^street_address$', 'street_address_evidence_url', 'street_address_confidence', 'address_corroboration'), ('^(sec_(crd_number|file_number|registration_status|firm_name_iapd|firm_other_names|branches_count|address_city|address_state|address_country|near_match_review_status|near_match_notes)|form_adv_brochure_url|sec_summary_url)$', 'sec_evidence_url', 'sec_confidence', 'regulatory_identifier'),
  ('^sec_(aum_usd|fee_structure|listed_officers|business_address|form_adv_parse_status)$', 'sec_form_adv_evidence_path', 'sec_confidence', 'form_adv_pdf_parse'), ('^principal_1_(name|role)$', 'principal_1_source_url', 'principal_1_confidence', 'official_team_roster'), ('^principal_2_(name|role)$', 'principal_2_source_url', 'principal_2_confidence', 'official_team_roster'),
  ('^principal_3_(name|role)$', 'principal_3_source_url', 'principal_3_confidence', 'official_team_roster'), ('^principal_1_linkedin_url$', 'principal_1_linkedin_url', 'principal_1_linkedin_confidence', 'official_principal_linkedin'), ('^principal_2_linkedin_url$', 'principal_2_linkedin_url', 'principal_2_linkedin_confidence', 'official_principal_linkedin'),
  ('^principal_3_linkedin_url$', 'principal_3_linkedin_url', 'principal_3_linkedin_confidence', 'official_principal_linkedin')) v(form, e, c, kind)),
one AS (SELECT k, max(v) FILTER (WHERE f = 'source_urls') AS src, max(v) FILTER (WHERE f = 'recent_activity') AS act, max(v) FILTER (WHERE f = 'recent_activity_url') AS aurl, max(v) FILTER (WHERE f = 'recent_activity_confidence') AS aconf, max(v) FILTER (WHERE f = 'sec_evidence_url') AS surl, max(v) FILTER (WHERE f = 'sec_confidence') AS sconf FROM cells GROUP BY k),
a AS (
  SELECT x.k, x.f, x.v, e.v AS url, c.v AS conf, kind FROM cells x JOIN g ON regexp_matches(x.f, form) JOIN cells e ON e.k = x.k AND e.f = g.e JOIN cells c ON c.k = x.k AND c.f = g.c WHERE e.v <> '' AND c.v <> ''
  UNION ALL SELECT x.k, f, v, CASE v WHEN 'False' THEN 'data/registry/' || x.k || '.json' ELSE surl END, CASE v WHEN 'False' THEN 'iapd_no_match_above_threshold' ELSE sconf END, 'regulatory_registration_status' FROM cells x JOIN one USING (k) WHERE f = 'sec_registered' AND (v = 'False' OR surl <> '')
  UNION ALL SELECT x.k, f, v, CASE WHEN aurl <> '' THEN aurl ELSE src END, CASE WHEN aconf <> '' THEN aconf ELSE 'news_signal' END, 'recent_activity_signal' FROM cells x JOIN one USING (k) WHERE act <> '' AND f IN ('recent_activity', 'recent_activity_date', 'recent_activity_outlet', 'recent_activity_url', 'recent_activity_type', 'recent_activity_age_days', 'recent_activity_recency_label')
  UNION ALL SELECT x.k, f, v, 'reports/methodology_summary.md', aconf, 'no_recent_signal_status' FROM cells x JOIN one USING (k) WHERE act = '' AND f = 'recent_activity_type'
  UNION ALL SELECT x.k, f, v, CASE WHEN f LIKE 'data_completion%' OR f LIKE '%secondary%' OR src = '' THEN 'reports/methodology_summary.md' ELSE src END, 'derived_from_validated_record', 'derived_or_sample_parity' FROM cells x JOIN one USING (k)
    WHERE f IN ('contact_first_name', 'contact_last_name', 'contact_full_name', 'contact_location', 'data_completion_score_text', 'data_completion_score_visual', 'secondary_email_validation_code', 'email_code_explanation_secondary', 'email_quality_assessment_secondary', 'source_content_review_status', 'source_content_review_notes'))
SELECT k || '_augmented_' || f AS claim_id, k AS record_id, f AS field_name, v AS claim_value, url AS source_url, CASE WHEN url = '' THEN 'unknown' WHEN url LIKE 'reports/%' THEN 'methodology' WHEN url LIKE 'data/%' THEN 'local_evidence_artifact' ELSE 'secondary_source' END AS source_type, kind AS claim_type,
  conf AS confidence, CASE WHEN conf <> '' THEN 'verified' ELSE 'documented' END AS validation_status FROM a WHERE v <> ''""")
def augmented_claims(t):
    """Nine groups of promoted fields gated by evidence and confidence, registration, three principals, activity or its absence, derived fields."""
    return Q.augmented_claims(_records(t), "record_id", "data/registry")


@query("record_completion", f"""
WITH {_CELLS} SELECT k AS record_id, 3 + count(*) FILTER (WHERE v <> '' AND f IN ('family_office_name', 'description', 'investment_thesis', 'investing_sectors', 'corporate_linkedin_url', 'street_address', 'city', 'state_region', 'country', 'contact_first_name', 'contact_last_name', 'contact_full_name',
  'principal_title', 'contact_location', 'primary_email', 'primary_phone', 'secondary_email_validation_code', 'email_code_explanation_secondary', 'email_quality_assessment_secondary', 'principal_linkedin_url', 'contact_secondary_email', 'contact_secondary_phone'))::BIGINT AS completion FROM cells GROUP BY k""")
def record_completion(t):
    """Filled cells of the 31 columns that count; the records lack six of them."""
    rows = _records(t)
    return rows.select("record_id", Q.completion(rows).cast("bigint").alias("completion"))


@query("completion_summary", f"""
WITH {_CELLS}, c AS (SELECT k, 3 + count(*) FILTER (WHERE v <> '' AND f IN ('family_office_name', 'description', 'investment_thesis', 'investing_sectors', 'corporate_linkedin_url', 'street_address', 'city', 'state_region', 'country', 'contact_first_name', 'contact_last_name', 'contact_full_name',
  'principal_title', 'contact_location', 'primary_email', 'primary_phone', 'secondary_email_validation_code', 'email_code_explanation_secondary', 'email_quality_assessment_secondary', 'principal_linkedin_url', 'contact_secondary_email', 'contact_secondary_phone')) AS n FROM cells GROUP BY k)
SELECT min(n)::BIGINT AS lowest, median(n)::DOUBLE AS median, max(n)::BIGINT AS highest, count(*)::BIGINT AS n FROM c""")
def completion_summary(t):
    """Least, exact median and most of the completion scores; their counts, 32 at most, meet in one task."""
    rows = _records(t)
    n = rows.select(Q.completion(rows).cast("bigint").alias("n")).groupBy("n").agg(F.count("*").alias("times"))
    return n.agg(F.min("n").alias("lowest"), F.percentile("n", 0.5, F.col("times")).alias("median"), F.max("n").alias("highest"), F.sum("times").alias("n"))


_URLS = "CASE c_custkey % 4 WHEN 0 THEN ['https://a.test', 'https://b.test/x'] WHEN 1 THEN ['https://a.test'] WHEN 2 THEN ['https://a.test', 'https://www.swfinstitute.org/p'] ELSE ['https://a.test', 'https://b.test', 'https://c.test'] END"


@query("record_score", f"""
WITH r AS (SELECT c_custkey AS k, {_URLS} AS u, c_custkey % 3 > 0 AS site, c_custkey % 2 = 0 AS dns, c_custkey % 5 AS q, c_custkey % 7 > 0 AS kind, c_custkey % 11 > 0 AS thesis, c_custkey % 13 > 0 AS act, c_custkey % 6 > 0 AS who FROM customer),
s AS (SELECT *, len(u) AS n, len(u) - (k % 9 = 0)::INTEGER AS ok, k % 4 = 2 AS directory FROM r),
p AS (SELECT *, 16 + 8 * kind::INTEGER + 6 * thesis::INTEGER + 6 + CASE WHEN site THEN 12 WHEN dns THEN 4 ELSE 0 END + 12 * (n >= 2)::INTEGER + least(6 * ok, 18) + CASE q WHEN 0 THEN 10 WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END + 6 * who::INTEGER + 6 * act::INTEGER AS score FROM s)
SELECT k AS record_id, least(score, 100)::BIGINT AS score, CASE WHEN score >= 80 THEN 'high' WHEN score >= 60 THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN score >= 80 AND site AND n >= 2 AND ok >= 2 AND NOT directory THEN 'accepted' ELSE 'needs_review' END AS status, ok::BIGINT AS n_ok,
  coalesce(nullif(concat_ws('; ', CASE WHEN NOT kind THEN 'family office type is unclear' END, CASE WHEN NOT site AND dns THEN 'website request failed but DNS resolves' WHEN NOT site THEN 'website request failed and DNS did not resolve' END, CASE WHEN n < 2 THEN 'fewer than two source URLs' END,
    CASE WHEN q > 2 THEN 'evidence quality is unverified' END, CASE WHEN ok < 2 THEN 'fewer than two source URLs were reachable' END, CASE WHEN directory THEN 'source URLs include discovery-only directory sources' END), ''), 'passed configured validation checks') AS notes FROM p""")
def record_score(t):
    """The weights of a record's score, its confidence, notes and status."""
    k = F.col("c_custkey")
    text = lambda test: F.when(test, "x").otherwise(" ")
    urls = F.when(k % 4 == 0, F.array(F.lit("https://a.test"), F.lit("https://b.test/x"))).when(k % 4 == 1, F.array(F.lit("https://a.test"))).when(k % 4 == 2, F.array(F.lit("https://a.test"), F.lit("https://www.swfinstitute.org/p"))).otherwise(F.array(*map(F.lit, ("https://a.test", "https://b.test", "https://c.test"))))
    rows = t("customer").select(
        k.alias("record_id"), F.col("c_name").alias("family_office_name"), F.when(k % 7 > 0, "family_foundation").otherwise("unclear").alias("family_office_type"), F.lit("x").alias("description"), text(k % 11 > 0).alias("investment_thesis"), F.lit("x").alias("investing_sectors"),
        (k % 3 > 0).alias("site_ok"), (k % 2 == 0).alias("dns_ok"), urls.alias("source_urls"), F.transform(urls, lambda u, i: ~((i == 0) & (k % 9 == 0))).alias("source_oks"), F.element_at(F.array(*map(F.lit, ("primary", "secondary", "tertiary", "unverified", ""))), (k % 5 + 1).cast("int")).alias("evidence_quality"),
        F.lit("x").alias("principal_name"), text(k % 6 > 0).alias("principal_title"), text(k % 13 > 0).alias("recent_activity"),
    )
    return Q.record_score(rows, "record_id")


@query("prescreen_rules", """
WITH r AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'single_family_office' WHEN 1 THEN 'multi_family_office' ELSE 'unclear' END AS kind, CASE p_size % 4 WHEN 0 THEN ' the  Family ' WHEN 1 THEN 'FAMILY' WHEN 2 THEN '' ELSE 'Ada Stone' END AS who,
  CASE p_size % 5 WHEN 0 THEN 'A Wealth Manager.' WHEN 1 THEN 'works as a SERVICE PROVIDER' WHEN 2 THEN 'service providers' ELSE 'an owner' END AS notes, p_name || ' Family Office' AS name, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'https://www.' || CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, ' ', '') ELSE 'elsewhere' END || '.test/x' END AS url FROM part),
w AS (SELECT *, list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda x: length(x) > 2 AND NOT list_contains(['family', 'office'], x)) AS tokens, CASE WHEN url = '' THEN '' WHEN p_partkey % 2 = 0 THEN regexp_replace(lower(name), ' family office$| ', '', 'g') ELSE 'elsewhere' END AS base FROM r),
f AS (SELECT p_partkey, concat_ws(';', CASE WHEN kind = 'single_family_office' AND trim(regexp_replace(lower(who), 'family', '')) IN ('') THEN 'H1_sfo_no_specific_principal' END, CASE WHEN kind = 'multi_family_office' AND regexp_matches(lower(notes), 'wealth manager|service provider') THEN 'H8_service_provider_mfo' END,
  CASE WHEN len(tokens) > 0 AND base <> '' AND len(list_filter(tokens, lambda x: contains(base, x))) = 0 THEN 'H5_domain_name_mismatch' END) AS reason FROM w)
SELECT p_partkey, reason <> '' AS flagged, reason FROM f""")
def prescreen_rules(t):
    """Three rules on records made of parts: no principal, a service provider, a domain that has none of the name's words."""
    k, n = F.col("p_partkey"), F.col("p_size")
    pick = lambda c, *values: F.element_at(F.array(*map(F.lit, values)), (c % len(values) + 1).cast("int"))
    site = F.concat(F.lit("https://www."), F.when(k % 2 == 0, F.replace("p_name", F.lit(" "), F.lit(""))).otherwise("elsewhere"), F.lit(".test/x"))
    rows = t("part").select(
        "p_partkey", pick(k, "single_family_office", "multi_family_office", "unclear").alias("family_office_type"), pick(n, " the  Family ", "FAMILY", "", "Ada Stone").alias("principal_name"),
        pick(n, "A Wealth Manager.", "works as a SERVICE PROVIDER", "service providers", "an owner", "an owner").alias("uncertainty_notes"), F.concat("p_name", F.lit(" Family Office")).alias("family_office_name"), F.when(k % 7 == 0, "").otherwise(site).alias("website_url"),
    )
    return rows.select("p_partkey", Q.prescreen(rows).alias("reason")).select("p_partkey", (F.col("reason") != "").alias("flagged"), "reason")


_RESULTS = (
    ("https://www.linkedin.com/company/x", "Stone Family Office", "candidate", "d"), ("https://uk.linkedin.com/x", "Stone Family Office", "", "d"), ("https://notlinkedin.com/", "Stone Family Office", "", "c"), ("https://stone.test/", "The largest family offices", "", "n"),
    ("https://stone.test/", "Stone", "a Family-Office in the north", "c"), ("https://stone.test/", "Stone", "an office of a family", "l"), ("https://stone.test/", "Newsroom of a family office", "", "n"), ("", "Stone family office", "", "c"), ("https://dev.swfinstitute.org/a", "news", "", "d"),
)
_REASONS = {"d": "directory/social/regulator result; use only as corroboration or lookup", "n": "non-entity result", "l": "snippet/title lacks direct family-office language", "c": "own-domain result with direct family-office language"}


@query("triage_rules", "WITH r AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{_REASONS[w]}', '{'candidate_raw' if w == 'c' else 'reject'}')" for i, (_, _, _, w) in enumerate(_RESULTS)) + f""") v(i, reason, status)),
p AS (SELECT page_id, length(url) % {len(_RESULTS) + 1} AS i, lower(url || ' ' || coalesce(substr(html, 1, 200), '')) AS x FROM pages)
SELECT page_id, coalesce(status, 'reject') AS triage_status, coalesce(reason, CASE WHEN regexp_matches(x, 'article|conference|considerations|compliance|fund manager|guide|insight|largest|list of|market research|monthly theme|news|operational playbook|overview|podcast|regulations|similar companies|summit|top family offices|what i learned')
  THEN 'non-entity result' ELSE 'snippet/title lacks direct family-office language' END) AS triage_reason FROM p LEFT JOIN r USING (i)""")
def triage_rules(t):
    """Search results with stated judgements, dealt to pages by the length of their URL; one page in ten is judged by its own URL and beginning."""
    i = F.length("url") % (len(_RESULTS) + 1)
    part = lambda at, own: F.coalesce(F.get(F.array(*[F.lit(r[at]) for r in _RESULTS]), i), own)
    url = part(0, F.lit("https://own.test/"))
    status, reason = Q.triage(part(1, F.col("url")), part(2, F.coalesce(F.substring("html", 1, 200), F.lit(""))), url)
    return t("pages").select("page_id", status.alias("triage_status"), reason.alias("triage_reason"))


@query("index_upsert", """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS kind FROM documents)
SELECT kind, count(*)::BIGINT AS n, count(*) FILTER (WHERE doc_id % 10 = 3)::BIGINT AS changed, count(*) FILTER (WHERE doc_id % 7 = 5)::BIGINT AS added FROM d GROUP BY kind""")
def index_upsert(t):
    """Chunks of documents in three batches, one of them replayed; what the current version holds by language, of rows that were changed or came later."""
    docs = t("documents").select(F.col("doc_id").alias("chunk_id"), F.coalesce("lang", F.lit("")).alias("kind"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.lit("b1").alias("batch"))
    root = f"{V.shared_folder(docs.sparkSession)}/chunks-{uuid.uuid4().hex}"
    late, changed = F.col("chunk_id") % 7 == 5, F.col("chunk_id") % 10 == 3
    for name, rows in (("b1", docs.where(~late)), ("b2", docs.where(changed)), ("b2", docs.where(late)), ("b3", docs.where(late & ~changed))):
        U.upsert(rows.withColumn("batch", F.lit(name)), root, name, kind="kind")
    now = U.read_table(docs.sparkSession, root)
    return now.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(F.col("batch") == "b2").alias("changed"), F.count_if(late).alias("added"))


@query("page_export", """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages)
SELECT url, length(arg_max(html, (length(html), -page_id)))::BIGINT AS n_chars, md5(arg_max(html, (length(html), -page_id))) AS digest FROM p WHERE url <> '' GROUP BY url""")
def page_export(t):
    """All pages written as one JSON list a partition, in one line, read back in splits: the longest text of each URL, the first of equals."""
    from ..sources.readers import read_page_export

    pages = t("pages")
    spark = pages.sparkSession
    path = f"{V.shared_folder(spark)}/export-{uuid.uuid4().hex}"
    item = F.to_json(F.struct(F.coalesce("html", F.lit("")).alias("markdown"), F.struct(F.col("url").alias("sourceURL")).alias("metadata")))
    # Lists of some 200 pages, in order; a file holds one list in one line. Names of equal length, so that files come in order of their pages.
    part = F.coalesce(F.when(F.col("page_id").isNotNull(), F.format_string("%018d", F.floor(F.col("page_id") / 200) + F.lit(5 * 10**16))), F.lit("0" * 18))
    listed = pages.withColumn("part", part).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("page_id", item.alias("j")))).alias("js"))
    text = F.concat(F.lit('{"status": "ok", "data": ['), F.array_join(F.transform("js", lambda j: j["j"]), ","), F.lit("]}"))
    listed.select("part", text.alias("value")).repartition("part").write.partitionBy("part").option("lineSep", "\n").text(path)
    found = read_page_export(spark, path)
    return found.select("url", F.length("markdown").cast("bigint").alias("n_chars"), F.md5("markdown").alias("digest"))


#: The SQL's own statement of the templates: label, or label and columns after bars.
_TEMPLATES = {
    "record_profile": "Record profile for {name}.~Record ID: {id}.~Family office type|family_office_type~Location|city|state_region|country~Description|description~Investment thesis|investment_thesis~Investing sectors|investing_sectors~Website|website_url~"
    "Corporate LinkedIn|corporate_linkedin_url~Source notes|source_notes~Confidence|confidence~Uncertainty notes|uncertainty_notes",
    "contact_policy": "Contact policy for {name}.~Safe answer policy: return only values directly evidenced in this locked dataset; if a contact, principal LinkedIn, or AUM field is blank, say it is not evidenced.~Primary email|primary_email~"
    "Primary email evidence URL|primary_email_evidence_url~Primary email confidence|primary_email_confidence~Primary phone|primary_phone~Primary phone evidence URL|primary_phone_evidence_url~Primary phone confidence|primary_phone_confidence~"
    "Principal name|principal_name~Principal title|principal_title~Principal LinkedIn|principal_linkedin_url~AUM|aum_text~SEC regulatory AUM|sec_aum_usd~SEC fee structure labels|sec_fee_structure~Secondary contact email|contact_secondary_email~"
    "Secondary contact phone|contact_secondary_phone~Uncertainty notes|uncertainty_notes",
    "regulatory": "Regulatory evidence for {name}.~SEC registered: {registered}.~SEC CRD number|sec_crd_number~SEC file number|sec_file_number~SEC registration status|sec_registration_status~SEC firm name from IAPD|sec_firm_name_iapd~"
    "SEC other names|sec_firm_other_names~SEC branches count|sec_branches_count~SEC summary URL|sec_summary_url~SEC evidence URL|sec_evidence_url~Form ADV brochure URL|form_adv_brochure_url~SEC regulatory AUM|sec_aum_usd~"
    "SEC fee structure labels|sec_fee_structure~SEC business address|sec_business_address~SEC address|sec_address_city|sec_address_state|sec_address_country~SEC confidence|sec_confidence~Uncertainty notes|uncertainty_notes",
    "recent_activity": "Recent activity evidence for {name}.~Recent activity|recent_activity~Recent activity date|recent_activity_date~Recent activity outlet|recent_activity_outlet~Recent activity type|recent_activity_type~"
    "Recent activity URL|recent_activity_url~Recent activity confidence|recent_activity_confidence~Uncertainty notes|uncertainty_notes",
}


def _template_sql(text: str) -> str:
    def line(x: str) -> str:
        label, *columns = x.split("|")
        if not columns:
            return "'" + label.replace("{name}", "' || m['family_office_name'] || '").replace("{id}", "' || k || '").replace("{registered}", "' || reg || '") + "'"
        return f"'{label}: ' || " + " || ', ' || ".join(f"coalesce(nullif(m['{c}'], ''), 'not evidenced in the locked dataset')" for c in columns) + " || '.'"

    return " || chr(10) || ".join(line(x) for x in text.split("~"))


_SHOWN = "coalesce(nullif({x}, ''), 'not evidenced in the locked dataset')"


@query("record_chunks", f"""
WITH {_CELLS}, r AS (SELECT k, map_from_entries(list((f, v))) AS m FROM (SELECT * FROM cells UNION ALL SELECT c_custkey, 'website_url', 'https://firm.test' FROM customer) GROUP BY k),
b AS (SELECT k, m, CASE WHEN m['sec_registered'] = 'True' THEN 'true' ELSE 'false' END AS reg, CASE WHEN m['source_urls'] <> '' THEN [m['source_urls'], 'https://x.test'] ELSE []::VARCHAR[] END AS own FROM r WHERE k % 4 > 0),
c AS (
  SELECT k, 'record_profile' AS chunk_type, '' AS field_name, '' AS value, {_template_sql(_TEMPLATES['record_profile'])} AS text, own AS urls, m['confidence'] AS conf, 'evidence_only' AS policy FROM b
  UNION ALL SELECT k, 'contact_policy', '', '', {_template_sql(_TEMPLATES['contact_policy'])}, list_filter([m['primary_email_evidence_url'], m['primary_phone_evidence_url']], lambda x: x <> '') || own, m['confidence'], 'sensitive_fields_require_direct_evidence' FROM b
  UNION ALL SELECT k, 'regulatory', '', '', {_template_sql(_TEMPLATES['regulatory'])}, list_filter([CASE reg WHEN 'true' THEN '' ELSE 'https://adviserinfo.sec.gov/' END, m['sec_evidence_url'], m['sec_summary_url'], m['form_adv_brochure_url']], lambda x: x <> '') || own,
    CASE WHEN m['sec_confidence'] <> '' THEN m['sec_confidence'] ELSE m['confidence'] END, 'sec_claims_require_regulatory_chunk' FROM b
  UNION ALL SELECT k, 'recent_activity', '', '', {_template_sql(_TEMPLATES['recent_activity'])}, list_filter([m['recent_activity_url']], lambda x: x <> '') || own, CASE WHEN m['recent_activity_confidence'] <> '' THEN m['recent_activity_confidence'] ELSE m['confidence'] END, 'recent_activity_requires_activity_chunk'
    FROM b WHERE m['recent_activity'] <> '' OR m['recent_activity_date'] <> '' OR m['recent_activity_outlet'] <> '' OR m['recent_activity_url'] <> ''
  UNION ALL SELECT k, 'field_evidence', f, m[f], 'Field evidence for ' || m['family_office_name'] || '.' || chr(10) || 'Field name: ' || f || '.' || chr(10) || 'Field value: ' || m[f] || '.' || chr(10) || 'Evidence URL: ' || {_SHOWN.format(x='us[1]')} || '.' || chr(10) || 'Evidence confidence: ' || {_SHOWN.format(x='conf')} || '.' || chr(10)
    || 'Safe answer policy: use this field value only as written; do not infer adjacent contact, AUM, regulatory, or recent activity facts.', us, conf, 'field_value_exact_extract_only'
    FROM (SELECT *, CASE WHEN e = '' OR m[e] = '' THEN own ELSE [m[e]] || own END AS us, CASE WHEN c = '' THEN m['confidence'] ELSE m[c] END AS conf FROM b, (VALUES ('website_url', '', ''), ('corporate_linkedin_url', 'corporate_linkedin_evidence_url', 'corporate_linkedin_confidence'), ('primary_email', 'primary_email_evidence_url', 'primary_email_confidence'),
      ('primary_phone', 'primary_phone_evidence_url', 'primary_phone_confidence'), ('google_places_phone', 'google_places_evidence_url', 'google_places_confidence'), ('street_address', 'street_address_evidence_url', 'street_address_confidence'), ('principal_name', '', ''), ('principal_title', '', ''), ('principal_linkedin_url', '', ''), ('contact_full_name', '', ''),
      ('contact_secondary_email', '', ''), ('contact_secondary_phone', '', ''), ('aum_text', '', ''), ('sec_aum_usd', 'sec_form_adv_evidence_path', 'sec_confidence'), ('sec_fee_structure', 'sec_form_adv_evidence_path', 'sec_confidence'), ('principal_1_name', 'principal_1_source_url', 'principal_1_confidence'), ('principal_1_role', 'principal_1_source_url', 'principal_1_confidence'),
      ('principal_1_linkedin_url', 'principal_1_linkedin_url', 'principal_1_linkedin_confidence'), ('principal_2_name', 'principal_2_source_url', 'principal_2_confidence'), ('principal_2_role', 'principal_2_source_url', 'principal_2_confidence'), ('principal_2_linkedin_url', 'principal_2_linkedin_url', 'principal_2_linkedin_confidence'),
      ('principal_3_name', 'principal_3_source_url', 'principal_3_confidence'), ('principal_3_role', 'principal_3_source_url', 'principal_3_confidence'), ('principal_3_linkedin_url', 'principal_3_linkedin_url', 'principal_3_linkedin_confidence')) v(f, e, c)) WHERE m[f] <> '')
SELECT k || '::' || chunk_type || CASE WHEN field_name <> '' THEN '::' || field_name ELSE '' END AS chunk_id, chunk_type, field_name, value AS field_value_text, text, array_to_string(urls, ' ') AS source_urls, coalesce(urls[1], '') AS primary_source_url, conf AS confidence_label, policy AS safe_answer_policy FROM c""")
def record_chunks(t):
    """Chunks of the accepted records: profile, contact policy, regulation, activity if any, and up to 24 fields."""
    rows = _records(t).withColumn("validation_status", F.when(F.col("record_id") % 4 > 0, "Accepted").otherwise("needs_review"))
    found = C.record_chunks(rows)
    return found.select("chunk_id", "chunk_type", "field_name", "field_value_text", "text", F.array_join("source_urls", " ").alias("source_urls"), "primary_source_url", "confidence_label", "safe_answer_policy")


@query("url_dialects", """
WITH p AS (SELECT page_id, url AS u, length(url) % 9 AS n FROM pages)
SELECT page_id, CASE n WHEN 0 THEN 'json_array' WHEN 1 THEN 'legacy_python_list' WHEN 2 THEN 'legacy_delimited' WHEN 3 THEN 'legacy_single_url' WHEN 4 THEN 'invalid' WHEN 5 THEN 'invalid' WHEN 6 THEN 'empty' ELSE 'legacy_single_url' END AS format,
  CASE n WHEN 0 THEN u || ' https://b.test' WHEN 1 THEN u || ' https://b.test' WHEN 2 THEN u || ' https://b.test' WHEN 3 THEN u WHEN 7 THEN u || '|https://b.test' WHEN 8 THEN u || ',https://b.test' ELSE '' END AS audited,
  CASE n WHEN 4 THEN 'source_urls JSON must be an array of strings' WHEN 5 THEN 'source_urls is not parseable' WHEN 6 THEN 'source_urls is blank' ELSE '' END AS error,
  CASE n WHEN 0 THEN u || ' https://b.test' WHEN 1 THEN u || ' https://b.test' WHEN 2 THEN u || '; https://b.test' WHEN 3 THEN u WHEN 4 THEN '7' WHEN 5 THEN 'see ' || u WHEN 6 THEN '' ELSE u || ' https://b.test' END AS parsed,
  CASE n WHEN 0 THEN u || ' https://b.test' WHEN 1 THEN u || ' https://b.test' WHEN 2 THEN u || '; https://b.test' WHEN 3 THEN u WHEN 4 THEN '7' WHEN 5 THEN 'see ' || u WHEN 6 THEN '' ELSE u || ' https://b.test' END AS shown,
  CASE n WHEN 0 THEN u WHEN 1 THEN u WHEN 2 THEN u WHEN 3 THEN u WHEN 4 THEN '7' WHEN 5 THEN 'see ' || u WHEN 6 THEN '' WHEN 7 THEN u || '|https://b.test' ELSE u || ',https://b.test' END AS first FROM p""")
def url_dialects(t):
    """Cells in nine forms made of the pages' URLs, read by four of the dialects."""
    u, n = F.col("url"), F.length("url") % 9
    both = lambda a, m, z: F.concat(F.lit(a), u, F.lit(m + "https://b.test" + z))
    forms = [both('["', '", "', '"]'), both("['", "', '", "']"), both("", "; ", ""), F.concat(F.lit(" "), u), F.lit("7"), F.concat(F.lit("see "), u), F.lit(" "), both("", "|", ""), both("", ",", "")]
    cell = F.get(F.array(*forms), n)
    rows = t("pages").select("page_id", cell.alias("c"))
    urls, name, error = L.audited_urls(F.col("c"))
    joined = lambda x: F.array_join(x, " ")
    return rows.select("page_id", name.alias("format"), joined(urls).alias("audited"), error.alias("error"), joined(L.parsed_urls(F.col("c"))).alias("parsed"), joined(L.shown_urls(F.col("c"))).alias("shown"), Q.first_url(F.trim("c")).alias("first"))


@query("source_registry", """
WITH s AS (SELECT page_id, url, unnest([url, 'https://www.businesswire.com/' || page_id, 'https://adviserinfo.sec.gov/x.pdf']) AS source_url, unnest([1, 2, 3]) AS nth FROM pages),
k AS (SELECT DISTINCT url FROM pages), d AS (SELECT s.*, k.url IS NOT NULL AS checked, length(source_url) % 2 = 0 AS good FROM s LEFT JOIN k ON k.url = s.source_url)
SELECT page_id || '_src_' || printf('%02d', nth) AS source_id, page_id, source_url, CASE nth WHEN 1 THEN 'official_site' WHEN 2 THEN 'press_release' ELSE 'regulator' END AS source_type, CASE nth WHEN 2 THEN 'secondary' ELSE 'primary' END AS source_rank, CASE nth WHEN 1 THEN 'first_party' ELSE 'third_party_or_regulator' END AS source_owner,
  checked AND good AS http_ok, CASE WHEN checked THEN CASE WHEN good THEN 200 ELSE 404 END END::INTEGER AS http_status_code FROM d""")
def source_registry(t):
    """Three sources of each page, and the checks of all pages' own URLs; the others weren't checked."""
    pages = t("pages")
    records = pages.select("page_id", F.col("url").alias("website_url"), F.array(F.col("url"), F.concat(F.lit("https://www.businesswire.com/"), F.col("page_id")), F.lit("https://adviserinfo.sec.gov/x.pdf")).alias("source_urls"))
    ok = F.length("url") % 2 == 0
    checks = pages.select("url").distinct().select("url", ok.alias("ok"), F.when(ok, 200).otherwise(404).alias("status_code"), F.col("url").alias("final_url"))
    return E.source_registry(records, checks, "page_id").select("source_id", "page_id", "source_url", "source_type", "source_rank", "source_owner", "http_ok", "http_status_code")


@query("crawl_evidence", r"""
WITH s AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN url || '/' WHEN 2 THEN url || '#part' WHEN 3 THEN url || '.pdf' ELSE url || '-gone' END AS u FROM pages),
c AS (SELECT regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS base, arg_max(url, page_id) AS crawled, arg_max(coalesce(html, ''), page_id) AS body FROM pages WHERE page_id % 4 > 0 GROUP BY base),
j AS (SELECT page_id, u, regexp_replace(regexp_replace(u, '#.*$', ''), '/+$', '') AS base FROM s)
SELECT page_id AS source_id, crawled IS NOT NULL AS matched, coalesce(crawled, '') AS crawled_url, page_id % 5 = 3 AS is_pdf, coalesce(length(body), 0)::BIGINT AS markdown_chars,
  CASE WHEN page_id % 5 = 3 THEN 'PDF excluded from website-content-crawler' WHEN crawled IS NOT NULL AND j.base <> regexp_replace(u, '/+$', '') THEN 'Matched by canonical URL without fragment' WHEN crawled IS NULL THEN 'No Apify crawl item returned' ELSE 'Matched' END AS note
FROM j LEFT JOIN c USING (base)""")
def crawl_evidence(t):
    """Sources that are pages' URLs as they are, with a slash, a fragment, another suffix; three pages of four were crawled, the last of a URL counts."""
    u, k = F.col("url"), F.col("page_id") % 5
    registry = t("pages").select(F.col("page_id").alias("source_id"), F.when(k == 0, u).when(k == 1, F.concat(u, F.lit("/"))).when(k == 2, F.concat(u, F.lit("#part"))).when(k == 3, F.concat(u, F.lit(".pdf"))).otherwise(F.concat(u, F.lit("-gone"))).alias("source_url"))
    crawl = t("pages").where("page_id % 4 > 0").select(F.col("page_id").alias("at"), "url", F.when(F.col("page_id") % 2 == 0, F.col("html")).alias("markdown"), F.col("html").alias("text"))
    return E.crawl_evidence(registry, crawl, "office").drop("snippet")


@query("audit_dataset", f"""
WITH {_CELLS}, r AS (SELECT k, max(v) FILTER (WHERE f = 'primary_email') AS mail, max(v) FILTER (WHERE f = 'primary_email_confidence') AS code, max(v) FILTER (WHERE f = 'city') AS city FROM cells GROUP BY k),
o AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n FROM orders GROUP BY o_custkey)
SELECT 'row_count' AS check_id, 'issue' AS severity, count(*) = 1500 AS ok, count(*)::BIGINT AS observed FROM r UNION ALL SELECT 'missing_columns', 'issue', false, 1 UNION ALL SELECT 'website_url_filled', 'issue', true, 0 UNION ALL SELECT 'city_filled', 'issue', count(*) FILTER (WHERE city = '') = 0, count(*) FILTER (WHERE city = '') FROM r
UNION ALL SELECT 'email_has_code', 'issue', count(*) FILTER (WHERE mail <> '' AND code = '') = 0, count(*) FILTER (WHERE mail <> '' AND code = '') FROM r
UNION ALL SELECT 'quota_' || n_nationkey, 'issue', coalesce(n, 0) >= 3, coalesce(n, 0) FROM nation LEFT JOIN o ON o_custkey = n_nationkey""")
def audit_dataset(t):
    """Rows, columns, filled columns and a pairing of all records in one pass; and whether the customers of 25 numbers have three finished orders."""
    rows = _records(t)
    has = lambda c: F.col(c) != ""
    whole = A.dataset_checks(rows, 1500, ["record_id", "city", "nowhere"], ["website_url", "city"], {"email_has_code": ~has("primary_email") | has("primary_email_confidence")})
    wanted = t("nation").select(F.col("n_nationkey").alias("o_custkey"))
    return whole.unionByName(A.quota(t("orders"), "o_custkey", wanted, F.col("o_orderstatus") == "F", 3))
