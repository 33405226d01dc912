"""Rules over the columns of an entity record: score, completion, prescreen, triage, claims.

Every rule reads a row alone, in one pass and without a shuffle; cells are text, and null is blank. A table that lacks a column is read as if it were blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..functions.blanks import existing, is_filled
from .evidence import all_matches, first_match

#: Hosts whose pages only point to entities.
DISCOVERY_ONLY = ("dev.swfinstitute.org", "swfinstitute.org")
#: The columns that a completion score counts, in order.
COMPLETION_COLUMNS = (
    "family_office_name", "data_validation_period", "data_completion_score_text", "data_completion_score_visual", "description", "investment_thesis", "investing_sectors", "family_office_domain", "website_url", "url_quality",
    "corporate_linkedin_url", "street_address", "city", "state_region", "country", "contact_first_name", "contact_last_name", "contact_full_name", "principal_title", "contact_location", "principal_linkedin_url", "primary_email",
    "primary_email_validation_code", "primary_email_code_explanation", "primary_email_quality_assessment", "primary_phone", "contact_secondary_email", "secondary_email_validation_code", "email_code_explanation_secondary",
    "email_quality_assessment_secondary", "contact_secondary_phone",
)
_SCORES = ("data_completion_score_text", "data_completion_score_visual")
#: Phrases of a firm that serves families.
SERVICE_WORDS = ("service-provider", "service provider", "advisory firm", "wealth management firm", "wealth manager")
#: Hosts and phrases that a search result is turned down for.
REJECTED_HOSTS = ("adviserinfo.sec.gov", "crunchbase.com", "familyoffices.com", "linkedin.com", "pitchbook.com", "simplefamilyoffice.com", "swfinstitute.org", "wikipedia.org", "youtube.com", "zoominfo.com")
NON_ENTITY_TERMS = (
    "article", "conference", "considerations", "compliance", "fund manager", "guide", "insight", "largest", "list of", "market research", "monthly theme", "news", "operational playbook", "overview", "podcast", "regulations",
    "similar companies", "summit", "top family offices", "what i learned",
)
#: Words that a domain needn't hold.
DOMAIN_STOPWORDS = ("family", "office", "capital", "group", "partners", "advisors", "advisory", "management", "wealth", "investment", "investments", "the", "and", "co", "company", "ag", "llc", "ltd", "inc", "lp", "plc", "pte", "trust")


def cell(df: DataFrame, name: str) -> Column:
    return existing(F.col(f"`{name}`").cast("string")) if name in df.columns else F.lit("")


def record_score(df: DataFrame, key: str) -> DataFrame:
    """key, score, confidence, status, notes. df: the record's cells, `site_ok`, `dns_ok`, `source_urls` and `source_oks` (arrays: every source's URL, and whether it was reached)."""
    has = lambda c: cell(df, c) != ""
    points = lambda test, yes: F.when(test, F.lit(yes)).otherwise(F.lit(0))
    quality, kind = cell(df, "evidence_quality"), cell(df, "family_office_type")
    site, dns = F.coalesce("site_ok", F.lit(False)), F.coalesce("dns_ok", F.lit(False))
    n, ok = F.size(F.coalesce("source_urls", F.array().cast("array<string>"))), F.size(F.filter(F.coalesce("source_oks", F.array().cast("array<boolean>")), lambda x: x))
    only = F.exists(F.coalesce("source_urls", F.array().cast("array<string>")), lambda u: U.domain(u).isin(*DISCOVERY_ONLY))
    score = (
        points(has("family_office_name"), 8) + points(kind != "unclear", 8) + points(has("description"), 8) + points(has("investment_thesis"), 6) + points(has("investing_sectors"), 6)
        + F.when(site, 12).when(dns, 4).otherwise(0) + points(n >= 2, 12) + F.least(ok * 6, F.lit(18)) + F.when(quality == "primary", 10).when(quality == "secondary", 6).when(quality == "tertiary", 3).otherwise(0)
        + points(has("principal_name") & has("principal_title"), 6) + points(has("recent_activity"), 6)
    )
    notes = all_matches([
        (kind == "unclear", "family office type is unclear"), (~site & dns, "website request failed but DNS resolves"), (~site & ~dns, "website request failed and DNS did not resolve"), (n < 2, "fewer than two source URLs"),
        (~quality.isin("primary", "secondary", "tertiary"), "evidence quality is unverified"), (ok < 2, "fewer than two source URLs were reachable"), (only, "source URLs include discovery-only directory sources"),
    ])
    rows = df.select(key, score.alias("score"), site.alias("site"), n.alias("n"), ok.alias("ok"), only.alias("only"), notes.alias("notes"))
    accepted = (F.col("score") >= 80) & F.col("site") & (F.col("n") >= 2) & (F.col("ok") >= 2) & ~F.col("only")
    confidence = first_match([(F.col("score") >= 80, "high"), (F.col("score") >= 60, "medium")], "low")
    said = F.when(F.col("notes") == "", F.lit("passed configured validation checks")).otherwise(F.col("notes"))
    return rows.select(key, F.least("score", F.lit(100)).cast("bigint").alias("score"), confidence.alias("confidence"), first_match([(accepted, "accepted")], "needs_review").alias("status"), said.alias("notes"), F.col("ok").cast("bigint").alias("n_ok"))


def completion(df: DataFrame) -> Column:
    """How many of the counted columns are filled; the two of the score itself always are."""
    total = F.lit(len(_SCORES))
    for c in COMPLETION_COLUMNS:
        if c in df.columns and c not in _SCORES:
            total = total + is_filled(F.col(f"`{c}`").cast("string")).cast("int")
    return total


def prescreen(df: DataFrame) -> Column:
    """The rules that a record should be looked at for, in order, joined by semicolons; blank if none."""
    kind, who = cell(df, "family_office_type"), cell(df, "principal_name")
    notes = F.lower(cell(df, "uncertainty_notes"))
    nobody = (kind == "single_family_office") & (F.trim(F.regexp_replace(who, r"(?i)\bfamily\b", "")) == "")
    serves = F.lit(False)
    for w in SERVICE_WORDS:
        serves = serves | notes.contains(w)
    tokens = F.filter(X.words(cell(df, "family_office_name")), lambda w: ~w.isin(*DOMAIN_STOPWORDS) & (F.length(w) > 2))
    base = F.regexp_replace(F.regexp_replace(U.domain(cell(df, "website_url")), r"\.[^.]*$", ""), "[^a-z0-9]", "")
    elsewhere = (F.size(tokens) > 0) & (base != "") & ~F.exists(tokens, lambda w: base.contains(w))
    return all_matches([(nobody, "H1_sfo_no_specific_principal"), ((kind == "multi_family_office") & serves, "H8_service_provider_mfo"), (elsewhere, "H5_domain_name_mismatch")], ";")


def triage(title: Column, description: Column, url: Column) -> tuple[Column, Column]:
    """Status and reason of a search result; the first rule that holds gives them."""
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))))
    term = F.lit(False)
    for w in NON_ENTITY_TERMS:
        term = term | text.contains(w)
    rules = [
        (U.at_host(U.domain(url), REJECTED_HOSTS), "directory/social/regulator result; use only as corroboration or lookup"), (term, "non-entity result"),
        (~(text.contains("family office") | text.contains("family-office")), "snippet/title lacks direct family-office language"),
    ]
    reason = first_match(rules, "own-domain result with direct family-office language")
    return F.when(reason.startswith("own-domain"), F.lit("candidate_raw")).otherwise(F.lit("reject")), reason


#: The fields of seed claims; those that state a fact rather than a summary.
SEED_FIELDS = (
    "family_office_name", "family_office_type", "description", "investment_thesis", "investing_sectors", "aum_text", "website_url", "city", "state_region", "country", "principal_name", "principal_title", "recent_activity",
)
SEED_FACTS = ("family_office_name", "website_url", "city", "state_region", "country", "principal_name", "principal_title")
#: Groups of promoted fields, the columns of their evidence and confidence, and the type of their claims.
CLAIM_GROUPS = (
    (("primary_email", "primary_email_smtp_verified"), "primary_email_evidence_url", "primary_email_confidence", "promoted_contact"),
    (("primary_phone",), "primary_phone_evidence_url", "primary_phone_confidence", "promoted_contact"),
    (("corporate_linkedin_url",), "corporate_linkedin_evidence_url", "corporate_linkedin_confidence", "promoted_linkedin_company"),
    (("linkedin_employee_count", "linkedin_follower_count", "linkedin_specialties", "linkedin_company_size_band", "linkedin_industry", "linkedin_founded_year", "linkedin_headquarters_full"),
     "linkedin_company_evidence_url", "linkedin_company_confidence", "linkedin_company_enrichment"),
    (("twitter_url", "instagram_url", "facebook_url", "youtube_url", "tiktok_url"), "social_media_evidence_url", "social_media_confidence", "official_site_social_link"),
    (("google_places_phone", "google_places_reviews_count", "google_places_rating", "google_places_category", "google_maps_url", "primary_phone_corroborated_by_places", "primary_phone_conflict_with_places", "primary_phone_canonical_source"),
     "google_places_evidence_url", "google_places_confidence", "google_places_corroboration"),
    (("street_address",), "street_address_evidence_url", "street_address_confidence", "address_corroboration"),
    (("sec_crd_number", "sec_file_number", "sec_registration_status", "sec_firm_name_iapd", "sec_firm_other_names", "sec_branches_count", "form_adv_brochure_url", "sec_summary_url", "sec_address_city", "sec_address_state", "sec_address_country",
      "sec_near_match_review_status", "sec_near_match_notes"), "sec_evidence_url", "sec_confidence", "regulatory_identifier"),
    (("sec_aum_usd", "sec_fee_structure", "sec_listed_officers", "sec_business_address", "sec_form_adv_parse_status"), "sec_form_adv_evidence_path", "sec_confidence", "form_adv_pdf_parse"),
)
#: What is told of a recent activity, and the fields that are derived from a record.
ACTIVITY_FIELDS = ("recent_activity", "recent_activity_date", "recent_activity_outlet", "recent_activity_url", "recent_activity_type", "recent_activity_age_days", "recent_activity_recency_label")
DERIVED_FIELDS = (
    "contact_first_name", "contact_last_name", "contact_full_name", "contact_location", "data_completion_score_text", "data_completion_score_visual", "secondary_email_validation_code", "email_code_explanation_secondary",
    "email_quality_assessment_secondary", "source_content_review_status", "source_content_review_notes",
)
METHOD_REPORT = "reports/methodology_summary.md"
_CLAIM = "array<struct<field:string,value:string,url:string,confidence:string,kind:string>>"


def first_url(cell_: Column) -> Column:
    """The first URL of a cell: of a list literal, else what stands before the first semicolon or line feed."""
    listed = F.get(F.from_json(cell_, "array<string>", {"allowSingleQuotes": "true"}), F.lit(0))
    return F.when(cell_.startswith("["), F.coalesce(listed, existing(F.substring_index(F.regexp_replace(cell_, "\n", ";"), ";", 1)))).otherwise(existing(F.substring_index(F.regexp_replace(cell_, "\n", ";"), ";", 1)))


def seed_claims(df: DataFrame, key: str) -> DataFrame:
    """A claim for each filled seed field: claim_id, key, field_name, claim_value, source_url (the first), source_type, claim_type."""
    url, kind = first_url(cell(df, "source_urls")), lambda f: "fact" if f in SEED_FACTS else "normalized_summary"
    cells = F.array(*[F.struct(F.lit(f).alias("field"), cell(df, f).alias("value"), F.lit(kind(f)).alias("kind")) for f in SEED_FIELDS])
    rows = df.select(F.col(key), url.alias("source_url"), U.source_type(url, cell(df, "website_url")).alias("source_type"), F.explode(F.filter(cells, lambda c: c["value"] != "")).alias("c"))
    return rows.select(F.concat_ws("_", F.col(key).cast("string"), "c.field").alias("claim_id"), key, F.col("c.field").alias("field_name"), F.col("c.value").alias("claim_value"), "source_url", "source_type", F.col("c.kind").alias("claim_type"))


def augmented_claims(df: DataFrame, key: str, registry_folder: str) -> DataFrame:
    """A claim for each promoted cell that has both evidence and confidence, and for registration, principals, activity and derived fields by rules of their own.

    claim_id, key, field_name, claim_value, source_url, source_type, claim_type, confidence, validation_status (verified, or documented without confidence).
    """
    c = lambda name: cell(df, name)
    entry = lambda f, url, confidence, kind: F.struct(F.lit(f).alias("field"), c(f).alias("value"), url.alias("url"), confidence.alias("confidence"), F.lit(kind).alias("kind"))
    gated = lambda f, url, confidence, kind: F.when((url != "") & (confidence != ""), entry(f, url, confidence, kind))
    found = [gated(f, c(url), c(confidence), kind) for fields, url, confidence, kind in CLAIM_GROUPS for f in fields]
    unregistered = c("sec_registered") == "False"
    url = F.when(unregistered, F.concat(F.lit(f"{registry_folder}/"), F.col(key).cast("string"), F.lit(".json"))).otherwise(c("sec_evidence_url"))
    confidence = F.when(unregistered, F.lit("iapd_no_match_above_threshold")).otherwise(c("sec_confidence"))
    found.append(F.when(url != "", entry("sec_registered", url, confidence, "regulatory_registration_status")))
    for slot in (1, 2, 3):
        p = f"principal_{slot}"
        found += [gated(f"{p}_{x}", c(f"{p}_source_url"), c(f"{p}_confidence"), "official_team_roster") for x in ("name", "role")]
        found.append(gated(f"{p}_linkedin_url", c(f"{p}_linkedin_url"), c(f"{p}_linkedin_confidence"), "official_principal_linkedin"))
    first = first_url(c("source_urls"))
    active, label = c("recent_activity") != "", c("recent_activity_confidence")
    where = F.when(c("recent_activity_url") != "", c("recent_activity_url")).otherwise(first)
    found += [F.when(active, entry(f, where, F.when(label != "", label).otherwise("news_signal"), "recent_activity_signal")) for f in ACTIVITY_FIELDS]
    found.append(F.when(~active, entry("recent_activity_type", F.lit(METHOD_REPORT), label, "no_recent_signal_status")))
    own = F.when(first != "", first).otherwise(METHOD_REPORT)
    method = lambda f: f.startswith("data_completion") or "secondary" in f
    found += [entry(f, F.lit(METHOD_REPORT) if method(f) else own, F.lit("derived_from_validated_record"), "derived_or_sample_parity") for f in DERIVED_FIELDS]
    rows = df.select(F.col(key), c("website_url").alias("site"), F.explode(F.filter(F.array_compact(F.array(*found)).cast(_CLAIM), lambda e: e["value"] != "")).alias("c"))
    claim_id = F.concat(F.col(key).cast("string"), F.lit("_augmented_"), F.col("c.field"))
    status = F.when(F.col("c.confidence") != "", "verified").otherwise("documented")
    return rows.select(claim_id.alias("claim_id"), key, F.col("c.field").alias("field_name"), F.col("c.value").alias("claim_value"), F.col("c.url").alias("source_url"), U.claim_source_type(F.col("c.url"), F.col("site")).alias("source_type"), F.col("c.kind").alias("claim_type"), F.col("c.confidence").alias("confidence"), status.alias("validation_status"))
