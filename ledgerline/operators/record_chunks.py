"""Accepted records as chunks: four templated texts and one chunk for each filled field, with the metadata that filters and citations read.

A record is read once and its chunks are exploded from one array, so nothing is shuffled; blank values are shown as missing. Only accepted records have chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.blanks import existing, truth
from .chunks import shown
from .records import cell

#: What records must be to have chunks.
ACCEPTED = ("accepted", "valid", "validated")
#: The lines of each template as label and columns; a line without columns is a sentence.
PROFILE = (
    ("Record ID", "record_id"), ("Family office type", "family_office_type"), ("Location", "city", "state_region", "country"), ("Description", "description"), ("Investment thesis", "investment_thesis"), ("Investing sectors", "investing_sectors"),
    ("Website", "website_url"), ("Corporate LinkedIn", "corporate_linkedin_url"), ("Source notes", "source_notes"), ("Confidence", "confidence"), ("Uncertainty notes", "uncertainty_notes"),
)
CONTACT = (
    ("Safe answer policy: return only values directly evidenced in this locked dataset; if a contact, principal LinkedIn, or AUM field is blank, say it is not evidenced",), ("Primary email", "primary_email"),
    ("Primary email evidence URL", "primary_email_evidence_url"), ("Primary email confidence", "primary_email_confidence"), ("Primary phone", "primary_phone"), ("Primary phone evidence URL", "primary_phone_evidence_url"),
    ("Primary phone confidence", "primary_phone_confidence"), ("Principal name", "principal_name"), ("Principal title", "principal_title"), ("Principal LinkedIn", "principal_linkedin_url"), ("AUM", "aum_text"), ("SEC regulatory AUM", "sec_aum_usd"),
    ("SEC fee structure labels", "sec_fee_structure"), ("Secondary contact email", "contact_secondary_email"), ("Secondary contact phone", "contact_secondary_phone"), ("Uncertainty notes", "uncertainty_notes"),
)
REGULATORY = (
    ("SEC CRD number", "sec_crd_number"), ("SEC file number", "sec_file_number"), ("SEC registration status", "sec_registration_status"), ("SEC firm name from IAPD", "sec_firm_name_iapd"), ("SEC other names", "sec_firm_other_names"),
    ("SEC branches count", "sec_branches_count"), ("SEC summary URL", "sec_summary_url"), ("SEC evidence URL", "sec_evidence_url"), ("Form ADV brochure URL", "form_adv_brochure_url"), ("SEC regulatory AUM", "sec_aum_usd"),
    ("SEC fee structure labels", "sec_fee_structure"), ("SEC business address", "sec_business_address"), ("SEC address", "sec_address_city", "sec_address_state", "sec_address_country"), ("SEC confidence", "sec_confidence"), ("Uncertainty notes", "uncertainty_notes"),
)
ACTIVITY = (
    ("Recent activity", "recent_activity"), ("Recent activity date", "recent_activity_date"), ("Recent activity outlet", "recent_activity_outlet"), ("Recent activity type", "recent_activity_type"), ("Recent activity URL", "recent_activity_url"),
    ("Recent activity confidence", "recent_activity_confidence"), ("Uncertainty notes", "uncertainty_notes"),
)
#: The fields that have chunks of their own; the columns of their evidence and confidence, where they have such.
FIELDS = (
    "website_url", "corporate_linkedin_url", "primary_email", "primary_phone", "google_places_phone", "street_address", "principal_name", "principal_title", "principal_linkedin_url", "contact_full_name", "contact_secondary_email",
    "contact_secondary_phone", "aum_text", "sec_aum_usd", "sec_fee_structure", "principal_1_name", "principal_1_role", "principal_1_linkedin_url", "principal_2_name", "principal_2_role", "principal_2_linkedin_url", "principal_3_name",
    "principal_3_role", "principal_3_linkedin_url",
)
EVIDENCE = {
    "primary_email": "primary_email_evidence_url", "primary_phone": "primary_phone_evidence_url", "corporate_linkedin_url": "corporate_linkedin_evidence_url", "google_places_phone": "google_places_evidence_url",
    "street_address": "street_address_evidence_url", "sec_aum_usd": "sec_form_adv_evidence_path", "sec_fee_structure": "sec_form_adv_evidence_path",
    **{f"principal_{i}_{c}": f"principal_{i}_source_url" for i in (1, 2, 3) for c in ("name", "role")}, **{f"principal_{i}_linkedin_url": f"principal_{i}_linkedin_url" for i in (1, 2, 3)},
}
CONFIDENCE = {
    "primary_email": "primary_email_confidence", "primary_phone": "primary_phone_confidence", "corporate_linkedin_url": "corporate_linkedin_confidence", "google_places_phone": "google_places_confidence",
    "street_address": "street_address_confidence", "sec_aum_usd": "sec_confidence", "sec_fee_structure": "sec_confidence",
    **{f"principal_{i}_{c}": f"principal_{i}_confidence" for i in (1, 2, 3) for c in ("name", "role")}, **{f"principal_{i}_linkedin_url": f"principal_{i}_linkedin_confidence" for i in (1, 2, 3)},
}
FIELD_POLICY = "Safe answer policy: use this field value only as written; do not infer adjacent contact, AUM, regulatory, or recent activity facts."
#: Where unregistered records are looked up.
REGISTRY_SITE = "https://adviserinfo.sec.gov/"
#: Metadata that chunks take over from their record as they are.
CARRIED = (
    "family_office_name", "family_office_type", "country", "state_region", "city", "evidence_quality", "validation_status", "sec_crd_number", "sec_confidence", "recent_activity_type", "recent_activity_date", "recent_activity_outlet",
    "recent_activity_confidence", "human_audit_status", "auto_prescreen_flag", "uncertainty_notes", "data_validation_period",
)
_CHUNK = "array<struct<chunk_type:string,field_name:string,field_value_text:string,text:string,source_urls:array<string>,primary_source_url:string,confidence_label:string,safe_answer_policy:string>>"


def record_chunks(df: DataFrame, key: str = "record_id") -> DataFrame:
    """chunk_id, key, chunk_type, field_name, field_value_text, text, source_urls, primary_source_url, confidence_label, safe_answer_policy, and the record's own metadata."""
    templates = {x for table in (PROFILE, CONTACT, REGULATORY, ACTIVITY) for _, *columns in table for x in columns}
    names = sorted({*templates, *FIELDS, *EVIDENCE.values(), *CONFIDENCE.values(), *CARRIED, "sec_registered", "source_urls", "website_ok", "validation_score", "source_count"} - {key})
    # Each cell is cleaned once, and each list of URLs is read once.
    kept = df.where(F.lower(cell(df, "validation_status")).isin(*ACCEPTED)).select(F.col(key), *[cell(df, x).alias(x) for x in names])
    listed = sorted({*EVIDENCE.values(), "sec_summary_url", "form_adv_brochure_url", "sec_evidence_url", "recent_activity_url", "source_urls"})
    kept = kept.select("*", *[U.parsed_urls(F.col(x)).alias(f"urls_{x}") for x in listed])
    c = lambda name: existing(F.col(key).cast("string")) if name == key else F.col(name)
    lines = lambda head, table: F.concat_ws("\n", head, *[F.concat(F.lit(label + (": " if columns else "")), *([F.concat_ws(", ", *[shown(c(x)) for x in columns])] if columns else []), F.lit(".")) for label, *columns in table])
    title = lambda what: F.concat(F.lit(f"{what} for "), c("family_office_name"), F.lit("."))
    own = F.col("urls_source_urls")
    urls = lambda *cells: F.array_distinct(F.concat(*[F.col(f"urls_{x}") for x in cells], own))
    first = lambda u: F.coalesce(F.get(u, F.lit(0)), F.lit(""))
    either = lambda a: F.when(c(a) != "", c(a)).otherwise(c("confidence"))

    def entry(kind, text, sources, confidence, policy, field="", value=None):
        return F.struct(F.lit(kind).alias("chunk_type"), F.lit(field).alias("field_name"), (F.lit("") if value is None else value).alias("field_value_text"), text.alias("text"), sources.alias("source_urls"), first(sources).alias("primary_source_url"), confidence.alias("confidence_label"), F.lit(policy).alias("safe_answer_policy"))

    registered = truth(c("sec_registered"))
    filed = urls("sec_evidence_url", "sec_summary_url", "form_adv_brochure_url")
    filed = F.when(registered, filed).otherwise(F.array_distinct(F.concat(F.array(F.lit(REGISTRY_SITE)), filed)))
    regulatory = F.concat_ws("\n", title("Regulatory evidence"), F.concat(F.lit("SEC registered: "), F.when(registered, "true").otherwise("false"), F.lit(".")), lines(F.lit(None).cast("string"), REGULATORY))
    active = (c("recent_activity") != "") | (c("recent_activity_date") != "") | (c("recent_activity_outlet") != "") | (c("recent_activity_url") != "")
    found = [
        entry("record_profile", lines(title("Record profile"), PROFILE), own, c("confidence"), "evidence_only"),
        entry("contact_policy", lines(title("Contact policy"), CONTACT), urls("primary_email_evidence_url", "primary_phone_evidence_url"), c("confidence"), "sensitive_fields_require_direct_evidence"),
        entry("regulatory", regulatory, filed, either("sec_confidence"), "sec_claims_require_regulatory_chunk"),
        F.when(active, entry("recent_activity", lines(title("Recent activity evidence"), ACTIVITY), urls("recent_activity_url"), either("recent_activity_confidence"), "recent_activity_requires_activity_chunk")),
    ]
    for f in FIELDS:
        sources = urls(EVIDENCE[f]) if f in EVIDENCE else own
        confidence = c(CONFIDENCE[f]) if f in CONFIDENCE else c("confidence")
        said = F.concat(F.lit(f"Field name: {f}.\nField value: "), c(f), F.lit(".\nEvidence URL: "), shown(first(sources)), F.lit(".\nEvidence confidence: "), shown(confidence), F.lit(f".\n{FIELD_POLICY}"))
        found.append(F.when(c(f) != "", entry("field_evidence", F.concat_ws("\n", title("Field evidence"), said), sources, confidence, "field_value_exact_extract_only", f, c(f))))
    number = lambda name: c(name).try_cast("double").try_cast("int")
    carried = [c(x).alias(x) for x in CARRIED] + [truth(c("website_ok")).alias("website_ok"), registered.alias("sec_registered"), number("validation_score").alias("validation_score"), number("source_count").alias("source_count")]
    rows = kept.select(F.col(key), *carried, F.explode(F.array_compact(F.array(*found)).cast(_CHUNK)).alias("chunk"))
    chunk_id = F.concat_ws("::", existing(F.col(key).cast("string")), "chunk.chunk_type", F.when(F.col("chunk.field_name") != "", F.col("chunk.field_name")))
    return rows.select(chunk_id.alias("chunk_id"), key, "chunk.*", *[x for x in rows.columns if x not in (key, "chunk")])


def coverage(chunks: DataFrame) -> Column:
    """Share of the chunks that have each key of the metadata, as a map; aggregate it."""
    names = [x for x, t in chunks.dtypes if not t.startswith(("array", "struct", "map"))]
    return F.create_map(*[x for n in names for x in (F.lit(n), F.round(F.avg((existing(F.col(n).cast("string")) != "").cast("int")), 6))])
