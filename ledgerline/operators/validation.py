"""The contract of an entity record: every broken rule of every row in one pass, with the row's place in its file.

A row's own fields are judged first, all of them; placeholders are looked for in rows that break no other rule, and the first field that
holds one is told. `require_valid` ends a run with the errors' places if there are any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import existing
from ..sources.numbered import first_errors

#: The kinds of entity and the grades of evidence.
KINDS = ("single_family_office", "multi_family_office", "family_backed_investment_firm", "family_foundation", "unclear")
GRADES = ("primary", "secondary", "tertiary", "unverified")
#: Texts and hosts that stand for a missing value.
PLACEHOLDERS = ("hidden", "tbd", "todo", "dummy", "example.com")
PLACEHOLDER_HOSTS = ("example.com", "example.org", "example.net")
#: The fields of a record in order, and the rule that each has.
FIELDS = {
    "record_id": "filled", "family_office_name": "filled", "family_office_type": "kind", "description": "filled", "investment_thesis": "any", "investing_sectors": "any", "aum_text": "any", "website_url": "url",
    "corporate_linkedin_url": "url or blank", "street_address": "any", "city": "any", "state_region": "any", "country": "filled", "principal_name": "any", "principal_title": "any", "principal_linkedin_url": "url or blank",
    "primary_email": "email or blank", "primary_phone": "any", "recent_activity": "any", "source_urls": "two urls", "source_notes": "filled", "extraction_method": "filled", "evidence_quality": "grade", "uncertainty_notes": "any",
}
#: Fields that a table may lack.
OPTIONAL = tuple(f for f, rule in FIELDS.items() if rule in ("any", "kind", "grade") or rule.endswith("blank")) + ("extraction_method",)
_URL = r"^(?i:https?)://[^\s/?#]+([/?#]\S*)?$"
_EMAIL = r"^[^\s@,;:<>()\[\]]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"


def url_items(cell: Column) -> Column:
    """The URLs of a cell, parted by semicolons or line feeds."""
    return F.filter(F.transform(F.split(existing(cell), "[;\n]"), existing), lambda u: u != "")


def is_placeholder(value: Column) -> Column:
    """The whole stripped text is a placeholder, or a URL at a placeholder's host; null for null."""
    v = F.when(value.isNotNull(), F.lower(existing(value)))
    host = F.regexp_extract(v, r"^https?://(?:www\.)?([^/]*)", 1)
    return v.isin(*PLACEHOLDERS) | host.isin(*PLACEHOLDER_HOSTS)


def _code(rule: str, cell: Column) -> Column:
    """Why a cell breaks a rule, null if it doesn't."""
    value = existing(cell)
    if rule == "filled":
        return F.when(value == "", F.lit("blank"))
    if rule in ("kind", "grade"):
        return F.when(~value.isin(*(KINDS if rule == "kind" else GRADES)), F.lit("not_in_set"))
    if rule == "two urls":
        items = url_items(cell)
        return F.when(F.exists(items, lambda u: ~u.rlike(_URL)), F.lit("not_a_url")).when(F.size(items) < 2, F.lit("too_few"))
    if rule == "any":
        return F.lit(None).cast("string")
    wrong = ~value.rlike(_URL if rule.startswith("url") else _EMAIL)
    code = F.lit("not_a_url" if rule.startswith("url") else "not_an_email")
    return F.when(((value != "") & wrong) if rule.endswith("blank") else wrong, code)


def record_errors(rows: DataFrame, at: list[str]) -> DataFrame:
    """The columns `at`, field and code of every error of rows; fields that a table lacks are errors of each row unless they are optional."""
    entry = lambda f, code: F.struct(F.lit(f).alias("field"), code.alias("code"))
    broken, marks = [], []
    for f, rule in FIELDS.items():
        if f not in rows.columns:
            broken += [] if f in OPTIONAL else [entry(f, F.lit("missing"))]
            continue
        code = _code(rule, F.col(f))
        broken.append(F.when(code.isNotNull(), entry(f, code)))
        held = F.exists(url_items(F.col(f)), is_placeholder) if rule == "two urls" else F.coalesce(is_placeholder(F.col(f)), F.lit(False))
        marks.append(F.when(held, entry(f, F.lit("placeholder"))))
    found = rows.select(*at, F.array_compact(F.array(*broken)).alias("broken"), F.array_compact(F.array(*marks)).alias("marks"))
    errors = F.when(F.size("broken") > 0, F.col("broken")).otherwise(F.slice("marks", 1, 1))
    return found.select(*at, F.explode(errors).alias("e")).select(*at, "e.field", "e.code")


def require_valid(errors: DataFrame) -> None:
    """ValueError with the places of the first errors, if there are any."""
    if not errors.isEmpty():
        raise ValueError(first_errors(errors))
