"""Text, name, number, phone and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .blanks import cell_text, existing, strip

#: Legal suffixes that a normalised entity name drops.
LEGAL_SUFFIXES = ("ag", "co", "company", "corp", "corporation", "inc", "limited", "llc", "lp", "ltd", "plc", "pte")
#: Words that say nothing about which entity a name means.
NAME_STOPWORDS = ("family", "office", "the", "and", "co", "company", "group", "capital", "partners", "advisors", "advisory", "management", "wealth", "investment", "investments", "ag", "llc", "ltd", "lp", "inc", "plc", "trust", "&")
#: Words that a registry name drops.
REGISTRY_DROPS = ("family", "office", "offices", "capital", "wealth", "management", "advisors", "advisor", "advisory", "partners", "group", "llc", "inc", "llp", "ltd", "co", "corp", "company", "holdings", "limited", "the", "&", "and")
#: Local parts of shared mailboxes.
SHARED_MAILBOXES = ("info", "contact", "hello", "admin", "office", "enquiries", "inquiries", "reception", "team", "investments", "investor", "investorrelations", "ir", "general", "mail")
#: Patterns of fee labels.
FEE_PATTERNS = {
    "asset_based_fees": r"\basset[- ]based fees?\b",
    "fixed_fees": r"\bfixed fees?\b",
    "hourly_fees": r"\bhourly (fees?|charges?)\b",
    "performance_based_fees": r"\bperformance[- ]based fees?\b",
    "other_advisory_fees": r"\bother advisory fees?\b",
}
BAR_WIDTH = 31


def words(c: Column) -> Column:
    """Lower-case runs of a-z and 0-9."""
    return F.filter(F.split(F.lower(existing(c)), "[^a-z0-9]+"), lambda w: w != "")


def _without(tokens: Column, drops: tuple[str, ...]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(*drops))


def entity_name(c: Column) -> Column:
    return F.array_join(_without(words(c), LEGAL_SUFFIXES), " ")


def registry_name(c: Column) -> Column:
    return F.array_join(_without(words(c), REGISTRY_DROPS), " ")


def informative_tokens(c: Column, drops: tuple[str, ...] = NAME_STOPWORDS, loose: bool = False) -> Column:
    """Distinct tokens of more than two characters; loose: those of two where there are none."""
    kept = F.array_distinct(_without(words(c), drops))
    strict = F.filter(kept, lambda w: F.length(w) > 2)
    return F.when(F.size(strict) > 0, strict).otherwise(F.filter(kept, lambda w: F.length(w) >= 2)) if loose else strict


def token_jaccard(left: Column, right: Column) -> Column:
    """Of two token arrays as sets; 0 if either is empty."""
    return F.when((F.size(left) > 0) & (F.size(right) > 0), F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))).otherwise(F.lit(0.0))


def person_name(c: Column) -> tuple[Column, Column]:
    """First and last name; ('', '') for single words, collectives and '... family'. A generation suffix goes."""
    t = F.split(existing(c), r"\s+")
    suffix = F.lower(F.regexp_replace(F.element_at(t, -1), r"\.", "")).isin("jr", "sr", "ii", "iii", "iv")
    kept = F.when((F.size(t) >= 3) & suffix, F.slice(t, F.lit(1), F.size(t) - 1)).otherwise(t)
    whole = F.lower(existing(c))
    none = (F.size(kept) < 2) | whole.endswith(" family") | whole.isin("founders", "founding family", "family members")
    first = F.array_join(F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))), " ")
    return F.when(none, F.lit("")).otherwise(first), F.when(none, F.lit("")).otherwise(F.element_at(kept, -1))


def joined(*parts: Column, by: str = ", ") -> Column:
    """The parts that aren't blank."""
    return F.concat_ws(by, *(F.nullif(cell_text(p), F.lit("")) for p in parts))


def integer_text(c: Column) -> Column:
    """'843.0' as '843'; what is no number passes."""
    t = existing(c)
    return F.coalesce(t.try_cast("double").try_cast("bigint").cast("string"), t)


def without_zero_decimal(c: Column) -> Column:
    return F.when(c.rlike(r"^-?[0-9]+\.0$"), F.regexp_replace(c, r"\.0$", "")).otherwise(c)


def identifier_variants(c: Column) -> Column:
    t = existing(c)
    return F.filter(F.array_distinct(F.array(t, F.when(t.rlike(r"^[0-9]+\.0$"), F.regexp_replace(t, r"\.0$", "")).otherwise(t))), lambda x: x != "")


def rating(c: Column) -> Column:
    return F.bround(c.try_cast("double"), 1)


def last_digits(c: Column, n: int = 10) -> Column:
    return F.right(F.regexp_replace(existing(c), "[^0-9]", ""), F.lit(n))


def phones_match(left: Column, right: Column) -> Column:
    a, b = last_digits(left), last_digits(right)
    return (a != "") & (a == b)


def parts(c: Column, by: str = ";") -> Column:
    return F.filter(F.transform(F.split(existing(c), by), strip), lambda x: x != "")


def corporate_email(emails: Column, host: Column) -> Column:
    """Of an array: a shared mailbox, of the same domain if there is any; null if all are personal."""
    valid = F.filter(F.transform(emails, lambda e: F.lower(strip(e))), lambda e: e.rlike(r"^[\w.+\-]+@[\w\-]+(\.[\w\-]+)+$"))
    same = F.filter(valid, lambda e: F.substring_index(e, "@", -1) == host)
    pool = F.when(F.size(same) > 0, same).otherwise(valid)
    exact = F.filter(pool, lambda e: F.substring_index(e, "@", 1).isin(*SHARED_MAILBOXES))
    prefixed = F.filter(pool, lambda e: e.rlike(f"^({'|'.join(SHARED_MAILBOXES)})"))
    return F.coalesce(F.try_element_at(exact, F.lit(1)), F.try_element_at(prefixed, F.lit(1)))


def first_phone(phones: Column) -> Column:
    return F.try_element_at(F.filter(phones, lambda p: F.length(F.regexp_replace(p, "[^0-9]", "")) >= 7), F.lit(1))


def first_company_page(urls: Column) -> Column:
    return F.try_element_at(F.filter(urls, lambda u: F.lower(u).rlike(r"linkedin\.com/(company|school)/")), F.lit(1))


def age_days(c: Column, as_of: str) -> Column:
    day = F.try_to_date(F.substring(existing(c), 1, 10), "yyyy-MM-dd")
    return F.greatest(F.datediff(F.lit(as_of).cast("date"), day), F.lit(0))


def recency_label(days: Column) -> Column:
    return F.when(days.isNull(), F.lit("")).when(days <= 90, F.lit("fresh")).when(days <= 365, F.lit("moderate")).otherwise(F.lit("stale"))


def with_note(notes: Column, note: Column, by: str = "; ") -> Column:
    """Note appended unless it is there."""
    old = existing(notes)
    return F.when(old == "", note).when(old.contains(note), old).otherwise(F.concat(F.regexp_replace(old, r"[.;]\s*$", "") if by == ". " else old, F.lit(by), note))


def activity_text(title: Column, outlet: Column, day: Column, url: Column) -> Column:
    return F.concat(title, F.lit(" ("), outlet, F.lit(", "), day, F.lit(") — "), url)


def parse_activity(c: Column) -> dict[str, Column]:
    form = r"^(.*) \(([^()]*), ([0-9]{4}-[0-9]{2}-[0-9]{2})\) — (\S+)$"
    return {name: F.regexp_extract(existing(c), form, i) for i, name in enumerate(("title", "outlet", "date", "url"), 1)}


def regulatory_assets(c: Column) -> Column:
    """Total (c) of a filing's regulatory assets, commas removed; '' without."""
    return F.regexp_replace(F.regexp_extract(existing(c), r"(?is)Regulatory Assets Under Management.*?Total:\s*\(c\)\s*\$\s*([0-9,]+)", 1), ",", "")


def fee_labels(c: Column) -> Column:
    return F.concat_ws("; ", *(F.when(F.lower(existing(c)).rlike(p), F.lit(k)) for k, p in FEE_PATTERNS.items()))


def bar(n: Column, width: int = BAR_WIDTH) -> Column:
    full = F.least(F.greatest(n, F.lit(0)), F.lit(width)).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), F.lit(width) - full))


def claim_id(record: Column, field: Column) -> Column:
    return F.concat(record.cast("string"), F.lit("_augmented_"), F.regexp_replace(field, "[^A-Za-z0-9]", "_"))


def search_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(existing(c)), F.lit(r"[a-z0-9@._'\-]+"), F.lit(0))


def sensitive_tokens(c: Column) -> Column:
    t = existing(c)
    found = [F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in (r"[\w.+-]+@[\w-]+\.[\w.-]+", r"\+?[0-9][0-9() .-]{6,}[0-9]", r"https?://[^\s)]+")]
    return F.array_distinct(F.concat(*found))


def sentences(c: Column) -> Column:
    """Split after . ! ? before white space and a capital."""
    return F.split(F.regexp_replace(existing(c), r"\s+", " "), r"(?<=[.!?]) (?=[A-Z])")


def snippet(c: Column, keywords: str, most: int = 600) -> Column:
    """First sentence with a keyword, else the beginning."""
    flat = F.regexp_replace(existing(c), r"\s+", " ")
    hit = F.try_element_at(F.filter(sentences(c), lambda s: F.lower(s).rlike(keywords)), F.lit(1))
    return F.substring(F.coalesce(hit, flat), 1, most)


def without_markdown(c: Column) -> Column:
    """Images go, links become their text, heading marks and short list lines go, marks become spaces."""
    t = existing(c)
    for pattern, by in ((r"!\[[^\]]*\]\([^)]*\)", " "), (r"\[([^\]]+)\]\([^)]*\)", "$1"), (r"(?m)^#+\s*", ""), (r"(?m)^\s*[-*]\s+.{0,40}$", " "), (r"[\\_*`>]", " "), (r"\s+", " ")):
        t = F.regexp_replace(t, pattern, by)
    return strip(t)
