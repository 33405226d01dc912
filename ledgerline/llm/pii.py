"""Personal data by patterns, checksums and context (operator 4), in native column expressions only.

A regular expression proposes the spans of each kind, leftmost first and without overlap; a validator (number ranges,
digit counts, Luhn, mod-97) drops those that fail; words near a span raise or lower its score. Positions are code points,
got from the pieces between matches, which split() gives, and the matches themselves.

The patterns are possessive and tied to the start of a run, so that no text takes quadratic time or deep recursion; they match
what the plain forms in FORMS match. IBANs and assigned secrets (a name such as token or password, a sign, and a value of 16 or more
letters and digits mixed, however long) are the kinds that the method adds; an IBAN ends where its country's length ends; the base kinds stay as they are. Every span carries its score, and
whether it reaches the threshold: what masks or drops documents reads that.

Defined results: a null or empty text has no span; a text of any length is read whole; a score that ties with the threshold is
likely; repeated rows each have theirs; an empty table gives an empty table; extra columns of any name stay, but for one named pii, which
is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried

#: The plain forms of the base kinds.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE_KINDS = tuple(FORMS)
KINDS = (*BASE_KINDS, "iban", "secret")
#: The length of an IBAN by its country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBANS = "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
#: Other countries: the whole run.
_OTHER_IBANS = rf"(?!{'|'.join(x for c in IBAN_LENGTHS.values() for x in c.split())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}"
#: A match can begin at the start of a run or where the last match ended (\G). Card numbers: a chain of 16 to 19 digits, all of it.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": FORMS["phone"],
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBANS}|{_OTHER_IBANS})(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key)(?![A-Za-z0-9])[\x20\x22']{0,2}[:=][\x20\x22']{0,2}[A-Za-z0-9_+/=-]{16,}+",
}
#: Base score, and words (lower case) within WINDOW characters that raise it.
_SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.8, "secret": 0.8}
_CONTEXT = {
    "email": "mail|contact|reach|write",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|credit|payment|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|bank|account|konto|cuenta|compte",
    "secret": "key|auth|login|credential|private|config",
}
_AGAINST = "version|order|sku|serial|build"
WINDOW = 40


def _spans(text: Column, pattern: str, matches: Column) -> Column:
    """array<struct<start,end,value>> of the matches, by the lengths of what lies between them."""
    kind = "struct<pos:bigint,found:array<struct<start:bigint,end:bigint,value:string>>>"
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("value"))

    def add(acc: Column, pair: Column) -> Column:
        start = acc["pos"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        return F.struct(end.cast("bigint").alias("pos"), F.array_append(acc["found"], F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), pair["value"].alias("value"))).alias("found")).cast(kind)

    empty = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<struct<start:bigint,end:bigint,value:string>>").alias("found")).cast(kind)
    return F.aggregate(pairs, empty, add)["found"]


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (blanks allowed) leaves remainder 1."""
    plain = F.regexp_replace(iban, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(add(a, c))) == 1


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, r"[^0-9]", "")
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, r"\x20", "")).between(15, 34) & mod97(value)
    if kind == "secret":
        given = F.regexp_extract(value, r"[:=][\x20\x22']{0,2}([A-Za-z0-9_+/=-]+)$", 1)
        return given.rlike("[0-9]") & given.rlike("[A-Za-z]")
    return F.lit(True)


def _score(kind: str, text: Column, span: Column) -> Column:
    before = F.substring(text, F.greatest(span["start"] - WINDOW + 1, F.lit(1)).cast("int"), F.least(span["start"], F.lit(WINDOW)).cast("int"))
    near = F.lower(F.concat_ws(" ", before, F.substring(text, (span["end"] + 1).cast("int"), F.lit(WINDOW))))
    lift = F.when(near.rlike(rf"\b(?:{_CONTEXT[kind]})"), 0.2).otherwise(0.0) - F.when(near.rlike(rf"\b(?:{_AGAINST})\b"), 0.2).otherwise(0.0)
    return F.round(F.least(F.greatest(F.lit(_SCORES[kind]) + lift, F.lit(0.0)), F.lit(1.0)), 2)


def _maybe(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match of the kind passes."""
    if kind == "email":
        return text.contains("@")
    if kind == "iban":
        return text.rlike("[A-Z]{2}[0-9]{2}")
    if kind == "secret":
        return text.rlike("[:=]") & text.rlike("(?i)token|secret|passw|key")
    return text.contains("+") if kind == "phone" else F.lit(True)


def find_pii(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs with pii: array<struct<kind,start,end,value,score,likely>>, by kind in order of KINDS, then start."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    out = carried(docs).withColumns({f"m_{k}": F.when(_maybe(k, text), F.regexp_extract_all(text, F.lit(_PATTERNS[k]), F.lit(0))).otherwise(none) for k in KINDS})
    no_span = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def proved(k: str) -> Column:
        return F.when(F.size(f"m_{k}") > 0, F.filter(_spans(text, _PATTERNS[k], F.col(f"m_{k}")), lambda s: _valid(k, s["value"]))).otherwise(no_span)

    def scored(k: str) -> Column:
        spans = F.transform(f"s_{k}", lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _score(k, text, s).alias("score")))
        return F.transform(spans, lambda s: s.withField("likely", s["score"] >= threshold))

    out = out.withColumns({f"s_{k}": proved(k) for k in KINDS})
    return out.withColumn("pii", F.concat(*[scored(k) for k in KINDS])).select(F.col("row"), "pii").select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "pii"], "pii")


def _named(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The counts and spans of every document; scores: the score of each span in the order of spans; n_likely: how many reach the threshold."""
    p = F.col("pii")
    count = lambda k: F.size(F.filter(p, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter(p, lambda s: s["kind"].isin(*BASE_KINDS))
    scores = F.array_join(F.transform(p, lambda s: F.format_number(s["score"], 2)), ",")
    return find_pii(docs.select("doc_id", "text"), threshold).select(
        "doc_id", *(count(k) for k in BASE_KINDS), F.sha2(_named(base), 256).alias("base_sha256"), _named(p).alias("spans"),
        *(count(k) for k in KINDS if k not in BASE_KINDS), scores.alias("scores"), F.size(F.filter(p, lambda s: s["likely"])).cast("long").alias("n_likely"),
    )
