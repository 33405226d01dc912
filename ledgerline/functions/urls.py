"""URL, domain and source-type expressions. Hosts come from patterns, not parse_url(), which fails on odd hosts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .blanks import existing

#: Hosts of regulators, of the company registry, and of press.
REGULATOR_HOSTS = ("adviserinfo.sec.gov", "reports.adviserinfo.sec.gov", "files.adviserinfo.sec.gov")
REGISTRY_HOSTS = ("find-and-update.company-information.service.gov.uk",)
PRESS_HOSTS = ("businesswire.com",)
#: Hosts of social platforms.
SOCIAL_HOSTS = ("twitter.com", "x.com", "instagram.com", "facebook.com", "youtube.com", "youtu.be", "tiktok.com")


def domain(url: Column, scheme: str = "required", lower: bool = True, keep_www: bool = False) -> Column:
    """Host of a URL without www. What happens without a scheme: required -> '', any -> taken as a host,
    dotted -> taken as a host if the text has a dot."""
    u = existing(url)
    full = F.when(u.contains("://"), u)
    if scheme == "any":
        full = full.when(u != "", F.concat(F.lit("http://"), u))
    elif scheme == "dotted":
        full = full.when(u.contains("."), F.concat(F.lit("http://"), u))
    host = F.regexp_extract(F.coalesce(full, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(host) if lower else host
    return host if keep_www else F.regexp_replace(host, r"^www\.", "")


def evidence_domain(url: Column) -> Column:
    """Host of a URL; local report and data paths have none."""
    u = existing(url)
    return F.when(u.startswith("reports/") | u.startswith("data/"), F.lit("")).otherwise(domain(u, "any"))


def domain_base(url: Column) -> Column:
    """Letters and digits of the host without its last label."""
    return F.regexp_replace(F.regexp_replace(domain(url, "any"), r"\.[^.]*$", ""), "[^a-z0-9]", "")


def canonical(url: Column) -> Column:
    """Without fragment and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(existing(url), "#.*$", ""), "/+$", "")


def audit_form(url: Column) -> Column:
    """Scheme and host in lower case without www., no trailing slash, query and fragment kept; a path that is no URL
    loses leading dots and slashes."""
    u = existing(url)
    head = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/?#]*", 1))
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.regexp_replace(path, "/+$", "")
    tail = F.regexp_extract(u, r"^[^?#]*([?#].*)$", 1)
    local = F.regexp_replace(F.regexp_replace(u, r"\\", "/"), r"^[./]+", "")
    return F.when(head != "", F.concat(head, domain(u), F.when(path == "", F.lit("/")).otherwise(path), tail)).otherwise(local)


def at_host(host: Column, hosts: tuple[str, ...]) -> Column:
    """Whether a host is one of hosts or below one."""
    test = host.isin(*hosts)
    for h in hosts:
        test = test | host.endswith(f".{h}")
    return test


def source_type(source: Column, site: Column, registry: str = "sec.gov") -> Column:
    s, w = domain(source), domain(site)
    pdf = F.lower(existing(source)).endswith(".pdf")
    return (
        F.when(s == w, F.when(pdf, F.lit("official_disclosure")).otherwise(F.lit("official_site")))
        .when(s.isin(*REGULATOR_HOSTS), F.lit("regulator"))
        .when(s.isin(*REGISTRY_HOSTS), F.lit("registry"))
        .when(s.isin(*PRESS_HOSTS), F.lit("press_release"))
        .otherwise(F.lit("secondary_source"))
    )


def source_rank(kind: Column) -> Column:
    return F.when(kind.isin("official_site", "official_disclosure", "regulator", "registry"), F.lit("primary")).when(kind == "press_release", F.lit("secondary")).otherwise(F.lit("tertiary"))


def claim_source_type(source: Column, site: Column) -> Column:
    """Another taxonomy for claims: ordered, partly by substrings of the host, with names for local artifacts."""
    u, host = existing(source), domain(source, "any")
    return (
        F.when(u == "", F.lit("unknown"))
        .when(u.startswith("reports/"), F.lit("methodology"))
        .when(u.startswith("data/"), F.lit("local_evidence_artifact"))
        .when(host == domain(site, "any"), F.lit("official_site"))
        .when(host.contains("linkedin.com"), F.lit("linkedin"))
        .when(host.contains("adviserinfo.sec.gov"), F.lit("regulator"))
        .when(host.contains("google.com"), F.lit("google_places"))
        .when(host.isin(*SOCIAL_HOSTS), F.lit("social_platform"))
        .otherwise(F.lit("secondary_source"))
    )


def quality(ok: Column, code: Column) -> Column:
    n = code.try_cast("double").cast("int")
    return (
        F.when(~ok, F.lit("Failed"))
        .when(n.isNull(), F.lit("Unknown"))
        .when(n == 200, F.lit("Highest"))
        .when(n.between(201, 299), F.lit("High"))
        .when(n.between(300, 399), F.lit("Medium"))
        .when(n.between(400, 499), F.lit("Low"))
        .otherwise(F.lit("Failed"))
    )


def url_list(cell: Column) -> Column:
    """URLs of a cell: a list literal, or parts between ; and line feeds; a bare http text is itself. First seen, distinct."""
    t = existing(cell)
    literal = F.from_json(t, "array<string>", {"allowSingleQuotes": "true"})
    parts = F.split(t, r"[;\n]")
    raw = F.when(t.startswith("["), F.coalesce(literal, F.array().cast("array<string>"))).otherwise(parts)
    return F.array_distinct(F.filter(F.transform(raw, existing), lambda u: u != ""))


def parsed_urls(cell: Column) -> Column:
    """URLs of a cell: a list literal, parts between bars, parts between commas where it names a protocol, else the whole text."""
    t = existing(cell)
    listed = F.from_json(t, "array<string>", {"allowSingleQuotes": "true"})
    whole = t.startswith("[") & t.endswith("]")
    quotes = lambda u: F.regexp_replace(existing(u), "^['\"]+|['\"]+$", "")
    raw = (
        F.when(whole, F.coalesce(F.transform(listed, existing), F.array().cast("array<string>")))
        .when(t.contains("|"), F.transform(F.split(t, r"\|"), existing))
        .when(t.contains(",") & t.contains("http"), F.transform(F.filter(F.split(t, ","), lambda u: existing(u) != ""), quotes))
        .otherwise(F.array(t))
    )
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.filter(raw, lambda u: u != ""))


def shown_urls(cell: Column) -> Column:
    """URLs of a cell as a page shows them: JSON first, then as parsed_urls() has it."""
    t = existing(cell)
    kind = F.schema_of_variant(F.try_parse_json(t))
    listed = F.filter(F.transform(F.from_json(t, "array<string>"), existing), lambda u: u != "")
    return F.when(t.startswith("[") & kind.startswith("ARRAY"), listed).otherwise(parsed_urls(cell))


def audited_urls(cell: Column) -> tuple[Column, Column, Column]:
    """URLs, the name of the cell's format, and what is wrong with it ('' if nothing): JSON, a list literal, parts, or one URL."""
    t, none = existing(cell), F.array().cast("array<string>")
    kind = F.schema_of_variant(F.try_parse_json(t))
    clean = lambda c: F.filter(F.transform(c, existing), lambda u: u != "")
    literal = F.from_json(F.regexp_replace(F.regexp_replace(t, r"^\(", "["), r",?\s*\)$", "]"), "array<string>", {"allowSingleQuotes": "true"})
    # A list literal whose elements are all quoted.
    quoted = t.rlike(r"""(?s)^[\[(]\s*(?:(?:'[^']*'|"[^"]*")\s*,?\s*)*[\])]$""") & literal.isNotNull()
    parts = t.contains(";") | t.contains("\n")
    one = t.rlike(r"^(?i:https?)://\S")
    name = (
        F.when(t == "", "empty").when(kind.isNotNull(), F.when(kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), "json_array").otherwise("invalid"))
        .when(quoted, "legacy_python_list").when(parts, "legacy_delimited").when(one, "legacy_single_url").otherwise("invalid")
    )
    urls = F.when(name == "json_array", clean(F.from_json(t, "array<string>"))).when(name == "legacy_python_list", clean(literal)).when(name == "legacy_delimited", clean(F.split(t, "[;\n]"))).when(name == "legacy_single_url", F.array(t)).otherwise(none)
    error = F.when(t == "", "source_urls is blank").when(kind.isNotNull() & (name == "invalid"), "source_urls JSON must be an array of strings").when(name == "invalid", "source_urls is not parseable").otherwise("")
    return F.coalesce(urls, none), name, error


def first_on(urls: Column, hosts: tuple[str, ...]) -> Column:
    """First URL whose host contains any of hosts."""

    def on(u: Column) -> Column:
        host = domain(u, "any")
        test = F.lit(False)
        for h in hosts:
            test = test | host.contains(h)
        return test

    return F.try_element_at(F.filter(urls, on), F.lit(1))


def brochure_url(identifier: Column) -> Column:
    return F.concat(F.lit("https://reports.adviserinfo.sec.gov/reports/ADV/"), identifier, F.lit("/PDF/"), identifier, F.lit(".pdf"))


def summary_url(identifier: Column) -> Column:
    return F.concat(F.lit("https://adviserinfo.sec.gov/firm/summary/"), identifier)


def is_loopback(url: Column) -> Column:
    """Whether a URL is plain http at this machine's own name or IPv4 address."""
    host = F.lower(F.regexp_extract(existing(url), r"^(?i:http)://(?:[^/?#@]*@)?([^:/?#]*)", 1))
    return host.isin("localhost", "127.0.0.1")
