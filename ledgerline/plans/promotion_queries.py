"""Queries that promote values of several sources onto records made of customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import survivorship as P
from ..operators.ranking import top_per_key
from ..operators.sequences import seniority
from .registry import query

_RECORDS = """r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 31 = 0 THEN '' ELSE 'https://www.D' || c_custkey || '.test/home' END AS website_url, CASE c_custkey % 4 WHEN 0 THEN '(203) 555-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') WHEN 1 THEN '+1 203 555 ' || lpad((c_custkey % 10000)::VARCHAR, 4, '0')
  WHEN 2 THEN '1112223333' ELSE '' END AS primary_phone, CASE WHEN c_custkey % 6 = 1 THEN 'Existing' ELSE '' END AS google_places_category, CASE WHEN c_custkey % 5 = 2 THEN '1 Own Street' ELSE ' ' END AS street_address FROM customer)"""
_PLACES = """p AS (SELECT o_custkey AS k, o_orderkey AS n, o_orderstatus = 'P' AS closed, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'https://maps.test/' || o_orderkey END AS url, '(203) 555-' || lpad((o_custkey % 10000)::VARCHAR, 4, '0') AS phone, o_orderpriority AS category, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderkey || ' Map Road' END AS street FROM orders)"""
_COMPANY = """e AS (SELECT user_id AS k, event_id AS n, CASE WHEN event_type IN ('click', 'view') THEN 'https://www.linkedin.com/company/u' || event_id ELSE 'https://www.linkedin.com/in/u' || event_id END AS url, event_type AS industry, CASE WHEN event_id % 2 = 0 THEN event_id || ' Page Lane' ELSE '' END AS street FROM events)"""


def _records(t):
    k = F.col("c_custkey")
    tail = F.lpad((k % 10000).cast("string"), 4, "0")
    phone = F.when(k % 4 == 0, F.concat(F.lit("(203) 555-"), tail)).when(k % 4 == 1, F.concat(F.lit("+1 203 555 "), tail)).when(k % 4 == 2, "1112223333").otherwise("")
    return t("customer").select(
        k.alias("k"), F.when(k % 31 == 0, "").otherwise(F.concat(F.lit("https://www.D"), k, F.lit(".test/home"))).alias("website_url"), phone.alias("primary_phone"),
        F.when(k % 6 == 1, "Existing").otherwise("").alias("google_places_category"), F.when(k % 5 == 2, "1 Own Street").otherwise(" ").alias("street_address"),
    )


def _host(k):
    return F.concat(F.lit("d"), k, F.lit(".test"))


def _places(t):
    n, k = F.col("o_orderkey"), F.col("o_custkey")
    return t("orders").select(
        n.alias("at"), F.when(n % 2 == 0, F.concat(F.lit("http://"), _host(k), F.lit("/x"))).otherwise(_host(k)).alias("website"), (F.col("o_orderstatus") == "P").alias("permanently_closed"), F.lit(None).cast("string").alias("temporarily_closed"),
        F.when(n % 9 == 0, " ").otherwise(F.concat(F.lit("https://maps.test/"), n)).alias("url"), F.when(n % 4 == 0, None).otherwise(F.concat(F.lit("(203) 555-"), F.lpad((k % 10000).cast("string"), 4, "0"))).alias("phone"),
        F.concat(F.lit("(203) 555-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone_unformatted"), F.concat(n, F.lit(".0")).alias("reviews_count"), ((n % 50) / 10).cast("string").alias("total_score"),
        F.col("o_orderpriority").alias("category_name"), F.when(n % 3 == 0, "").otherwise(F.concat(n, F.lit(" Map Road"))).alias("street"),
    )


def _company(t):
    n = F.col("event_id")
    url = F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit("https://www.linkedin.com/company/u"), n)).otherwise(F.concat(F.lit("https://www.linkedin.com/in/u"), n))
    return t("events").select(
        n.alias("at"), F.concat(F.lit("https://"), _host(F.col("user_id"))).alias("website"), url.alias("linkedinUrl"), F.concat(n, F.lit(".0")).alias("employeeCount"), F.lit(None).cast("string").alias("followerCount"),
        F.concat(F.lit("['a"), n, F.lit("', ' ', 'b']")).alias("specialties"), F.lit("11-50").alias("companySize"), F.col("event_type").alias("industry"), F.lit("1999.0").alias("foundedYear"),
        F.when(n % 2 == 0, F.concat(n, F.lit(" Page Lane"))).otherwise("").alias("street"), F.lit("Here").alias("city"), F.lit("nan").alias("state"), F.lit(" ").alias("country"), F.lit("00100").alias("postalCode"),
    )


def _site():
    from ..functions import urls as U

    return U.domain(F.col("website_url"), "any")


@query("promote_places", f"""
WITH {_RECORDS}, {_PLACES}, f AS (SELECT * FROM p WHERE NOT closed QUALIFY row_number() OVER (PARTITION BY k ORDER BY n) = 1), j AS (SELECT r.*, n, phone, category, url FROM r LEFT JOIN f ON f.k = r.k AND website_url <> '' AND url <> '')
SELECT k, CASE WHEN n IS NULL THEN '' ELSE phone END AS google_places_phone, CASE WHEN n IS NULL THEN '' ELSE n::VARCHAR END AS google_places_reviews_count, CASE WHEN n IS NULL THEN '' ELSE printf('%.1f', (n % 50) / 10.0) END AS google_places_rating,
  CASE WHEN google_places_category <> '' THEN google_places_category WHEN n IS NULL THEN '' ELSE category END AS google_places_category, coalesce(url, '') AS google_places_evidence_url, CASE WHEN n IS NULL THEN '' ELSE 'google_places_domain_match' END AS google_places_confidence,
  CASE WHEN n IS NULL OR primary_phone = '' THEN '' WHEN k % 4 = 2 THEN 'False' ELSE 'True' END AS phone_corroborated FROM j""")
def promote_places(t):
    """The first open listing of a record's domain; five cells, and whether its phone is the record's."""
    out = P.fold(_records(t), _site(), [(P.places(), _places(t))])
    agrees = F.when(P.wrote("google_places"), P.phone_agrees(F.col("primary_phone"), F.col("google_places_phone"))).otherwise("")
    return out.select("k", "google_places_phone", "google_places_reviews_count", "google_places_rating", "google_places_category", "google_places_evidence_url", "google_places_confidence", agrees.alias("phone_corroborated"))


@query("promote_company", f"""
WITH {_RECORDS}, {_COMPANY}, f AS (SELECT * FROM e WHERE contains(url, '/company/') QUALIFY row_number() OVER (PARTITION BY k ORDER BY n) = 1), j AS (SELECT r.k, n, industry, url, street FROM r LEFT JOIN f ON f.k = r.k AND website_url <> '')
SELECT k, coalesce(n::VARCHAR, '') AS linkedin_employee_count, '' AS linkedin_follower_count, CASE WHEN n IS NULL THEN '' ELSE 'a' || n || '; b' END AS linkedin_specialties, coalesce(industry, '') AS linkedin_industry, CASE WHEN n IS NULL THEN '' ELSE '1999' END AS linkedin_founded_year,
  CASE WHEN n IS NULL THEN '' ELSE concat_ws(', ', nullif(street, ''), 'Here', '00100') END AS linkedin_headquarters_full, coalesce(url, '') AS linkedin_evidence_url, CASE WHEN n IS NULL THEN '' ELSE 'linkedin_company_page' END AS linkedin_confidence FROM j""")
def promote_company(t):
    """The first company page of a record's domain; pages of persons don't count."""
    out = P.fold(_records(t), _site(), [(P.company(), _company(t))])
    return out.select("k", "linkedin_employee_count", "linkedin_follower_count", "linkedin_specialties", "linkedin_industry", "linkedin_founded_year", "linkedin_headquarters_full", "linkedin_evidence_url", "linkedin_confidence")


@query("promote_social", f"""
WITH {_RECORDS}, f AS (SELECT o_custkey AS k, o_orderkey AS n FROM orders QUALIFY row_number() OVER (PARTITION BY k ORDER BY n) = 1), j AS (SELECT r.k, n FROM r LEFT JOIN f ON f.k = r.k AND website_url <> '')
SELECT k, CASE WHEN n % 3 = 0 THEN 'https://x.com/a' || n WHEN n % 3 = 1 THEN 'https://twitter.com/b' || n ELSE '' END AS twitter_url, CASE WHEN n % 2 = 0 THEN 'https://www.facebook.com/f' || n ELSE '' END AS facebook_url, '' AS youtube_url,
  CASE WHEN n % 3 < 2 OR n % 2 = 0 THEN 'https://d' || k || '.test' ELSE '' END AS social_media_evidence_url, CASE WHEN n % 3 < 2 OR n % 2 = 0 THEN 'linked_from_official_site' ELSE '' END AS social_media_confidence FROM j""")
def promote_social(t):
    """The first page of each platform that is at one of its hosts."""
    n, k = F.col("o_orderkey"), F.col("o_custkey")
    tweets = F.when(n % 3 == 0, F.concat(F.lit("['https://elsewhere.test/x', 'https://x.com/a"), n, F.lit("']"))).when(n % 3 == 1, F.concat(F.lit("https://twitter.com/b"), n)).otherwise("[]")
    books = F.when(n % 2 == 0, F.concat(F.lit("['https://www.facebook.com/f"), n, F.lit("', 'https://fb.com/second']"))).otherwise("https://example.test/facebook")
    raw = t("orders").select(n.alias("at"), F.when(n % 5 == 0, " ").otherwise(F.concat(F.lit("https://"), _host(k))).alias("originalStartUrl"), _host(k).alias("domain"), tweets.alias("twitters"), F.lit("").alias("instagrams"), books.alias("facebooks"), F.lit(None).cast("string").alias("youtubes"), F.lit("x").alias("tiktoks"))
    out = P.fold(_records(t), _site(), [(P.social(), raw)])
    return out.select("k", "twitter_url", "facebook_url", "youtube_url", "social_media_evidence_url", "social_media_confidence")


@query("promote_address", f"""
WITH {_RECORDS}, {_PLACES}, {_COMPANY}, a AS (SELECT * FROM p WHERE NOT closed AND street <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY n) = 1), b AS (SELECT * FROM e WHERE contains(url, '/company/') AND street <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY n) = 1),
j AS (SELECT r.k, trim(street_address) AS own, a.street AS s1, a.url AS u1, b.street AS s2, b.url AS u2 FROM r LEFT JOIN a ON a.k = r.k AND website_url <> '' LEFT JOIN b ON b.k = r.k AND website_url <> '')
SELECT k, coalesce(nullif(own, ''), s1, s2, '') AS street_address, CASE WHEN own <> '' THEN '' WHEN s1 IS NOT NULL THEN u1 ELSE coalesce(u2, '') END AS street_address_evidence_url,
  CASE WHEN own <> '' THEN '' WHEN s1 IS NOT NULL THEN 'google_places_domain_match' WHEN s2 IS NOT NULL THEN 'linkedin_company_page' ELSE '' END AS street_address_confidence,
  CASE WHEN own <> '' THEN 'record' WHEN s1 IS NOT NULL THEN 'places_street' WHEN s2 IS NOT NULL THEN 'company_street' END AS chosen,
  CASE WHEN own <> '' THEN (s1 IS NOT NULL)::INTEGER + (s2 IS NOT NULL)::INTEGER WHEN s1 IS NOT NULL THEN (s2 IS NOT NULL)::INTEGER ELSE CASE WHEN s2 IS NOT NULL THEN 0 END END AS conflicts FROM j""")
def promote_address(t):
    """A listing's street, else a company page's, on records without one; where the value is from, and how many sources have another."""
    here, there = P.addresses()
    out = P.fold(_records(t), _site(), [(here, _places(t)), (there, _company(t))])
    cell = F.col("cells")["street_address"]
    return out.select("k", "street_address", "street_address_evidence_url", "street_address_confidence", cell["source"].alias("chosen"), cell["other"].alias("conflicts"))


_ROLES = ("Founder", "Chair of the board", "President", "CIO", "Managing Director", "Partner", "", "Gardener")
_RANKS = (1, 2, 3, 4, 5, 7, 999, 999)


@query("promote_principals", f"""
WITH o AS (SELECT o_custkey AS k, 'Person ' || o_orderkey AS name, [{', '.join(f"'{r}'" for r in _ROLES)}][o_orderkey % 8 + 1] AS role, [{', '.join(map(str, _RANKS))}][o_orderkey % 8 + 1] AS rank, 'https://t.test/' || o_orderkey AS url FROM orders),
s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rank, lower(name), name, role, url) AS slot FROM o QUALIFY slot <= 3),
r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 1 THEN 'Kept Name' ELSE '' END AS first FROM customer)
SELECT r.k, CASE WHEN first <> '' THEN first ELSE coalesce(a.name, '') END AS principal_1_name, CASE WHEN first <> '' THEN '' ELSE coalesce(a.role, '') END AS principal_1_role, CASE WHEN first <> '' OR a.name IS NULL THEN '' ELSE 'corporate_team_page' END AS principal_1_confidence,
  coalesce(b.name, '') AS principal_2_name, coalesce(b.role, '') AS principal_2_role, coalesce(c.name, '') AS principal_3_name, coalesce(c.url, '') AS principal_3_source_url
FROM r LEFT JOIN s a ON a.k = r.k AND a.slot = 1 LEFT JOIN s b ON b.k = r.k AND b.slot = 2 LEFT JOIN s c ON c.k = r.k AND c.slot = 3""")
def promote_principals(t):
    """The three most senior people, by rank of role and name; a slot that has a name uses its person up."""
    role = F.element_at(F.array(*map(F.lit, _ROLES)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    people = t("orders").select(F.col("o_custkey").alias("k"), F.concat(F.lit("Person "), F.col("o_orderkey")).alias("name"), role.alias("role"), F.concat(F.lit("https://t.test/"), F.col("o_orderkey")).alias("source_url")).withColumn("rank", seniority(F.col("role")))
    # Only the first three people of a record can fill a slot; they are picked before the record's people meet.
    people = top_per_key(people, ["k"], 3, "slot", F.col("rank"), F.lower("name"), F.col("name"), F.col("role"), F.col("source_url"))
    records = t("customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 1, "Kept Name").otherwise("").alias("principal_1_name"))
    out = P.fill_slots(records, "k", people)
    return out.select("k", "principal_1_name", "principal_1_role", "principal_1_confidence", "principal_2_name", "principal_2_role", "principal_3_name", "principal_3_source_url")


@query("promote_news", """
WITH s AS (SELECT user_id AS k, event_id AS n, strftime(ts, '%Y-%m-%d') AS day, event_type FROM events WHERE event_type IN ('purchase', 'signup') QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
r AS (SELECT c_custkey AS k, c_custkey % 7 = 1 AS has, c_custkey % 7 = 2 AS odd, c_custkey % 5 = 0 AS noted FROM customer), j AS (SELECT r.*, n, day, event_type FROM r LEFT JOIN s USING (k))
SELECT k, CASE WHEN has THEN 'Old news (The Paper, 2025-02-03) — https://p.test/' || k WHEN odd THEN 'free text' WHEN n IS NULL THEN '' ELSE 'Title ' || n || ' (' || CASE WHEN n % 2 = 0 THEN 'Outlet' ELSE 'news' END || ', ' || day || ')' || CASE WHEN n % 3 = 0 THEN '' ELSE ' — https://n.test/' || n END END AS recent_activity,
  CASE WHEN has THEN '2025-02-03' WHEN odd OR n IS NULL THEN '' ELSE day END AS recent_activity_date, CASE WHEN has THEN 'Kept' WHEN odd OR n IS NULL OR n % 2 = 1 THEN '' ELSE 'Outlet' END AS recent_activity_outlet,
  CASE WHEN has THEN 'https://p.test/' || k WHEN odd OR n IS NULL OR n % 3 = 0 THEN '' ELSE 'https://n.test/' || n END AS recent_activity_url, CASE WHEN odd THEN '' WHEN has OR n IS NOT NULL THEN 'news' ELSE 'none_found' END AS recent_activity_type,
  CASE WHEN has THEN 'previously_promoted_news_signal' WHEN odd THEN '' WHEN n IS NOT NULL THEN 'name_token_date_filtered' ELSE 'no_qualifying_public_signal' END AS recent_activity_confidence,
  CASE WHEN has OR odd THEN CASE WHEN noted THEN 'check; no recent public signal as of 2026-01-01' ELSE '' END WHEN n IS NOT NULL THEN CASE WHEN noted THEN 'check' ELSE '' END
    ELSE CASE WHEN noted THEN 'check; no recent public signal as of 2026-01-01; no recent public signal as of 2026-05-17' ELSE 'no recent public signal as of 2026-05-17' END END AS uncertainty_notes FROM j""")
def promote_news(t):
    """What is there stays and is read for details; the latest signal fills six columns; none is said, with the day."""
    n, k = F.col("event_id"), F.col("c_custkey")
    rows = t("events").where(F.col("event_type").isin("purchase", "signup"))
    latest = rows.groupBy(F.col("user_id").alias("k")).agg(F.max(F.struct("ts", "event_id")).alias("s")).select("k", F.col("s.event_id").alias("event_id"), F.date_format("s.ts", "yyyy-MM-dd").alias("pub_date"))
    signals = latest.select("k", F.concat(F.lit("Title "), n).alias("title"), F.when(n % 2 == 0, "Outlet").alias("source_name"), F.when(n % 3 == 0, None).otherwise(F.concat(F.lit("https://n.test/"), n)).alias("url"), "pub_date")
    has = k % 7 == 1
    own = F.when(has, F.concat(F.lit("Old news (The Paper, 2025-02-03) — https://p.test/"), k)).when(k % 7 == 2, "free text").otherwise("")
    records = t("customer").select(k.alias("k"), own.alias("recent_activity"), F.when(has, "Kept").otherwise("").alias("recent_activity_outlet"), F.when(k % 5 == 0, "check; no recent public signal as of 2026-01-01").otherwise("").alias("uncertainty_notes"))
    return P.news(records, "k", signals, "2026-05-17")
