"""Queries over lookups, promotion, scoring, windows and reshaping."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.blanks import blank_to_null, is_blank, is_filled, truth
from ..operators import sequences as S
from ..operators.evidence import all_matches, claims, filled_count, first_match, lookup, promote, replace_claims
from ..operators.ranking import top_per_key
from ..operators.validation import is_placeholder, record_errors
from ..sources import versions as V
from ..sources.numbered import read_numbered_csv
from .registry import query

_FIRST = "SELECT user_id, event_id, event_type, value FROM events {w} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id {d}) = 1"


@query("lookup_first", _FIRST.format(w="WHERE event_type <> 'error'", d="ASC"))
def lookup_first(t):
    return lookup(t("events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id", "first", F.col("event_type") != "error")


@query("lookup_last", _FIRST.format(w="", d="DESC"))
def lookup_last(t):
    return lookup(t("events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id", "last")


@query("lookup_family", """
SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type, arg_min(event_id, event_id) FILTER (WHERE event_type = 'purchase') AS first_purchase,
  arg_max(event_id, event_id) FILTER (WHERE event_type = 'purchase') AS last_purchase FROM events GROUP BY user_id""")
def lookup_family(t):
    buy = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return t("events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"), F.max_by("event_type", "event_id").alias("last_type"), F.min(buy).alias("first_purchase"), F.max(buy).alias("last_purchase"))


@query("promote_blank", """
WITH l AS (SELECT user_id, arg_max(event_type, event_id) AS kind, max(event_id) AS id FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY user_id)
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN kind IS NOT NULL THEN kind ELSE '' END AS segment,
  CASE WHEN c_custkey % 3 <> 0 AND kind IS NOT NULL THEN 'https://e.org/' || id ELSE '' END AS segment_evidence_url, CASE WHEN c_custkey % 3 <> 0 AND kind IS NOT NULL THEN 'last_event' ELSE '' END AS segment_confidence
FROM customer LEFT JOIN l ON user_id = c_custkey""")
def promote_blank(t):
    rows = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("segment"))
    found = lookup(t("events").select("user_id", "event_id", "event_type"), "user_id", "event_id", "last", F.col("event_type").isin("purchase", "signup"))
    both = rows.join(found.withColumnRenamed("user_id", "c_custkey"), "c_custkey", "left")
    out = promote(both, {"segment": F.col("event_type")}, F.concat(F.lit("https://e.org/"), F.col("event_id").cast("string")), "last_event", ("segment_evidence_url", "segment_confidence"))
    return out.select("c_custkey", "segment", "segment_evidence_url", "segment_confidence")


@query("promote_fallback", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'own' WHEN c_custkey % 4 = 1 THEN 'place' WHEN c_custkey % 4 = 2 THEN 'company' ELSE '' END AS street,
  CASE WHEN c_custkey % 4 = 1 THEN 'google_places' WHEN c_custkey % 4 = 2 THEN 'company_page' ELSE '' END AS street_confidence FROM customer""")
def promote_fallback(t):
    """Two sources in order of preference: the second only where the first left the cell blank."""
    k = F.col("c_custkey") % 4
    rows = t("customer").select("c_custkey", F.when(k == 0, F.lit("own")).otherwise(F.lit(" ")).alias("street"))
    out = promote(rows, {"street": F.when(k < 2, F.lit("place"))}, F.lit("u1"), "google_places", ("street_evidence_url", "street_confidence"))
    out = promote(out, {"street": F.when(k < 3, F.lit("company"))}, F.lit("u2"), "company_page", ("street_evidence_url", "street_confidence"))
    return out.select("c_custkey", "street", "street_confidence")


@query("registry_branch", """
WITH f AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS buys, count(*) FILTER (WHERE event_type = 'signup') AS ups FROM events GROUP BY user_id)
SELECT c_custkey, CASE WHEN buys > 0 AND ups > 0 THEN 'True' WHEN buys > 0 THEN '' ELSE 'False' END AS sec_registered, CASE WHEN buys > 0 AND ups > 0 THEN (c_custkey + 1000)::VARCHAR ELSE '' END AS sec_crd_number,
  CASE WHEN buys > 0 AND ups > 0 THEN CASE WHEN c_custkey % 9 = 0 THEN 'sec_authoritative_manual_review' ELSE 'sec_authoritative' END ELSE '' END AS sec_confidence,
  CASE WHEN coalesce(buys, 0) = 0 THEN 'No registration was accepted.' ELSE '' END AS note FROM customer LEFT JOIN f ON user_id = c_custkey""")
def registry_branch(t):
    """Registered with an id: values and confidence; registered without: nothing; else False and a note."""
    n = lambda k: F.count_if(F.col("event_type") == k)
    flags = t("events").groupBy(F.col("user_id").alias("c_custkey")).agg(n("purchase").alias("buys"), n("signup").alias("ups"))
    rows = t("customer").select("c_custkey").join(flags, "c_custkey", "left").na.fill(0)
    registered, identified = F.col("buys") > 0, (F.col("buys") > 0) & (F.col("ups") > 0)
    review = first_match([(F.col("c_custkey") % 9 == 0, "sec_authoritative_manual_review")], "sec_authoritative")
    return rows.select("c_custkey", first_match([(identified, "True"), (registered, "")], "False").alias("sec_registered"), F.when(identified, (F.col("c_custkey") + 1000).cast("string")).otherwise(F.lit("")).alias("sec_crd_number"), F.when(identified, review).otherwise(F.lit("")).alias("sec_confidence"), first_match([(registered, "")], "No registration was accepted.").alias("note"))


@query("parity_enrich", """
WITH o AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_day, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_custkey, '2026-05' AS validation_period, lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) || '.org' AS domain, CASE WHEN last_day IS NOT NULL THEN greatest(date_diff('day', last_day, DATE '1998-12-31'), 0) END::BIGINT AS age_days,
  CASE WHEN last_day IS NULL THEN '' WHEN date_diff('day', last_day, DATE '1998-12-31') <= 90 THEN 'fresh' WHEN date_diff('day', last_day, DATE '1998-12-31') <= 365 THEN 'moderate' ELSE 'stale' END AS recency,
  CASE WHEN c_custkey % 2 = 0 THEN 'no_secondary_evidence' ELSE 'info@a.org' END AS secondary_email, c_custkey % 5 = 0 AS phone_conflict FROM customer LEFT JOIN o ON o_custkey = c_custkey""")
def parity_enrich(t):
    last = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.to_date("o_orderdate")).alias("last_day"))
    rows = t("customer").join(last, "c_custkey", "left")
    days = X.age_days(F.col("last_day").cast("string"), "1998-12-31")
    days = F.when(F.col("last_day").isNotNull(), days)
    other = F.when(F.col("c_custkey") % 2 == 1, F.lit("info@a.org"))
    place = F.when(F.col("c_custkey") % 5 == 0, F.lit("+1 203 555 0101")).otherwise(F.lit("(203) 555-0100"))
    return rows.select("c_custkey", F.lit("2026-05").alias("validation_period"), F.concat(F.lower(F.regexp_replace("c_name", "[^A-Za-z0-9]", "")), F.lit(".org")).alias("domain"), days.cast("bigint").alias("age_days"), X.recency_label(days).alias("recency"), F.coalesce(blank_to_null(other), F.lit("no_secondary_evidence")).alias("secondary_email"), (~X.phones_match(F.lit("+12035550100"), place)).alias("phone_conflict"))


@query("latest_signal", """
WITH s AS (SELECT user_id, event_id, event_type, ts FROM events WHERE event_type IN ('purchase', 'signup') AND ts >= TIMESTAMP '2024-01-10' AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT c_custkey, coalesce(event_type, 'none_found') AS recent_activity, strftime(ts, '%Y-%m-%d') AS activity_date, event_id FROM customer LEFT JOIN s ON user_id = c_custkey""")
def latest_signal(t):
    signals = t("events").where(F.col("event_type").isin("purchase", "signup") & (F.col("ts") >= "2024-01-10") & F.col("value").isNotNull())
    latest = signals.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max(F.struct("ts", "event_id", "event_type")).alias("s"))
    return t("customer").select("c_custkey").join(latest, "c_custkey", "left").select("c_custkey", F.coalesce("s.event_type", F.lit("none_found")).alias("recent_activity"), F.date_format("s.ts", "yyyy-MM-dd").alias("activity_date"), F.col("s.event_id").alias("event_id"))


@query("row_score", """
WITH l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'N') AS ok, bool_or(l_linestatus = 'O') AS open FROM lineitem GROUP BY l_orderkey),
s AS (SELECT o_orderkey, n, ok, 8 + CASE WHEN o_orderstatus <> 'P' THEN 8 ELSE 0 END + CASE WHEN o_orderpriority <> '5-LOW' THEN 20 ELSE 0 END + CASE WHEN open THEN 12 ELSE 4 END + CASE WHEN n >= 2 THEN 12 ELSE 0 END
  + least(6 * coalesce(ok, 0), 18) + CASE WHEN o_totalprice > 200000 THEN 10 WHEN o_totalprice > 100000 THEN 6 ELSE 3 END + CASE WHEN o_totalprice > 50000 THEN 12 ELSE 0 END AS score, open FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
SELECT o_orderkey, least(score, 100)::BIGINT AS score, CASE WHEN score >= 80 THEN 'high' WHEN score >= 60 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN score >= 80 AND coalesce(open, false) AND coalesce(n, 0) >= 2 AND coalesce(ok, 0) >= 2 THEN 'accepted' ELSE 'needs_review' END AS status,
  concat_ws('; ', CASE WHEN NOT coalesce(open, false) THEN 'site not reachable' END, CASE WHEN coalesce(n, 0) < 2 THEN 'fewer than two sources' END, CASE WHEN coalesce(ok, 0) < 2 THEN 'fewer than two reachable sources' END) AS notes FROM s""")
def row_score(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "N").alias("ok"), F.bool_or(F.col("l_linestatus") == "O").alias("open"))
    rows = t("orders").join(lines, "o_orderkey", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "ok": F.coalesce("ok", F.lit(0)), "open": F.coalesce("open", F.lit(False))})
    points = lambda test, yes, no=0: F.when(test, F.lit(yes)).otherwise(F.lit(no))
    price = F.col("o_totalprice")
    score = F.lit(8) + points(F.col("o_orderstatus") != "P", 8) + points(F.col("o_orderpriority") != "5-LOW", 20) + points(F.col("open"), 12, 4) + points(F.col("n") >= 2, 12) + F.least(6 * F.col("ok"), F.lit(18)) + F.when(price > 200000, 10).when(price > 100000, 6).otherwise(3) + points(price > 50000, 12)
    rows = rows.withColumn("score", score)
    accepted = (F.col("score") >= 80) & F.col("open") & (F.col("n") >= 2) & (F.col("ok") >= 2)
    notes = all_matches([(~F.col("open"), "site not reachable"), (F.col("n") < 2, "fewer than two sources"), (F.col("ok") < 2, "fewer than two reachable sources")])
    return rows.select("o_orderkey", F.least("score", F.lit(100)).cast("bigint").alias("score"), first_match([(F.col("score") >= 80, "high"), (F.col("score") >= 60, "medium")], "low").alias("confidence"), first_match([(accepted, "accepted")], "needs_review").alias("status"), notes.alias("notes"))


@query("completion_score", """
WITH o AS (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS p FROM orders GROUP BY o_custkey),
s AS (SELECT c_custkey, 2 + CASE WHEN trim(c_name) <> '' THEN 1 ELSE 0 END + CASE WHEN c_custkey % 4 > 0 THEN 1 ELSE 0 END + CASE WHEN c_mktsegment IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN n IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN p IS NOT NULL THEN 1 ELSE 0 END AS score FROM customer LEFT JOIN o ON o_custkey = c_custkey)
SELECT c_custkey, score::BIGINT AS completion_text, repeat('█', score) || repeat('░', 31 - score) AS completion_visual FROM s""")
def completion_score(t):
    extra = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_orderpriority").alias("p"))
    odd = F.element_at(F.array(*map(F.lit, ("nan", "0", "False", "x"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    rows = t("customer").join(extra, "c_custkey", "left").withColumn("score", F.lit(2) + filled_count([F.col("c_name"), odd, F.col("c_mktsegment"), F.col("n"), F.col("p")]))
    return rows.select("c_custkey", F.col("score").cast("bigint").alias("completion_text"), X.bar(F.col("score")).alias("completion_visual"))


_RANK = "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN o_orderpriority = '2-HIGH' THEN 2 WHEN regexp_matches(o_orderpriority, 'MEDIUM') THEN 3 ELSE 999 END"


@query("role_rank_slots", f"""
WITH r AS (SELECT o_custkey, o_orderkey, o_orderpriority, {_RANK} AS rank FROM orders),
s AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY rank, o_orderkey) AS slot FROM r)
SELECT o_custkey, max(o_orderkey) FILTER (WHERE slot = 1) AS slot_1, max(o_orderkey) FILTER (WHERE slot = 2) AS slot_2, max(o_orderkey) FILTER (WHERE slot = 3) AS slot_3, max(o_orderpriority) FILTER (WHERE slot = 1) AS role_1 FROM s WHERE slot <= 3 GROUP BY o_custkey""")
def role_rank_slots(t):
    p = F.col("o_orderpriority")
    rank = F.when(p == "1-URGENT", 1).when(p == "2-HIGH", 2).when(p.rlike("MEDIUM"), 3).otherwise(999)
    top = top_per_key(t("orders").select("o_custkey", "o_orderkey", "o_orderpriority", rank.alias("rank")), ["o_custkey"], 3, "slot", F.col("rank"), F.col("o_orderkey"))
    at = lambda n, c: F.max(F.when(F.col("slot") == n, F.col(c)))
    return top.groupBy("o_custkey").agg(*(at(n, "o_orderkey").alias(f"slot_{n}") for n in (1, 2, 3)), at(1, "o_orderpriority").alias("role_1"))


@query("best_per_type", """
WITH r AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders),
p AS (SELECT *, CASE WHEN k = 1 AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE 1 END AS later FROM r)
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY later, o_totalprice DESC, o_orderkey)::BIGINT AS place FROM p QUALIFY place <= 3""")
def best_per_type(t):
    """The best of each preferred type first, then the best of the rest, three in all."""
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey", "o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    ranked = t("orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice", F.row_number().over(w).alias("k"))
    later = F.when((F.col("k") == 1) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 0).otherwise(1)
    return top_per_key(ranked.withColumn("later", later), ["o_custkey"], 3, "place", F.col("later"), F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "place")


@query("claims_unpivot", """
SELECT s_suppkey, field_name, claim_value FROM (SELECT s_suppkey, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE ' ' END AS nation, floor(s_acctbal)::BIGINT::VARCHAR AS balance FROM supplier JOIN nation ON n_nationkey = s_nationkey)
UNPIVOT (claim_value FOR field_name IN (name, nation, balance)) WHERE trim(claim_value) <> ''""")
def claims_unpivot(t):
    rows = t("supplier").join(F.broadcast(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select("s_suppkey", F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("n_name")).otherwise(F.lit(" ")).alias("nation"), F.floor("s_acctbal").cast("bigint").cast("string").alias("balance"))
    return claims(rows, "s_suppkey", ["name", "nation", "balance"])


@query("claims_replace", """
SELECT s_suppkey || '_name' AS claim_id, s_name AS claim_value FROM supplier UNION ALL SELECT s_suppkey || '_augmented_name', upper(s_name) FROM supplier""")
def claims_replace(t):
    s = t("supplier")
    key = F.col("s_suppkey").cast("string")
    seed = s.select(F.concat(key, F.lit("_name")).alias("claim_id"), F.col("s_name").alias("claim_value"))
    new = s.select(X.claim_id(F.col("s_suppkey"), F.lit("name")).alias("claim_id"), F.upper("s_name").alias("claim_value"))
    return replace_claims(replace_claims(seed, new), new)


@query("first_seen_distinct", """
SELECT user_id, event_type, min(event_id) AS first_event, row_number() OVER (PARTITION BY user_id ORDER BY min(event_id))::BIGINT AS appearance FROM events GROUP BY user_id, event_type""")
def first_seen_distinct(t):
    from pyspark.sql import Window

    seen = t("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_event"))
    return seen.withColumn("appearance", F.row_number().over(Window.partitionBy("user_id").orderBy("first_event")).cast("bigint"))


@query("longest_per_key", """
SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) = 1""")
def longest_per_key(t):
    pick = F.max(F.struct(F.length("text"), -F.col("doc_id"), "n_chars")).alias("m")
    return t("documents").groupBy("source").agg(pick).select("source", (-F.col("m.col2")).alias("doc_id"), F.col("m.n_chars").alias("n_chars"))


@query("nested_explode", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def nested_explode(t):
    return t("events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("array_anti", """
WITH o AS (SELECT o_custkey, unnest(list_concat(list(o_orderkey), [-1])) AS k FROM orders GROUP BY o_custkey)
SELECT o_custkey, k AS missing FROM o ANTI JOIN lineitem ON l_orderkey = k""")
def array_anti(t):
    """Elements of a list that a registry lacks."""
    lists = t("orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("ks")).select("o_custkey", F.explode(F.concat("ks", F.array(F.lit(-1).cast("bigint")))).alias("missing"))
    return lists.join(t("lineitem").select(F.col("l_orderkey").alias("missing")), "missing", "left_anti").select("o_custkey", "missing")


@query("url_fallback_match", """
WITH r AS (SELECT page_id, url AS k, 1 AS p FROM pages UNION ALL SELECT page_id, regexp_replace(url, '/+$', ''), 2 FROM pages UNION ALL SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', ''), 3 FROM pages UNION ALL SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') || '/', 4 FROM pages),
b AS (SELECT url AS k, max(page_id) AS target FROM pages GROUP BY url), m AS (SELECT page_id, target, p FROM r JOIN b USING (k) QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY p) = 1)
SELECT page_id, target, CASE p WHEN 1 THEN 'exact' WHEN 2 THEN 'no_slash' WHEN 3 THEN 'base' WHEN 4 THEN 'base_slash' ELSE 'unmatched' END AS matched_by FROM pages LEFT JOIN m USING (page_id)""")
def url_fallback_match(t):
    """The best of four keys: as is, without slash, without fragment, and that with a slash."""
    from ..functions import urls as U

    u = F.col("url")
    keys = F.array(u, F.regexp_replace(u, "/+$", ""), U.canonical(u), F.concat(U.canonical(u), F.lit("/")))
    build = t("pages").groupBy(u.alias("k")).agg(F.max("page_id").alias("target"))
    hits = t("pages").select("page_id", F.posexplode(keys).alias("p", "k")).join(build, "k").groupBy("page_id").agg(F.min(F.struct("p", "target")).alias("m"))
    name = first_match([(F.col("m.p") == i, n) for i, n in enumerate(("exact", "no_slash", "base", "base_slash"))], "unmatched")
    return t("pages").select("page_id").join(hits, "page_id", "left").select("page_id", F.col("m.target").alias("target"), name.alias("matched_by"))


@query("decision_apply", """
SELECT s_suppkey, CASE s_suppkey WHEN 1 THEN 'weak' WHEN 2 THEN 'relabel' ELSE 'pass' END AS verdict, CASE s_suppkey WHEN 1 THEN CASE WHEN s_suppkey % 2 = 1 THEN 'seen before; check the site' END WHEN 2 THEN 'brand' ELSE CASE WHEN s_suppkey % 2 = 1 THEN 'seen before' ELSE '' END END AS notes FROM supplier""")
def decision_apply(t):
    """Explicit verdicts by id, the default otherwise; notes are added once, however often it runs."""
    s = t("supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 1, F.lit("seen before")).otherwise(F.lit("")).alias("notes"))
    table = s.sparkSession.createDataFrame([(1, "weak", "check the site"), (2, "relabel", "brand")], "s_suppkey long, verdict string, note string")
    for _ in range(2):
        s = s.join(F.broadcast(table), "s_suppkey", "left").select("s_suppkey", F.coalesce("verdict", F.lit("pass")).alias("verdict"), F.when(F.col("note").isNotNull(), X.with_note(F.col("notes"), F.col("note"))).otherwise(F.col("notes")).alias("notes"))
        s = s if _ else s.drop("verdict")
    return s


@query("override_rows", """SELECT s_suppkey, CASE s_suppkey WHEN 3 THEN 'Curated Three' WHEN 5 THEN 'Curated Five' ELSE s_name END AS name FROM supplier""")
def override_rows(t):
    s = t("supplier")
    table = s.sparkSession.createDataFrame([(3, "Curated Three"), (5, "Curated Five")], "s_suppkey long, curated string")
    return s.join(F.broadcast(table), "s_suppkey", "left").select("s_suppkey", F.coalesce("curated", "s_name").alias("name"))


@query("schema_rules", """
SELECT o_orderkey, 'o_orderpriority' AS field, 'not_in_set' AS code FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') UNION ALL
SELECT o_orderkey, 'o_totalprice', 'too_small' FROM orders WHERE o_totalprice < 1000 UNION ALL SELECT o_orderkey, 'o_orderstatus', 'discovery_only' FROM orders WHERE o_orderstatus = 'P'""")
def schema_rules(t):
    """A row for each broken rule; all rules are tried in one pass."""
    rules = {("o_orderpriority", "not_in_set"): ~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), ("o_totalprice", "too_small"): F.col("o_totalprice") < 1000, ("o_orderstatus", "discovery_only"): F.col("o_orderstatus") == "P"}
    broken = F.array_compact(F.array(*(F.when(test, F.struct(F.lit(f).alias("field"), F.lit(c).alias("code"))) for (f, c), test in rules.items())))
    return t("orders").select("o_orderkey", F.explode(broken).alias("b")).select("o_orderkey", "b.*")


#: Texts with the judgement that the reference states for each, beside the documents.
_PLACEHOLDERS = (
    ("TBD", True), (" ToDo ", True), ("hidden", True), ("example.com", True), ("https://www.example.org/a", True), ("http://example.net", True), ("please write to www.example.com for help", False),
    ("https://example.com.evil.test/", False), ("https://notexample.org/", False), ("tbd later", False), ("", False),
)


@query("placeholder_reject", r"""
SELECT doc_id, v IN ('hidden', 'tbd', 'todo', 'dummy', 'example.com') OR regexp_extract(v, '^https?://(www\.)?([^/]*)', 2) IN ('example.com', 'example.org', 'example.net') AS rejected
FROM (SELECT doc_id, lower(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS v FROM documents) UNION ALL SELECT * FROM (VALUES """ + ", ".join(f"({-1 - i}, {want})" for i, (_, want) in enumerate(_PLACEHOLDERS)) + ")")
def placeholder_reject(t):
    """The whole text, stripped of white space, is a placeholder, or a URL at a placeholder host; literal texts with stated results stand beside."""
    docs = t("documents").select("doc_id", "text")
    literal = docs.sparkSession.createDataFrame([(-1 - i, v) for i, (v, _) in enumerate(_PLACEHOLDERS)], "doc_id long, text string")
    return docs.unionByName(literal).select("doc_id", is_placeholder(F.col("text")).alias("rejected"))


@query("record_validation", r"""
WITH c AS (SELECT c_custkey AS k, c_custkey // 400 AS bucket, c_name FROM customer),
r AS (SELECT k, bucket, CASE WHEN k % 50 = 7 THEN ' ' ELSE 'r' || k END AS id, CASE k % 9 WHEN 4 THEN 'Bank' WHEN 5 THEN '' ELSE 'unclear' END AS kind, CASE WHEN k % 23 = 1 THEN 'TBD' END AS tbd, k % 13 = 2 AS ftp, k % 17 = 3 AS example, k % 19 = 5 AS one, k % 29 = 6 AS mail,
  1 + (k % 3 = 0)::INTEGER + 2 * (k % 5 = 0)::INTEGER AS n_lines FROM c),
p AS (SELECT *, row_number() OVER w + 1 AS row_no, 2 + coalesce(sum(n_lines) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_no FROM r WINDOW w AS (PARTITION BY bucket ORDER BY k)),
e AS (SELECT *, list_filter([CASE WHEN trim(id) = '' THEN ['record_id', 'blank'] END, CASE WHEN kind <> 'unclear' THEN ['family_office_type', 'not_in_set'] END, CASE WHEN ftp THEN ['website_url', 'not_a_url'] END,
  CASE WHEN mail THEN ['primary_email', 'not_an_email'] END, CASE WHEN one THEN ['source_urls', 'too_few'] END], lambda x: x IS NOT NULL) AS own,
  list_filter([CASE WHEN tbd IS NOT NULL THEN ['description', 'placeholder'] END, CASE WHEN example THEN ['website_url', 'placeholder'] END], lambda x: x IS NOT NULL) AS marks FROM p)
SELECT bucket::BIGINT AS bucket, row_no::BIGINT AS row_no, line_no::BIGINT AS line_no, x[1] AS field, x[2] AS code FROM (SELECT bucket, row_no, line_no, unnest(CASE WHEN len(own) > 0 THEN own ELSE marks[1:1] END) AS x FROM e)""")
def record_validation(t):
    """Records made of customers, written as CSV with quoted line feeds, read in parallel with line numbers, and judged by the contract."""
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.concat(F.col("c_name"), F.lit(' says "hello",\nthen goes'))).otherwise(F.col("c_name"))
    urls = F.when(k % 19 == 5, F.lit("https://a.firm.test/x")).otherwise(F.lit("https://a.firm.test/x; https://b.firm.test"))
    rows = t("customer").select(
        F.floor(k / 400).alias("bucket"), F.when(k % 50 == 7, F.lit(" ")).otherwise(F.concat(F.lit("r"), k)).alias("record_id"), F.col("c_name").alias("family_office_name"), F.when(k % 9 == 4, "Bank").when(k % 9 == 5, "").otherwise("unclear").alias("family_office_type"),
        F.when(k % 23 == 1, " TBD").otherwise(text).alias("description"), F.when(k % 13 == 2, "ftp://x.test").when(k % 17 == 3, "https://www.example.com/about").otherwise("https://firm.test").alias("website_url"), F.lit("Here").alias("country"),
        F.when(k % 29 == 6, "nobody").when(k % 2 == 0, "a.b@firm.test").otherwise("").alias("primary_email"), F.when(k % 5 == 0, F.concat(urls, F.lit(";\n\n"))).otherwise(urls).alias("source_urls"),
        F.when(k % 23 == 1, F.when(k % 3 == 0, "x\ny").otherwise("x")).otherwise("x").alias("source_notes"), k.alias("k"),
    )
    spark = rows.sparkSession
    path = f"{V.shared_folder(spark)}/records-{uuid.uuid4().hex}"
    rows.repartition("bucket").sortWithinPartitions("bucket", "k").drop("k").write.partitionBy("bucket").option("header", True).options(quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    records = read_numbered_csv(spark, path)
    errors = record_errors(records, ["file", "row_no", "line_no"])
    return errors.select(F.regexp_extract("file", "/bucket=([0-9]+)/", 1).cast("long").alias("bucket"), "row_no", "line_no", "field", "code")


@query("signal_filters", """
SELECT event_type, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS users, count(*) FILTER (WHERE value > 50)::BIGINT AS strong, round(sum(value), 4) AS total FROM events WHERE event_type NOT IN ('error') GROUP BY event_type""")
def signal_filters(t):
    e = t("events").where(~F.col("event_type").isin("error"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") > 50).alias("strong"), F.round(F.sum("value"), 4).alias("total"))


_SHAPES = (
    ("Ada Stone", True, False), ("Ada W. Stone", True, False), ("ADA Stone", False, False), ("Our Team", False, False), ("Solo", False, False), ("Ada de Stone", False, False), ("Jean-Luc O\u2019Neil", True, False),
    ("A B C D E", False, False), ("Managing Director, Funds", False, True), ("director", False, True), ("Directory of names", False, False), ("Head of Research", False, True), ("", False, False), ("Partner " + "x" * 80, False, False),
)
_SHAPE_SQL = ", ".join(f"({-1 - i}, '{line}', {name}, {role})" for i, (line, name, role) in enumerate(_SHAPES))


@query("name_shape_rules", rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents), w AS (SELECT doc_id, line, string_split_regex(line, '\s+') AS w FROM l),
n AS (SELECT doc_id, len(w) BETWEEN 2 AND 4 AND len(list_filter(w, lambda x: NOT regexp_matches(x, '^([A-Z][a-zA-Z''’-]+|[A-Z][.])$') OR length(x) > 1 AND upper(x) = x AND NOT ends_with(x, '.'))) = 0 AND NOT ends_with(w[1], '.')
  AND NOT list_has_any(w, {sorted(S.NO_NAMES)}) AS is_name, length(trim(regexp_replace(line, '[][()]', '', 'g'))) BETWEEN 1 AND 80 AND regexp_matches(lower(trim(regexp_replace(line, '[][()]', '', 'g'))), '^({'|'.join(S.ROLE_WORDS)})\b') AS is_role FROM w)
SELECT doc_id, count(*) FILTER (WHERE is_name)::BIGINT AS n_names, count(*) FILTER (WHERE is_role)::BIGINT AS n_roles FROM n GROUP BY doc_id
UNION ALL SELECT id, name::INTEGER::BIGINT, role::INTEGER::BIGINT FROM (VALUES {_SHAPE_SQL}) v(id, line, name, role)""")
def name_shape_rules(t):
    """How many lines of each whole text have the shape of a name, and of a role; literal lines with stated results stand beside."""
    docs = t("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    literal = docs.sparkSession.createDataFrame([(-1 - i, line) for i, (line, _, _) in enumerate(_SHAPES)], "doc_id long, text string")
    lines = F.split("text", "\n")
    count = lambda test: F.size(F.filter(lines, test)).cast("bigint")
    return docs.unionByName(literal).select("doc_id", count(S.is_name).alias("n_names"), count(S.is_role).alias("n_roles"))


@query("value_flags", """
SELECT c_custkey, c_custkey % 5 IN (0, 1) AS is_true, c_custkey % 5 <> 3 AS filled, c_custkey % 5 = 3 AS blank FROM customer""")
def value_flags(t):
    v = F.element_at(F.array(*map(F.lit, (" Registered ", "YES", "no", " \t ", "0"))), (F.col("c_custkey") % 5 + 1).cast("int"))
    return t("customer").select("c_custkey", truth(v).alias("is_true"), is_filled(v).alias("filled"), is_blank(v).alias("blank"))


@query("grouped_counts", """
SELECT o_orderstatus, o_orderpriority, count(*)::BIGINT AS n, count(DISTINCT o_custkey)::BIGINT AS customers FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def grouped_counts(t):
    return t("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))
