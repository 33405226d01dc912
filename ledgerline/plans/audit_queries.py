"""Queries over audits, chunks, answers, dictionaries and manifests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import audits as A
from ..operators import chunks as C
from ..operators.evidence import first_match
from ..operators.ranking import first_per_key, top_per_key
from .registry import query

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: How many ranges of keys a running sum over a table is cut into.
BUDGET_BUCKETS = 4096


@query("audit_unique", """
SELECT 'k_blank' AS check_id, 'issue' AS severity, count(*) FILTER (WHERE k = '') = 0 AS ok, count(*) FILTER (WHERE k = '')::BIGINT AS observed FROM (SELECT CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE (o_orderkey % 14000)::VARCHAR END AS k FROM orders)
UNION ALL SELECT 'k_duplicates', 'issue', count(*) = 0, count(*)::BIGINT FROM (SELECT k FROM (SELECT CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE (o_orderkey % 14000)::VARCHAR END AS k FROM orders) WHERE k <> '' GROUP BY k HAVING count(*) > 1)""")
def audit_unique(t):
    return A.unique_ids(t("orders").select(F.when(F.col("o_orderkey") % 50 == 0, F.lit(" ")).otherwise((F.col("o_orderkey") % 14000).cast("string")).alias("k")), "k")


@query("audit_anti", "SELECT DISTINCT l_orderkey FROM lineitem ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey")
def audit_anti(t):
    return A.missing_references(t("lineitem"), "l_orderkey", t("orders").where("o_orderstatus <> 'P'"), "o_orderkey")


@query("audit_children", "SELECT o_orderkey, count(l_orderkey)::BIGINT AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING count(l_orderkey) < 2")
def audit_children(t):
    return A.too_few_children(t("orders"), "o_orderkey", t("lineitem"), "l_orderkey", 2)


@query("audit_pairing", """
SELECT 'segment' AS check_id, 'issue' AS severity, count(*) FILTER (WHERE c_custkey % 5 > 0 AND c_custkey % 3 = 0) = 0 AS ok, count(*) FILTER (WHERE c_custkey % 5 > 0 AND c_custkey % 3 = 0)::BIGINT AS observed FROM customer""")
def audit_pairing(t):
    value = F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment"))
    return A.pairing(t("customer"), "segment", value, F.when(F.col("c_custkey") % 3 > 0, F.lit("url")), F.lit("high"))


@query("audit_coverage", """
SELECT s_nationkey AS nation, count(*)::BIGINT AS records, count(*) FILTER (WHERE s_acctbal > 0)::BIGINT AS claims, count(*) FILTER (WHERE s_acctbal > 0) >= count(*) AS covered FROM supplier GROUP BY s_nationkey""")
def audit_coverage(t):
    n, c = F.count("*"), F.count_if(F.col("s_acctbal") > 0)
    return t("supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(n.alias("records"), c.alias("claims"), (c >= n).alias("covered"))


@query("audit_topk_values", "SELECT n_name, count(*)::BIGINT AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 8")
def audit_topk_values(t):
    counted = t("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n").orderBy(F.desc("n"), "n_name").limit(8)


_PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("audit_sets", "WITH f AS (" + " UNION ALL ".join(f"SELECT '{c}' AS c, count({c}) AS n FROM part" for c in _PART) + """ UNION ALL SELECT 'p_weight', 0)
SELECT 'part' AS table_name, c AS column_name, 'missing' AS state, n::BIGINT AS n_filled FROM f WHERE c IN ('p_partkey', 'p_weight', 'p_name') AND n = 0
UNION ALL SELECT 'part', c, 'extra', n FROM f WHERE c NOT IN ('p_partkey', 'p_weight', 'p_name') AND n > 0 UNION ALL SELECT 'part', c, 'undefined', n FROM f WHERE c IN ('p_size', 'p_retailprice') AND n > 0""")
def audit_sets(t):
    """Columns that no row fills, that nobody asked for, that have no definition, by what the rows hold."""
    defined = F.col("column_name").isin("p_partkey", "p_name", "p_brand", "p_type", "p_weight")
    return A.column_states(A.filled_cells({"part": t("part")}), {"part": ["p_partkey", "p_weight", "p_name"]}, defined)


@query("audit_suspicious", """SELECT doc_id, contains(lower(text), 'idiot') AND (contains(lower(text), 'clown') OR contains(lower(text), 'scum')) AS suspicious FROM documents""")
def audit_suspicious(t):
    low = F.lower("text")
    return t("documents").select("doc_id", (low.contains("idiot") & (low.contains("clown") | low.contains("scum"))).alias("suspicious"))


@query("audit_suspicious_all", """SELECT doc_id, coalesce(source IN ('src1', 'src2'), false) AS selected, coalesce(contains(lower(text), 'idiot') AND (contains(lower(text), 'clown') OR contains(lower(text), 'scum')), false) AS suspicious FROM documents""")
def audit_suspicious_all(t):
    """The rule on every document, with the selector of sources as a flag."""
    selected = F.coalesce(F.col("source").isin("src1", "src2"), F.lit(False))
    return t("documents").select("doc_id", selected.alias("selected"), A.suspicious(F.col("text"), "idiot", ("clown", "scum")).alias("suspicious"))


@query("audit_status", """SELECT CASE WHEN (SELECT count(*) FROM orders WHERE o_totalprice < 0) > 0 OR (SELECT count(*) FROM lineitem WHERE l_quantity < 0) > 0 THEN 1 ELSE 0 END::BIGINT AS exit_status""")
def audit_status(t):
    none = lambda o: o == 0
    checks = [A.check(t("orders"), "price", F.count_if(F.col("o_totalprice") < 0), none), A.check(t("lineitem"), "quantity", F.count_if(F.col("l_quantity") < 0), none), A.check(t("orders"), "rows", F.count("*"), lambda o: o < 0, "note")]
    return A.exit_status(checks[0].unionByName(checks[1]).unionByName(checks[2]))


@query("near_miss_band", """
WITH s AS (SELECT c_custkey, (c_custkey % 100) / 100 AS score, CASE WHEN c_custkey % 7 = 0 THEN 'accepted' END AS review FROM customer)
SELECT c_custkey, round(score, 6) AS score FROM s WHERE score >= 0.45 AND score < 0.6 AND review IS NULL""")
def near_miss_band(t):
    """Scores just below the threshold that nobody reviewed."""
    s = t("customer").select("c_custkey", F.round((F.col("c_custkey") % 100) / 100, 6).alias("score"), F.when(F.col("c_custkey") % 7 == 0, F.lit("accepted")).alias("review"))
    return s.where((F.col("score") >= 0.45) & (F.col("score") < 0.6) & F.col("review").isNull()).drop("review")


@query("stale_wording", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS said FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-15' AND event_type = 'error'""")
def stale_wording(t):
    """'as of DATE' in a note, before the audit's day."""
    note = F.concat(F.lit("checked as of "), F.date_format("ts", "yyyy-MM-dd"), F.lit(" by hand"))
    said = F.explode(F.regexp_extract_all(F.col("note"), F.lit("(?i)as of ([0-9]{4}-[0-9]{2}-[0-9]{2})"), F.lit(1)))
    return t("events").where("event_type = 'error'").select("event_id", note.alias("note")).select("event_id", said.alias("said")).where(F.try_to_date("said", "yyyy-MM-dd") < F.lit("2024-01-15").cast("date"))


_RECORDS = """r AS (SELECT c_custkey, c_name, n_name, r_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS segment, CASE WHEN c_acctbal > 0 THEN floor(c_acctbal)::BIGINT::VARCHAR ELSE '' END AS balance, CASE WHEN c_custkey % 4 = 0 THEN 'moved' ELSE '' END AS activity
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_CHUNKS = f"""{_RECORDS}, c AS (
SELECT c_custkey || '_record_profile' AS chunk_id, c_custkey, 'record_profile' AS chunk_type, '' AS field_name, c_name || ' in ' || n_name || ', segment ' || CASE WHEN segment = '' THEN 'not evidenced in the locked dataset' ELSE segment END AS text FROM r UNION ALL
SELECT c_custkey || '_contact_policy', c_custkey, 'contact_policy', '', 'Contact policy for ' || c_name FROM r UNION ALL SELECT c_custkey || '_regulatory', c_custkey, 'regulatory', '', 'Region ' || r_name FROM r UNION ALL
SELECT c_custkey || '_recent_activity', c_custkey, 'recent_activity', '', 'Recent activity: ' || activity FROM r WHERE activity <> '' UNION ALL
SELECT c_custkey || '_field_evidence_segment', c_custkey, 'field_evidence', 'segment', 'segment: ' || segment FROM r WHERE segment <> '' UNION ALL SELECT c_custkey || '_field_evidence_balance', c_custkey, 'field_evidence', 'balance', 'balance: ' || balance FROM r WHERE balance <> '')"""


def _records(t):
    joined = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("c_custkey", "c_name", "n_name", "r_name", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("segment"), F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal").cast("bigint").cast("string")).alias("balance"), F.when(F.col("c_custkey") % 4 == 0, F.lit("moved")).alias("activity"))


def _chunks(t):
    profile = F.concat("c_name", F.lit(" in "), "n_name", F.lit(", segment "), C.shown(F.col("segment")))
    templates = {"record_profile": profile, "contact_policy": F.concat(F.lit("Contact policy for "), "c_name"), "regulatory": F.concat(F.lit("Region "), "r_name")}
    return C.chunks(_records(t), "c_custkey", templates, {"segment": F.col("segment"), "balance": F.col("balance")}, F.col("activity"))


@query("chunk_build", f"WITH {_CHUNKS} SELECT * FROM c")
def chunk_build(t):
    return _chunks(t)


@query("chunk_coverage", f"WITH {_CHUNKS} SELECT chunk_type, count(*)::BIGINT AS n, bool_and(field_name <> '') AS field_name_always, bool_and(text <> '') AS text_always FROM c GROUP BY chunk_type")
def chunk_coverage(t):
    return _chunks(t).groupBy("chunk_type").agg(F.count("*").alias("n"), F.bool_and(F.col("field_name") != "").alias("field_name_always"), F.bool_and(F.col("text") != "").alias("text_always"))


@query("answer_contact", f"""WITH {_RECORDS}, a AS (SELECT *, concat_ws('; ', CASE WHEN segment <> '' THEN 'segment: ' || segment END, CASE WHEN balance <> '' THEN 'balance: ' || balance END) AS have FROM r)
SELECT c_custkey, c_custkey % 10 = 9 OR have = '' AS abstain, CASE WHEN c_custkey % 10 = 9 OR have = '' THEN c_name || ': not evidenced in the locked dataset' ELSE c_name || ' — ' || have END AS answer, concat_ws(', ', CASE WHEN segment = '' THEN 'segment' END, CASE WHEN balance = '' THEN 'balance' END) AS missing FROM a""")
def answer_contact(t):
    answer, abstain, missing = C.copied_answer(F.col("c_name"), {"segment": F.col("segment"), "balance": F.col("balance")}, F.col("c_custkey") % 10 == 9)
    return _records(t).select("c_custkey", abstain.alias("abstain"), answer.alias("answer"), missing.alias("missing"))


@query("answer_listing", "SELECT n_name, string_agg(c_name, chr(10) ORDER BY c_custkey) AS answer FROM (SELECT n_name, c_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY c_custkey) <= 10) GROUP BY n_name")
def answer_listing(t):
    """The first ten records of each listing, a line each."""
    top = top_per_key(t("customer").select("c_custkey", "c_name", "c_nationkey"), ["c_nationkey"], 10, "place", F.col("c_custkey"))
    lists = top.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("place", "c_name"))).alias("l"))
    return lists.join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", F.array_join(F.col("l.c_name"), "\n").alias("answer"))


@query("answer_comparison", f"""WITH {_RECORDS} SELECT field, max(v) FILTER (WHERE c_custkey = 1) AS record_1, max(v) FILTER (WHERE c_custkey = 2) AS record_2, max(v) FILTER (WHERE c_custkey = 4) AS record_4
FROM (SELECT c_custkey, 'nation' AS field, n_name AS v FROM r UNION ALL SELECT c_custkey, 'segment', CASE WHEN segment = '' THEN 'not evidenced in the locked dataset' ELSE segment END FROM r) WHERE c_custkey IN (1, 2, 4) GROUP BY field""")
def answer_comparison(t):
    """Facts by records."""
    facts = F.array(F.struct(F.lit("nation").alias("field"), F.col("n_name").alias("v")), F.struct(F.lit("segment").alias("field"), C.shown(F.col("segment")).alias("v")))
    rows = _records(t).where(F.col("c_custkey").isin(1, 2, 4)).select("c_custkey", F.explode(facts).alias("f")).select("c_custkey", "f.*")
    return rows.groupBy("field").pivot("c_custkey", [1, 2, 4]).agg(F.max("v")).select("field", *(F.col(k).alias(f"record_{k}") for k in ("1", "2", "4")))


@query("answer_dispatch", f"""WITH {_RECORDS} SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'recent_activity' WHEN 1 THEN 'regulatory' WHEN 2 THEN 'contact_lookup' ELSE 'entity_lookup' END AS intent,
CASE c_custkey % 4 WHEN 0 THEN c_name || ': ' || activity WHEN 1 THEN c_name || ' is in region ' || r_name WHEN 2 THEN CASE WHEN segment = '' THEN 'abstain' ELSE c_name || ' — ' || segment END ELSE c_name || ' in ' || n_name END AS answer FROM r""")
def answer_dispatch(t):
    k = F.col("c_custkey") % 4
    intent = first_match([(k == 0, "recent_activity"), (k == 1, "regulatory"), (k == 2, "contact_lookup")], "entity_lookup")
    name = F.col("c_name")
    answer = F.when(k == 0, F.coalesce(F.concat(name, F.lit(": "), "activity"), F.lit("abstain"))).when(k == 1, F.concat(name, F.lit(" is in region "), "r_name")).when(k == 2, F.coalesce(F.concat(name, F.lit(" — "), "segment"), F.lit("abstain"))).otherwise(F.concat(name, F.lit(" in "), "n_name"))
    return _records(t).select("c_custkey", intent.alias("intent"), answer.alias("answer"))


@query("citation_choice", f"""WITH {_CHUNKS} SELECT c_custkey, chunk_id FROM c WHERE chunk_type <> 'contact_policy' QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY CASE chunk_type WHEN 'regulatory' THEN 0 WHEN 'field_evidence' THEN 1 ELSE 2 END, chunk_id) = 1""")
def citation_choice(t):
    """The first chunk with a source, of the preferred types first."""
    order = F.when(F.col("chunk_type") == "regulatory", 0).when(F.col("chunk_type") == "field_evidence", 1).otherwise(2)
    return first_per_key(_chunks(t).where("chunk_type <> 'contact_policy'"), ["c_custkey"], order, F.col("chunk_id")).select("c_custkey", "chunk_id")


@query("text_checks", r"""SELECT doc_id, contains(lower(text), 'the') AND contains(lower(text), 'and') AS must_include, NOT (contains(lower(text), 'idiot') OR contains(lower(text), 'moron')) AS must_exclude FROM documents""")
def text_checks(t):
    low = F.lower("text")
    return t("documents").select("doc_id", (low.contains("the") & low.contains("and")).alias("must_include"), (~(low.contains("idiot") | low.contains("moron"))).alias("must_exclude"))


@query("jaccard_match", r"""
WITH n AS (SELECT s_suppkey AS k, list_distinct(list_filter(string_split_regex(lower(s_name), '[^a-z0-9]+'), lambda w: length(w) > 2)) AS w, s_nationkey FROM supplier),
c AS (SELECT c_custkey AS q, list_distinct(list_filter(string_split_regex(lower(replace(c_name, 'Customer', 'Supplier')), '[^a-z0-9]+'), lambda w: length(w) > 2)) AS v, c_nationkey FROM customer WHERE c_custkey % 20 = 0),
p AS (SELECT DISTINCT q, k FROM (SELECT q, unnest(v) AS t FROM c) a JOIN (SELECT k, unnest(w) AS t FROM n) b USING (t)),
s AS (SELECT q, k, CASE WHEN v = w THEN 0.75 ELSE len(list_intersect(v, w)) / len(list_distinct(list_concat(v, w))) END + CASE WHEN c_nationkey = s_nationkey THEN 0.25 ELSE 0 END AS score FROM p JOIN c USING (q) JOIN n USING (k)),
b AS (SELECT q, k, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY round(score, 6) DESC, k) = 1)
SELECT q AS c_custkey, k AS s_suppkey, score, CASE WHEN score >= 0.6 THEN 'matched' WHEN score >= 0.45 THEN 'needs_review' ELSE 'unmatched' END AS verdict FROM b""")
def jaccard_match(t):
    """Best match by name tokens, with a place bonus and a review band.

    Candidates share a rare token; or a frequent one, and then one supplier stands for all of the same frequent tokens, size and place,
    since they score alike. So no token's suppliers meet all of its customers.
    """
    tokens = lambda c: F.array_distinct(F.filter(X.words(c), lambda w: F.length(w) > 2))
    n = t("supplier").select(F.col("s_suppkey"), tokens(F.col("s_name")).alias("w"), "s_nationkey")
    q = t("customer").where("c_custkey % 20 = 0").select("c_custkey", tokens(F.regexp_replace("c_name", "Customer", "Supplier")).alias("v"), "c_nationkey")
    by_token = n.select("*", F.explode("w").alias("t"))
    often = by_token.groupBy("t").agg(F.count("*").alias("df")).where("df > 64").select("t")
    rare = by_token.join(often, "t", "left_anti")
    shared = by_token.join(often, "t").groupBy("s_suppkey", "s_nationkey", "w").agg(F.sort_array(F.collect_list("t")).alias("common"))
    stands = shared.groupBy("common", F.size("w").alias("size"), "s_nationkey").agg(F.min_by(F.struct("s_suppkey", "w"), "s_suppkey").alias("s"))
    stands = stands.select(F.col("s.s_suppkey").alias("s_suppkey"), F.col("s.w").alias("w"), "s_nationkey", F.explode("common").alias("t"))
    asked = q.select("*", F.explode("v").alias("t"))
    found = [asked.join(side.select("s_suppkey", "w", "s_nationkey", "t"), "t").drop("t") for side in (rare, stands)]
    pairs = found[0].unionByName(found[1]).dropDuplicates(["c_custkey", "s_suppkey"])
    score = F.when(F.col("v") == F.col("w"), F.lit(0.75)).otherwise(X.token_jaccard(F.col("v"), F.col("w"))) + F.when(F.col("c_nationkey") == F.col("s_nationkey"), 0.25).otherwise(0.0)
    best = first_per_key(pairs.withColumn("score", F.round(score, 6)), ["c_custkey"], F.desc("score"), F.col("s_suppkey"))
    return best.select("c_custkey", "s_suppkey", "score", first_match([(F.col("score") >= 0.6, "matched"), (F.col("score") >= 0.45, "needs_review")], "unmatched").alias("verdict"))


@query("budget_cutoff", "SELECT p_partkey, spent / 100.0 AS spent FROM (SELECT p_partkey, sum(p_size) OVER (ORDER BY p_partkey, p_size) AS spent, sum(p_size) OVER () AS total FROM part) WHERE 2 * spent <= total")
def budget_cutoff(t):
    """Rows in order until the running cost passes the budget, half of what all would cost.

    The keys' range is cut into a fixed number of buckets. Their totals, so many rows at most, run in one task; each bucket's own running
    sum then needs only its rows and the total before it.
    """
    parts = t("part").select("p_partkey", F.col("p_size").cast("bigint").alias("cost"))
    ends = parts.agg(F.min("p_partkey").alias("low"), F.max("p_partkey").alias("high"))
    bucket = F.floor((F.col("p_partkey") - F.col("low")) * BUDGET_BUCKETS / (F.col("high") - F.col("low") + 1))
    rows = parts.join(F.broadcast(ends), F.lit(True)).select("p_partkey", "cost", bucket.alias("bucket"))
    totals = rows.groupBy("bucket").agg(F.sum("cost").alias("own"))
    before = totals.select("bucket", (F.sum("own").over(Window.orderBy("bucket")) - F.col("own")).alias("before"), F.sum("own").over(Window.partitionBy()).alias("total"))
    spent = F.sum("cost").over(Window.partitionBy("bucket").orderBy("p_partkey", "cost"))
    running = rows.withColumn("spent", spent).join(F.broadcast(before), "bucket").withColumn("spent", F.col("spent") + F.col("before"))
    return running.where(2 * F.col("spent") <= F.col("total")).select("p_partkey", (F.col("spent") / 100).alias("spent"))


_DESCRIBED = {
    "region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name", "n_regionkey"), "embeddings": ("vec_id", "embedding", "label"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
}


@query("data_dictionary", "WITH c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_filled FROM {n}" for n, cs in _DESCRIBED.items() for c in cs) + """)
SELECT table_name, column_name, CASE WHEN column_name = 'embedding' THEN 'Vector.' WHEN ends_with(column_name, 'key') OR ends_with(column_name, '_id') THEN 'Identifier.' WHEN starts_with(column_name, 'l_') THEN 'Line value.' WHEN ends_with(column_name, 'name') THEN 'Name.' ELSE 'Value.' END AS definition,
  n_rows::BIGINT AS n_rows, n_filled::BIGINT AS n_filled FROM c""")
def data_dictionary(t):
    """Exact names first, then prefix and suffix rules in order; beside each column how many rows hold a value."""
    c = F.col("column_name")
    rules = [(c == "embedding", "Vector."), (c.endswith("key") | c.endswith("_id"), "Identifier."), (c.startswith("l_"), "Line value."), (c.endswith("name"), "Name.")]
    return A.filled_cells({n: t(n) for n in _DESCRIBED}).select("table_name", "column_name", first_match(rules, "Value.").alias("definition"), "n_rows", "n_filled")


@query("manifest_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*)::BIGINT AS n_rows FROM {n}" for n in TABLES))
def manifest_counts(t):
    out = None
    for n in TABLES:
        one = t(n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out
