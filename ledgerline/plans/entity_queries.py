"""Queries that resolve entities: registry matches, mentions of records, quotes by turn, rosters of people."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import matching as M
from ..operators import mentions as N
from ..operators import sequences as S
from .registry import query
from .scalar_queries import SENTENCES_SQL

_WORDS_SQL = "regexp_extract_all(coalesce(text, ''), '[A-Za-z]+')"
#: Fixed values of the query's SQL: the generic words that a name drops.
_DROPS_SQL = "['family', 'office', 'offices', 'capital', 'wealth', 'management', 'advisors', 'advisor', 'advisory', 'partners', 'group', 'llc', 'inc', 'llp', 'ltd', 'co', 'corp', 'company', 'holdings', 'limited', 'the', 'and']"


def _set(name: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split_regex(lower({name}), '[^a-z0-9]+'), lambda w: w <> '')))"


def _simple(name: str) -> str:
    return f"array_to_string(list_filter(string_split_regex(lower({name}), '[^a-z0-9]+'), lambda w: w <> '' AND NOT list_contains({_DROPS_SQL}, w)), ' ')"


@query("entity_resolve", f"""
WITH w AS (SELECT doc_id, {_WORDS_SQL} AS w, coalesce(lang, '') AS city, coalesce(source, '') AS state FROM documents),
e AS (SELECT doc_id AS entry_id, city, state, list_filter([array_to_string(w[1:4], ' '), array_to_string(w[5:7], ' ')], lambda n: n <> '') AS names FROM w),
n AS (SELECT DISTINCT entry_id, city, state, n AS name, {_set('n')} AS s, {_simple('n')} AS simple FROM (SELECT entry_id, city, state, unnest(names) AS n FROM e)),
r AS (SELECT doc_id AS record_id, city, state, array_to_string(w[1:3], ' ') || CASE WHEN doc_id % 40 = 0 THEN ' LLC' ELSE ' Family Office' END AS name FROM w WHERE doc_id % 20 = 0),
q0 AS (SELECT *, {_set('name')} AS s, {_simple('name')} AS simple FROM r),
q1 AS (SELECT *, list_filter([trim(name), CASE WHEN simple <> array_to_string(list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda w: w <> ''), ' ') THEN simple ELSE '' END, array_to_string(string_split(simple, ' ')[1:2], ' ')], lambda q: q <> '') AS asked FROM q0),
q2 AS (SELECT *, list_filter(asked, lambda q, i: i = 1 OR NOT list_contains(list_transform(asked[1:i - 1], lambda b: lower(b)), lower(q))) AS qs FROM q1),
q AS (SELECT record_id, unnest(qs) AS q, generate_subscripts(qs, 1) - 1 AS ordinal FROM q2), qq AS (SELECT *, {_set('q')} AS s FROM q),
h AS (SELECT DISTINCT qq.record_id, ordinal, entry_id FROM qq JOIN n ON len(list_intersect(qq.s, n.s)) >= 0.5 * (len(qq.s) + len(n.s) - len(list_intersect(qq.s, n.s))) AND len(qq.s) > 0 AND len(n.s) > 0),
j AS (SELECT h.record_id, ordinal, h.entry_id, max(CASE WHEN len(list_intersect(q0.s, n.s)) = 0 THEN 0 ELSE len(list_intersect(q0.s, n.s)) / len(list_distinct(list_concat(q0.s, n.s))) END) AS jac, bool_or(q0.simple <> '' AND q0.simple = n.simple) AS same,
    any_value(q0.city <> '' AND q0.city = n.city AND q0.state <> '' AND q0.state IN (n.state, substr(n.state, 1, 2))) AS place FROM h JOIN q0 USING (record_id) JOIN n USING (entry_id) GROUP BY ALL),
sc AS (SELECT *, round(CASE WHEN same THEN 0.75 ELSE jac END + CASE WHEN place THEN 0.25 ELSE 0 END, 6) AS score FROM j),
st AS (SELECT record_id, min(ordinal) AS stop FROM sc WHERE score >= 0.6 GROUP BY ALL),
b AS (SELECT sc.*, stop FROM sc LEFT JOIN st USING (record_id) WHERE score > 0 AND (stop IS NULL OR ordinal <= stop) QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY score DESC, ordinal, entry_id) = 1)
SELECT record_id, entry_id, coalesce(score, 0.0) AS score, CASE WHEN score >= 0.6 THEN 'matched' WHEN score >= 0.45 THEN 'needs_review' ELSE 'unmatched' END AS verdict, coalesce(same, false) AS same_name, coalesce(place, false) AS same_place,
  coalesce(stop + 1, len(qs))::BIGINT AS n_queries FROM q2 LEFT JOIN b USING (record_id)""")
def entity_resolve(t):
    """Names made of the documents' first words against all documents as a registry with an alias; language and source are the place."""
    w = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]+"), F.lit(0))
    docs = t("documents").select("doc_id", w.alias("w"), "lang", "source")
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    registry = docs.select(F.col("doc_id").alias("entry_id"), part(1, 4).alias("name"), F.array(part(5, 3)).alias("aliases"), F.col("lang").alias("city"), F.col("source").alias("state"))
    suffix = F.when(F.col("doc_id") % 40 == 0, " LLC").otherwise(" Family Office")
    records = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("record_id"), F.concat(part(1, 3), suffix).alias("name"), F.col("lang").alias("city"), F.col("source").alias("state"))
    found = M.resolve(records, registry)
    return found.select("record_id", "entry_id", "score", "verdict", F.col("reason").contains("simplified_name_exact_match").alias("same_name"), F.col("reason").contains("address_match").alias("same_place"), "n_queries")


_LITERAL_TEXTS = ("The office of Customer#000000007 and Supplier#000000003", "write to customer3@cust.example or visit cust.example", "Call 5550100, the number of nobody", "nothing is named here")


@query("mention_match", f"""
WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'), lambda w: length(w) > 3) AS w FROM documents),
r AS (SELECT 'c' || c_custkey AS record_id, CASE WHEN c_custkey % 2 = 0 OR len(w) < 3 OR w IS NULL THEN c_name ELSE array_to_string(w[1:3], ' ') END AS name, 'customer' || c_custkey || '@cust.example' AS mail, '5' || (c_custkey + 550000) AS number FROM customer LEFT JOIN d ON doc_id = c_custkey),
n AS (SELECT *, lower(name) AS low, list_filter(string_split_regex(lower(name), '[^a-z0-9]+'), lambda w: length(w) > 2) AS tk FROM r),
t AS (SELECT item_id AS text_id, lower(text) AS t FROM benchmark UNION ALL SELECT -1 - conv_id, lower(text) FROM conversations WHERE turn = 0 UNION ALL SELECT -1000000 - generate_subscripts(q, 1), lower(unnest(q)) FROM (SELECT [{', '.join(f"'{x}'" for x in _LITERAL_TEXTS)}] AS q)),
m AS (SELECT text_id, record_id, name, CASE WHEN contains(t, low) THEN length(low) WHEN contains(t, mail) OR contains(t, number) THEN 80
  WHEN len(tk) >= 2 AND contains(t, tk[1]) AND contains(t, tk[2]) AND (len(tk) < 3 OR contains(t, tk[3])) THEN list_sum(list_transform(tk, lambda w: length(w))) END AS weight FROM t, n)
SELECT text_id, record_id, weight::BIGINT AS weight, row_number() OVER (PARTITION BY text_id ORDER BY weight DESC, record_id DESC, name DESC)::BIGINT AS place FROM m WHERE weight IS NOT NULL""")
def mention_match(t):
    """All customers as records, every other one named by words of the document of its number; benchmark items, first turns and four literal texts are read."""
    w = F.filter(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)), lambda x: F.length(x) > 3)
    words = t("documents").select(F.col("doc_id").alias("c_custkey"), w.alias("w"))
    key = F.col("c_custkey")
    name = F.when((key % 2 == 0) | F.col("w").isNull() | (F.size("w") < 3), F.col("c_name")).otherwise(F.array_join(F.slice("w", 1, 3), " "))
    mail, number = F.concat(F.lit("customer"), key, F.lit("@cust.example")), F.concat(F.lit("5"), key + 550000)
    records = t("customer").join(words, "c_custkey", "left").select(F.concat(F.lit("c"), key).alias("record_id"), name.alias("name"), F.array(mail).alias("identifiers"), F.array(number).alias("numbers"))
    texts = t("benchmark").select(F.col("item_id").alias("text_id"), "text").unionByName(t("conversations").where("turn = 0").select((-1 - F.col("conv_id")).alias("text_id"), "text"))
    literal = texts.sparkSession.createDataFrame([(-1_000_001 - i, x) for i, x in enumerate(_LITERAL_TEXTS)], "text_id long, text string")
    return N.mentions(texts.unionByName(literal), records)


@query("snippet_sequential", rf"""
WITH RECURSIVE s AS (SELECT source, doc_id, unnest({SENTENCES_SQL}) AS s, generate_subscripts({SENTENCES_SQL}, 1) AS pos FROM (SELECT source, doc_id, coalesce(text, '') AS text FROM documents)),
c AS (SELECT source, doc_id, pos, CASE WHEN len(string_split(s, ' ')) > 25 THEN array_to_string(string_split(s, ' ')[1:25], ' ') || '…' ELSE s END AS q FROM s WHERE len(string_split(s, ' ')) BETWEEN 5 AND 60 AND regexp_matches(lower(s), '(^| )(and|und|et|y)( |$)')),
u AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id, lower(substr(q, 1, 80)) ORDER BY pos) = 1),
l AS MATERIALIZED (SELECT d.source, d.doc_id, row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id) AS nth, (SELECT coalesce(list(q ORDER BY pos), []) FROM u WHERE u.doc_id = d.doc_id) AS qs FROM documents d),
walk AS (
  SELECT source, doc_id, nth, qs[1:2] AS took, list_transform(qs[1:2], lambda q: lower(substr(q, 1, 80))) AS used FROM l WHERE nth = 1
  UNION ALL SELECT l.source, l.doc_id, l.nth, list_filter(l.qs, lambda q: NOT list_contains(used, lower(substr(q, 1, 80))))[1:2], list_concat(used, list_transform(list_filter(l.qs, lambda q: NOT list_contains(used, lower(substr(q, 1, 80))))[1:2], lambda q: lower(substr(q, 1, 80))))
  FROM walk w JOIN l ON l.source IS NOT DISTINCT FROM w.source AND l.nth = w.nth + 1)
SELECT source, doc_id, k::BIGINT AS quote_index, 'extracted' AS status, took[k] AS quote FROM walk, (VALUES (1), (2)) v(k) WHERE len(took) >= k
UNION ALL SELECT source, doc_id, 1, 'no_keyword_match', NULL FROM walk WHERE len(took) = 0""")
def snippet_sequential(t):
    """Per source, in order of doc_id: each document's first two sentences, cut to 25 words, that no earlier one of the source gave."""
    fit = F.filter(X.sentences(F.col("text")), lambda s: F.lower(s).rlike(r"(^| )(and|und|et|y)( |$)") & F.size(F.split(s, " ")).between(5, 60))
    cut = F.transform(fit, lambda s: F.when(F.size(F.split(s, " ")) > 25, F.concat(F.array_join(F.slice(F.split(s, " "), 1, 25), " "), F.lit("…"))).otherwise(s))
    return S.distinct_snippets(t("documents"), "source", "doc_id", cut)


#: Pages with stated names and roles, beside the pages that the query makes of documents.
_PAGES = (
    ("/our-team", "# Team\n\n**Ada Stone**, Managing Partner — sees to all.\n\n**Ben Hill**\n\nChief Investment Officer\n\n## Our Team\n\n### Cara Lane\n\nPrincipal\n\n**Ada Stone**, Partner\n",
     (("Ada Stone", "Managing Partner — sees to all", "bold"), ("Ben Hill", "Chief Investment Officer", "bold"), ("Cara Lane", "Principal", "heading"))),
    ("/people", "**Ada Stone**, Partner and **Ben Hill**, Director\nDora W. Finch\n\n\n- *Head of Research*\nEmil Frost\nx\ny\nTrustee\n### **Finn Grove**\n[Chief of Staff](https://x.example/a)\n",
     (("Ada Stone", "Partner and **Ben Hill**, Director", "bold"), ("Ben Hill", "Director", "bold"), ("Dora W. Finch", "Head of Research*", "plain"))),
    ("/news", "Dora Finch\nPartner\n", ()),
    ("/about", "Gina Holt\n\nAnalyst\nSOLO NAME\nDirector\n**Hugo Ives** writes\n**Iris Jung**, lives here\nPresident\n### Press Team\nChair\n", (("Gina Holt", "Analyst", "plain"), ("Iris Jung", "President", "bold"))),
)


@query("roster_extract", rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '(^|[ \n])([A-Z][a-z]+)', 2), lambda w: length(w) > 2 AND NOT list_contains(['Our', 'Team', 'New', 'San', 'Los', 'Get', 'Use', 'Firm', 'Form', 'Read', 'More', 'Next', 'Back', 'Home', 'News', 'Sec', 'Inc', 'Adv', 'Ltd', 'Trust'], w)) AS w FROM documents),
n AS (SELECT doc_id, w[1] || ' ' || w[2] AS name, doc_id % 7 AS k FROM w WHERE len(w) >= 2)
SELECT doc_id AS page_id, name, ['Managing Partner', 'Chief Investment Officer', 'Principal', 'Head of Research', '', '', 'Founder & CEO'][k + 1] AS role, ['bold', 'bold', 'heading', 'plain', '', '', 'bold'][k + 1] AS extraction_method FROM n WHERE k NOT IN (4, 5)
UNION ALL SELECT * FROM (VALUES {', '.join(f"({-1 - i}, '{n}', '{r}', '{h}')" for i, (_, _, rows) in enumerate(_PAGES) for n, r, h in rows)})""")
def roster_extract(t):
    """Names and roles of markdown pages made of each document's first two capital words, in seven layouts, two of them without a role in reach, and of literal pages."""
    banned = ("Our", "Team", "New", "San", "Los", "Get", "Use", "Firm", "Form", "Read", "More", "Next", "Back", "Home", "News", "Sec", "Inc", "Adv", "Ltd", "Trust")
    w = F.filter(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("(^|[ \n])([A-Z][a-z]+)"), F.lit(2)), lambda x: (F.length(x) > 2) & ~x.isin(*banned))
    name = F.concat_ws(" ", F.col("w")[0], F.col("w")[1])
    k = F.col("doc_id") % 7
    page = (
        F.when(k == 0, F.concat(F.lit("Who we are\n\n* **"), name, F.lit("** — Managing Partner\nand more\n")))
        .when(k == 1, F.concat(F.lit("**"), name, F.lit("**\n\nof the firm\n\nChief Investment Officer\n")))
        .when(k == 2, F.concat(F.lit("### "), name, F.lit("\r\nsince 1990\n\nPrincipal\n")))
        .when(k == 3, F.concat(name, F.lit("\n\n[Head of Research](https://a.example/x)\n")))
        .when(k == 4, F.concat(name, F.lit("\none\ntwo\nTrustee\n")))
        .when(k == 5, F.concat(F.lit("**"), name, F.lit("**" + "\n" * 11 + "Director\n")))
        .otherwise(F.concat(F.lit("intro **"), name, F.lit("**: Founder & CEO\n### "), name, F.lit("\nPartner\n")))
    )
    docs = t("documents").select("doc_id", w.alias("w")).where("size(w) >= 2").select(F.col("doc_id").alias("page_id"), F.lit("https://a.example/our-team").alias("url"), page.alias("markdown"))
    literal = docs.sparkSession.createDataFrame([(-1 - i, f"https://a.example{url}", text) for i, (url, text, _) in enumerate(_PAGES)], "page_id long, url string, markdown string")
    return S.rosters(docs.unionByName(literal), "page_id", "url", "markdown")
