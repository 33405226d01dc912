"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from ledgerline.plans import catalog
from ledgerline.plans.audit_queries import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, FOLDER)
    rows = rows_of(got.columns, got.collect())
    if name not in catalog.SQL:
        assert got.columns
        return
    want = duck.sql(catalog.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows == rows_of(want.columns, want.fetchall())


def test_entry_imports():
    import __spark_entry__ as e

    assert len(e.queries()) >= len(catalog.QUERIES) and set(e.oracle_sql()) <= set(e.queries())


def test_plans(spark):
    """Filters and columns reach the scan, and small lookups aggregate before they shuffle."""
    plan = catalog.QUERIES["lookup_first"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(event_type)" in plan and "props" not in plan.split("ReadSchema")[1]
    assert "partial_min_by" in plan


def test_suspicious_covers_every_document(spark, duck):
    """No document is left out by its source or id."""
    got = catalog.QUERIES["audit_suspicious_all"](spark, FOLDER)
    want = "SELECT count(*), count(*) FILTER (WHERE contains(lower(text), 'idiot') AND (contains(lower(text), 'clown') OR contains(lower(text), 'scum'))) FROM documents"
    assert (got.count(), got.where("suspicious").count()) == duck.sql(want).fetchall()[0]


def test_eval_passes_ask_every_item(spark, duck):
    """No item of the benchmark is left out by its id."""
    from ledgerline.plans.retrieval_queries import ASKED

    n_items = duck.sql("SELECT count(*) FROM benchmark").fetchall()[0][0]
    got = {(r["pass"], r.category): r.n for r in catalog.QUERIES["eval_passes"](spark, FOLDER).collect()}
    assert got == {(p, c): n for p in ("all", "hybrid", "bm25") for c, n in (("asked", len(ASKED)), ("benchmark", n_items))}


def test_placeholder_reads_the_whole_text(spark, tmp_path):
    texts = ["TBD" + " " * 20 + "a long text", " " * 15 + "\u00a0ToDo\n", "https://www.example.org/a", "http://example.net", "https://notexample.org/", "hidden", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.rejected for r in catalog.QUERIES["placeholder_reject"](spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(7)] == [False, True, True, True, False, True, None]
