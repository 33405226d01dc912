"""The pipeline: each stage on its predecessor's rows, whole results against brute force, and queries registered."""

import random

import pytest

import corpus_pipeline
from ledgerline.llm import queries
from tests.llm.test_operators import DOCS, brute_quality, corpus, near_copies, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    rng = random.Random(12)
    item = prose(rng, 25)
    leak = (900, f"{prose(rng, 100)} {item} {prose(rng, 100)}", "en", "s", 1, None, None, None, None)
    spark.createDataFrame([*corpus(), *near_copies(40), leak], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            counts.append(docs.count())
        if name == "quality_rules":
            assert all(brute_quality(r.text)[0] >= 50 for r in docs.collect())
    quality, lines, near, clean = counts[1:]
    assert counts[0] > quality == lines > near == clean + 1
    pieces = docs.collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in spark.read.parquet(f"{tmp_path}/3").collect()} and 900 not in {p.doc_id for p in pieces}
    # run() gives the same pieces of documents, up to where sequences cut.
    total = lambda rows: sorted((r.doc_id is not None, r.doc_id or 0, r.doc_tokens) for r in {(r.doc_id, r.doc_tokens): r for r in rows}.values())
    assert total(corpus_pipeline.run(spark, folder).collect()) == total(pieces)


def test_queries_have_all_operators():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)
