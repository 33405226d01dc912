"""Round trips of sources and sinks, and the event stream."""

import hashlib
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.validation import record_errors, require_valid
from ledgerline.sources import readers as R
from ledgerline.sources import upsert as U
from ledgerline.sources import writers as W
from ledgerline.sources.json_list import read_json_list
from ledgerline.sources.numbered import read_numbered_csv
from ledgerline.streaming import signals


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('record_id,note,n\n1,"two\nlines, ""quoted""",843.0\n2,,\n')
    got = R.read_records(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in got] == [("1", 'two\nlines, "quoted"', "843.0"), ("2", "", "")]
    fixed = R.normalize_artifacts(R.ensure_columns(R.read_records(spark, str(tmp_path / "a.csv"), ["record_id", "note", "n"]), ["extra"]))
    assert fixed.columns[-1] == "extra" and fixed.first().n == "843"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        R.read_records(spark, str(tmp_path / "none.csv"))
    W.write_csv(fixed, str(tmp_path / "out"), ["n", "record_id"])
    assert R.read_records(spark, str(tmp_path / "out")).columns == ["n", "record_id"]


def test_page_export(spark, tmp_path):
    items = [{"markdown": "ab", "metadata": {"sourceURL": "u"}}, {"markdown": "abcd", "url": "u"}, {"markdown": "efgh", "metadata": {"url": "u"}}, {"markdown": "x"}]
    for name, body in (("list", items), ("data", {"data": items})):
        (tmp_path / name).write_text(json.dumps(body, indent=1))
        assert [tuple(r) for r in R.read_page_export(spark, str(tmp_path / name)).collect()] == [("u", "abcd")]


def test_page_export_of_several_files(spark, tmp_path):
    """Of equal texts the first file's stays, wherever it stands there."""
    page = lambda text, url: {"markdown": text, "metadata": {"sourceURL": url}}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1").write_text(json.dumps([page("x", "v"), page("aaaa", "u")]))
    (tmp_path / "in" / "2").write_text(json.dumps([page("zzzz", "u"), page("yy", "v")]))
    assert sorted(map(tuple, R.read_page_export(spark, str(tmp_path / "in")).collect())) == [("u", "aaaa"), ("v", "yy")]


def test_page_export_query_keeps_the_first_of_equals(spark, tmp_path):
    """Pages of one URL and length in several lists; neither their places there nor the numbers as text give their order."""
    from ledgerline.plans.catalog import QUERIES

    rows = [(198, "w"), (199, "a"), (400, "a"), (1998, "x"), (1999, "b"), (2000, "b"), (-2, "y"), (-1, "c"), (1, "c"), (None, "d"), (0, "d")]
    pages = spark.createDataFrame([(i, u, f"{u}{'none' if i is None else f'{i:4d}'}") for i, u in rows], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.url: r.digest for r in QUERIES["page_export"](spark, str(tmp_path)).collect()}
    assert {u: got[u] for u in "abcd"} == {u: hashlib.md5(h.encode()).hexdigest() for u, h in (("a", "a 199"), ("b", "b1999"), ("c", "c  -1"), ("d", "dnone"))}


def test_json_directory(spark, tmp_path):
    for name, text in (("1.json", '{"record_id": "a", "match_score": 0.5}'), ("2.json", '{"record_id": "a",\n "match_score": "manual"}'), ("3.json", "{broken"), ("4.json", '{"record_id": " "}')):
        (tmp_path / name).write_text(text)
    assert [tuple(r) for r in R.read_json_directory(spark, str(tmp_path), "record_id string, match_score string").collect()] == [("a", "manual")]


def test_locked_records(spark, tmp_path):
    (tmp_path / "ok.json").write_text("﻿" + json.dumps([{"entity": "A"}, {"entity": "B", "record_id": "own"}]))
    assert [(r.record_id, r.name) for r in R.read_locked_records(spark, str(tmp_path / "ok.json"), "entity").collect()] == [("fo_001", "A"), ("own", "B")]
    (tmp_path / "bad.json").write_text(json.dumps([{"entity": ""}]))
    with pytest.raises(ValueError, match="1 without entity"):
        R.read_locked_records(spark, str(tmp_path / "bad.json"), "entity")


def test_json_lines_and_metrics(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "tags": ["x"]}\n\n{"id": 2}\n')
    assert [r.id for r in R.read_json_lines(spark, str(tmp_path / "a.jsonl"), "id int, tags array<string>").collect()] == [1, 2]
    (tmp_path / "b.jsonl").write_text('{"id": 1}\n{oops\n')
    with pytest.raises(ValueError, match="line 2: not JSON: .oops"):
        R.read_json_lines(spark, str(tmp_path / "b.jsonl"), "id int")
    (tmp_path / "m.md").write_text("# Report\n- mrr: 0.96\n- words: none\n- hit@3: 1\n")
    assert sorted(map(tuple, R.read_metrics(spark, str(tmp_path / "m.md")).collect())) == [("hit@3", 1.0), ("mrr", 0.96)]


def test_workbook(spark, tmp_path):
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    rows = "".join(f'<row r="{i}">{cell(f"B{i}", v)}</row>' for i, v in ((1, "title"), (3, "Name"), (5, "A"), (6, " B "), (7, "A"), (8, "")))
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{rows}</sheetData></worksheet>')
    names = lambda p, h: [r.name for r in R.read_workbook_column(spark, str(p), h).collect()]
    assert sorted(names(tmp_path / "w.xlsx", "Name")) == ["A", "B"] and names(tmp_path / "w.xlsx", "None") == [] and names(tmp_path / "no.xlsx", "Name") == []


def test_indexes_logs_manifest(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c")], "doc_id long, text string")
    W.write_bm25_index(docs, str(tmp_path / "bm25"))
    assert R.read_index(spark, str(tmp_path / "bm25"), ["term", "tf"], 1).where("term = 'a'").first().tf == 2
    with pytest.raises(ValueError, match="lacks"):
        R.read_index(spark, str(tmp_path / "bm25"), ["vector"])
    with pytest.raises(ValueError, match="another version"):
        R.read_index(spark, str(tmp_path / "bm25"), ["term"], 2)
    with pytest.raises(ValueError, match="needs documents"):
        W.write_bm25_index(docs.where("false"), str(tmp_path / "none"))
    W.write_dense_index(docs.select("doc_id", F.array(F.lit(1.0)).alias("v"), F.array("text").alias("tags")), str(tmp_path / "dense"))
    assert spark.read.parquet(str(tmp_path / "dense")).first().tags.startswith("[")
    for label in ("one", "two"):
        W.append_log(spark, str(tmp_path / "log"), ["run", "status"], {"run": label, "other": 1})
    assert sorted(r.run for r in R.read_records(spark, str(tmp_path / "log")).collect()) == ["one", "two"]
    assert W.write_tables({"d": docs, "e": docs.where("false")}, str(tmp_path / "book")) == ["d"]
    rows = W.manifest({"d": docs}, R.read_artifacts(spark, str(tmp_path / "book"))).collect()
    assert rows[0].n_rows == 2 and any(r.sha256 for r in rows)
    assert "| doc_id | text |" in W.markdown_report("T", {"Docs": docs})


def test_candidate_queries_and_urls(spark):
    row = spark.createDataFrame([("Stone Hill Family Office LLC",)], "n string").select(R.candidate_queries(F.col("n")).alias("q")).first().q
    assert row == ["Stone Hill Family Office LLC", "stone hill"]
    cells = spark.createDataFrame([(1, "http://a;http://b.pdf"), (2, "['http://c', 'http://a']")], "id int, urls string")
    assert [r.url for r in R.source_urls(cells, "urls", "id").collect()] == ["http://a", "http://c"]


def test_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartitionByRange(3, "event_id").write.parquet(str(tmp_path / "in"))
    query = signals.latest_by_user(signals.read_events(spark, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "c"))
    query.awaitTermination(120)
    got = {r.user_id: r.s.event_id for r in spark.read.parquet(f"{tmp_path}/t/v{(3 - 1) % 2}").collect()}
    want = {r.user_id: r.e for r in events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", F.col("m.event_id").alias("e")).collect()}
    assert got == want
    counts = signals.windowed_counts(signals.read_events(spark, str(tmp_path / "in"), 10), "40 days").writeStream.format("memory").queryName("counts").outputMode("append").trigger(availableNow=True).start()
    counts.awaitTermination(120)
    assert spark.table("counts").columns == ["start", "event_type", "n", "total"]


def records(rng, n):
    """CSV text of n records with quoted line feeds, and each record's line and cells."""
    out, rows, line = ["id,note,tail\n"], [], 2
    for i in range(n):
        note = "".join(rng.choice(["a", "b,", "\n", "\r\n", '"', " "]) for _ in range(rng.randrange(8)))
        tail = rng.choice(["", "x", "\n"])
        text = ",".join(str(i) if c is None else '"' + c.replace('"', '""') + '"' if c else "" for c in (None, note, tail))
        rows.append((i + 2, line, str(i), note, tail))
        line += 1 + text.count("\n")
        out.append(text + rng.choice(["\n", "\r\n"]))
    return "".join(out), rows


def test_numbered_csv(spark, tmp_path):
    """Records keep their cells and lines however the file is split."""
    rng = random.Random(6)
    text, rows = records(rng, 2000)
    (tmp_path / "a.csv").write_bytes(text.encode())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for bytes_ in ("100b", "3k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            got = read_numbered_csv(spark, f"{tmp_path}/a.csv", ["id", "note", "tail"])
            assert sorted(tuple(r)[1:] for r in got.collect()) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (tmp_path / "open.csv").write_text('id,note\n1,x\n2,"y\n3,z\n')
    with pytest.raises(ValueError, match="record of line 3 is never closed"):
        read_numbered_csv(spark, f"{tmp_path}/open.csv")
    with pytest.raises(ValueError, match="headers differ"):
        read_numbered_csv(spark, f"{tmp_path}/a.csv", ["id"])


GOOD = {
    "record_id": "fo_1", "family_office_name": "Stone Office", "family_office_type": "single_family_office", "description": "What the office does.", "website_url": "https://www.stone.test", "country": "Here",
    "source_urls": "https://www.stone.test/a; https://www.stone.test/b", "source_notes": "Where it is from.", "evidence_quality": "primary", "primary_email": "", "corporate_linkedin_url": "",
}


def test_record_contract(spark, tmp_path):
    cases = [
        ({}, set()), ({"source_urls": "https://a.test/x"}, {("source_urls", "too_few")}), ({"description": "Hidden"}, {("description", "placeholder")}), ({"website_url": "https://example.com", "description": "TBD"}, {("description", "placeholder")}),
        ({"source_urls": "https://a.test/x;https://www.example.org/y"}, {("source_urls", "placeholder")}), ({"record_id": " ", "family_office_type": "Bank", "description": "todo"}, {("record_id", "blank"), ("family_office_type", "not_in_set")}),
        ({"website_url": "stone.test"}, {("website_url", "not_a_url")}), ({"primary_email": "x@y"}, {("primary_email", "not_an_email")}), ({"corporate_linkedin_url": "no"}, {("corporate_linkedin_url", "not_a_url")}),
        ({"source_urls": "https://a.test/x\nnot a url"}, {("source_urls", "not_a_url")}), ({"description": None}, {("description", "blank")}),
    ]
    rows = spark.createDataFrame([(i, *(GOOD | change).values()) for i, (change, _) in enumerate(cases)], "line_no int, " + ", ".join(f"{k} string" for k in GOOD)).withColumn("file", F.lit("f"))
    errors = record_errors(rows, ["file", "line_no"])
    got = errors.collect()
    assert [{(r.field, r.code) for r in got if r.line_no == i} for i in range(len(cases))] == [want for _, want in cases]
    assert {(r.field, r.code) for r in record_errors(rows.drop("country").where("line_no = 0"), ["line_no"]).collect()} == {("country", "missing")}
    with pytest.raises(ValueError, match="line 1: source_urls: too_few\n"):
        require_valid(errors)
    require_valid(errors.where("line_no = 0"))


def test_json_list_is_split(spark, tmp_path):
    """A list in one line comes out whole however the file is split, with braces and quotes in its strings."""
    rng = random.Random(8)
    pool = ["{", "}", '"', "\\\\", "\\n", "[", "]", "a", '"data": [', "é", "},{"]
    text = lambda: "".join(rng.choice(pool) for _ in range(rng.randrange(12)))
    items = [{"url": f"u{i % 400}", "markdown": text() * rng.choice((1, 1, 9)), "metadata": {"x": {"y": [text(), {}]}, "z": [{"k": text()}]}} for i in range(1500)]
    other = {"errors": [{"data": text()}], "note": {"a": "}"}, "data": items, "more": [{"url": "not me"}]}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for name, body, indent in (("list", items, None), ("data", other, None), ("pretty", items, 1)):
            (tmp_path / name).write_text(json.dumps(body, indent=indent))
            for bytes_ in ("4k", "128m"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
                spark.conf.set("spark.sql.files.openCostInBytes", "1b")
                got = read_json_list(spark, f"{tmp_path}/{name}").orderBy("pos").collect()
                assert [json.loads(r.text) for r in got] == items and [r.pos for r in got] == list(range(len(items)))
                assert spark.read.option("lineSep", "}").text(f"{tmp_path}/{name}").rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for broken in ('[{"a": 1}, {"b": ', '[{"a": "x'):
        (tmp_path / "broken").write_text(broken)
        with pytest.raises(ValueError, match="ends within"):
            read_json_list(spark, f"{tmp_path}/broken")
    (tmp_path / "empty").write_text("[]\n")
    assert read_json_list(spark, f"{tmp_path}/empty").count() == 0


def test_upsert(spark, tmp_path, monkeypatch):
    root, schema = f"{tmp_path}/t", "chunk_id long, kind string, text string"
    first = spark.createDataFrame([(i, "a" if i % 3 else "b", f"t{i}" if i % 4 else " ") for i in range(200)], schema)
    made = U.upsert(first, root, "b1", kind="kind")
    assert (made["n_rows"], made["counts"], made["coverage"]["text"]) == (200, {"a": 133, "b": 67}, 0.75)
    assert U.upsert(first, root, "b1", kind="kind")["version"] == 1
    second = spark.createDataFrame([(5, "c", "new"), (900, "a", None)], schema)
    # A run that ends before its commit changes nothing, and is repeated.
    with monkeypatch.context() as m:
        m.setattr(U.V, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            U.upsert(second, root, "b2", kind="kind")
    assert U.read_table(spark, root).count() == 200
    changed = U.upsert(second, root, "b2", kind="kind")
    got = {r.chunk_id: (r.kind, r.text) for r in U.read_table(spark, root).collect()}
    assert len(got) == 201 and got[5] == ("c", "new") and got[900] == ("a", None) and got[7] == ("a", "t7")
    assert changed["n_rows"] == 201 and changed["counts"] == {"a": 133, "b": 67, "c": 1} and len({e["folder"] for e in changed["buckets"].values()}) == 2
    # The digest is that of the rows, however they came together.
    whole = U.upsert(U.read_table(spark, root).drop("bucket"), f"{tmp_path}/other", "x", kind="kind")
    assert whole["digest"] == changed["digest"] != made["digest"]
    assert U.upsert(second.limit(0), root, "b3", kind="kind")["version"] == 2 and U.upsert(second, root, "b4", kind="kind", reset=True)["n_rows"] == 2
    for rows, message in ((second.union(second), "stand twice"), (second.drop("kind"), "the table has")):
        with pytest.raises(ValueError, match=message):
            U.upsert(rows, root, "bad")


def test_golden_questions(spark, tmp_path):
    default = [{"id": "q1", "question": "Who?", "gold_record_ids": ["r1"], "must_include": ["x"], "expected_behavior": "answer"}, {"id": "q2", "question": "What?", "expected_behavior": "abstain"}]
    for _ in range(2):
        got = {r.id: r for r in R.read_golden(spark, f"{tmp_path}/golden", default).collect()}
        assert got["q1"].gold_record_ids == ["r1"] and got["q1"].must_exclude == [] and got["q2"].gold_record_ids == [] and got["q2"].notes == "" and len(got) == 2
        default = []
