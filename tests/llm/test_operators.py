"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and odd columns."""

import hashlib
import inspect
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat_tree, common, components, cotraining, decontaminate, jaccard_join, line_dedup, packing, pii, quality_rules, toxicity, warc
from ledgerline.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, row_key string, __doc string, q int"
WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "so", "ta", "ve") for b in ("bra", "cet", "don", "fel", "gim", "hup", "jor", "kim")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def corpus():
    rng = random.Random(1)
    shared = "  This Line stands in MANY documents\t"
    texts = [prose(rng, rng.randrange(5, 200)) + "\n" + shared.upper() + "\n" + prose(rng, 30) for _ in range(30)]
    texts += [texts[3], texts[3], texts[4] + " extra words", "", None, "short", "x", "x", "\n\n\n", "é" * 30 + "\n" + shared, "word " * 30_000, "a" * 100_000]
    rows = [(i, t, None if i % 7 == 0 else "en", "s", None, "raw", "k", "d", 1) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (1, "another text under a known id", "en", None, 3, None, None, None, None), (None, texts[5], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows):
    holders = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(-(2**63) if r[0] is None else r[0])
    drop = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        own = -(2**63) if r[0] is None else r[0]
        kept = [x for x in lines if drop.get(key(x), own) == own]
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup(docs, rows, empty):
    assert Counter(tuple(r) for r in line_dedup.line_report(docs).collect()) == brute_lines(rows)
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert line_dedup.line_report(empty).count() == 0 and line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_run_over_many_partitions(spark):
    """One hot line in order of many partitions: only the largest document keeps it."""
    rows = [(i, f"{'hot line of more than twenty':s}\nown line number {i:09d} here") for i in range(500)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = {r.doc_id: r.n_dropped for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == {i: int(i != 499) for i in range(500)}


def brute_quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_rules(spark, docs, rows, empty):
    got = quality_rules.quality_report(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((r[0], *brute_quality(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    assert quality_rules.quality_report(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0


def test_label_model_finds_bad_rules():
    n = len(quality_rules.RULES)
    good, bad, symbols = "-" * (n - 1) + "1", "0" * 3 + "-" * (n - 3), "-0" + "-" * (n - 2)
    model = quality_rules.fit_label_model({good: 900, bad: 60, symbols: 40})
    p = model["posterior"]
    assert p[good] > 0.9 and p[bad] < 0.1 and p[symbols] < 0.1


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    t = Tokenizer.from_file(path)
    pieces = packing.pack_documents(docs, path).collect()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    want = defaultdict(Counter)
    for r in rows:
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want[r[0]][len(ids), ids.tobytes()] += 1
    for doc_id, found in by_doc.items():
        if sum(want[doc_id].values()) == 1:
            found.sort(key=lambda p: p.start)
            assert [p.start for p in found] == list(np.cumsum([0, *(p.length for p in found)])[:-1])
            assert (found[0].doc_tokens, b"".join(bytes(p.ids) for p in found)) in want[doc_id]
        else:
            assert sum(p.length for p in found) == sum(n * c for (n, _), c in want[doc_id].items())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for s in sequences.values():
        ends = [a + n for a, n in sorted(s)]
        assert [a for a, _ in sorted(s)] == [0, *ends[:-1]] and ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0
    assert all(r.ids_crc32 == zlib.crc32(bytes(p.ids)) for r, p in zip(sorted(packing.packing_report(docs, path).collect(), key=str), sorted(pieces, key=str), strict=False) if (r.doc_id, r.start, r.length) == (p.doc_id, p.start, p.length) and len(want[p.doc_id]) == 1)
    assert packing.pack_documents(empty, path).count() == 0


def test_hilbert_neighbours():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = np.argsort(packing.hilbert_index(cells, 3))
    assert sorted(packing.hilbert_index(cells, 3)) == list(range(512))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_token_cache_equals_tokenizer():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    t, cache = Tokenizer.from_file(path), packing.TokenCache(path, most=50)
    rng = random.Random(4)
    letters = "abzABZéÉßΣσςİ \t\n\r\x0b\x1c  '’.,!?-09№ñ́\U0001f600<|>"
    for text in ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(500)] + ["<|endoftext|>", "a <|ENDOFTEXT|> b", "it's he'll.", "word, word. word.. word,"]:
        assert np.frombuffer(cache.encode(text.encode()), "<u2").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_tokens_of_whole_texts_and_of_another_tokenizer(spark):
    from tokenizers import Tokenizer

    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = tokenizer_path(name)
        t, cache = Tokenizer.from_file(path), packing.TokenCache(path)
        assert cache.whole == (name != "word_bpe_49k.json")
        for text in texts:
            assert np.frombuffer(cache.encode(text.encode()), "<u2").tolist() == t.encode(text, add_special_tokens=False).ids


def base_spans(text):
    out = []
    for kind, form in pii.FORMS.items():
        for m in re.finditer(form, text or ""):
            digits = re.sub(r"\D", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii(spark, docs, rows, empty):
    rng = random.Random(3)
    marks = "0123456789 -.+()@ab%_\né😀"
    texts = ["".join(rng.choice(marks if rng.random() < 0.5 else "0123456789.- +@") for _ in range(rng.randrange(120))) for _ in range(600)]
    texts += [rng.choice(["", "-", " "]).join(str(rng.randrange(10)) for _ in range(rng.randrange(14, 21))) for _ in range(600)]
    texts += ["a" * 50_000, "1" * 50_000, "1 " * 20_000, "+" * 500 + "+1" + "(" * 20_000, "a@b" + ".c" * 20_000, None, "1.2.3.4 " * 500, "my bank iban DE89 3704 0044 0532 0130 00 is mine"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.pii_report(table).collect():
        base = base_spans(texts[r.doc_id])
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("iban")] == base
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(base)
    last = pii.find_pii(table.where(f"doc_id = {len(texts) - 1}")).first().pii
    assert [s.kind for s in last] == ["iban"] and last[0].score == pytest.approx(1.0)
    assert pii.find_pii(docs).columns == [*docs.columns, "pii"] and pii.pii_report(docs).count() == len(rows) and pii.pii_report(empty).count() == 0
    plan = pii.pii_report(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_decontamination(spark, docs, rows, empty):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([5, 6, 9, 12, 20, 40, 80, 300, 4, 0])] + [(90, None), (None, "no id"), (91, WORDS[0] + "7"), (92, prose(rng, 2)), (93, "never there at all")]
    planted = [(1000 + i, f"{prose(rng, 300)} {t or ''} {prose(rng, 900)}", "en", "s", 1, None, None, None, None) for i, t in items if i is not None]
    broken = [(2000, items[5][1].replace(items[5][1].split()[20], "changed"), None, None, None, None, None, None, None)]
    every = spark.createDataFrame([*rows, *planted, *broken], DOCS)
    table = spark.createDataFrame(items, "item_id long, text string")

    def grams(t, n=5):
        w = re.sub(r"[^\w]", " ", (t or "").lower()).split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    def held(t, text):
        n = min(len(re.sub(r"[^\w]", " ", (t or "").lower()).split()), 5)
        return n > 0 and len(grams(t, n) & grams(text, n)) >= 0.8 * len(grams(t, n))

    want = Counter((r[0], i) for r in [*rows, *planted, *broken] for i, t in items if i is not None and held(t, r[1]))
    assert {i for _, i in want} >= {0, 1, 2, 3, 4, 5, 6, 7, 8, 91, 92}
    for block_chars in (4_000_000, 500):  # one block of items, and many
        assert Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(every, table, block_chars=block_chars).collect()) == want
        clean = decontaminate.clean_documents(every, table, block_chars=block_chars)
        assert clean.columns == every.columns and clean.count() == every.count() - len({d for d, _ in want if d is not None})
    assert decontaminate.leaks(empty, table).count() == 0 and decontaminate.clean_documents(docs, table.where("false")).count() == len(rows)


def brute_classes(rows):
    """(doc_id, text) -> (class, links) by all pairs."""
    sets = [frozenset(jaccard_join.shingle_set((r[1] or "").encode()).tolist()) if r[0] is not None else frozenset() for r in rows]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter((r[0], least.get(root(i)), links[i]) for i, r in enumerate(rows))


def near_copies(n=120, size=150):
    """A large group of near copies whose similarities lie on both sides of the threshold."""
    rng = random.Random(5)
    words = prose(rng, size).split()
    out = []
    for i in range(n):
        own = list(words)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(size)] = f"new{rng.random()}"
        out.append((500 + i, " ".join(own), "en", "s", 1, None, None, None, None))
    return out


def test_bucket_pass_holds_no_large_bucket():
    """Edges of small buckets, rows and sizes of large ones, however the rows are cut into batches."""
    rng = np.random.default_rng(5)
    kinds = rng.integers(0, 256, (3, jaccard_join.N_VALUES), np.uint8)
    rows = [(1, 5, 5, 0), (1, 6, 6, 1), (1, 6, 6, 1), (1, 7, 7, 0), (2, 8, 8, 0)]  # 5 and 7 are near; a set may come twice
    rows += [(3, 20 + k, 9, 0) for k in range(4)] + [(3, 30 + k, 11, 1) for k in range(6)] + [(3, 40, 40, 2)] + [(4, 50 + k, 50, 0) for k in range(9)] + [(5, 3, 3, 1), (5, 4, 4, 1)]
    seen = set()
    for size in (1, 2, 3, 7, 100):
        cut = [rows[at : at + size] for at in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*b, strict=True))[:3]] + [pa.array([kinds[r[3]].tobytes() for r in b], pa.binary())], ["path", "sid", "comp", "short"]) for b in cut]
        found = [r for b in jaccard_join._bucket_pass(4, 39)(iter(batches)) for r in b.to_pylist()]
        assert sorted((r["u"], r["v"]) for r in found if r["u"] is not None) == [(3, 4), (5, 7)]
        assert [(r["path"], r["c"], r["k"], r["most"], r["main"]) for r in found if (r["k"] or 0) > 1] == [(3, 11, 3, 6, 11)]
        large = [(r["sid"], r["comp"], r["part"], r["short"]) for r in found if r["path"] == 3 and r["sid"] is not None]
        assert large == [(s, c, n // 4, kinds[k].tobytes()) for n, (p, s, c, k) in enumerate(r for r in rows if r[0] == 3)]
        seen.add(tuple(large))
    assert len(seen) == 1


def test_components_of_few_edges_take_one_table(spark, monkeypatch):
    """A chain of 400 nodes, a star and a pair: one task contracts them, in place of a round of shuffles for each doubling; in parts the result is the same."""
    edges = [(k, k + 1) for k in range(399)] + [(1000, 1000 + k) for k in range(60)] + [(5000, 4000)]
    table = spark.createDataFrame(edges, "u long, v long").repartition(7)
    want = {k: 0 for k in range(400)} | {1000 + k: 1000 for k in range(60)} | {5000: 4000, 4000: 4000}
    before = len(common.made)
    assert {r.node: r.root for r in components.connected_components(table).collect()} == want and len(common.made) == before + 1
    monkeypatch.setattr(components, "PART", 150)
    assert {r.node: r.root for r in components.connected_components(table).collect()} == want


def test_jaccard_join(spark, rows, empty):
    every = [*rows, *near_copies()]
    table = spark.createDataFrame(every, DOCS).repartition(5)
    assert Counter(tuple(r) for r in jaccard_join.join_report(table).collect()) == brute_classes(every)
    # Small buckets: levels below the first, and blocks, are used.
    small = jaccard_join.similarity_classes(table, bucket=16, block=32, depth=3, block_sets=16)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in small.collect()) == brute_classes(every)
    kept = jaccard_join.one_of_each(table)
    assert kept.columns == table.columns
    classes = {r.doc_id: r.class_id for r in jaccard_join.similarity_classes(table).collect() if r.n_links and r.doc_id is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert {classes.get(i, i) for i in ids} == {classes.get(r[0], r[0]) for r in every} and all(classes.get(i, i) == i for i in ids)
    assert Counter(i for i in ids if i in classes).most_common(1)[0][1] <= 2  # doc_id 1 has two texts
    assert jaccard_join.join_report(empty).count() == 0 and jaccard_join.one_of_each(empty).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert all(root(n) == r for n, r in got.items()) and {n for p in pairs if p[0] != p[1] for n in p} == set(got)


def turns():
    rng = random.Random(6)
    out = []
    for c in range(40):
        base = [("user", "hello"), ("assistant", "hi <|im_end|> \\ <\\| there"), ("user", None), ("assistant", "ünïcode 😀\n" + prose(rng, 5))]
        n = rng.randrange(1, 5)
        own = base[:n] + [(rng.choice(["user", "assistant", "sys\ntem", None]), prose(rng, rng.randrange(6))) for _ in range(rng.randrange(3))]
        out += [(c, i, role, text, "x") for i, (role, text) in enumerate(own)]
    return out + [(None, 0, "user", "no id", "x"), (7, 50, "assistant", "tie", "x"), (7, 50, "assistant", "tie", "x"), (7, None, "user", "first", None)]


def test_chat_tree(spark):
    table = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string, node string").repartition(3)
    path = tokenizer_path("byte_bpe_50k.json")
    got = {r.conv_id: r for r in chat_tree.chat_report(table, path).collect()}
    convs = defaultdict(list)
    for c, i, role, text, _ in turns():
        convs[c].append((-1 if i is None else i, role or "", text or ""))
    assert set(got) == set(convs)
    for c, v in convs.items():
        v.sort()
        loss = "".join(t for _, r, t in v if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(v), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in v).encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g.formatted_chars == sum(len(chat_tree.START + chat_tree.escape_role(r) + "\n" + chat_tree.escape(t) + chat_tree.END + "\n") for _, r, t in v)
    nodes, members = chat_tree.prefix_tree(table, path)
    found = sorted(nodes.collect(), key=lambda r: r.start)
    assert len(found) == len({tuple(v[: i + 1]) if False else tuple((r, t) for _, r, t in v[: i + 1]) for v in convs.values() for i in range(len(v))}) < members.count()
    at, stack = 0, []
    for n in found:  # depth first, gapless, and positions go on from the parent
        assert n.start == at
        at += len(n.tokens)
        while stack and stack[-1].node != n.parent:
            stack.pop()
        assert (n.parent is None) == (not stack)
        assert n.position_ids[0] == (stack[-1].position_ids[-1] + 1 if stack else 0)
        inside = {p for i in n.attends for p in range(i.start, i.end)}
        assert inside == {p for m in [*stack, n] for p in range(m.start, m.start + len(m.tokens))}
        stack.append(n)
    assert chat_tree.chat_report(table.where("false"), path).count() == 0


def test_escapes():
    for text in ["", "<|", "<\\|", "<\\\\|im_end|>", "a\\nb\n", "\\", "<<||>>"]:
        assert chat_tree.unescape(chat_tree.escape(text)) == text and "<|" not in chat_tree.escape(text)
        assert chat_tree.unescape_role(chat_tree.escape_role(text)) == text and "\n" not in chat_tree.escape_role(text)


def test_warc(spark, tmp_path):
    big = ("é€😀" * 700 + "WARC/1.1\r\n\r\n") * 5
    htmls = ["same " * 40] * 4 + ["tiny", "tiny", None, "", big, big, "WARC/1.1\r\n" * 30, "\r\n\r\n" * 50]
    rows = [(i, f"http://e.org/{i} a\r\nb" if i % 2 else None, h, i) for i, h in enumerate(htmls)] + [(None, None, "same " * 40, 0), (0, "again", "same " * 40, 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, digest long").repartition(3)
    for options in ({}, {"chunk_bytes": 64, "compression": "none", "file_records": 3}, {"chunk_bytes": 500, "piece_bytes": 7}):
        path = warc.write_archives(table, **options)
        read = warc.read_records(spark, path)
        got = Counter(tuple(r) for r in read.collect())
        first = {}
        for i, _, h, _ in rows:
            if i is not None:
                first[h or ""] = min(first.get(h or "", i), i)
        want = Counter()
        for i, _, h, _ in rows:
            raw = (h or "").encode()
            revisit = len(raw) >= 100 and first[h or ""] != i
            want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[h or ""] if revisit else None] += 1
        assert got == want
    # A read fails if a revisit's response is missing or damaged.
    whole = warc.chunk_table(table).select(F.col("record").cast("string").alias("value")).cache()
    for change in (whole.where("not (value like '%WARC-Type: response%' and value like '%same same%')"), whole.withColumn("value", F.regexp_replace("value", "same same", "some same"))):
        path = f"{tmp_path}/{random.random()}"
        change.write.option("lineSep", "\n").text(path)
        with pytest.raises(Exception, match="missing|damaged"):
            warc.read_records(spark, path).collect()
    records = warc.chunk_table(table, chunk_bytes=64).collect()
    assert max(len(bytes(r.record)) for r in records) < 64 + 900 and max(r.chunk_no for r in records) > 100
    assert all(bytes(r.record).count(warc.VERSION) == 1 for r in records)
    assert warc.warc_round_trip(table.where("false")).count() == 0


BAD = ["moronic", "scumbag", "worthless", "idiotic"]


def labelled(n=700):
    rng = random.Random(9)
    out, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(20, 250)).split()
        toxic, junk = i % 5 == 0, i % 6 == 0
        if toxic:
            for _ in range(3 + len(words) // 20):
                bad = rng.choice(BAD)
                words.insert(rng.randrange(len(words)), bad if rng.random() < 0.5 else bad + rng.choice("sxyz"))
        text = " ".join(f"{w}!!".upper() if junk else w for w in words)
        out.append((i, text, "en", f"s{i % 9}", len(text), None, None, None, None))
        labels.append((i, int(not junk), int(toxic)))
    return out, labels


def test_classifiers(spark, docs, rows, empty):
    data, marks = labelled()
    table = spark.createDataFrame([*data, *rows], DOCS).where("doc_id is null or doc_id >= 60 or length(text) > 0 or text is null or true")
    labels = spark.createDataFrame([*marks, (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    truth = {d: (q, t) for d, q, t in marks if d >= 100}
    scored = toxicity.score_documents(table, labels).collect()
    assert len(scored) == len(data) + len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    held = [r for r in scored if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored if r.doc_id is not None)
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id][1] for r in held) > 0.93 * len(held)
    good = cotraining.score_quality(table, labels).collect()
    assert len(good) == len(data) + len(rows)
    assert sum(r.predicted == truth[r.doc_id][0] for r in good if r.doc_id in truth) > 0.95 * len(truth)
    none = labels.where("false")
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0} and {r.score for r in cotraining.score_quality(docs, none).collect()} == {1.0}
    assert toxicity.score_documents(empty, labels).count() == 0 and cotraining.score_quality(empty, labels).count() == 0


def test_runs_reach_the_target_recall():
    """The fixed 16 runs lost 0.4 % of the pairs at depth four."""
    assert jaccard_join.pair_recall(16, 4, 0.8) < 0.997 and jaccard_join.runs_for(0.9998, 2, 0.8) == 16
    for depth in (2, 3, 4):
        assert jaccard_join.pair_recall(jaccard_join.runs_for(0.9998, depth, 0.8), depth, 0.8) >= 0.9998
    with pytest.raises(ValueError):
        jaccard_join.runs_for(0.99999, 2, 0.8)


def test_classes_that_share_a_doc_id_both_stay(spark):
    rng = random.Random(4)
    a, b = prose(rng, 60), prose(rng, 60)
    table = spark.createDataFrame([(5, a), (7, a + "\n"), (5, b), (9, b + "\n"), (11, prose(rng, 60))], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in jaccard_join.one_of_each(table).where("doc_id < 11").collect()) == sorted([(5, a), (5, b)])


def test_every_unlabelled_row_trains(spark):
    """Two sources that only the last rows by hash have, after 20,000 others, alike but for their texts: the metadata view tells them apart."""
    data, marks = labelled(300)
    ids = [r.doc_id for r in spark.range(10_000, 30_600).withColumnRenamed("id", "doc_id").orderBy(F.xxhash64("doc_id")).collect()]
    good, bad = ("x" * 3 + " " + " ".join(WORDS[i % 50 : i % 50 + 12]) + " y" for i in (1, 1))
    bad = good.upper().replace(" ", "!", 2)
    source = {d: "last_good" if i % 2 else "last_bad" for i, d in enumerate(ids[-400:])}
    data += [(d, bad if source.get(d) == "last_bad" or (d not in source and d % 2) else good, "en", source.get(d, "many"), len(good), None, None, None, None) for d in ids]
    scored = cotraining.score_quality(spark.createDataFrame(data, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    p = {r.doc_id: r.metadata_probability for r in scored.where("doc_id >= 10000").collect()}
    of = lambda name: {round(p[d], 9) for d, s in source.items() if s == name}
    assert len(of("last_good")) == len(of("last_bad")) == 1 and max(of("last_bad")) < min(of("last_good")) - 0.01


def test_toxicity_bounds_are_not_cut():
    bounds = inspect.signature(toxicity.train).parameters
    assert (bounds["max_toxic"].default, bounds["max_clean"].default) == (4000, 8000)


def test_toxicity_ignores_held_out_labels(spark):
    data, marks = labelled(200)
    table = spark.createDataFrame(data, DOCS)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in marks]
    first, second = (sorted((r.doc_id, round(r.score, 6)) for r in toxicity.score_documents(table, spark.createDataFrame(m, "doc_id long, quality int, toxic int")).collect()) for m in (marks, flipped))
    assert first == second


def test_toxicity_held_out(spark):
    """Documents whose labels training never saw, at sf0.1: 97 toxic ones, of which five hold no toxic word."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_documents(docs, labels).where("held_out").join(labels.where("toxic is not null"), "doc_id").select("predicted", "toxic").collect()
    toxic, clean = ([r.predicted for r in scored if r.toxic == y] for y in (1, 0))
    assert len(toxic) > 90 and sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_cotraining_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    apart = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)
    scored = cotraining.score_quality(docs, labels.join(apart, "doc_id", "left_anti")).join(apart.where("quality is not null"), "doc_id").select("predicted", "quality").collect()
    assert len(scored) > 700 and sum(r.predicted != r.quality for r in scored) <= 0.01 * len(scored)


def test_label_model_equals_one_document_at_a_time(spark, docs):
    """Expectation-maximisation written out over single documents, against the one over counts of patterns."""
    rules = [r.votes for r in quality_rules.with_votes(docs).select("votes").collect()]
    expected, weight, n_rules = {0: (0.2, 0.02), 1: (0.01, 0.3)}, 0.02 * len(rules), len(quality_rules.RULES)
    rate = [[{"0": b, "1": g, "-": 1 - b - g} for _ in range(n_rules)] for b, g in expected.values()]
    prior = 0.85
    for _ in range(50):
        p = []
        for v in rules:
            odds = np.log(prior / (1 - prior)) + sum(np.log(rate[1][j][c]) - np.log(rate[0][j][c]) for j, c in enumerate(v))
            p.append(1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        prior = min(max((sum(p) + 0.85 * weight) / (len(p) + weight), 0.02), 0.98)
        for y in (0, 1):
            own = [x if y else 1 - x for x in p]
            start = dict(zip("01-", (*expected[y], 1 - sum(expected[y])), strict=True))
            rate[y] = [{c: (sum(o for o, v in zip(own, rules, strict=True) if v[j] == c) + weight * start[c]) / (sum(own) + weight) for c in "01-"} for j in range(n_rules)]
    model = quality_rules.fit_label_model(dict(Counter(rules)))
    assert all(abs(model["posterior"][v] - x) < 1e-9 for v, x in zip(rules, p, strict=True))
    for r in quality_rules.quality_report(docs).collect():
        assert r.kept == (not r.base_failed and r.quality_probability >= 0.25)


def test_pii_scores_and_secrets(spark):
    texts = ["my card number is 4111 1111 1111 1111", "order 4111 1111 1111 1111", 'token = "abcdef0123456789abcd"', "api_key: 0123456789abcdef", "token of many words", "password: onlylettersarenone", None, "+49 30 1234567 serial build"]
    got = {r.doc_id: r for r in pii.pii_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_secret for i in range(8)] == [0, 0, 1, 1, 0, 0, 0, 0]
    assert (got[0].scores, got[0].n_likely) == ("0.90", 1) and (got[1].scores, got[1].n_likely) == ("0.50", 1) and (got[7].scores, got[7].n_likely) == ("0.30", 0)
    assert got[2].spans == "secret:0:29" and got[6].spans == ""


def test_ibans_and_long_secrets_are_whole(spark):
    """An IBAN ends where its country says, whatever follows; a secret of any length is one span."""
    texts = {
        "DE89370400440532013000 IS MY ACCOUNT": "iban:0:22", "DE89 3704 0044 0532 0130 00 BIC COBADEFF": "iban:0:27", "GB82WEST12345698765432 REF 123": "iban:0:22", "pay NO9386011117947, now": "iban:4:19", "DE893704004405320130001": "", "XX89370400440532013000": "",
        "token = " + "a1" * 300: "secret:0:608", "password=" + "k9" * 40_000: "secret:0:80009", "token=" + "1" * 40: "", "token: " + "z" * 40: "", "MT84MALT011000012345MTLCAST001S IS IT": "iban:0:31",
    }
    got = pii.pii_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [",".join(x for x in r.spans.split(",") if x.startswith(("iban", "secret"))) for r in sorted(got)] == list(texts.values())
