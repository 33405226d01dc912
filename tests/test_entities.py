"""Registry matches, mentions, quotes by turn and rosters, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import matching as M
from ledgerline.operators import mentions as N
from ledgerline.operators import sequences as S

ENTRIES = "entry_id long, name string, aliases array<string>, city string, state string"
RECORDS = "record_id long, name string, city string, state string"


def resolved(spark, records, entries):
    return {r.record_id: r for r in M.resolve(spark.createDataFrame(records, RECORDS), spark.createDataFrame(entries, ENTRIES)).collect()}


def test_resolve(spark):
    entries = [
        (1, "BRAMBLE, LLC", ["BRAMBLE, LLC"], "LONG HOLLOW", "WY"), (2, "Other Advisors", [], "Miami", "FL"), (3, "Stone Hill Partners", ["Old Mill Trust"], "Boston", "Massachusetts"),
        (4, None, None, None, None), (5, "Stone Hill River", None, "Boston", "MA"),
    ]
    records = [(1, "Bramble", "Long Hollow", "WY"), (2, "Old Mill Trust", "", "MA"), (3, "Stone Hill Family Office", "Boston", "MA"), (4, None, None, None), (5, "Nobody Here", "Miami", "FL"), (6, "Stone River", "Boston", "ma")]
    got = resolved(spark, records, entries)
    assert got[1].entry_id == 1 and got[1].score == 1.0 and "simplified_name_exact_match" in got[1].reason and got[1].verdict == "matched" and got[1].n_queries == 1
    assert got[2].entry_id == 3 and got[2].score == 0.75 and "Old Mill Trust" in got[2].reason
    # No hit of the whole name is good enough; its first words name both entries, of which one is equal without generic words, at the same place.
    assert got[3].entry_id == 3 and got[3].score == 1.0 and got[3].n_queries == 2
    assert got[4].entry_id is None and got[4].n_queries == 0 and got[5].entry_id is None and got[5].verdict == "unmatched"
    assert got[6].entry_id == 5 and got[6].reason == "name_jaccard=0.67 (vs 'Stone Hill River'); address_match=city+state"


def test_similar_sets_are_whole(spark):
    rng = random.Random(3)
    words = ["the"] * 6 + ["of"] * 3 + [f"w{i}" for i in range(40)]
    sets = [sorted({rng.choice(words) for _ in range(rng.choice((1, 2, 3, 4, 6, 9, 17)))}) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in sets], "tokens array<string>")
    for similar in (0.35, 0.5, 0.8):
        got = {(tuple(r.l), tuple(r.r)) for r in M.similar_sets(df.limit(120), df, similar).collect()}
        left = {tuple(r.tokens) for r in df.limit(120).collect()}
        want = {(a, b) for a in left for b in map(tuple, sets) if len({*a} & {*b}) >= similar * len({*a} | {*b})}
        assert got == want


def test_hot_names_collapse(spark):
    """A thousand entries of one name and a thousand records that ask for it meet as one pair."""
    entries = [(i, "The Stone Trust", None, "x", "y") for i in range(1000)]
    got = resolved(spark, [(i, "Stone Trust", "x", "y") for i in range(1000)] + [(-1, "the", "", "")], entries)
    assert len(got) == 1001 and all(r.entry_id == 0 and r.score == 1.0 for k, r in got.items() if k >= 0) and got[-1].entry_id is None


def brute_mentions(texts, records):
    out = []
    for mark, (id_, text) in enumerate(texts):
        if text is None:
            continue
        text, found = text.lower(), []
        for record_id, name, identifiers, numbers in records:
            if not (name or "").strip():
                continue
            low = name.strip().lower()
            tokens = [w for w in "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in low).split() if len(w) > 2]
            hosts = [v.split("://")[1].split("/")[0].removeprefix("www.") for v in identifiers or [] if "://" in v]
            if low in text:
                weight = len(low)
            elif any(v.lower() in text for v in [*(identifiers or []), *hosts, *(numbers or [])]):
                weight = 80
            elif len(tokens) >= 2 and all(w in text for w in tokens[:3]):
                weight = sum(map(len, tokens))
            else:
                continue
            found.append((weight, record_id, name.strip()))
        out += [(id_, record_id, weight, place) for place, (weight, record_id, _) in enumerate(sorted(found, reverse=True), 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 50_000])
def test_mentions(spark, monkeypatch, block):
    monkeypatch.setattr(N, "RECORDS", block)
    monkeypatch.setattr(N, "PART_BYTES", 200)
    records = [
        ("r1", "Stone Hill", ["info@stone.example", "https://www.stonehill.example/x"], ["1234"]), ("r2", "Hill", None, None), ("r3", " ", ["x"], None), ("r4", None, None, ["5"]), ("r5", "The Old Mill Trust", [], []),
        ("r6", "Stone Hill", None, ["98765"]), ("r7", "of to", None, None), *[(f"x{i}", f"Stone Common{i} Name", None, None) for i in range(40)],
    ]
    texts = [(1, "STONE HILL and the old mill"), (2, "trust the mill of old"), (3, "write to Info@Stone.example"), (4, "see stonehill.example now"), (5, None), (6, ""), (7, "call 98765 or 1234"), (8, "names of common7 stones"), (8, "names of common7 stones"), (9, "x" * 100_000 + "hillstone")]
    got = N.mentions(spark.createDataFrame(texts, "text_id long, text string"), spark.createDataFrame(records, "record_id string, name string, identifiers array<string>, numbers array<string>"))
    assert sorted(map(tuple, got.collect())) == brute_mentions(texts, records)


def sequential(rows, most):
    out, used = [], {}
    for key, at, quotes in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        taken = used.setdefault(key, set())
        mine = []
        for q in quotes or []:
            sig = q[:80].lower()
            if len(mine) < most and sig not in taken and sig not in [m[:80].lower() for m in mine]:
                mine.append(q)
        taken |= {m[:80].lower() for m in mine}
        out += [(key, at, i, "extracted", q) for i, q in enumerate(mine, 1)] or [(key, at, 1, "no_keyword_match", None)]
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [1, 2])
def test_snippets_end_as_the_sequential_rule_does(spark, most):
    rng = random.Random(most)
    pool = [f"Quote {i} " + "y" * rng.choice((5, 90)) for i in range(25)]
    rows = [(rng.choice(("a", "b", None)), i, rng.choices(pool, k=rng.choice((0, 1, 3, 6)))) for i in range(120)]
    rows += [("copies", 1000 + i, pool[:6]) for i in range(9)] + [("copies", 990, [pool[5].upper(), pool[0]]), ("empty", 1, None)]
    df = spark.createDataFrame(rows, "k string, at long, quotes array<string>").repartition(3)
    assert sorted(map(tuple, S.distinct_snippets(df, "k", "at", F.col("quotes"), most).collect()), key=str) == sequential(rows, most)


def test_names_and_roles(spark):
    names = {"Ada Stone": True, "Ada W. Stone": True, "Jean-Luc O’Neil": True, "Our Team": False, "About Us": False, "Investment Management": False, "ADA STONE": False, "ada stone": False, "Solo": False, "A B C D E F": False, "Ada Stone MBA": False, "W. Stone": False, "New York": False}
    roles = {"Managing Partner": True, "Founder & CEO": True, "Chief Investment Officer": True, "Head of Research": True, "Trustee": True, "[Senior Partner]": True, "Seniority matters": False, "New York, NY": False, "Lorem ipsum dolor sit": False, "Partner " + "x" * 80: False}
    for table, test in ((names, S.is_name), (roles, S.is_role)):
        got = spark.createDataFrame([(k,) for k in table], "line string").select("line", test(F.col("line")).alias("ok")).collect()
        assert {r.line: r.ok for r in got} == table


def test_rosters(spark):
    pages = {
        1: "The people\n\n**Orla Marsh**, Managing Partner — sees to all.\n**Pell Q. Marsh**, Partner — looks after land.\n",
        2: "### Orla Marsh\nManaging Partner & Founder\n\nA few words on this.\n\n### Rhys Calder\nDirector of Investments\n",
        3: "### Our Team\nManaging Partner in charge.\n\n### About\nWhat is done.\n",
        4: "**Orla Marsh**, Managing Partner.\n\n### Orla Marsh\nManaging Partner\n",
        5: None, 6: "", 7: "**Ada Stone** and **Ben Hill**, [Senior Partner](https://a.example/x)\\\n",
    }
    df = spark.createDataFrame([(k, "https://a.example/team", v) for k, v in pages.items()], "id long, url string, md string")
    got = sorted((r.id, r.name, r.role, r.extraction_method) for r in S.rosters(df, "id", "url", "md").collect())
    assert got == sorted([
        (1, "Orla Marsh", "Managing Partner — sees to all", "bold"), (1, "Pell Q. Marsh", "Partner — looks after land", "bold"), (2, "Rhys Calder", "Director of Investments", "heading"),
        (2, "Orla Marsh", "Managing Partner & Founder", "heading"), (4, "Orla Marsh", "Managing Partner", "bold"), (7, "Ben Hill", "Senior Partner", "bold"),
    ])
    assert S.rosters(df.withColumn("url", F.lit("https://a.example/x")), "id", "url", "md").select("id").distinct().count() == 3
