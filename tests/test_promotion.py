"""Promotion by several sources, principals, news, screening of records, claims and chunks: stated cases."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import urls as L
from ledgerline.functions import urls as U
from ledgerline.operators import record_chunks as C
from ledgerline.operators import records as Q
from ledgerline.operators import survivorship as P

FIRM = {"at": 1, "website": "https://www.larch.test/", "url": "https://maps.test/larch", "phone": "(307) 555-0142", "phone_unformatted": "+13075550142", "reviews_count": "4.0", "total_score": "5.0", "category_name": "Bookkeeping", "permanently_closed": "False", "temporarily_closed": None}


def listing(**change):
    return tuple((FIRM | change).values())


def test_places(spark):
    sites = ("larch.test", "other.test", "shut.test", "bare.test", "larch.test/about", "")
    records = [(i, f"https://{s}" if s else "", "(307) 555-0142" if i == 0 else "+1 307 555 0199" if i == 4 else "", "Kept" if i == 4 else None) for i, s in enumerate(sites)]
    listings = [
        listing(), listing(at=2, url="https://maps.test/later", phone="1"), listing(at=0, permanently_closed="True"), listing(website="http://elsewhere.test"), listing(website="shut.test", temporarily_closed="TRUE"), listing(website="bare.test", url=" "),
        listing(website=None), listing(website=" "),
    ]
    schema = ", ".join(f"{c} {'int' if c == 'at' else 'string'}" for c in FIRM)
    out = P.fold(spark.createDataFrame(records, "id int, website_url string, primary_phone string, google_places_category string"), U.domain(F.col("website_url"), "any"), [(P.places(), spark.createDataFrame(listings, schema))])
    out = out.withColumns({"wrote": P.wrote("google_places"), "agrees": P.phone_agrees(F.col("primary_phone"), F.col("google_places_phone"))})
    got = {r.id: r for r in out.collect()}
    assert (got[0].google_places_phone, got[0].google_places_reviews_count, got[0].google_places_rating, got[0].google_places_category) == ("(307) 555-0142", "4", "5.0", "Bookkeeping")
    assert (got[0].google_places_evidence_url, got[0].google_places_confidence, got[0].agrees) == ("https://maps.test/larch", "google_places_domain_match", "True")
    assert got[4].google_places_category == "Kept" and got[4].cells["google_places_category"].source == "record" and got[4].cells["google_places_category"].other == 1 and got[4].agrees == "False"
    assert not any(got[i].wrote or got[i].google_places_evidence_url for i in (1, 2, 3, 5)) and got[5].cells == {}


def test_sources_fold_in_order(spark):
    source = lambda name: P.Source(name, f"by {name}", (f"{name}_url", f"{name}_confidence"), F.col("k"), "at", F.col("url"), {"phone": F.col("phone"), "mail": F.col("mail")}, policy="last" if name == "b" else "first")
    schema = "k string, at int, url string, phone string, mail string"
    a = spark.createDataFrame([("x", 1, "ua", "1", " "), ("x", 2, "u2", "9", "m9"), ("y", 1, "", "1", "m")], schema)
    b = spark.createDataFrame([("x", 1, "old", "0", "m0"), ("x", 2, "ub", "2", "MB"), ("y", 1, "ub", "3", None)], schema)
    c = spark.createDataFrame([("x", 1, "uc", "1", "mb")], schema)
    records = spark.createDataFrame([("x", None, None), ("y", " ", "own"), (None, None, None)], "id string, phone string, mail string")
    got = {r.id: r for r in P.fold(records, F.col("id"), [(source("a"), a), (source("b"), b), (source("c"), c)]).collect()}
    x, y = got["x"], got["y"]
    assert (x.phone, x.a_url, x.a_confidence, x.mail, x.b_url, x.c_url) == ("1", "ua", "by a", "MB", "ub", "")
    assert (x.cells["phone"].same, x.cells["phone"].other) == (1, 1) and (x.cells["mail"].source, x.cells["mail"].same, x.cells["mail"].other) == ("b", 1, 0)
    assert (y.phone, y.a_url, y.b_url, y.mail, y.cells["mail"].source) == ("3", "", "ub", "own", "record") and got[None].phone == ""
    with pytest.raises(ValueError):
        P.fold(records, F.col("id"), [(source("a"), a), (source("a"), b)])


def test_principals_and_news(spark):
    people = spark.createDataFrame([("r", 5, "Zoe", "Partner", "u1"), ("r", 1, "adam", "Founder", None), ("r", 5, "Bea", "", "u3"), ("r", 9, "Too Many", "x", "u"), ("r", 0, " ", "x", "u")], "id string, rank int, name string, role string, source_url string")
    row = P.fill_slots(spark.createDataFrame([("r", "Kept")], "id string, principal_2_name string"), "id", people).first()
    assert (row.principal_1_name, row.principal_1_role, row.principal_1_source_url, row.principal_1_confidence) == ("adam", "Founder", "", "corporate_team_page")
    assert (row.principal_2_name, row.principal_2_role, row.principal_2_confidence, row.principal_3_name) == ("Kept", "", "", "Zoe")
    stale = "a; no recent public signal as of 2026-01-01"
    records = spark.createDataFrame([(1, None, stale), (2, "Old (Paper, 2025-01-02)", None), (3, None, "no recent public signal as of 2026-05-17"), (4, "words", "n")], "id int, recent_activity string, uncertainty_notes string")
    signals = spark.createDataFrame([(1, " T ", None, " ", "2026-02-03")], "id int, title string, source_name string, url string, pub_date string")
    got = {r.id: r for r in P.news(records, "id", signals, "2026-05-17").collect()}
    assert (got[1].recent_activity, got[1].recent_activity_type, got[1].uncertainty_notes) == ("T (news, 2026-02-03)", "news", "a")
    assert (got[2].recent_activity_outlet, got[2].recent_activity_date, got[2].recent_activity_url) == ("Paper", "2025-01-02", "")
    assert (got[3].recent_activity_type, got[3].uncertainty_notes) == ("none_found", "no recent public signal as of 2026-05-17") and (got[4].recent_activity_type, got[4].uncertainty_notes) == ("", "n")


def test_claims_and_chunks(spark):
    record = {
        "record_id": "fo_1", "family_office_name": "Stone", "website_url": "https://stone.test", "source_urls": "['https://stone.test/a', 'https://x.test']", "primary_email": "a@stone.test", "primary_email_evidence_url": "https://stone.test/c",
        "primary_email_confidence": "site", "primary_phone": "1", "primary_phone_evidence_url": "u", "sec_registered": "False", "recent_activity_type": "none_found", "contact_first_name": "Ada", "validation_status": "Accepted", "city": None,
    }
    df = spark.createDataFrame([tuple(record.values())], ", ".join(f"{c} string" for c in record))
    claims = {r.field_name: r for r in Q.augmented_claims(df, "record_id", "data/reg").collect()}
    assert set(claims) == {"primary_email", "sec_registered", "recent_activity_type", "contact_first_name"}
    assert (claims["primary_email"].claim_id, claims["primary_email"].source_type, claims["primary_email"].validation_status) == ("fo_1_augmented_primary_email", "official_site", "verified")
    assert (claims["sec_registered"].source_url, claims["sec_registered"].source_type) == ("data/reg/fo_1.json", "local_evidence_artifact")
    assert (claims["recent_activity_type"].validation_status, claims["recent_activity_type"].source_type, claims["contact_first_name"].source_url) == ("documented", "methodology", "https://stone.test/a")
    assert {r.field_name: r.claim_type for r in Q.seed_claims(df, "record_id").collect()} == {"family_office_name": "fact", "website_url": "fact"}
    chunks = {r.chunk_id: r for r in C.record_chunks(df).collect()}
    assert set(chunks) == {"fo_1::record_profile", "fo_1::contact_policy", "fo_1::regulatory", *(f"fo_1::field_evidence::{f}" for f in ("website_url", "primary_email", "primary_phone"))}
    mail = chunks["fo_1::field_evidence::primary_email"]
    assert mail.source_urls == ["https://stone.test/c", "https://stone.test/a", "https://x.test"] and "Evidence confidence: site." in mail.text and mail.confidence_label == "site"
    assert chunks["fo_1::regulatory"].primary_source_url == "https://adviserinfo.sec.gov/" and "Location: not evidenced in the locked dataset, not" in chunks["fo_1::record_profile"].text
    assert C.record_chunks(df.withColumn("validation_status", F.lit("needs_review"))).isEmpty()


def test_screening(spark):
    rows = [("single_family_office", " Family ", "", "Oak Gate Family Office", "https://www.oakgate.test"), ("multi_family_office", "x", "A Wealth Management Firm", "The Group", "https://z.test"), ("single_family_office", "Ada", "wealth manager", "Stone", "https://pebble.test"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "family_office_type string, principal_name string, uncertainty_notes string, family_office_name string, website_url string")
    assert [r.x for r in df.select(Q.prescreen(df).alias("x")).collect()] == ["H1_sfo_no_specific_principal", "H8_service_provider_mfo", "H5_domain_name_mismatch", ""]


def test_url_cells(spark):
    cells = {
        '["a", "b"]': (["a", "b"], "json_array", ""), "[]": ([], "json_array", ""), "['a', \"b\"]": (["a", "b"], "legacy_python_list", ""), "('a',)": (["a"], "legacy_python_list", ""), "a;b\nc": (["a", "b", "c"], "legacy_delimited", ""),
        "https://a.test": (["https://a.test"], "legacy_single_url", ""), "word": ([], "invalid", "source_urls is not parseable"), "[1]": ([], "invalid", "source_urls JSON must be an array of strings"), " ": ([], "empty", "source_urls is blank"), "3": ([], "invalid", "source_urls JSON must be an array of strings"),
    }
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    urls, name, error = L.audited_urls(F.col("c"))
    assert {r.c: (r.u, r.n, r.e) for r in df.select("c", urls.alias("u"), name.alias("n"), error.alias("e")).collect()} == cells
    parsed = {"a|b": ["a", "b"], "http://a, 'http://b'": ["http://a", "http://b"], "['x', ' ']": ["x"], "[broken": ["[broken"], "[bro'ken]": [], "": []}
    df = spark.createDataFrame([(c,) for c in parsed], "c string")
    assert {r.c: r.u for r in df.select("c", L.parsed_urls(F.col("c")).alias("u")).collect()} == parsed


def test_loopback(spark):
    urls = {"http://localhost:11434/api": True, "https://127.0.0.1": False, "http://127.0.0.1/x": True, "http://[::1]:80/x": False, "http://localhost.evil.test": False, "ftp://localhost": False, "http://user@localhost/": True, "http://localhost@evil.test/": False, "": False}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.ok for r in df.select("u", U.is_loopback(F.col("u")).alias("ok")).collect()} == urls
