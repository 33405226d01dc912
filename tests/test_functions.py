"""Behaviour cases of the scalar functions and evidence operators."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import blanks as B
from ledgerline.functions import text as X
from ledgerline.functions import urls as U
from ledgerline.operators import audits, evidence, sequences


@pytest.fixture(scope="module")
def of(spark):
    def run(expression, *values):
        row = spark.createDataFrame([tuple(values) or ("",)], ", ".join(f"c{i} string" for i in range(max(1, len(values)))))
        return row.select(expression(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x

    return run


@pytest.mark.parametrize(
    ("expression", "values", "want"),
    [
        (U.domain, ("https://www.a.com/",), "a.com"), (U.domain, ("",), ""), (U.domain, ("a.com/x",), ""), (lambda c: U.domain(c, "any"), ("a.com/x",), "a.com"), (lambda c: U.domain(c, "dotted"), ("nodots",), ""),
        (U.domain_base, ("https://oaktrail.com",), "oaktrail"), (U.domain_base, ("a.b.co",), "ab"), (U.canonical, ("https://a.com/b/#x",), "https://a.com/b"), (U.audit_form, ("HTTPS://www.A.com",), "https://a.com/"),
        (U.audit_form, ("./..\\reports\\x.md",), "reports/x.md"), (U.evidence_domain, ("reports/x.md",), ""), (U.url_list, ("['https://a.org', \"https://b.org\"]",), ["https://a.org", "https://b.org"]),
        (U.url_list, ("[]",), []), (U.url_list, (None,), []), (U.url_list, ("http://a.org",), ["http://a.org"]), (X.entity_name, ("X Investments LLC",), "x investments"), (X.registry_name, ("The Stone Family Office, LLC",), "stone"),
        (lambda c: X.person_name(c)[0], ("A W. B",), "A W."), (lambda c: X.person_name(c)[1], ("A B Jr.",), "B"), (lambda c: X.person_name(c)[1], ("B family",), ""), (lambda c: X.person_name(c)[1], ("Solo",), ""), (lambda c: X.person_name(c)[0], ("",), ""),
        (lambda a, b, c: X.joined(a, b, c), ("London", "", "UK"), "London, UK"), (X.integer_text, ("843.0",), "843"), (X.integer_text, ("n/a",), "n/a"), (X.integer_text, (None,), ""), (X.without_zero_decimal, ("158515.0",), "158515"),
        (X.phones_match, ("(203) 992-4630", "+12039924630"), True), (X.phones_match, ("", ""), False), (X.recency_label, (None,), ""), (lambda c: X.bar(c.cast("int")), ("100",), "█" * 31), (lambda c: X.bar(c.cast("int")), ("0",), "░" * 31),
        (lambda a, b: X.with_note(a, b), ("", "A"), "A"), (lambda a, b: X.with_note(a, b), ("has A", "A"), "has A"), (lambda a, b: X.with_note(a, b, ". "), ("Older note.", "New note"), "Older note. New note"),
        (X.regulatory_assets, ("Regulatory Assets Under Management\n x Total: (c) $ 1,234",), "1234"), (X.fee_labels, ("Fixed fee and hourly charges",), "fixed_fees; hourly_fees"), (B.truth, ("Registered",), True), (B.truth, (None,), False),
        (B.is_filled, ("0",), True), (B.is_filled, (" NaN ",), False), (B.cell_text, ("nan",), ""), (B.strip, ("\t a \n",), "a"), (X.without_markdown, ("# T ![i](u) [name](v) **b**",), "T name b"),
        (lambda c: X.corporate_email(F.array(c, F.lit("irene@x.org")), F.lit("x.org")), ("joe@x.org",), "irene@x.org"), (lambda c: X.corporate_email(F.array(c), F.lit("x.org")), ("joe@x.org",), None), (X.sensitive_tokens, ("mail a@b.org or https://c.d/e",), ["a@b.org", "https://c.d/e"]),
    ],
)
def test_scalar(of, expression, values, want):
    assert of(expression, *values) == want


def test_url_quality(spark):
    rows = spark.createDataFrame([(True, "200"), (True, "204"), (True, "301"), (True, "404"), (False, "200"), (True, ""), (True, "not-a-number"), (True, "500")], "ok boolean, code string")
    got = [r.q for r in rows.select(U.quality(F.col("ok"), F.col("code")).alias("q")).collect()]
    assert got == ["Highest", "High", "Medium", "Low", "Failed", "Unknown", "Unknown", "Failed"]


def test_promotion_needs_evidence_and_blank(spark):
    rows = spark.createDataFrame([(1, "", "new", "u"), (2, "old", "new", "u"), (3, None, "new", ""), (4, "", None, "u")], "id int, phone string, found string, url string")
    out = evidence.promote(rows, {"phone": F.col("found")}, F.col("url"), "site", ("phone_evidence_url", "phone_confidence")).orderBy("id").collect()
    assert [(r.phone, r.phone_evidence_url, r.phone_confidence) for r in out] == [("new", "u", "site"), ("old", "", ""), ("", "", ""), ("", "", "")]


def test_lookup_policies(spark):
    rows = spark.createDataFrame([("k", 1, "a", False), ("k", 2, "b", True), ("k", 3, "c", False), (None, 4, "d", False)], "key string, at int, v string, closed boolean")
    open_ = ~F.col("closed")
    assert [r.v for r in evidence.lookup(rows, "key", "at", "first", open_).collect()] == ["a"] and [r.v for r in evidence.lookup(rows, "key", "at", "last").collect()] == ["c"]


def test_claims_are_idempotent(spark):
    rows = spark.createDataFrame([(1, "x", " "), (2, None, "y")], "id int, a string, b string")
    assert sorted(map(tuple, evidence.claims(rows, "id", ["a", "b"]).collect())) == [(1, "a", "x"), (2, "b", "y")]
    old, new = (spark.createDataFrame([(c,)], "claim_id string") for c in ("1_a", "1_augmented_a"))
    once = evidence.replace_claims(old, new)
    assert sorted(r[0] for r in evidence.replace_claims(once, new).collect()) == ["1_a", "1_augmented_a"]


def test_audits(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("",), ("b",)], "id string")
    got = {r.check_id: (r.ok, r.observed) for r in audits.unique_ids(rows, "id").collect()}
    assert got == {"id_blank": (False, 1), "id_duplicates": (False, 1)}
    assert audits.exit_status(audits.unique_ids(rows, "id")).first()[0] == 1 and audits.exit_status(audits.unique_ids(rows.where("id = 'b'"), "id")).first()[0] == 0


def test_people_page(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators import sequences as S

    rows = [("https://a.test/Our-Team", "", True), ("https://a.test/x", "**Ada Stone**, Partner", True), ("https://a.test/x", "**Ada Stone** is here", False), (None, None, False)]
    got = spark.createDataFrame(rows, "url string, text string, want boolean").select(S.people_page(F.col("url"), F.col("text")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)
