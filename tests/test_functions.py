"""Scalar rules on hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.functions import dates as D
from cohortmill.functions import labels as L
from cohortmill.functions import names as M
from cohortmill.functions import numbers as N


def applied(spark, f, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r["out"] for r in spark.createDataFrame(rows, "i int, v string").select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


def test_dates(spark):
    assert applied(spark, D.period_end, ["2020", "2020-02", "2020-02-03", "soon", None]) == [dt.date(2020, 12, 31), dt.date(2020, 2, 29), dt.date(2020, 2, 3), None, None]
    assert applied(spark, D.precision, ["2020", "2020-02", "2020-02-03", "", None]) == ["year", "month", "day", None, None]
    assert applied(spark, D.list_date, ["1/2/95", " 12/31/21 ", "2/30/20", "1/2/1999", "x"]) == [dt.date(1995, 1, 2), dt.date(2021, 12, 31), None, dt.date(1999, 1, 2), None]
    assert applied(spark, D.prefix_date, ["2020-05-06T00", "2020-05", "2020", "x", None]) == [dt.date(2020, 5, 6), dt.date(2020, 5, 1), dt.date(2020, 1, 1), None, None]
    assert applied(spark, lambda v: D.add_years(D.period_start(v), 1), ["2020-02-29"]) == [dt.date(2021, 2, 28)]
    got = applied(spark, D.decimal_year, ["2009", "2009-12", "2009-12-31"])
    assert got == pytest.approx([2009.5, 2009 + 11 / 12 + 1 / 24, 2009 + 11 / 12 + 30 / 365])


def test_numbers(spark):
    texts = ["12", "1,234", "NA", "50.3 (33.8)", "45%", "", None, "nan"]
    assert applied(spark, N.posted_number, texts)[:7] == [12, 1234, None, 50.3, 45, None, None]
    assert applied(spark, N.parser_number, texts) == [12, None, None, None, None, None, None, None]
    assert applied(spark, N.finite_number, texts) == [12, 1234, None, None, None, None, None, None]
    assert applied(spark, N.p_value_form, ["0.02", "=0.02", "<0.001", "p=0.3", "NS", "", None]) == ["number", "number", "bound", "other_with_digit", "no_digit", "absent", "absent"]


def test_totals(spark):
    rows = spark.createDataFrame([([5.0, 5.0],), ([1.0, 2.0, 3.0],), ([1.0, 2.0, 4.0],), ([7.0],), ([],), (None,)], "v array<double>")
    got = [tuple(r["t"]) for r in rows.select(N.sum_checked_total(F.coalesce("v", F.array().cast("array<double>"))).alias("t")).collect()]
    assert got == [(5, False, True), (3, False, True), (4, True, False), (7, False, None), (None, False, None), (None, False, None)]


@pytest.mark.parametrize(
    ("label", "bucket"),
    [("Female", "female"), ("males ", "male"), ("Women†", "female"), ("Prefer not to say", "unknown"), ("Transgender man", "ambiguous"), ("Non-binary", "gender_diverse"), ("Total", ""), ("African American", ""), ("F", "female"), ("Heterosexual", ""), ("", ""), (None, "")],
)
def test_buckets(spark, label, bucket):
    assert applied(spark, L.sex_bucket, [label]) == [bucket]


def test_names(spark):
    assert applied(spark, M.sponsor_key, ["Pfizer Inc.", "Merck & Co., Inc.", "Merck KGaA", "A B and Company Ltd"]) == ["pfizer", "merck", "merck kgaa", "a b"]
    entity, parent = (lambda v, k=k: M.subsidiary(v)[k] for k in (0, 1))
    names = ["Wyeth is now a wholly owned subsidiary of Pfizer Inc.", "X, a subsidiary of Y, a subsidiary of Z Corp (old)", "Acme"]
    assert applied(spark, entity, names) == ["wyeth", "x", "acme"]
    assert applied(spark, parent, names) == ["pfizer", "z", None]
    assert applied(spark, M.phase_name, ["PHASE1|PHASE2", "Early Phase 1", "NA", None]) == ["Phase 1/2", "Phase 1", "N/A or other", "N/A or other"]
    assert applied(spark, lambda v: M.organisation_key(v, ["sa", "inc"], ["the", "and", "of"]), ["The Q Bio S.A. (Paris) d/b/a Z", "Inc."]) == ["q bio", "inc"]


def test_closest_words(spark):
    from cohortmill.functions.fuzzy import closest, indel_ratio

    assert indel_ratio("kitten", "sitting") == pytest.approx(200 * 4 / 13)
    words = [("white", "w"), ("black", "b")]
    df = spark.createDataFrame([("Whte",), ("blak",), ("zzz",), ("",)], "v string")
    got = {r["v"]: (r["outcome"], round(r["ratio"], 6)) for r in closest(df, "v", words, 80.0).collect()}
    for v in ("Whte", "blak", "zzz", ""):
        best = max((indel_ratio(v.lower(), w), c) for w, c in words)
        assert got[v] == (best[1] if best[0] >= 80 else None, round(best[0], 6))


def test_records(spark):
    from cohortmill.functions import records as R

    schema = "g array<struct<id: string, title: string, denom: double>>, m array<struct<title: string, measurements: array<struct<group: string, value: double>>>>"
    rows = [
        ([("a", "Arm", 5.0)], [("x", [("a", 1.0)])]),
        ([("a", "Arm", 5.0), ("b", "Arm", 6.0), ("t", "Pooled", 11.0)], [("x", [("t", 1.0)])]),
        ([("a", "Arm", 5.0), ("b", " TOTAL ", 6.0)], [("x", [("a", None), ("b", None)])]),
        ([("a", "Arm", 5.0), ("b", "Arm", 6.0)], [("x", [("a", 1.0)])]),
        ([], []),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    got = df.select("i", R.total_group(F.col("g")).alias("t"), R.baseline_usable(F.col("g"), F.col("m")).alias("b")).orderBy("i").collect()
    assert [tuple(r["t"]) for r in got] == [("a", "single_group"), ("t", "last_equals_sum_untitled_total"), ("b", "titled_total"), (None, "no_total_sum_arms"), (None, "no_total_sum_arms")]
    assert [r["b"]["reason"] for r in got] == ["ok", "ok", "no_numeric_values", "values_or_denominators_incomplete", "no_groups"]


def test_sponsor_conflicts(spark):
    from cohortmill.operators import sponsors as S

    frame = spark.createDataFrame([("n1", "INDUSTRY", "lead", "Acme Inc."), ("n1", "INDUSTRY", "lead", "ACME"), ("n2", "OTHER", "collaborator", "Joint Venture")], "nct_id string, agency_class string, role string, name string")
    rule = "canonical string, rule_type string, pattern string, status string, shared string, note string"
    good = spark.createDataFrame([("Acme", "exact_normalized", "acme", "attribute", "no", "x"), ("A", "exact_literal", "Joint Venture", "attribute", "yes", "x"), ("B", "exact_literal", "Joint Venture", "attribute", "yes", "x")], rule)
    names = S.literals(frame)
    assert S.conflicts(S.rule_hits(names, good)).count() == 0
    assert {(r["nct_id"], r["canonical"], r["literal_name"]) for r in S.bridge(frame, good).collect()} == {("n1", "Acme", "ACME"), ("n2", "A", "Joint Venture"), ("n2", "B", "Joint Venture")}
    bad = good.unionByName(spark.createDataFrame([("C", "exact_literal", "ACME", "attribute", "no", ""), ("X", "exact_literal", "Joint Venture", "exclude", "no", "x")], rule))
    assert {r["name"] for r in S.conflicts(S.rule_hits(names, bad)).collect()} == {"ACME", "Joint Venture"}
    assert [r["problem"] for r in S.rule_problems(bad).collect()] == ["empty_note"]


def test_least_squares_with_a_dependent_column(spark):
    from cohortmill.operators.stats import least_squares

    rows = [("g", float(2 * i + 1), float(i), float(3 * i)) for i in range(20)]
    got = {r["term"]: r for r in least_squares(spark.createDataFrame(rows, "g string, y double, a double, b double"), ["g"], "y", ["a", "b"]).collect()}
    assert got["a"]["estimate"] + 3 * got["b"]["estimate"] == pytest.approx(2) and got["a"]["r2"] == pytest.approx(1)
