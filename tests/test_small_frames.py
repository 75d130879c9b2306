"""Operators on hand-made frames: nulls, ties, empty tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import areas as A
from cohortmill.operators import blocks as B
from cohortmill.operators import history as H
from cohortmill.operators import links as K
from cohortmill.operators import selection as S
from cohortmill.sources import folders as R


def test_changes_with_cause(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", None)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("w", 5), ("z", None)], "k string, v int")
    got = {r["k"]: (r["before"], r["after"], r["change"]) for r in H.changes(a, b, ["k"], "v").collect()}
    assert got == {"y": (2, 3, "changed"), "w": (None, 5, "added")}
    cause = H.with_cause(H.changes(a, b, ["k"], "v"), F.lit("r1"), F.lit("r2"), F.col("k") == "w")
    assert {r["k"]: r["cause"] for r in cause.collect()} == {"y": "rules_change", "w": "both"}
    assert H.changes(a.filter("false"), b.filter("false"), ["k"], "v").count() == 0


def test_upsert(spark):
    state = spark.createDataFrame([("a", 1), ("b", 5), ("c", 2), ("d", 1)], "k string, rev int")
    heads = spark.createDataFrame([("a", 2, False), ("b", 5, False), ("c", 3, True), ("e", 1, False), ("f", 1, True)], "k string, rev int, gone boolean")
    got = {r["k"]: r["action"] for r in H.upsert(state, heads, "k", "rev", F.col("gone")).collect()}
    assert got == {"a": "update", "b": "keep", "c": "delete", "d": "untouched", "e": "insert", "f": "ignore"}


def test_retention(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(20)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = {(r["date"], r["kept_as"]) for r in H.retention(df, F.lit(days[-1]), "2024-01-01", 2).collect()}
    assert {d for d, k in got if k == "complete"} == {days[16], days[18]}
    assert {d.month for d, k in got if k == "aggregate"} == {1, 2, 3}
    assert H.retention(df.filter("false"), F.lit(days[-1]), "2024-01-01", 2).count() == 0


def test_total_class(spark):
    rows = [("n", "t", "Total", "F", 5), ("n", "t", "Total", "M", 6), ("n", "t", "Adults", "F", 5), ("m", "t", "Total", "F", 1), ("m", "t", "Adults", "X", 1), ("k", "t", "Adults", "F", 2)]
    got = S.total_class_view(spark.createDataFrame(rows, "nct_id string, title string, class string, label string, value int"))
    assert sorted((r["nct_id"], r["class"]) for r in got.collect()) == [("k", "Adults"), ("m", "Adults"), ("m", "Total"), ("n", "Total"), ("n", "Total")]


def test_parts(spark):
    rows = [("a", 40, 100, "x"), ("a", 60, 100, "y"), ("b", 50, 100, "x"), ("b", 50, 100, "x"), ("c", 100, 100, "x")]
    got = {r["k"]: r["is_parted"] for r in S.disjoint_parts(spark.createDataFrame(rows, "k string, n int, total int, sig string"), "k", "n", "total", "sig").collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_status_is_not_zero(spark):
    cells = spark.createDataFrame([("a", "Sex: Female, Male", "Participants", "Female", 0.0), ("b", "Sex: Female, Male", "Participants", "Unknown", 3.0), ("c", "Sex: Female, Male", "Participants", "Women", 3.0), ("d", "Age", "years", "Female", 3.0)], "nct_id string, title string, unit string, label string, value double")
    studies = spark.createDataFrame([(k, "F", 10) for k in "abcde"], "nct_id string, status string, enrollment long")
    rows = {r["nct_id"]: r for r in S.finished(S.parsed_trials(S.bucket_sums(cells)), studies).collect()}
    assert {k: r["status"] for k, r in rows.items()} == {"a": "uninformative", "b": "explicit_unknown_only", "c": "reported", "d": "not_reported", "e": "not_reported"}
    assert rows["c"]["percent_female"] == 100 and rows["a"]["percent_female"] is None and rows["b"]["n_female"] is None


def test_windows(spark):
    df = spark.createDataFrame([(2009.9975,), (2010.0,), (1990.0,), (2030.5,), (None,)], "m double")
    got = [(r["vintage"], r["reason"], r["gap_years"]) for r in A.assign_window(df, "m", [(2005, 2009), (2010, 2014)]).collect()]
    assert got == [(2009, "midpoint_inside_window", 0.0), (2014, "midpoint_inside_window", 0.0), (2009, "before_first_window", 15.0), (2014, "after_last_window", 15.5), (None, "no_usable_date", None)]


def test_points_in_a_notched_area(spark):
    corners = [(0, 0), (4, 0), (4, 4), (2, 2), (0, 4)]
    edges = [("v", float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(corners, corners[1:] + corners[:1])]
    points = [(1, 1.0, 1.0), (2, 2.0, 3.0), (3, 0.5, 3.0), (4, 5.0, 1.0)]
    got = B.points_in_areas(spark.createDataFrame(points, "point_id int, x double, y double"), spark.createDataFrame(edges, "area string, x1 double, y1 double, x2 double, y2 double"))
    assert {r["point_id"] for r in got.collect()} == {1, 3}


def test_names_in_titles(spark):
    forms = spark.createDataFrame([("deep view", 1), ("view", 2)], "form string, strength int")
    titles = spark.createDataFrame([(1, "The Deep-View study"), (2, "A viewing study"), (3, "Overview, then view"), (4, None)], "title_id int, title string")
    got = {r["title_id"]: r["form"] for r in K.name_matches(forms, titles).collect()}
    assert got == {1: "deep view", 3: "view"}


def test_long_and_squashed_names(spark):
    forms = spark.createDataFrame([("alpha beta gamma delta epsilon zeta", 1), ("kardiaai", 2), ("Deep View", 3)], "form string, strength int")
    titles = spark.createDataFrame([(1, "On alpha beta gamma delta epsilon zeta"), (2, "alpha beta gamma delta epsilon"), (3, "Kardia AI in use"), (4, "a DeepView trial"), (5, "kardiaaix")], "title_id int, title string")
    got = {r["title_id"]: r["form"] for r in K.name_matches(forms, titles).collect()}
    assert got == {1: "alpha beta gamma delta epsilon zeta", 3: "kardiaai", 4: "Deep View"}
    words = spark.createDataFrame([("alpha beta gamma delta epsilon", "P", "S", 0), ("alpha", "Q", "T", 1)], "keyword string, primary string, secondary string, position int")
    assert [r["primary"] for r in K.longest_keyword(titles.filter("title_id = 1"), "title", words).collect()] == ["P"]


def test_containers_are_bounded(spark):
    from cohortmill.plans.assembly import contained

    rows = spark.range(2500).select(F.lit("one").alias("class"), F.col("id").cast("string").alias("nct_id"), F.lit("x").alias("lead"), F.lit(1).cast("long").alias("enrollment"))
    sizes = [len(r["data"]) for r in contained(rows, 100).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 2500


def test_lines_and_parts(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1, "b": "x"}\nnot json\n{"a": "y"}\n{"b": "z"}\n')
    good, bad = R.read_lines(spark, str(tmp_path / "x.json"), "a int, b string")
    assert sorted((r["a"], r["b"]) for r in good.collect() if r["a"]) == [(1, "x")] and good.count() == 2 and bad.count() == 2
    with pytest.raises(ValueError, match="missing columns"):
        (tmp_path / "y.csv").write_text("a|b\n1|2\n")
        R.read_delimited(spark, str(tmp_path / "y.csv"), ["a", "c"])
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert [r["position"] for r in R.numbered(rows, ["k"]).orderBy("k").collect()] == list(range(1000))
    one = spark.createDataFrame([("s1", 0, 2), ("s2", 1, 2)], "stamp string, part int, total int")
    assert not R.mixed_runs(one, [], ["stamp"], "part", "total").first()["is_one_run"]
    assert [r["s"] for r in spark.createDataFrame([("NCT00000017",), ("X1",)], "i string").select(R.shard_of(F.col("i"), 5).alias("s")).collect()] == [2, None]
