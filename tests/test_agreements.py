"""Agreements of tables: each rule on a planted fault, odd rows, and one scan a table."""

import pytest
from pyspark.sql import functions as F

from cohortmill.operators.agreements import Terms, Total, breaches


def terms():
    return {
        "families": Terms(F.col("fid"), {"status_known": F.col("status").isin("candidate", "curated")}, {}, {"n_members": Total(F.col("n_members"), "items", "family"), "people": Total(F.col("people"), "items", "family", "people")}),
        "items": Terms(F.col("iid"), {"dated_or_reason": F.col("date").isNull() != F.col("reason").isNull()}, {"family": ("families", F.col("fid")), "parent": ("items", F.col("parent"))}),
    }


def tables(spark, families, items):
    return {
        "families": spark.createDataFrame(families, "fid string, status string, n_members int, people double, key int, facts int"),
        "items": spark.createDataFrame(items, "iid string, fid string, people double, date string, reason string, parent string, value int"),
    }


def test_each_rule(spark):
    families = [
        ("ok", "curated", 2, 7.5, 0, 0), ("twice", "candidate", 9, 9.0, 0, 0), ("twice", "candidate", 9, 9.0, 0, 0), (None, "curated", None, None, 0, 0), ("odd", "perhaps", 0, None, 0, 0),
        ("null status", None, None, None, 0, 0), ("short", "curated", 3, 0.1, 0, 0), ("none", "curated", 1, 0.0, 0, 0), ("", "curated", 0, 0.0, 0, 0),
    ]
    items = [
        ("a", "ok", 7.0, "2020", None, None, 0), ("b", "ok", 0.5, None, "withdrawn", "a", 0), ("c", "short", 0.1, "2020", None, "zz", 0), ("d", "short", None, "2020", "both", "c", 0), ("e", "gone", 1.0, None, None, None, 0),
        ("f", "gone", 1.0, "2020", None, None, 0), ("g", None, 5.0, "2020", None, "zz", 0), ("a", "twice", 1.0, "2020", None, None, 0),
    ]
    got = {(r["table"], r["key"], r["rule"], r["n"]) for r in breaches(tables(spark, families, items), terms()).collect()}
    assert got == {
        ("families", "twice", "key_repeated", 2), ("families", None, "key_missing", 1), ("families", "odd", "status_known", 1), ("families", "null status", "status_known", 1),
        ("families", "short", "n_members", 2), ("families", "none", "n_members", 0), ("families", "gone", "not_found:items.family", 2),
        ("items", "a", "key_repeated", 2), ("items", "d", "dated_or_reason", 1), ("items", "e", "dated_or_reason", 1), ("items", "zz", "not_found:items.parent", 2),
    }


def test_empty_tables_and_one_scan(spark, tmp_path):
    assert breaches(tables(spark, [], []), terms()).collect() == []
    read = {}
    for name, df in tables(spark, [("ok", "curated", 0, 0.0, 0, 0)], []).items():
        df.write.parquet(str(tmp_path / name))
        read[name] = spark.read.parquet(str(tmp_path / name))
    df = breaches(read, terms())
    assert df.collect() == []
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2
    shuffled = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Join" not in shuffled


def test_totals_need_their_reference(spark):
    with pytest.raises(ValueError, match="does not refer"):
        breaches({}, {"a": Terms(F.col("k"), {}, {}, {"n": Total(F.col("n"), "b", "a")}), "b": Terms(F.col("k"), {}, {"a": ("b", F.col("k"))})})
