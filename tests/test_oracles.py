"""Every query that has SQL gives DuckDB's rows; no plan holds a cross or nested-loop join of two tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from cohortmill.plans import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else repr(round(float(v), 6) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = con.execute(ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want
    assert "CartesianProduct" not in df._jdf.queryExecution().toString()


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_bootstrap(spark):
    """Means exactly; intervals cover them, and neither another run nor another partitioning changes anything."""
    from pyspark.sql import functions as F

    from cohortmill.operators.stats import bootstrap_mean

    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).cast("string").alias("g"), (F.col("id") * 7919 % 101).cast("double").alias("v"), (F.col("id") % 10 + 1).cast("double").alias("w"))
    few = spark.createDataFrame([("x", "few", 1.0, 1.0), ("y", "few", None, 2.0)], "k string, g string, v double, w double")
    runs = []
    for df in (rows.unionByName(few), rows.repartition(7).unionByName(few), rows.coalesce(1).unionByName(few)):
        runs.append({r["g"]: r for r in bootstrap_mean(df, "g", "v", "w", "k", 400, 50).collect()})
    held = rows.toPandas()
    for g, part in held.groupby("g"):
        r = runs[0][g]
        assert r["n"] == len(part) and abs(r["mean"] - part["v"].mean()) < 1e-9 and abs(r["weighted_mean"] - (part["v"] * part["w"]).sum() / part["w"].sum()) < 1e-9
        assert r["low"] < r["mean"] < r["high"] and r["weighted_low"] < r["weighted_mean"] < r["weighted_high"]
        se = part["v"].std() / len(part) ** 0.5
        assert 0.8 < (r["high"] - r["low"]) / (2 * 1.96 * se) < 1.2
        assert all((x[g]["low"], x[g]["high"], x[g]["weighted_low"], x[g]["weighted_high"]) == (r["low"], r["high"], r["weighted_low"], r["weighted_high"]) for x in runs)
    assert runs[0]["few"]["n"] == 1 and runs[0]["few"]["mean"] is None
    assert {r["class"] for r in QUERIES["AGG-26"](spark, DATA).collect()}


def test_contrasts_by_brute_force(spark):
    import numpy as np

    from cohortmill.operators.stats import contrasts

    r = np.random.default_rng(5)
    x = r.normal(size=(300, 2))
    b = r.choice(["a", "b", "other", "tiny"], 300, p=[0.3, 0.3, 0.38, 0.02])
    y = 2 + x @ [1.0, -3.0] + (b == "a") * 1.5 + r.normal(size=300)
    df = spark.createDataFrame([(str(k), float(v), float(p), float(q), 1.0) for k, v, (p, q) in zip(b, y, x)], "g string, y double, p double, q double, same double")
    got = {row["g"]: row for row in contrasts(df, "g", "other", "y", ["p", "q", "same"], 120).collect()}
    assert set(got) == {"a", "b"} | ({"tiny"} if ((b == "tiny") | (b == "other")).sum() >= 120 else set())
    for g in ("a", "b"):
        use = (b == g) | (b == "other")
        m = np.c_[np.ones(use.sum()), (b[use] == g), x[use]]
        beta, rss, rank, _ = np.linalg.lstsq(m, y[use], rcond=None)
        se = np.sqrt(rss[0] / (use.sum() - rank) * np.linalg.inv(m.T @ m)[1, 1])
        want = (beta[1], beta[1] - 1.96 * se, beta[1] + 1.96 * se, math.erfc(abs(beta[1] / se) / math.sqrt(2)))
        assert np.allclose((got[g]["beta"], got[g]["lo"], got[g]["hi"], got[g]["p"]), want)


def test_refusals(spark):
    """What must not be read as an answer is refused."""
    import datetime as dt

    from cohortmill.operators import sponsors as P
    from cohortmill.sources import folders as R

    names = P.literals(spark.createDataFrame([("Acme Inc.",), ("Bolt",)], "name string"))
    rules = "canonical string, rule_type string, pattern string, status string, shared string, note string"
    two = lambda a, b: spark.createDataFrame([("A", "exact_normalized", "acme", "attribute", a, "x"), ("B", "exact_literal", "Acme Inc.", "attribute", b, "x")], rules)
    with pytest.raises(ValueError, match="conflicting rules"):
        P.matched(names, two("yes", "no"))
    assert P.matched(names, two("yes", "yes")).count() == 2
    with pytest.raises(ValueError, match="conflicting rules"):
        P.matched(names, two("yes", "yes").unionByName(spark.createDataFrame([("A", "exact_literal", "Acme Inc.", "exclude", "no", "x")], rules)))
    index = spark.createDataFrame([("n", "acme", "A")], "nct_id string, entity string, canonical string")
    dated = lambda d, s: spark.createDataFrame([("Acme, Inc.", "A", d, s)], "entity string, canonical string, effective_date date, source string")
    for d, s, why in ((None, "x", "blank"), (dt.date(2020, 1, 1), " ", "no source")):
        with pytest.raises(ValueError, match=why):
            P.with_acquisitions(index, dated(d, s))
    assert P.with_acquisitions(index, dated(dt.date(2020, 1, 1), "x")).first()["effective_date"] == dt.date(2020, 1, 1)
    with pytest.raises(ValueError, match="not written"):
        R.write_shards(spark.createDataFrame([("NCT00000001",), ("X",)], "i string"), "i", 4, "/never")


def test_fuzzy_ratios():
    from cohortmill.functions.fuzzy import indel_ratio, token_set_ratio

    assert indel_ratio("abc", "abd") == pytest.approx(200 * 2 / 6) and token_set_ratio("coil spring steel", "steel coil spring") == 100
    assert token_set_ratio("a b", "a b c") == 100 and token_set_ratio("x", "y") == 0 and token_set_ratio("", "y") == 0
