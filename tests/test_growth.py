"""What must hold on tables larger than the given ones."""

import pytest

from cohortmill.operators import links as K
from cohortmill.plans import QUERIES


@pytest.mark.parametrize("few", [0, 100_000])
def test_exploded_runs_are_never_broadcast(spark, monkeypatch, few):
    monkeypatch.setattr(K, "FEW_FORMS", few)
    forms = spark.createDataFrame([("steel ring", 1), ("ring", 2), ("a b c d e", 1)], "form string, strength int")
    titles = spark.createDataFrame([(1, "big steel ring"), (2, "a ring"), (3, "x a b c d e"), (4, "none")], "title_id long, title string")
    df = K.name_matches(forms, titles)
    assert {(r["title_id"], r["form"]) for r in df.collect()} == {(1, "steel ring"), (2, "ring"), (3, "a b c d e")}
    plan = df._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all(("BroadcastHashJoin" in line and "BuildRight" in line) if few else "SortMergeJoin" in line for line in joins)


def test_first_outcome_by_the_sum_of_line_and_part(spark, tmp_path):
    lines = [(1, 1, 2_500_000, 7, "A"), (1, 2, 5, 8, "R"), (2, 1, 3, 7, "N"), (2, 3, 1, 7, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = {r["l_orderkey"]: r for r in QUERIES["PRJ-4"](spark, str(tmp_path)).collect()}
    assert [rows[k]["first_outcome"] for k in (1, 2)] == [5, 3] and [rows[k]["n_collaborators"] for k in (1, 2)] == [2, 1]
    assert [(rows[k]["subject_masked"], rows[k]["investigator_masked"]) for k in (1, 2)] == [(True, False), (False, True)]


def test_sentence_in_long_text(spark):
    from pyspark.sql import functions as F

    from cohortmill.functions import evidence as V

    long = "word " * 40_000
    texts = [(1, "One. Two\nLicensed by  us! Three Licensed."), (2, "Licensed"), (3, long), (4, None), (5, f"{long}. {long}Licensed {long}? no"), (6, "a.Licensed?"), (7, "x Licensed y Licensed z. w"), (8, "")]
    got = {r["i"]: r["s"] for r in spark.createDataFrame(texts, "i int, t string").select("i", V.sentence_of(F.col("t"), "Licensed").alias("s")).collect()}
    assert got == {1: " Two\nLicensed by  us", 2: "Licensed", 3: None, 4: None, 5: f" {long}Licensed {long}", 6: "Licensed", 7: "x Licensed y Licensed z", 8: None}


def test_scope_joins_each_order_once(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (2,), (None,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "l_orderkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = QUERIES["SET-6"](spark, str(tmp_path))
    assert sorted((str(r[0]), r[1]) for r in df.collect()) == [("1", "retrieved"), ("2", "not_retrieved"), ("2", "not_retrieved"), ("None", "not_retrieved")]
    assert sum("Join" in line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines()) == 1


def test_rounds_grow_with_the_longest_chain_only(spark, monkeypatch):
    from cohortmill.operators import history as H

    written, real = [], H.kept
    monkeypatch.setattr(H, "kept", lambda df, name: written.append(name) or real(df, name))
    rows = [(10 * c + i, 10 * c + i - 1 if i else None, False) for c in range(200) for i in range(5)] + [(9001, 9003, False), (9002, 9001, False), (9003, 9002, False)]
    got = {r.id: (r.head, r.depth, r.state) for r in H.supersession(spark.createDataFrame(rows, "id long, replaces long, withdrawn boolean")).collect()}
    assert all(got[10 * c + i] == (10 * c + 4, 4 - i, "current" if i == 4 else "superseded") for c in range(200) for i in range(5))
    assert {got[i][2] for i in (9001, 9002, 9003)} == {"quarantined"}
    assert len(written) <= 5


def test_spread_reads_the_trials_once(spark):
    df = QUERIES["AGG-24-spread"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum("l_quantity" in line and "Relation" in line for line in plan.splitlines()) == 1


def test_contract_adds_up_its_facts_once(spark):
    plan = QUERIES["DQ-4-contract"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Aggregate [table" in line for line in plan.splitlines()) == 1


def test_records_of_a_split_are_built_once(spark):
    for name in ("SRC-14-paths", "SRC-14-paths-planted"):
        assert "collect_list" not in QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_nested_tables_are_collected_once(spark):
    plan = QUERIES["SEL-11-records"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == 1


def test_block_groups_by_trial_alone(spark):
    from cohortmill.operators import blocks as B

    rows = spark.createDataFrame([(1, "a", "x", "F", 2), (1, "a", "x", "M", 3), (1, "a", None, "F", 1), (1, "b", None, None, None), (2, "b", None, None, None), (3, "c", "y", "F", 0)], "k int, c string, s string, j string, n long")
    size = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 5.0), (4, 5.0)], "k int, size double")
    df = B.dimension_block(rows, "k", "c", "n", size, "size", "s", "j")
    got = {r.k: r for r in df.collect()}
    assert (got[1].totals, got[1].subcategories, got[1].joint, got[1].n_in_table) == ({"a": 6, "b": None}, {"a.x": 5}, {"a.F": 3, "a.M": 3}, 6)
    assert got[2].totals == {"b": None} and got[2].n_in_table is None and not got[2].reported and got[2].joint == {}
    assert got[3].totals == {"c": 0} and not got[3].reported and got[4].totals is None
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Aggregate [") == 1


def test_usable_baseline_reads_the_total_group_once(spark):
    plan = QUERIES["FLT-15"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("single_group") == 1


def test_weeks_of_pairs_meet_once(spark, monkeypatch):
    from cohortmill.operators import sponsors as S

    written, real = [], S.kept
    monkeypatch.setattr(S, "kept", lambda df, name: written.append(name) or real(df, name))
    index = "nct_id string, canonical string, role string, literal_name string"
    was, now = spark.createDataFrame([("1", "A", "lead", "a"), ("2", "A", "lead", "a")], index), spark.createDataFrame([("1", "A", "lead", "a2"), ("3", "B", "lead", "b"), ("3", "C", "lead", "c")], index)
    registry = "nct_id string, role string, name string"
    before, after = spark.createDataFrame([("3", "lead", "b"), ("3", "lead", "b"), ("2", "lead", "a")], registry), spark.createDataFrame([("3", "lead", "b")], registry)
    got = {(r.nct_id, r.canonical, r.change, r.literal, r.cause) for r in S.pair_changes(was, now, before, after, True).collect()}
    assert got == {("3", "B", "added", "b", "rules_change"), ("3", "C", "added", "c", "registry_edit"), ("2", "A", "removed", "a", "registry_edit")}
    assert written == ["pair-changes"]


@pytest.mark.parametrize("name", ["SEL-7-tables", "SEL-9-tables"])
def test_posted_tables_are_shuffled_once(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    assert plan.executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert "Window" not in plan.optimizedPlan().toString() and plan.optimizedPlan().toString().count("Join") == 1


def test_lines_of_tables_are_summed_not_collected(spark, monkeypatch):
    """Only an order's tables are collected; its lines are sums, in as many partitions as their number asks for."""
    from cohortmill.plans import tables as T

    monkeypatch.setattr(T, "LINES", 100)
    df = QUERIES["SEL-9-tables"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == 1 and "array_sort(" not in plan
    n = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert "RepartitionByExpression [l_orderkey" in plan and f", {-(-n // 100)}" in plan.split("RepartitionByExpression [l_orderkey")[1].splitlines()[0]


def test_two_indexes_meet_in_one_shuffle(spark):
    from cohortmill.operators import sponsors as S

    index = lambda rows: spark.createDataFrame([(t, c, r, n) for t, c, r, n in rows], "nct_id string, canonical string, role string, literal_name string")
    left = index([("a", "X", "lead", "x1"), ("a", "X", "lead", "x0"), ("a", "Y", "lead", "y"), ("a", "Z", "lead", "z"), ("a", "W", None, "w"), ("b", "X", "lead", "x1"), ("c", "X", "lead", "x1")])
    right = index([("a", "X", "lead", "x1"), ("a", "V", "lead", "y"), ("a", "Z", "collaborator", "z"), ("a", "W", None, "w"), ("d", "X", "lead", "x1")])
    trials = spark.createDataFrame([("a",), ("c",), (None,)], "nct_id string")
    df = S.concordance(left, right, trials.unionByName(trials), trials)
    got = sorted((r.nct_id, r.canonical, str(r.role), r.state, str(r.cause)) for r in df.collect())
    want = [("a", "V", "lead", "right_only", "canonical_differs"), ("a", "W", "None", "left_only", "role_differs"), ("a", "W", "None", "right_only", "role_differs"), ("a", "X", "lead", "agree", "None"), ("a", "Y", "lead", "left_only", "canonical_differs")]
    assert got == [*want, ("a", "Z", "collaborator", "right_only", "role_differs"), ("a", "Z", "lead", "left_only", "role_differs"), ("c", "X", "lead", "left_only", "literal_absent")]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_likeness_is_taken_of_distinct_texts(spark):
    """Every row of part may hold the same text: the comparing stands above the aggregate, once."""
    plan = QUERIES["VOC-11"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    compared = [i for i, line in enumerate(plan) if "ArrowEvalPython" in line]
    assert len(compared) == 1
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    below = []
    for line in plan[compared[0] + 1 :]:
        if depth(line) <= depth(plan[compared[0]]):
            break
        below.append(line)
    assert any("Aggregate [" in line for line in below)


def test_points_hold_no_table_of_crossings(spark):
    from cohortmill.operators import blocks as B

    square = lambda a, x, y, d: [(a, x, y, x + d, y), (a, x + d, y, x + d, y + d), (a, x + d, y + d, x, y + d), (a, x, y + d, x, y)]
    edges = spark.createDataFrame([*square(1, 0.0, 0.0, 4.0), *square(1, 1.0, 1.0, 2.0), *square(2, 3.0, 0.5, 4.0)], "area long, x1 double, y1 double, x2 double, y2 double")
    points = spark.createDataFrame([(1, 0.5, 2.0), (2, 2.0, 2.0), (3, 3.5, 1.0), (4, 9.0, 1.0), (5, 0.0, 0.0), (6, None, 1.0), (7, 1.0, None), (8, 1.0, float("nan"))], "point_id long, x double, y double")
    df = B.points_in_areas(points, edges, 0.5)
    assert sorted((r.point_id, r.area) for r in df.collect()) == [(1, 1), (3, 1), (3, 2), (5, 1)]
    aggregates = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line]
    assert len(aggregates) == 1 and "strip" in aggregates[0]


def test_documents_are_searched_once_for_cited_numbers(spark, monkeypatch):
    from cohortmill.operators import links as K

    kinds, real = [], K.identifiers
    monkeypatch.setattr(K, "identifiers", lambda *a: kinds.append(list(a[4]) if len(a) > 4 else list(K.IDENTIFIERS)) or real(*a))
    plan = QUERIES["JN-15"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert kinds == [["nct"]] and "regexp_extract_all" not in plan and "c_custkey" not in plan


def test_sources_of_a_rebuilt_table_meet_once(spark):
    plan = QUERIES["SEL-15"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and "replicaterows" not in plan  # either source is read here only: not before, for its labels


def test_labels_beyond_the_known_ones_ask_the_rule(spark):
    from cohortmill.operators import selection as S

    cells = spark.createDataFrame([("a", "Sex: Female, Male", x, "Participants", 1.0) for x in ("Female", "Male ", "Women", "Non-binary", "stones", None)], "nct_id string, title string, label string, unit string, value double")
    known = S.label_buckets(cells.filter("label in ('Female', 'stones')"))
    bucket = lambda df: {r.label: r.bucket for r in df.collect()}
    assert bucket(S.labelled_rows(cells, known)) == bucket(S.labelled_rows(cells)) and bucket(S.labelled_rows(cells))["Women"] is not None
