"""Supersession: chains of any length, cycles, tombstones, branches; a history that only grows."""

from cohortmill.operators.history import appended, supersession

SCHEMA = "id long, replaces long, withdrawn boolean"


def test_chains(spark):
    rows = [(i, i - 1 if i > 1 else None, False) for i in range(1, 301)]
    rows += [(1001, 1003, False), (1002, 1001, False), (1003, 1002, False), (1004, 1002, None)]  # a cycle, and a branch off it
    rows += [(2001, None, False), (2002, 2001, True)]  # a tombstone
    rows += [(3001, None, False), (3002, 3001, False), (3003, 3001, False)]  # two replace one
    rows += [(4001, 4001, False), (4002, 9999, False), (5001, None, False), (5001, 4002, False), (6001, None, None), (6001, None, None)]
    got = {r.id: (r.head, r.depth, r.state) for r in supersession(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len({r[0] for r in rows})
    assert got[1] == (300, 299, "superseded") and got[300] == (300, 0, "current") and got[150] == (300, 150, "superseded")
    assert {got[i][2] for i in (1001, 1002, 1003, 3001, 4001, 4002, 5001)} == {"quarantined"}
    assert got[2001] == (2002, 1, "withdrawn") and got[2002] == (2002, 0, "withdrawn") and got[6001] == (6001, 0, "current")
    assert got[3002][2] == "current"


def test_no_records(spark):
    assert supersession(spark.createDataFrame([], SCHEMA)).count() == 0


def test_history(spark):
    none = spark.createDataFrame([], "id long, head long, state string, batch string")
    first = supersession(spark.createDataFrame([(1, None, False), (2, 1, False)], SCHEMA))
    one = appended(none, first, "w1")
    assert one.count() == 2 and appended(one, first, "w1").count() == 0
    second = supersession(spark.createDataFrame([(1, None, False), (2, 1, False), (3, 2, True)], SCHEMA))
    assert sorted((r.id, r.head, r.state) for r in appended(one, second, "w2").collect()) == [(1, 3, "withdrawn"), (2, 3, "withdrawn"), (3, 3, "withdrawn")]
