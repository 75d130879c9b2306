"""Texts of records of any shape, against a walk in plain Python."""

import json
import random

from cohortmill.operators.links import cited_numbers
from cohortmill.operators.walk import record_texts, unreadable


def walk(x, path=""):
    if isinstance(x, dict):
        return [y for k, v in x.items() for y in walk(v, f"{path}.{k}" if path else k)]
    if isinstance(x, list):
        return [y for v in x for y in walk(v, path + "[]")]
    return [(path, x)] if isinstance(x, str) else []


def made(r, depth):
    kind = r.randrange(6) if depth else 5
    if kind < 2:
        return {r.choice(["a", "b.c", "d e", "", "é"]) + str(i): made(r, depth - 1) for i in range(r.randrange(4))}
    if kind < 4:
        return [made(r, depth - 1) for _ in range(r.randrange(4))]
    return r.choice([None, 1, 2.5, True, "", "text", 'brackets [{ " \\ "', "\\", "2024-01-01", "null", "line\nbreak", "x" * 50_000])


def test_any_record(spark):
    r = random.Random(3)
    records = [made(r, 6) for _ in range(300)] + ["alone", [], {}, [[["deep"]]], None]
    rows = [(i, json.dumps(x, ensure_ascii=bool(i % 2)), "clash") for i, x in enumerate(records)] + [(1000, None, ""), (1001, "{", ""), (1002, "", "")]
    frame = spark.createDataFrame(rows, "id int, record string, value string")
    got = sorted(map(tuple, record_texts(frame, "id", "record").collect()))
    assert got == sorted((i, p, t) for i, x in enumerate(records) for p, t in walk(x))
    assert sorted(x.id for x in unreadable(frame, "record").collect()) == [1001, 1002]
    assert record_texts(frame.limit(0), "id", "record").collect() == []


def test_citations_in_any_field(spark):
    record = {"protocol": {"title": "none", "links": [{"label": "see k990001."}, {"label": ["P140011/S008", {"note": "P140011"}]}]}, "K123456": 5}
    frame = spark.createDataFrame([(1, json.dumps(record))], "id int, record string")
    numbers = spark.createDataFrame([("K990001",), ("P140011/S008",), ("P140011",), ("K123456",)], "number string")
    got = cited_numbers(record_texts(frame, "id", "record"), numbers).collect()
    assert sorted((x.path, x.number, x.supplement_cited) for x in got) == [("protocol.links[].label", "K990001", None), ("protocol.links[].label[]", "P140011/S008", True), ("protocol.links[].label[].note", "P140011", None), ("protocol.links[].label[].note", "P140011/S008", False)]


def test_no_join(spark):
    frame = spark.createDataFrame([(1, '{"a": ["x"]}')], "id int, record string")
    plan = record_texts(frame, "id", "record")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
