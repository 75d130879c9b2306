"""Contracts of paths: projections, lossless splits of nested arrays, losses by path, and what records lack."""

import json

import pytest

from cohortmill.sources import contracts as C

SCHEMA = "id int, record struct<id: string, groups: array<struct<id: string, title: string, n: int>>, race: struct<reported: boolean, rows: array<struct<label: string, flags: array<string>, cells: array<struct<sex: string, n: int>>>>>, extra: string>"
RECORDS = [
    {"id": "a", "groups": [{"id": "g1", "title": "Arm", "n": 3}, {"id": "g2", "title": None, "n": 4}], "race": {"reported": True, "rows": [{"label": "White", "flags": ["x", None], "cells": [{"sex": "f", "n": 1}, {"sex": "m", "n": None}]}, {"label": None, "flags": [], "cells": []}]}, "extra": "e"},
    {"id": "b", "groups": [], "race": {"reported": None, "rows": None}, "extra": None}, {"id": "c", "groups": None, "race": None, "extra": "e"}, {"id": "d", "groups": [None], "race": {"reported": False, "rows": [None]}, "extra": ""}, None,
]
CLASSES = {"core": ["id", "groups[].id", "race.reported"], "labels": ["groups[].title", "race.rows[].label", "race.rows[].cells[].sex"], "numbers": ["groups[].n", "race.rows[].flags", "race.rows[].cells[].n"]}
PATHS = [p for c in CLASSES.values() for p in c]


def frame(spark):
    return spark.createDataFrame([(i, r) for i, r in enumerate(RECORDS)], SCHEMA)


def test_projection(spark):
    got = C.project(frame(spark), "id", "record", ["race.rows[].label", "groups", "groups[].id"])
    assert got.schema["record"].dataType.simpleString() == "struct<race:struct<rows:array<struct<label:string>>>,groups:array<struct<id:string,title:string,n:int>>>"
    assert [r.record and r.record.asDict(True) for r in got.orderBy("id").collect()][0] == {"race": {"rows": [{"label": "White"}, {"label": None}]}, "groups": RECORDS[0]["groups"]}


@pytest.mark.parametrize("paths", [["a..b"], ["a[]b"], [""], ["a", "a"], ["a[].b", "a.c"], ["[]"]])
def test_refused(paths):
    with pytest.raises(ValueError):
        C.tree(paths)


@pytest.mark.parametrize("paths", [["nothing"], ["race.nothing"], ["id[]"], ["groups.id"]])
def test_refused_by_schema(spark, paths):
    with pytest.raises(ValueError):
        C.project(frame(spark), "id", "record", paths)


def test_split_and_merge(spark):
    whole = frame(spark)
    parts = C.split(whole, "id", "record", CLASSES)
    assert set(parts["labels"].schema["record"].dataType.names) == {"groups", "race"}
    back = C.merge(parts, "id", "record")
    plain = lambda r: r and {"id": r["id"], "groups": r["groups"], "race": r["race"]}
    got = {r.id: r.record and r.record.asDict(True) for r in back.collect()}
    assert got == {i: plain(r) for i, r in enumerate(RECORDS)}
    assert {(r.path, r.n_records, r.n_lost, r.example) for r in C.losses(whole, back, "id", "record", PATHS).collect()} == {(p, 5, 0, None) for p in PATHS}


def test_losses_are_named(spark):
    whole = frame(spark)
    parts = C.split(whole, "id", "record", CLASSES)
    parts["labels"] = parts["labels"].filter("id <> 0")
    lost = {r.path: (r.n_lost, r.example) for r in C.losses(whole, C.merge(parts, "id", "record"), "id", "record", PATHS).collect()}
    assert lost == {p: ((1, 0) if p in CLASSES["labels"] else (0, None)) for p in PATHS}
    with pytest.raises(ValueError):
        C.split(whole, "id", "record", {"a": ["id"], "b": ["id"]})


def test_what_records_lack(spark):
    records = [{"a": {"b": 1}, "l": [{"x": None, "deep": [{"y": 1}]}, {"x": 2, "deep": []}]}, {"a": {}, "l": []}, {"a": None, "l": None}, {"a": [1], "l": [{"x": 1, "deep": [{}]}, {"deep": []}]}, [1], "text", None]
    texts = [json.dumps(r) for r in records] + ["{", None]
    rows = C.presence(spark.createDataFrame([(t, "clash") for t in texts], "text string, path string"), "text", ["a", "a.b", "l[].x", "l[].deep[].y", "l"]).collect()

    def told(r, path):
        level = [r]
        for part in path.split("."):
            key = part.removesuffix("[]")
            if not all(isinstance(x, dict) and key in x for x in level):
                return f"no {key}"
            level = [x[key] for x in level]
            if part.endswith("[]"):
                if not all(isinstance(x, list) for x in level):
                    return f"{key} is not a list"
                level = [y for x in level for y in x]

    want = {}
    for path in ["a", "a.b", "l[].x", "l[].deep[].y", "l"]:
        for reason in [told(r, path) for r in records] + ["not json"] * 2:
            want[path, reason] = want.get((path, reason), 0) + 1
    assert {(r.path, r.reason): r.n for r in rows} == want


def test_archive_of_listed_ids(spark):
    texts = [("a", '{"x": {"y": null, "z": 1}, "l": [{"v": 1, "w": 2}, {}, {"v": "é"}], "t": [1, [2]]}'), ("b", "{}"), ("c", "[1]"), ("d", "{,"), ("e", '{"l": {"v": 1}, "t": "one"}'), ("f", "{}"), ("f", "{}"), ("g", None), (None, "{}")]
    frame = spark.createDataFrame([(*x, 1) for x in texts], "id string, text string, _n int")
    ids = lambda *x: spark.createDataFrame([(i, 2) for i in x], "id string, text int")
    paths = ["l[].v", "x.y", "t"]
    got = {r["id"]: r["text"] for r in C.archived(frame, "id", "text", paths, ids("a", "b", "e")).collect()}
    assert got == {"a": '{"l":[{"v":1},{},{"v":"é"}],"x":{"y":null},"t":[1,[2]]}', "b": "{}", "e": '{"t":"one"}'}
    assert C.archived(frame, "id", "text", paths, ids()).count() == 0
    for bad, why in (("c", "no readable"), ("d", "no readable"), ("g", "no readable"), ("f", "several"), ("zz", "no record"), (None, "is null")):
        with pytest.raises(ValueError, match=why):
            C.archived(frame, "id", "text", paths, ids(bad))
    with pytest.raises(ValueError, match="listed twice"):
        C.archived(frame, "id", "text", paths, ids("a", "a"))
    one = C.archived(frame, "id", "text", paths, ids("a", "b", "e"))
    lost = {r["path"]: (r["n_records"], r["n_dropped"], r["example"]) for r in C.dropped(frame, one, "id", "text", [*paths, "x.z", "x", "l[].v"][:5]).collect()}
    assert lost == {"l[].v": (3, 0, None), "x.y": (3, 0, None), "t": (3, 0, None), "x.z": (3, 1, "a"), "x": (3, 0, None)}
