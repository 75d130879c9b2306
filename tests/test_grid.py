"""Points in polygons by the grid: what the plain test of every point against every edge gives."""

import math
import random

import pytest

from cohortmill.operators.grid import points_in_cells

EDGES = "area string, x1 double, y1 double, x2 double, y2 double"
POINTS = "point_id int, x double, y double, area int"


def ring(area, corners):
    return [(area, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(corners, corners[1:] + corners[:1])]


def plain(points, edges):
    out = set()
    for p, x, y, _ in points:
        odd = {}
        for area, x1, y1, x2, y2 in edges:
            if min(y1, y2) <= y < max(y1, y2) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                odd[area] = odd.get(area, 0) + 1
        out |= {(p, a) for a, n in odd.items() if n % 2}
    return out


def shapes():
    r = random.Random(5)
    star = [((3 + 2 * (k % 2) + r.random()) * math.cos(k / 20 * math.tau), (3 + 2 * (k % 2) + r.random()) * math.sin(k / 20 * math.tau)) for k in range(20)]
    edges = ring("star", star) + ring("square", [(-2, -2), (2, -2), (2, 2), (-2, 2)]) + ring("square", [(-1, -1), (-1, 1), (1, 1), (1, -1)])  # with a hole
    edges += ring("two", [(4, 4), (6, 4), (6, 6), (4, 6)]) + ring("two", [(-6, -6), (-4, -6), (-5, -4)]) + ring("huge", [(-1e4, -1e4), (1e4, -1e4), (1e4, 1e4), (-1e4, 1e4)]) + ring("far", [(50, 50), (51, 50), (51, 51)])
    points = [(k, r.uniform(-7, 7), r.uniform(-7, 7), 0) for k in range(1500)]
    points += [(2000 + k, float(x), float(y), 0) for k, (x, y) in enumerate((x, y) for x in range(-6, 7) for y in range(-6, 7))]  # corners and borders
    return points, edges


@pytest.mark.parametrize("cell,heavy", [(None, 100_000), (0.5, 20), (1.0, 100_000), (100.0, 50)])
def test_the_plain_test(spark, cell, heavy):
    points, edges = shapes()
    got = points_in_cells(spark.createDataFrame(points, POINTS), spark.createDataFrame(edges, EDGES), cell, heavy=heavy).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == plain(points, edges)


def test_borders_nulls_and_empty_tables(spark):
    frame = spark.createDataFrame(ring("a", [(0, 0), (2, 0), (2, 2), (0, 2)]) + ring("b", [(2, 0), (4, 0), (4, 2), (2, 2)]) + [("a", None, 0.0, 1.0, 1.0)], EDGES)
    points = [(1, 2.0, 1.0, 9), (2, 0.0, 0.0, 9), (3, 4.0, 2.0, 9), (4, 1.0, 1.0, 9), (5, None, 1.0, 9), (6, float("nan"), 1.0, 9), (7, 3.0, 2.0, 9), (8, 5.0, 2.0, 9), (4, 1.0, 1.0, 9)]
    points = spark.createDataFrame(points, POINTS)
    for cell in (None, 0.7):
        assert {tuple(r) for r in points_in_cells(points, frame, cell, borders=True).collect()} == {(1, "a"), (1, "b"), (2, "a"), (3, "b"), (4, "a"), (7, "b")}
    assert {tuple(r) for r in points_in_cells(points.filter("point_id <> 4"), frame).collect()} == {(1, "b"), (2, "a")}
    assert points_in_cells(points.limit(0), frame).count() == points_in_cells(points, frame.limit(0)).count() == 0
