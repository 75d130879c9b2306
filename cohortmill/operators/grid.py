"""Points in polygons by a grid: cells as large as the points are dense, edges only where they lie, heavy cells split."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_CELL, HEAVY = 1_000, 100_000


def points_in_cells(points: DataFrame, edges: DataFrame, cell: float | None = None, borders: bool = False, heavy: int = HEAVY) -> DataFrame:
    """(point_id, area): points (point_id, x, y) in the polygons of edges (area, x1, y1, x2, y2). Rings are closed; those within others are holes, whichever way
    they run. A point on a border is in the area above or to the right of it; with `borders`, in every area that it touches.

    A ray to the right of a point must cross an odd number of an area's edges. Edges that meet the point's cell are tested one by one. Those
    farther right cross it by their heights alone: each begins and ends to count at a height, where two edges of a ring meet these cancel, and
    what stays is a row for each cell that lies inside, and one for each vertex between the cells of its edges. So no cell holds edges of
    far ones, nothing outside the points' extent is made, and the answers are those of the plain test. Null or non-finite coordinates take no part;
    repeated points count once, an id at several places is looked up at each."""
    real = lambda *names: F.expr(" and ".join(f"abs({n}) < double('infinity')" for n in names))
    points, edges = points.select("point_id", "x", "y").filter(real("x", "y")).distinct(), edges.select("area", "x1", "y1", "x2", "y2").filter(real("x1", "y1", "x2", "y2"))
    box = points.agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x", "y")]).first()
    wide, high = ((box[f"max_{c}"] - box[f"min_{c}"]) if box["n"] else 0.0 for c in ("x", "y"))
    cells = max(1.0, box["n"] / PER_CELL)
    cell = cell or math.sqrt(wide * high / cells) or max(wide, high) / cells or 1.0
    at = lambda v: F.floor(v / F.lit(cell))
    bounds = {c: [F.floor(F.lit(float(box[f"{f}_{c}"] if box["n"] else 0.0)) / F.lit(cell)) for f in ("min", "max")] for c in ("x", "y")}
    within = lambda lo, hi, axis: F.when(F.greatest(lo, bounds[axis][0]) <= F.least(hi, bounds[axis][1]), F.sequence(F.greatest(lo, bounds[axis][0]), F.least(hi, bounds[axis][1])))

    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    pieces = edges.withColumn("j", F.explode(within(at(lo), at(hi), "y")))
    top = (F.col("j") + 1) * F.lit(cell)
    pieces = pieces.withColumns({"a": F.greatest(lo, F.col("j") * F.lit(cell)), "b": F.least(hi, top)})
    x = lambda y: F.when(lo == hi, F.col("x1")).otherwise(F.col("x1") + (y - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1")))
    # a margin far over the rounding of x, and far under a cell; a flat edge lies along its whole length
    flat, margin = lo == hi, F.greatest(F.abs("x1"), F.abs("x2"), F.lit(cell)) * 1e-9
    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(x(F.col("a")), x(F.col("b")))) - margin
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(x(F.col("a")), x(F.col("b")))) + margin
    pieces = pieces.withColumns({"i1": at(left), "i2": at(right)})
    near = pieces.filter(F.lit(borders) | ~flat).withColumn("i", F.explode(within(F.col("i1"), F.col("i2"), "x"))).select("j", "i", "area", "x1", "y1", "x2", "y2", F.lit(None).cast("double").alias("from"))
    ends = pieces.filter("a < b").select("area", "j", "i1", F.explode(F.array_compact(F.array(F.col("a"), F.when(F.col("b") < top, F.col("b"))))).alias("from"))
    met = ends.groupBy("area", "j", "from").agg(F.sort_array(F.collect_list("i1")).alias("m"))
    # of the sorted cells, those from an even place (from 0) up to the next lie left of an odd number of them
    spans = F.transform(F.sequence(F.lit(0), F.floor(F.size("m") / 2).cast("int") - 1), lambda k: F.struct(F.get("m", 2 * k).alias("p"), (F.get("m", 2 * k + 1) - 1).alias("q")))
    spans = met.filter("size(m) > 1").select("area", "j", "from", F.explode(spans).alias("s")).filter("s.p <= s.q")
    none = F.lit(None).cast("double")
    far = spans.withColumn("i", F.explode(within(F.col("s.p"), F.col("s.q"), "x"))).select("j", "i", "area", none.alias("x1"), none.alias("y1"), none.alias("x2"), none.alias("y2"), "from")
    facts = near.unionByName(far)

    placed = points.withColumns({"j": at(F.col("y")), "i": at(F.col("x"))})
    crowded = placed.groupBy("j", "i").agg(F.ceil(F.count("*") / heavy).cast("int").alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    placed = placed.join(crowded, ["j", "i"], "left").withColumn("part", F.pmod(F.xxhash64("point_id"), parts)).drop("parts")
    facts = facts.join(crowded, ["j", "i"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), (parts - 1).cast("bigint")))).drop("parts")
    both = placed.join(facts, ["j", "i", "part"])
    crosses = F.when(F.col("from").isNotNull(), F.col("y") >= F.col("from")).otherwise((F.col("y") >= lo) & (F.col("y") < hi) & (F.col("x") < x(F.col("y"))))
    on = (F.col("x") >= F.least("x1", "x2")) & (F.col("x") <= F.greatest("x1", "x2")) & (F.col("y") >= lo) & (F.col("y") <= hi) & (flat | (F.col("x") == x(F.col("y"))))
    touches = F.coalesce(F.bool_or(on), F.lit(False)) if borders else F.lit(False)
    found = both.groupBy("point_id", "x", "y", "area").agg(F.count_if(crosses).alias("n"), touches.alias("on") if borders else F.lit(False).alias("on"))
    return found.filter("n % 2 = 1 or on").select("point_id", "area")
