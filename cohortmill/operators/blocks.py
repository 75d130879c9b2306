"""Dimension blocks of a trial: counted tables become category totals, the rest of the population is unknown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import bound


def dimension_block(rows: DataFrame, key: str, category: str, value: str, population: DataFrame, size: str, subcategory: str | None = None, sex: str | None = None) -> DataFrame:
    """One row a trial: totals by category, the shortfall to the baseline population as inferred unknown, and whether anything is reported;
    where asked for also maps of subcategories ('category.subcategory') and of categories by sex ('category.sex').

    A table of zeros only is not reported; explicit unknown rows stay apart from the inferred remainder."""
    fine = [c for c in (subcategory, sex) if c]
    number = rows.agg(F.sum(value).alias("n")).schema["n"].dataType
    total = lambda found: F.when(F.exists(found, lambda x: x["n"].isNotNull()), F.aggregate(found, F.lit(0).cast(number), lambda a, x: F.when(x["n"].isNull(), a).otherwise((a + x["n"]).cast(number))))

    def summed(c: str | None) -> Column:
        name = (lambda x: F.concat_ws(".", x[category], x[c])) if c else (lambda x: x[category])
        named = F.transform(F.filter("_c", lambda x: x[c].isNotNull()) if c else F.col("_c"), lambda x: F.struct(name(x).alias("name"), x["n"].alias("n")))
        by_name = lambda named: F.transform(F.array_sort(F.array_distinct(F.transform(named, lambda x: x["name"]))), lambda k: F.struct(k.alias("name"), bound(F.filter(named, lambda x: x["name"] == k), total).alias("n")))
        return F.map_from_entries(bound(named, by_name))

    # one shuffle, by trial, and no table of groups in memory before it; a trial's array is as long as what it posts
    per = rows.repartition(key).groupBy(key).agg(F.collect_list(F.struct(category, *fine, F.col(value).alias("n"))).alias("_c"))
    block = per.select(key, summed(None).alias("totals"), *[summed(c).alias(name) for c, name in ((subcategory, "subcategories"), (sex, "joint")) if c], total(F.col("_c")).alias("n_in_table"))
    out = population.join(block, key, "left")
    short = F.greatest(F.lit(0.0), F.col(size) - F.coalesce("n_in_table", F.lit(0.0)))
    reported = F.coalesce(F.col("n_in_table") > 0, F.lit(False))
    return out.withColumns({"reported": reported, "unknown_inferred": F.when(reported, short), "exceeds_population": F.when(reported, F.col("n_in_table") > F.col(size))})


def observed_counts(block: DataFrame, known: list[str]) -> DataFrame:
    """Two denominators: everyone in the table, and those in a known category."""
    of = lambda k: F.coalesce(F.try_element_at("totals", F.lit(k)), F.lit(0.0))
    classified = sum((of(k) for k in known[1:]), of(known[0]))
    return block.filter("reported").withColumns({"n_classified": classified, "n_unclassified": F.col("n_in_table") - classified})


def table_check(total: Column, other: Column, has_ethnicity_rows: Column) -> Column:
    """Whether a table's rows may be read as one classification that counts each person once."""
    slack = F.greatest(F.lit(1.0), 0.01 * other)
    return (
        F.when(has_ethnicity_rows, "race_table_has_ethnicity_rows")
        .when(F.coalesce(other, F.lit(0.0)) <= 0, "no_other_table_to_check_against")
        .when(total > other + slack, "table_total_exceeds_sex_table")
        .when(total < other - slack, "table_total_below_sex_table")
        .otherwise("matches_sex_table")
    )


def reference_caveats(healthy: Column, referral: Column, lo: Column, hi: Column, single_sex: Column) -> Column:
    """array<string> of the reasons why an area's population is only context."""
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(healthy, F.lit(False)), "enrols_patients_not_the_general_population"),
            F.when(referral, "site_in_a_referral_centre_zip"),
            F.when(hi <= 18, "children_only"),
            F.when(lo >= 60, "older_adults_only"),
            F.when(single_sex, "single_sex_eligibility"),
        )
    )


def points_in_areas(points: DataFrame, edges: DataFrame, cell: float = 1.0) -> DataFrame:
    """(point_id, area): points (point_id, x, y) inside polygons given by edges (area, x1, y1, x2, y2).

    An edge meets the horizontal strips that it crosses; a point looks at the edges of its strip only, and is inside
    where the ray to its right crosses an odd number of an area's edges. An area's edges in a strip are one row, so that a point counts
    them where it is, and no table of points and areas is held."""
    strip = lambda y: F.floor(y / cell)
    sides = edges.filter("y1 <> y2").select("area", "x1", "y1", "x2", "y2", F.least("y1", "y2").alias("low"), F.greatest("y1", "y2").alias("high"))
    cut = sides.withColumn("strip", F.explode(F.sequence(strip(F.col("low")), strip(F.col("high")))))
    cut = cut.groupBy("strip", "area").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2", "low", "high")).alias("edges"))
    near = points.withColumn("strip", strip(F.col("y"))).join(cut, "strip")
    at = lambda e: e["x1"] + (F.col("y") - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])
    crossed = F.filter("edges", lambda e: (F.col("y") >= e["low"]) & (F.col("y") < e["high"]) & (F.col("x") < at(e)))
    return near.filter(F.size(crossed) % 2 == 1).select("point_id", "area")
