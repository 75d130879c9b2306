"""Trials against the populations of their areas: survey windows, overlaps, expected and observed compositions, pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_window(rows: DataFrame, midpoint: str, windows: list[tuple[int, int]]) -> DataFrame:
    """Adds vintage, reason and gap_years: the window that holds the midpoint, else the nearest one."""
    m, first, last = F.col(midpoint), windows[0], windows[-1]
    inside = F.coalesce(*[F.when((m >= lo) & (m < hi + 1), hi) for lo, hi in windows])
    return rows.withColumns({
        "vintage": F.when(m.isNull(), None).otherwise(F.coalesce(inside, F.when(m < first[0], first[1]).otherwise(last[1]))),
        "reason": F.when(m.isNull(), "no_usable_date").when(inside.isNotNull(), "midpoint_inside_window").when(m < first[0], "before_first_window").otherwise("after_last_window"),
        "gap_years": F.when(inside.isNotNull(), F.lit(0.0)).when(m < first[0], F.bround(first[0] - m, 2)).otherwise(F.bround(m - (last[1] + 1), 2)),
    })


def largest_overlap(shares: DataFrame, unit: str, area: str, share: str, least: float = 0.0) -> DataFrame:
    """The area that holds most of each unit, if at least `least` of it; the smaller area id on ties."""
    best = Window.partitionBy(unit).orderBy(F.desc(share), area)
    return shares.withColumn("nth", F.row_number().over(best)).filter((F.col("nth") == 1) & (F.col(share) >= least)).drop("nth")


def band_weight(lo: Column, hi: Column, band_lo: Column, band_hi: Column, open_years: int = 15) -> Column:
    """The share of an age band inside [lo, hi); an open top band counts as `open_years` wide."""
    top = F.coalesce(band_hi, band_lo + open_years)
    return F.greatest(F.lit(0.0), F.least(F.coalesce(hi, top), top) - F.greatest(lo, band_lo)) / (top - band_lo)


def summed_estimates(rows: DataFrame, by: list[str], estimate: str, margin: str) -> DataFrame:
    """Sums with their margins by root of squares; an unpublished part leaves the sum unpublished."""
    whole = F.every(F.col(estimate).isNotNull())
    return rows.groupBy(*by).agg(F.when(whole, F.sum(estimate)).alias("estimate"), F.when(whole, F.sqrt(F.sum(F.col(margin) * F.col(margin)))).alias("margin"))


def share_margin(part: Column, whole: Column, part_margin: Column, whole_margin: Column) -> Column:
    """Margin of a proportion; where its root would be of a negative number, that of a ratio."""
    p = part / whole
    inner = part_margin * part_margin - p * p * whole_margin * whole_margin
    return F.when(whole > 0, F.sqrt(F.when(inner >= 0, inner).otherwise(part_margin * part_margin + p * p * whole_margin * whole_margin)) / whole)


def compared(observed: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Percentage-point difference and ratio of observed and expected shares; why a ratio is undefined."""
    both = observed.join(expected, keys)
    return both.withColumns({
        "diff_pp": 100 * (F.col("observed") - F.col("expected")),
        "ratio": F.when(F.col("expected") > 0, F.col("observed") / F.col("expected")),
        "undefined": F.when(F.col("expected").isNull(), "expected_missing").when(F.col("expected") == 0, "expected_zero"),
    })


def spread(rows: DataFrame, by: list[str], level: str, value: str, flag_from: float) -> DataFrame:
    """How far a value lies apart over the levels of geography that have it, and whether that is too far to choose one."""
    wide = F.max(value) - F.min(value)
    return rows.groupBy(*by).agg(F.count_distinct(F.when(F.col(value).isNotNull(), F.col(level))).alias("n_levels"), wide.alias("spread_pp"), F.coalesce(wide > flag_from, F.lit(False)).alias("is_spread"))


def unknown_bounds(rows: DataFrame, by: list[str], known: str, unknown: str, part: str) -> DataFrame:
    """The share of a category among the classified, and the bounds it has if none or all of the unknown belong to it; null without people."""
    n, u, x = F.sum(known), F.sum(unknown), F.sum(part)
    return rows.groupBy(*by).agg(F.try_divide(x, n).alias("classified"), F.try_divide(x, n + u).alias("low"), F.try_divide(x + u, n + u).alias("high"))


def pooled(rows: DataFrame, by: list[str], floor: int = 50, heavy: float = 0.5) -> DataFrame:
    """rows: n people, observed and expected shares, one row a trial. Plain and weighted means from `floor` trials on; flags one trial with most people."""
    n, enough = F.col("n"), F.count("*") >= floor
    mean = lambda c: F.when(enough, F.avg(c))
    weighted = lambda c: F.when(enough & (F.sum("n") > 0), F.sum(n * F.col(c)) / F.sum("n"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_trials"), F.sum("n").alias("n_people"), mean("observed").alias("observed_plain"), weighted("observed").alias("observed_weighted"), mean("expected").alias("expected_plain"),
        weighted("expected").alias("expected_weighted"), (F.max("n") > heavy * F.sum("n")).alias("is_concentrated"),
    )
