"""Readers of posted values. Three of them, kept apart on purpose: they disagree about commas, signs and 'NA'."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it: within lambdas Spark shares no common expressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def posted_number(text: Column) -> Column:
    """Without thousands commas, percent signs and a parenthesised deviation; null if no number is left."""
    plain = F.trim(F.regexp_replace(F.trim(F.regexp_replace(text, "[,%]", "")), r"\s*\(.*?\)\s*", ""))
    return F.nullif(plain, F.lit("")).try_cast("double")


def parser_number(text: Column) -> Column:
    """White space aside, the text must be a number: '1,234' and 'NA' are null."""
    x = F.trim(text).try_cast("double")
    return F.when(~F.isnan(x), x)


def finite_number(text: Column) -> Column:
    """Without commas; finite or null."""
    return _finite(F.trim(F.regexp_replace(text, ",", "")).try_cast("double"))


def as_count(number: Column, percent: Column, denominator: Column) -> Column:
    """A share of a known denominator becomes a count, rounded half to even; else the whole part; null counts 0."""
    share = percent & (denominator > 0) & number.between(0, 100)
    return F.coalesce(F.when(share, F.bround(number / 100 * denominator)).otherwise(number.cast("bigint")).cast("bigint"), F.lit(0).cast("bigint"))


def sum_checked_total(values: Column) -> Column:
    """struct<total, by_position, sum_check> of array<double>: the first value equal to the sum of the others, else the last, flagged."""

    def read(values: Column, whole: Column) -> Column:
        n, double = F.size(values), "double"
        fit = F.try_element_at(F.filter(values, lambda v: F.abs(2 * v - whole) < 1e-6), F.lit(1))
        total = lambda fit: F.when(n == 1, F.get(values, F.lit(0))).when(fit.isNotNull(), fit).when(n > 1, F.element_at(values, -1)).cast(double)
        return bound(fit, lambda fit: F.struct(total(fit).alias("total"), F.coalesce((n > 1) & fit.isNull(), F.lit(False)).alias("by_position"), F.when(n > 1, fit.isNotNull()).alias("sum_check")))

    return bound(F.filter(values, lambda v: v.isNotNull()), lambda known: bound(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), lambda whole: read(known, whole)))


def p_value_form(text: Column) -> Column:
    """absent, number, bound, other_with_digit or no_digit."""
    s = F.trim(F.coalesce(text, F.lit("")))
    bound = F.regexp_extract(s, r"^(?:<=|>=|<|>|≤|≥)\s*(.*)$", 1)
    return (
        F.when(s == "", "absent")
        .when(finite_number(s).isNotNull() | (s.startswith("=") & finite_number(F.substring(s, 2, 1000)).isNotNull()), "number")
        .when((bound != "") & finite_number(bound).isNotNull(), "bound")
        .when(s.rlike(r"\d"), "other_with_digit")
        .otherwise("no_digit")
    )


def shares(values: list[Column]) -> Column:
    """array<double>: percent of the known total, one decimal; null when nothing is known. Negative and null count 0."""
    clean = [F.greatest(F.coalesce(v.cast("double"), F.lit(0.0)), F.lit(0.0)) for v in values]
    known = sum(clean[1:], clean[0])
    return F.when(known > 0, F.array(*[F.bround(100 * v / known, 1) for v in clean]))
