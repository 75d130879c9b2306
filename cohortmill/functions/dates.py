"""Dates that may be known to a day, a month or a year only. Text in, columns out; unreadable text is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^(\d{4})(?:-(\d{2}))?(?:-(\d{2}))?$"


def _part(text: Column, k: int) -> Column:
    return F.nullif(F.regexp_extract(F.trim(text), ISO, k), F.lit(""))


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def days_between(start: Column, end: Column) -> Column:
    """Whole days; missing months and days count as the first."""

    def full(text: Column) -> Column:
        n = F.size(F.split(text, "-"))
        return F.try_to_date(F.when(n == 1, F.concat(text, F.lit("-01-01"))).when(n == 2, F.concat(text, F.lit("-01"))).otherwise(text), "yyyy-MM-dd")

    return F.datediff(full(end), full(start))


def precision(text: Column) -> Column:
    year, month, day = (_part(text, k) for k in (1, 2, 3))
    return F.when(year.isNull(), None).when(day.isNotNull(), "day").when(month.isNotNull(), "month").otherwise("year")


def period_start(text: Column) -> Column:
    return _date(_part(text, 1), F.coalesce(_part(text, 2), F.lit("01")), F.coalesce(_part(text, 3), F.lit("01")))


def period_end(text: Column) -> Column:
    """The last day of the period that the text names."""
    start, kind = period_start(text), precision(text)
    return F.when(kind == "year", F.make_date(F.year(start), F.lit(12), F.lit(31))).when(kind == "month", F.last_day(start)).otherwise(start)


def bounds(text: Column) -> Column:
    """struct<lo, hi>: a month is not placed on a day; a bare year is no date here."""
    return F.when(F.coalesce(precision(text), F.lit("year")) != "year", F.struct(period_start(text).alias("lo"), period_end(text).alias("hi")))


def add_years(date: Column, n: int) -> Column:
    """29 February becomes the 28th where there is none."""
    return F.add_months(date, 12 * n)


def decimal_year(text: Column) -> Column:
    """The middle of a year or month, the start of a day; left unrounded."""
    year, month, day = (_part(text, k) for k in (1, 2, 3))
    inside = F.when(day.isNotNull(), (day.cast("int") - 1) / F.lit(365)).otherwise(F.lit(1) / F.lit(24))
    return F.when(month.isNull(), year.cast("int") + F.lit(0.5)).otherwise(year.cast("int") + (month.cast("int") - 1) / F.lit(12) + inside)


def enrolment_midpoint(start: Column, primary: Column, completion: Column) -> tuple[Column, Column]:
    """(basis, midpoint): between the start and the primary completion, else the completion, else what there is."""
    a, p, c = decimal_year(start), decimal_year(primary), decimal_year(completion)
    end, which = F.coalesce(p, c), F.when(p.isNotNull(), "primary_completion").otherwise("completion")
    both = a.isNotNull() & end.isNotNull() & (end >= a)
    basis = F.when(both, F.concat(F.lit("midpoint_of_start_to_"), which)).when(a.isNotNull(), "start_date_only").when(end.isNotNull(), F.concat(which, F.lit("_date_only"))).otherwise("no_usable_date")
    return basis, F.when(both, (a + end) / 2).otherwise(F.coalesce(a, end))


def prefix_date(text: Column) -> Column:
    """The first of the text's first 10, 7 and 4 characters that is a date."""
    return F.coalesce(*[F.try_to_date(F.concat(F.substring(text, 1, n), F.lit(rest)), "yyyy-MM-dd") for n, rest in ((10, ""), (7, "-01"), (4, "-01-01"))])


def list_date(text: Column, pivot: int = 90) -> Column:
    """M/D/YY or M/D/YYYY; two digits from `pivot` on are 19xx."""
    pattern = r"^\s*(\d{1,2})/(\d{1,2})/(\d{2}|\d{4})\s*$"
    month, day, year = (F.nullif(F.regexp_extract(text, pattern, k), F.lit("")) for k in (1, 2, 3))
    y = year.try_cast("int")
    y = F.when(y < 100, y + F.when(y >= pivot, 1900).otherwise(2000)).otherwise(y)
    return _date(y.cast("string"), month, day)


def relation(start: Column, primary: Column, decision: Column, near: int = 365) -> Column:
    """A study's dates against a decision date; where a month's precision leaves it open, that is said."""
    s, p = bounds(start), bounds(primary)

    def at(end: str) -> Column:
        return (
            F.when(p.isNotNull() & (p[end] <= decision), "primary_completion_on_or_before_decision")
            .when(s[end] <= decision, "started_on_or_before_decision_not_complete")
            .when(F.datediff(s[end], decision) <= near, f"started_within_{near}_days_after_decision")
            .otherwise(f"started_more_than_{near}_days_after_decision")
        )

    return F.when(s.isNull(), "study_start_date_unknown").when(at("lo") == at("hi"), at("lo")).otherwise("indeterminate_at_recorded_precision")
