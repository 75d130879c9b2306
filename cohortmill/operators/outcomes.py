"""Whether a trial belongs to the outcomes frame, and whether its results are posted at a cutoff."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import add_years, period_end, period_start


def exclusion_reasons(study_type: Column, phases: Column, sponsor_class: Column, allocation: Column, completion: Column, window: tuple[str, str]) -> Column:
    """array<string> of every reason; empty means eligible. A partial date is inside the window only with its whole period."""
    inside = (period_start(completion) >= F.lit(window[0]).cast("date")) & (period_end(completion) <= F.lit(window[1]).cast("date"))
    has = lambda p: F.coalesce(F.array_contains(phases, p), F.lit(False))
    return F.array_compact(
        F.array(
            F.when(~study_type.eqNullSafe(F.lit("INTERVENTIONAL")), "NOT_INTERVENTIONAL"),
            F.when(~has("PHASE3"), "NOT_PHASE3").when(has("PHASE2"), "PHASE2_PHASE3_STRATUM"),
            F.when(~sponsor_class.eqNullSafe(F.lit("INDUSTRY")), "LEAD_SPONSOR_NOT_INDUSTRY"),
            F.when(~allocation.eqNullSafe(F.lit("RANDOMIZED")), "NOT_RANDOMIZED"),
            F.when(~F.coalesce(inside, F.lit(False)), "PRIMARY_COMPLETION_OUTSIDE_WINDOW"),
        )
    )


def results_state(cutoff: Column, has_results: Column, posted: Column, status: Column, enrollment_type: Column, enrollment: Column, completion: Column, completion_type: Column, certified: Column) -> Column:
    """struct<state, reason>. Results posted after the cutoff were not posted at it; an estimated completion leaves the window open."""
    end, certificate = period_end(completion), period_start(certified)
    row = lambda s, r: F.struct(F.lit(s).alias("state"), F.lit(r).cast("string").alias("reason"))
    return (
        F.when(has_results & F.coalesce(period_start(posted) <= cutoff, F.lit(True)), row("POSTED", None))
        .when(status == "WITHDRAWN", row("NOT_APPLICABLE", "WITHDRAWN_NO_PARTICIPANTS"))
        .when((status == "TERMINATED") & (enrollment_type == "ACTUAL") & (enrollment == 0), row("NOT_APPLICABLE", "TERMINATED_NO_DATA"))
        .when(end.isNull() | ~completion_type.eqNullSafe(F.lit("ACTUAL")) | (status == "UNKNOWN"), row("PENDING", "STATUS_UNCERTAIN"))
        .when((certificate <= cutoff) & (cutoff < add_years(certificate, 2)), row("PENDING", "CERTIFIED_DELAY"))
        .when(cutoff < add_years(end, 1), row("PENDING", "WITHIN_STANDARD_WINDOW"))
        .otherwise(row("UNREPORTED", "PAST_STANDARD_WINDOW"))
    )
