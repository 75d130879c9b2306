"""From baseline cells to one row per trial: bucket sums per table, the table to count, reporting status, derived values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import is_percentage, is_sex_gender, measure_type, sex_bucket
from ..sources.folders import kept

BUCKETS = ("female", "male", "unknown", "gender_diverse", "ambiguous")
STATES = ("reported", "explicit_unknown_only", "uninformative", "not_reported", "parse_error")


def classify_distinct(rows: DataFrame, column: str, to: str, rule) -> DataFrame:
    """Applies a rule once for each distinct value, writes the outcomes and joins them back: Spark broadcasts them if they are few."""
    known = kept(rows.select(column).distinct().withColumn(to, rule(F.col(column))), "classified")
    return rows.join(known, column, "left")


def label_buckets(cells: DataFrame) -> DataFrame:
    """(label, bucket) of every label of the sex and gender tables, written."""
    return kept(cells.filter(is_sex_gender(F.col("title"))).select("label").distinct().withColumn("bucket", sex_bucket(F.col("label"))), "buckets")


def labelled_rows(cells: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Sex and gender tables only, each row with its bucket. known: label_buckets() of a like source, which saves a reading of this one for its labels;
    the rule is asked for labels that are not among them."""
    rows, label = cells.filter(is_sex_gender(F.col("title"))), F.col("label")
    if known is None:
        return classify_distinct(rows, "label", "bucket", sex_bucket)
    both = rows.join(known.withColumn("_known", F.lit(True)), "label", "left")
    return both.withColumn("bucket", F.when(F.col("_known") | label.isNull(), F.col("bucket")).otherwise(sex_bucket(label))).drop("_known")


def bucket_sums(cells: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per trial and table: n_<bucket> is null where no such row is posted, which is not zero."""
    rows = labelled_rows(cells, known)
    return rows.groupBy("nct_id", "title").agg(*[F.sum(F.when(F.col("bucket") == b, F.col("value"))).alias(f"n_{b}") for b in BUCKETS], F.max("unit").alias("unit"), F.count("*").alias("n_rows"))


def parsed_trials(measures: DataFrame) -> DataFrame:
    """Female and male come from the table with most of both (first by title on ties), the rest are maxima over tables."""
    fm = F.coalesce("n_female", F.lit(0)) + F.coalesce("n_male", F.lit(0))
    best = Window.partitionBy("nct_id").orderBy(fm.desc(), "title")
    rest = [F.max(f"n_{b}").over(Window.partitionBy("nct_id")).alias(f"x_{b}") for b in BUCKETS[2:]]
    rows = measures.select("*", F.row_number().over(best).alias("nth"), F.count("*").over(Window.partitionBy("nct_id")).alias("n_measures"), *rest).filter("nth = 1")
    rows = rows.select("nct_id", F.col("title").alias("measure_title"), measure_type(F.col("title")).alias("measure_type"), "unit", "n_measures", "n_female", "n_male", *[F.col(f"x_{b}").alias(f"n_{b}") for b in BUCKETS[2:]])
    return rows.withColumns({"is_participant_count": ~is_percentage(F.col("unit"), F.lit(None).cast("string")), "n_total_parsed": sum((F.coalesce(f"n_{b}", F.lit(0.0)) for b in BUCKETS[1:]), F.coalesce("n_female", F.lit(0.0)))})


def report_status() -> Column:
    """Over the parsed columns; a null measure_title means that no table was posted."""
    known = sum((F.coalesce(f"n_{b}", F.lit(0.0)) for b in ("male", "gender_diverse")), F.coalesce("n_female", F.lit(0.0)))
    return (
        F.when(F.col("measure_title").isNull(), "not_reported")
        .when((known > 0) | (F.col("n_ambiguous") > 0), "reported")
        .when(F.col("n_unknown") > 0, "explicit_unknown_only")
        .otherwise("uninformative")
    )


def outcomes(rows: DataFrame) -> DataFrame:
    """reported_sex, reported_gender, reported_both, reported_any: null where the record could not be read."""
    fm = F.coalesce("n_female", F.lit(0.0)) + F.coalesce("n_male", F.lit(0.0)) > 0
    wide = (F.coalesce("n_gender_diverse", F.lit(0.0)) > 0) | (F.coalesce("n_ambiguous", F.lit(0.0)) > 0)
    read, any_ = F.col("status") != "parse_error", F.col("status") == "reported"
    return rows.withColumns({"reported_sex": F.when(read, any_ & fm), "reported_gender": F.when(read, any_ & wide), "reported_both": F.when(read, any_ & fm & wide), "reported_any": F.when(read, any_)})


def finished(trials: DataFrame, studies: DataFrame) -> DataFrame:
    """All studies, with status, outcomes, percent_female and the gap to the registered enrolment."""
    rows = outcomes(studies.join(trials, "nct_id", "left").withColumn("status_", report_status()).withColumnRenamed("status", "overall_status").withColumnRenamed("status_", "status"))
    fm = F.coalesce("n_female", F.lit(0.0)) + F.coalesce("n_male", F.lit(0.0))
    return rows.withColumns({
        "percent_female": F.when(F.col("reported_sex") & F.col("is_participant_count") & (fm > 0), 100.0 * F.coalesce("n_female", F.lit(0.0)) / fm),
        "enrollment_minus_parsed": F.col("enrollment") - F.col("n_total_parsed"),
    })


def fullest(tables: DataFrame, by: str, specific: Column, counted: Column, order: str) -> DataFrame:
    """The table of each trial with most specifically labelled people, then most counted, then first."""
    best = Window.partitionBy(by).orderBy(specific.desc(), counted.desc(), order)
    return tables.withColumn("nth", F.row_number().over(best)).filter("nth = 1").drop("nth")


def disjoint_parts(tables: DataFrame, by: str, analysed: str, total: str, signature: str) -> DataFrame:
    """Whether a trial's tables are parts of one population: none over it or all of it, together exactly it, none posted twice."""
    return tables.groupBy(by).agg(
        (F.every(F.col(analysed) < F.col(total)) & (F.sum(analysed) == F.max(total)) & (F.count_distinct(signature) == F.count("*")) & (F.count("*") > 1)).alias("is_parted"),
        F.count("*").alias("n_tables"),
    )


def select_tables(tables: DataFrame, by: str, analysed: str, total: str, signature: str, specific: Column, counted: Column, order: str) -> DataFrame:
    """Adds role: part where a trial's tables are disjoint parts of its population, else fullest and superseded."""
    parted = disjoint_parts(tables, by, analysed, total, signature).select(by, "is_parted")
    first = fullest(tables, by, specific, counted, order).select(by, F.col(order).alias("_first"))
    both = tables.join(parted, by).join(first, by)
    role = F.when(F.coalesce("is_parted", F.lit(False)), "part").when(F.col(order) == F.col("_first"), "fullest").otherwise("superseded")
    return both.withColumn("role", role).drop("is_parted", "_first")


def total_class_view(rows: DataFrame) -> DataFrame:
    """Where a table has a class for everyone that repeats each label of its other classes, that class alone; else all rows."""
    w = Window.partitionBy("nct_id", "title")
    rows = rows.withColumn("is_total", F.lower(F.trim("class")).isin("total", "overall", "all participants"))
    totals = F.collect_set(F.when(F.col("is_total"), F.col("label"))).over(w)
    others = F.collect_set(F.when(~F.col("is_total"), F.col("label"))).over(w)
    use = (F.size(totals) > 0) & (F.size(F.array_except(others, totals)) == 0)
    return rows.withColumn("use_total", use).filter(~F.col("use_total") | F.col("is_total"))


def breakdown(rows: DataFrame, by: list[str], label: str, value: str) -> DataFrame:
    """Counts of each label and their percentage of the group's sum, one decimal, rounded half to even."""
    counts = rows.groupBy(*by, label).agg(F.sum(value).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("percent", F.when(whole > 0, F.bround(100 * F.col("n") / whole, 1)))


def gender_categories(cells: DataFrame, finished: DataFrame, detail, minorities: list[str], apart: list[str], excess: float = 0.1) -> DataFrame:
    """Detailed gender categories of every trial: sums within a table, the largest over tables; absence is null, not 0.

    detail: the rule from label to category. status: parse_error, not_applicable (no gender reported, or no such row posted), excluded
    (units that are no people, or a sum over the enrolment by more than `excess`), or derived. d3_total: the minorities; d5_strict:
    those without the self-described ones."""
    rows = classify_distinct(labelled_rows(cells), "label", "detail", detail)
    sex, identity = F.col("bucket").isin("female", "male"), F.col("detail").isin(*minorities, "intersex", "cisgender_labeled")
    wide = rows.groupBy("nct_id", "title").agg(
        *[F.sum(F.when(F.col("detail") == c, F.col("value"))).alias(c) for c in (*minorities, *apart)],
        F.bool_or(F.coalesce(identity, F.lit(False))).alias("has_identity"), F.bool_or(sex).alias("has_binary"), F.bool_or(is_percentage(F.col("unit"), F.lit(None).cast("string"))).alias("not_people"),
    )
    per = wide.groupBy("nct_id").agg(
        *[F.max(c).alias(c) for c in (*minorities, *apart)],
        F.bool_or(F.col("has_identity")).alias("posts_identity"), F.bool_or(F.col("has_identity") & F.col("has_binary")).alias("two_question_table"),
        (F.count_if("has_identity") > 1).alias("possible_double_count"), F.bool_or(F.col("has_identity") & F.col("not_people")).alias("identity_not_people"),
    )
    total = lambda cs: F.when(F.coalesce(*cs).isNotNull(), sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0)))
    both = finished.select("nct_id", "status", "reported_gender", "is_participant_count", "enrollment").withColumnRenamed("status", "report").join(per, "nct_id", "left")
    both = both.withColumns({"d3_total": total([F.col(c) for c in minorities]), "d5_strict": total([F.col(c) for c in minorities if c != "another_self_described"])})
    units = F.col("is_participant_count").eqNullSafe(F.lit(False)) | F.col("identity_not_people")
    over = F.coalesce(F.col("d3_total") > F.col("enrollment") * (1 + excess), F.lit(False))
    applies = F.coalesce(F.col("reported_gender") & F.col("posts_identity"), F.lit(False))
    status = F.when(F.col("report") == "parse_error", "parse_error").when(~applies, "not_applicable").when(units | over, "excluded").otherwise("derived")
    exclusion = F.when(status == "excluded", F.when(units, "non_participant_units").otherwise("sum_exceeds_enrollment_10pct"))
    shown = lambda c: F.when(applies, F.col(c)).alias(c)
    return both.select("nct_id", status.alias("status"), exclusion.alias("exclusion"), *map(shown, [*minorities, *apart, "d3_total", "d5_strict", "two_question_table", "possible_double_count"]))


def reporting_dimension() -> Column:
    """both, sex_only, gender_only, neither or parse_error, over finished rows."""
    s, g = F.coalesce("reported_sex", F.lit(False)), F.coalesce("reported_gender", F.lit(False))
    return F.when(F.col("status") == "parse_error", "parse_error").when(s & g, "both").when(s, "sex_only").when(g, "gender_only").otherwise("neither")


def neither_reason() -> Column:
    """Why neither is reported; null where something is."""
    none = reporting_dimension() == "neither"
    return F.when(none & (F.col("status") == "explicit_unknown_only"), "explicit_unknown_or_not_collected").when(none & (F.col("status") == "not_reported"), "measure_absent").when(none & (F.col("status") == "uninformative"), "measure_present_no_usable_breakdown")


def composition_reason() -> Column:
    """Why a trial stays out of the composition denominators; null where it enters."""
    fm = F.coalesce("n_female", F.lit(0.0)) + F.coalesce("n_male", F.lit(0.0))
    return (
        F.when(F.col("status") == "parse_error", "parse_error")
        .when(~F.coalesce("reported_sex", F.lit(False)), "not_reported_sex")
        .when(F.col("is_participant_count").eqNullSafe(F.lit(False)), "non_participant_units")
        .when(fm <= 0, "no_female_male_counts")
    )


def structural_checks(rows: DataFrame, rules_version: str) -> DataFrame:
    """check_name, n_bad, pass: what must hold on any snapshot. rows: nct_id, status, the outcomes, the parsed counts, percent_female,
    is_participant_count, and raw_present, parse_ok, param_type, unit, parser_version."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    out = ("reported_sex", "reported_gender", "reported_both", "reported_any")
    people = ~is_percentage(F.col("unit"), F.col("param_type")) & ~F.upper(F.coalesce("param_type", F.lit(""))).isin("COUNT_OF_UNITS", "MEAN", "MEDIAN")
    others = z("n_female") + z("n_male") + z("n_gender_diverse") + z("n_ambiguous")
    n = {c: F.count_if(F.coalesce(F.col(c), F.lit(False))) for c in out}
    none = F.lit(0).cast("long")
    short = lambda cond, by: F.when(cond, none).otherwise(by)
    count = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    least = F.least(n["reported_sex"], n["reported_gender"])
    known = F.count_if(F.coalesce(F.col("status").isin(*STATES), F.lit(False)))
    checks = {
        "reported_any_ge_reported_sex": short(n["reported_any"] >= n["reported_sex"], n["reported_sex"] - n["reported_any"]),
        "reported_any_ge_reported_gender": short(n["reported_any"] >= n["reported_gender"], n["reported_gender"] - n["reported_any"]),
        "reported_both_le_min": short(n["reported_both"] <= least, n["reported_both"] - least),
        "status_counts_sum_to_rows": F.count("*") - known,
        "every_row_has_one_status": F.count("*") - known,
        "is_participant_count_matches_parser_rule": count(F.col("raw_present") & ~F.col("parse_ok").eqNullSafe(F.lit(False)) & (F.coalesce("is_participant_count", F.lit(False)) != people)),
        "count_of_units_never_participant_count": count((F.upper("param_type") == "COUNT_OF_UNITS") & ~F.col("is_participant_count").eqNullSafe(F.lit(False))),
        "parse_error_rows_have_none_outcomes": count((F.col("status") == "parse_error") & F.coalesce(*[F.col(c) for c in out]).isNotNull()),
        "explicit_unknown_only_rows_are_unknown_only": count((F.col("status") == "explicit_unknown_only") & ~((z("n_unknown") > 0) & (others == 0))),
        "not_reported_rows_have_no_measure": count((F.col("status") == "not_reported") & F.col("raw_present")),
        "percent_female_only_in_denominator_set": count(F.col("percent_female").isNotNull() & ~(F.coalesce("reported_sex", F.lit(False)) & F.coalesce("is_participant_count", F.lit(False)))),
        "single_parser_rules_version": count(~F.col("parser_version").eqNullSafe(F.lit(rules_version))),
    }
    one = rows.agg(*[c.cast("long").alias(k) for k, c in checks.items()])
    pairs = ", ".join(f"'{k}', {k}" for k in checks)
    return one.selectExpr(f"stack({len(checks)}, {pairs}) as (check_name, n_bad)").withColumn("pass", F.col("n_bad") == 0)
