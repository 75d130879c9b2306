"""Posted sex and gender tables as nested records: the layout of each is decided before its rows are read. Nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import is_sex_gender, measure_type, sex_bucket
from ..functions.numbers import parser_number, sum_checked_total
from .selection import BUCKETS, outcomes, report_status

#: The shape of one posted table.
MEASURE = """struct<title: string, paramType: string, unitOfMeasure: string, populationDescription: string, description: string,
  classes: array<struct<title: string, denoms: array<struct<units: string, counts: array<struct<groupId: string, value: string>>>>,
    categories: array<struct<title: string, measurements: array<struct<groupId: string, value: string, comment: string>>>>>>>"""

#: Titles of tables that are of sex or gender alone, units of shares, parameters that count no people, and words of what was not collected.
TYPED = ("sex", "sex_gender_customized", "gender")
SHARE_UNITS = "(?i)percent|%|proportion"
NOT_PEOPLE = ("COUNT_OF_UNITS", "MEAN", "MEDIAN")
NOT_COLLECTED = r"(?i)not (be )?(collected|recorded|captured|obtained|gathered|reported|available|analy[sz]ed|assessed|tracked)|no(t)? .{0,40}(collected|recorded)|did not collect|was not (a )?(required|pertinent)"

FLAGS = ("total_by_position", "multiclass_timepoint", "customized_layout", "empty_category", "unmapped_layout")


def _each(array: Column, kind: str) -> Column:
    """The array without nulls; an absent one is empty."""
    return F.filter(F.coalesce(array, F.array().cast(kind)), lambda x: x.isNotNull())


def _categories(one_class: Column) -> Column:
    return _each(one_class["categories"], "array<struct<title: string, measurements: array<struct<groupId: string, value: string, comment: string>>>>")


def _measurements(category: Column) -> Column:
    return _each(category["measurements"], "array<struct<groupId: string, value: string, comment: string>>")


def _declared(measure: Column) -> Column:
    says = lambda text: F.coalesce(text.rlike(NOT_COLLECTED), F.lit(False))
    comments = F.exists(measure["classes"], lambda c: F.exists(_categories(c), lambda t: F.exists(_measurements(t), lambda m: says(m["comment"]))))
    return says(measure["populationDescription"]) | says(measure["description"]) | F.coalesce(comments, F.lit(False))


def _labelled(measure: Column) -> Column:
    """The table with a bucket for the title of each class and category."""
    row = lambda x, values: (F.coalesce(x["title"], F.lit("")).alias("label"), sex_bucket(x["title"]).alias("bucket"), values.alias("values"))
    category = lambda t: F.struct(*row(t, F.transform(_measurements(t), lambda m: parser_number(m["value"]))))
    classes = F.coalesce(measure["classes"], F.array().cast("array<struct<title: string, denoms: array<struct<units: string, counts: array<struct<groupId: string, value: string>>>>, categories: array<struct<title: string, measurements: array<struct<groupId: string, value: string, comment: string>>>>>>"))
    return F.struct(
        measure["title"].alias("title"), measure_type(measure["title"]).alias("type"), measure["paramType"].alias("parameter"), measure["unitOfMeasure"].alias("unit"), _declared(measure).alias("declared"),
        F.exists(classes, lambda c: c["denoms"].isNotNull()).alias("has_denoms"),
        F.transform(classes, lambda c: F.struct(F.coalesce(c["title"], F.lit("")).alias("label"), sex_bucket(c["title"]).alias("bucket"), F.transform(_categories(c), category).alias("categories"))).alias("classes"),
    )


def _laid_out(m: Column) -> Column:
    """Customized: any class is titled by a bucket, so classes are the rows, each with the numbers of all of its categories.
    Standard: the categories of the first class are the rows; further classes are other times or groups."""
    customized = F.exists(m["classes"], lambda c: c["bucket"] != "")
    row = lambda x, values: F.struct(x["label"].alias("label"), x["bucket"].alias("bucket"), sum_checked_total(values).alias("read"))
    by_class = F.transform(m["classes"], lambda c: row(c, F.flatten(F.transform(c["categories"], lambda t: t["values"]))))
    first = F.coalesce(F.get(m["classes"], F.lit(0))["categories"], F.array().cast("array<struct<label: string, bucket: string, values: array<double>>>"))
    numbers = F.flatten(F.flatten(F.transform(m["classes"], lambda c: F.transform(c["categories"], lambda t: t["values"]))))
    mapped = customized | F.exists(m["classes"], lambda c: F.exists(c["categories"], lambda t: t["bucket"] != ""))
    return F.struct(
        *[m[c].alias(c) for c in ("title", "type", "parameter", "unit", "declared", "has_denoms")], customized.alias("customized"), F.size(m["classes"]).alias("n_classes"),
        F.when(customized, by_class).otherwise(F.transform(first, lambda t: row(t, t["values"]))).alias("rows"), numbers.alias("numbers"), mapped.alias("mapped"),
    )


def _summed(m: Column) -> Column:
    of = lambda b: F.filter(m["rows"], lambda r: (r["bucket"] == b) & r["read"]["total"].isNotNull())
    total = lambda b: F.when(F.size(of(b)) > 0, F.aggregate(of(b), F.lit(0.0), lambda a, r: a + r["read"]["total"]))
    labels = lambda b: F.array_distinct(F.transform(F.filter(m["rows"], lambda r: (r["bucket"] == b) & (r["label"] != "")), lambda r: r["label"]))
    known = F.exists(m["rows"], lambda r: r["bucket"] != "")
    return F.struct(
        *[m[c].alias(c) for c in ("title", "type", "parameter", "unit", "declared", "has_denoms", "n_classes", "numbers", "mapped")],
        F.when(m["customized"], "customized").otherwise("standard").alias("layout"),
        *[total(b).alias(b) for b in BUCKETS], *[labels(b).alias(f"{b}_labels") for b in BUCKETS[2:]], labels("").alias("unmapped_labels"),
        F.exists(m["rows"], lambda r: r["bucket"] == "unknown").alias("has_unknown_row"),
        F.exists(m["rows"], lambda r: r["read"]["by_position"] & (m["customized"] | (r["bucket"] != ""))).alias("total_by_position"),
        (~m["customized"] & (m["n_classes"] > 1)).alias("multiclass_timepoint"), m["customized"].alias("customized_layout"),
        (~m["customized"] & F.exists(m["rows"], lambda r: r["bucket"] == "")).alias("empty_category"), (~m["customized"] & ~known).alias("unmapped_layout"),
    )


def parse_tables(measures: Column) -> Column:
    """array of the sex and gender tables of a trial, in posted order, each with its layout, bucket sums, labels and flags.

    A bucket is null where no row of it posts a number, which is not 0. Of several numbers of a row the one equal to the sum of the
    others is the total, else the last (total_by_position). A null array, or one without such a table, gives an empty array."""
    chosen = F.filter(F.coalesce(measures, F.array().cast(f"array<{MEASURE}>")), lambda m: m.isNotNull() & is_sex_gender(m["title"]))
    return F.transform(F.transform(F.transform(chosen, _labelled), _laid_out), _summed)


def parse_records(trials: DataFrame, measures: str = "measures", enrollment: str = "enrollment") -> DataFrame:
    """The trials with the parsed columns in place of their tables, status and outcomes; a trial's row is read where it is.

    Female and male come from the table with most of both (the first of equal ones), the other buckets are the largest over tables;
    only tables titled as of sex or gender count where there are any. Flags are of any table. no_count says why an unusable table is so."""
    rows = trials.withColumn("_tables", parse_tables(F.col(measures)))
    typed = F.filter("_tables", lambda m: F.coalesce(m["type"].isin(*TYPED), F.lit(False)))
    rows = rows.withColumn("_pool", F.when(F.size(typed) > 0, typed).otherwise(F.col("_tables")))
    both = lambda m: F.coalesce(m["female"], F.lit(0.0)) + F.coalesce(m["male"], F.lit(0.0))
    rows = rows.withColumn("_most", F.array_max(F.transform("_pool", both)))
    rows = rows.withColumn("_first", F.get(F.filter("_pool", lambda m: both(m) == F.col("_most")), F.lit(0)))
    first, any_ = F.col("_first"), lambda c: F.exists("_tables", lambda m: m[c])
    largest = lambda b: F.array_max(F.transform("_pool", lambda m: m[b]))
    labels = lambda c, of: F.array_distinct(F.flatten(F.transform(of, lambda m: m[c])))
    share = F.coalesce(first["unit"].rlike(SHARE_UNITS), F.lit(False))
    present = F.size("_tables") > 0
    rows = rows.withColumns({
        "measure_title": first["title"], "measure_type": first["type"], "layout": first["layout"], "parameter": first["parameter"], "unit": first["unit"], "n_measures": F.size("_tables"),
        "has_sex_table": F.exists("_tables", lambda m: m["type"].eqNullSafe(F.lit("sex"))), "has_gender_table": F.exists("_tables", lambda m: F.coalesce(m["type"].isin("gender", "sex_gender_customized"), F.lit(False))),
        "is_participant_count": F.when(present, ~(F.upper(F.coalesce(first["parameter"], F.lit(""))).isin(*NOT_PEOPLE) | share)),
        "n_female": first["female"], "n_male": first["male"], **{f"n_{b}": largest(b) for b in BUCKETS[2:]},
        "n_classes": F.array_max(F.transform("_tables", lambda m: m["n_classes"])), "has_denoms": any_("has_denoms"), "has_unknown_row": any_("has_unknown_row"), **{c: any_(c) for c in FLAGS},
        **{f"{b}_labels": labels(f"{b}_labels", "_pool") for b in BUCKETS[2:]}, "unmapped_labels": labels("unmapped_labels", "_tables"), "declared_not_collected": any_("declared"), "nonparticipant_units": F.upper(F.coalesce(first["parameter"], F.lit(""))) == "COUNT_OF_UNITS",
        "_numbers": F.flatten(F.transform("_tables", lambda m: m["numbers"])), "_mapped": any_("mapped"),
    })
    z = lambda b: F.coalesce(f"n_{b}", F.lit(0.0))
    rows = rows.withColumn("n_total_parsed", F.when(present, sum((z(b) for b in BUCKETS[1:]), z(BUCKETS[0]))))
    none = present & (F.col("n_total_parsed") == 0) & (z("female") == 0) & (z("male") == 0)
    why = (
        F.when(F.size("_numbers") == 0, "no_measurements")
        .when(~F.exists("_numbers", lambda v: v.isNotNull()), "all_values_na")
        .when(~F.exists("_numbers", lambda v: v != 0), "all_values_zero")
        .when(~F.col("_mapped"), "no_mapped_labels")
        .otherwise("other")
    )
    rows = rows.withColumns({"no_count": F.when(none, why), "exceeds_enrollment": F.coalesce(F.col("n_total_parsed") > F.col(enrollment), F.lit(False)), "status": report_status()})
    binary = F.col("has_gender_table") & (z("gender_diverse") <= 0) & (z("ambiguous") <= 0) & (z("female") + z("male") > 0)
    return outcomes(rows.drop("_tables", "_pool", "_most", "_first", "_numbers", "_mapped", measures)).withColumn("gender_labeled_binary_only", F.when(F.col("status") != "parse_error", binary))
