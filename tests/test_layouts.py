"""Layouts of sex and gender tables: what is read from each, and what a trial makes of its tables."""

import json

from cohortmill.operators.layouts import MEASURE, parse_records
from pyspark.sql import functions as F


def category(title, *values, comment=None):
    return {"title": title, "measurements": [{"groupId": f"BG{i:03}", "value": v, "comment": comment} for i, v in enumerate(values)]}


def standard(*categories, title="Sex: Female, Male", **more):
    return {"title": title, "classes": [{"categories": list(categories)}], **more}


def customized(*rows, title="Sex/Gender, Customized", **more):
    return {"title": title, "classes": [{"title": r["title"], "categories": [{"title": None, "measurements": r["measurements"]}]} for r in rows], **more}


def parsed(spark, *trials):
    rows = [(i, json.dumps(m) if m is not None else None, e) for i, (m, e) in enumerate(trials)]
    frame = spark.createDataFrame(rows, "id int, text string, enrollment int").select("id", F.from_json("text", f"array<{MEASURE}>").alias("measures"), "enrollment")
    return [r for r in parse_records(frame).orderBy("id").collect()]


def test_both_layouts(spark):
    a, b, c, d = parsed(
        spark,
        ([standard(category("Female", "3", "4", "7"), category("Male", "2", "1", "3"))], 10),
        ([customized(category("Women", "3", "4", "7"), category("Men", "5", "6"), category("Non-binary", "1"), category("Arm A", "9", "9", "1"), category("Unknown", "NA"))], 10),
        ([{"title": "Sex: Female, Male", "classes": [{"title": t, "categories": [category("Female", n), category("Male", n)]} for t, n in (("Week 1", "4"), ("Week 2", "5"))]}], None),
        ([{"title": "Sex/Gender, Customized", "classes": [{"title": "Female", "categories": [category("White", "4"), category("Black", "6")]}, {"title": "Male", "denoms": [], "categories": [category("White", "5"), category("Black", "5"), category("All", "10")]}]}], None),
    )
    assert (a.layout, a.n_female, a.n_male, a.n_unknown, a.total_by_position, a.status, a.exceeds_enrollment) == ("standard", 7, 3, None, False, "reported", False)
    assert (b.layout, b.n_female, b.n_male, b.n_gender_diverse, b.n_unknown) == ("customized", 7, 6, 1, None)
    assert b.total_by_position and b.customized_layout and b.has_unknown_row and b.exceeds_enrollment and b.unmapped_labels == ["Arm A"] and b.unknown_labels == ["Unknown"]
    assert (c.layout, c.n_female, c.n_male, c.multiclass_timepoint, c.n_classes) == ("standard", 4, 4, True, 2)
    assert (d.layout, d.n_female, d.n_male, d.has_denoms, d.total_by_position) == ("customized", 6, 10, True, True)


def test_two_equal_numbers_are_total_and_part(spark):
    (a,) = parsed(spark, ([standard(category("Female", "5", "5"), category("Male", "2", "x"))], None))
    assert (a.n_female, a.n_male, a.total_by_position) == (5, 2, False)


def test_tables_of_a_trial(spark):
    small, large = standard(category("Female", "1"), category("Male", "2"), category("Unknown", "9")), customized(category("Female", "5"), category("Male", "5"), category("Unknown", "3"), title="Gender", unitOfMeasure="Participants")
    child = standard(category("Girls", "50"), category("Boys", "60"), category("Nonbinary", "8"), title="Child Gender")
    a, b, c = parsed(spark, ([{"title": "Age"}, None, small, large, child], 30), ([child], None), ([standard(category("Female", "4"), category("Male", "4")), standard(category("Female", "3"), category("Male", "5"), title="Gender")], None))
    assert (a.measure_title, a.n_measures, a.n_female, a.n_male, a.n_unknown, a.n_gender_diverse, a.n_total_parsed) == ("Gender", 3, 5, 5, 9, None, 19)
    assert a.has_sex_table and a.has_gender_table and a.reported_sex and not a.reported_gender
    assert (b.measure_type, b.n_female, b.n_gender_diverse, b.has_sex_table, b.reported_both) == ("other", 50, 8, False, True)
    assert (c.measure_title, c.n_female) == ("Sex: Female, Male", 4)  # of equal sums the first
    assert c.gender_labeled_binary_only and not b.gender_labeled_binary_only


def test_units_and_declarations(spark):
    f, m = category("Female", "40"), category("Male", "60")
    got = parsed(
        spark,
        ([standard(f, m, unitOfMeasure="Proportion of participants")], None), ([standard(f, m, paramType="mean")], None), ([standard(f, m, paramType="COUNT_OF_UNITS")], None), ([standard(f, m, paramType="NUMBER", unitOfMeasure="participants")], None),
        ([standard(f, m, populationDescription="Sex was not collected")], None), ([standard(category("Female", "0", comment="Data not available"), m)], None),
    )
    assert [r.is_participant_count for r in got] == [False, False, False, True, True, True]
    assert [r.declared_not_collected for r in got] == [False, False, False, False, True, True]
    assert [r.nonparticipant_units for r in got] == [False, False, True, False, False, False]


def test_nothing_to_count(spark):
    got = parsed(
        spark,
        (None, None), ([], 5), ([{"title": "Race"}, {"title": None}], 5), ([{"title": "Sex"}], 5), ([standard({"title": "Female"}, {"title": "Male", "measurements": []})], 5),
        ([standard(category("Female", "NA"), category("Male", None))], 5), ([standard(category("Female", "0"), category("Male", "0"))], 5), ([standard(category("", "7"), title="Gender")], 5),
        ([standard(category("Unknown", "7"), category("Female", "0"))], 5), ([{"title": "Sex", "classes": [None, {"title": None, "categories": [None]}]}], 5),
    )
    assert [r.status for r in got] == ["not_reported"] * 3 + ["uninformative"] * 5 + ["explicit_unknown_only", "uninformative"]
    assert [r.no_count for r in got] == [None] * 3 + ["no_measurements", "no_measurements", "all_values_na", "all_values_zero", "no_mapped_labels", None, "no_measurements"]
    assert got[7].empty_category and got[7].unmapped_layout and got[7].unmapped_labels == [] and got[0].n_total_parsed is None
    assert got[9].n_classes == 2 and got[9].multiclass_timepoint


def test_a_trial_is_read_where_it_is(spark):
    frame = spark.range(3).select("id", F.lit(None).cast(f"array<{MEASURE}>").alias("measures"), F.lit(1).alias("enrollment"))
    assert "Exchange" not in parse_records(frame)._jdf.queryExecution().toString()
