"""The by-year mart: what every results year reports in each demographic dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The mart's short names of categories, by dimension, and of the categories whose shares are summed too.
RACE = {"american_indian_alaska_native": "ai", "asian": "as", "black_african_american": "bl", "native_hawaiian_pacific_islander": "nh", "white": "wh", "more_than_one_race": "mu", "unknown_not_reported": "un", "other": "ot"}
ETHNICITY = {"hispanic_latino": "hi", "not_hispanic_latino": "nh", "unknown_not_reported": "un"}
SEX = {"female": "f", "male": "m", "unknown": "u"}
GENDER = {"woman": "w", "man": "m", "nonbinary": "nb", "transgender": "tg", "other": "ot", "unknown": "u"}
DIMENSIONS = {"race": ("r", RACE, ("wh", "bl", "as")), "ethnicity": ("e", ETHNICITY, ("hi",)), "sex": ("s", SEX, ("f",)), "gender": ("g", GENDER, ("w", "m", "nb", "tg"))}
#: Categories that a dimension's shares leave out of the whole.
OUTSIDE = {"gender": ("u",)}


def yearly(studies: DataFrame, blocks: dict[str, DataFrame], parsed: DataFrame) -> DataFrame:
    """One row per results year, all measures in one pass. studies: nct_id, year, enrollment; blocks by dimension: nct_id, totals (map of
    counts; no row where nothing is reported); parsed: nct_id, reported_sex, reported_gender. A year in which a trial has no
    parsed row has no counts of them; participants add up, shares are means over the trials that report any."""
    rows = studies.filter("year is not null").join(parsed.withColumn("is_parsed", F.lit(True)), "nct_id", "left")
    for name, block in blocks.items():
        rows = rows.join(block.select("nct_id", F.col("totals").alias(name)), "nct_id", "left")
    said = {name: F.col(name).isNotNull() for name in DIMENSIONS}
    people = F.sum(F.coalesce("enrollment", F.lit(0)))
    out = [F.count("*").alias("total"), people.alias("enrollment"), people.alias("fd_enrollment")]
    out += [F.count_if(said[name]).alias(f"{'eth' if name == 'ethnicity' else name}_reported") for name in DIMENSIONS]
    out.append(F.count_if(said["race"] & said["ethnicity"]).alias("both_reported"))
    every = F.every(F.col("is_parsed").isNotNull())
    s, g = F.coalesce("reported_sex", F.lit(False)), F.coalesce("reported_gender", F.lit(False))
    for name, cond in (("sg_sex", s), ("sg_gender", g), ("sg_sex_gender", s & g), ("all_four", s & g & said["race"] & said["ethnicity"])):
        out.append(F.when(every, F.count_if(cond)).alias(f"{name}_reported"))
    for name, (x, categories, shared) in DIMENSIONS.items():
        n = {short: F.coalesce(F.try_element_at(name, F.lit(c)), F.lit(0.0)) for c, short in categories.items()}
        whole = sum((v for short, v in n.items() if short not in OUTSIDE.get(name, ())), F.lit(0.0))
        out += [F.sum(F.when(said[name], v).otherwise(0.0)).alias(f"{x}_{short}") for short, v in n.items()]
        out.append(F.count_if(said[name] & (whole > 0)).alias(f"{x}n_count"))
        out += [F.coalesce(F.sum(F.when(said[name] & (whole > 0), n[short] / whole)), F.lit(0.0)).alias(f"{x}n_{short}") for short in shared]
    return rows.groupBy("year").agg(*out)
