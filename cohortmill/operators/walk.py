"""Every text of a record of any shape, with its path: built-in functions on VARIANT, one scan, no schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nesting(text: Column) -> Column:
    """How deep objects and arrays lie in a JSON text: 0 for a scalar. Brackets within strings do not count."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\\.", ""), r'"[^"]*"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    step = lambda a, c: F.struct((a["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)).alias("now"), F.greatest(a["most"], a["now"] + F.when(c.isin("[", "{"), 1).otherwise(0)).alias("most"))
    return F.aggregate(F.split(bare, ""), start, step, lambda a: a["most"])


def record_texts(records: DataFrame, key: str, record: str) -> DataFrame:
    """(key, path, text) of every string in the JSON texts of a column; 'a.b' is a field, 'a[]' an element of an array.

    One pass finds the deepest nesting of all (a single number comes back), and as many steps open one level each: what is a scalar already
    stays as it is. A text that is no JSON, or null, has no rows; see unreadable()."""
    deepest = records.agg(F.max(nesting(F.col(record)))).first()[0] or 0
    rows = records.select(F.col(key).alias("_key"), F.lit("").alias("_path"), F.try_parse_json(record).alias("_v"))
    for _ in range(deepest):
        opened = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("_v").outer()))
        under = F.when(F.col("pos").isNull(), F.col("_path")).when(F.col("key").isNull(), F.concat("_path", F.lit("[]"))).when(F.col("_path") == "", F.col("key")).otherwise(F.concat_ws(".", "_path", "key"))
        rows = opened.select("_key", under.alias("_path"), F.when(F.col("pos").isNull(), F.col("_v")).otherwise(F.col("value")).alias("_v"))
    texts = rows.filter(F.schema_of_variant("_v") == "STRING")
    return texts.select(F.col("_key").alias(key), F.col("_path").alias("path"), F.try_variant_get("_v", "$", "string").alias("text"))


def unreadable(records: DataFrame, record: str) -> DataFrame:
    """The records whose text is no JSON."""
    return records.filter(F.col(record).isNotNull() & F.try_parse_json(record).isNull())
