"""Readers and writers of registry files: JSON lines with bad lines kept apart, checked headers, parts and shards."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def landing(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see: under the checkpoint folder. Where none is set, a temporary one will do on a local master only."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local($|\[)", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="cohortmill-")
        sc.setCheckpointDir(folder)
    return f"{sc._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Writes df and reads it back: computed once, and of a size that Spark knows when it chooses a join."""
    path = landing(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").json(path)


def read_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, problems): a line that is no record of the schema becomes a problem, never a stop."""
    lines = spark.read.text(path)
    # as a generator's output, each line is parsed once: as an expression it would be once for the filter and again for the fields
    record = F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = lines.select(F.stack(F.lit(1), F.col("value"), record).alias("value", "r"))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return parsed.filter(~bad).select("r.*").drop("_bad"), parsed.filter(bad).select(F.col("value").alias("line"))


def read_studies(spark: SparkSession, path: str, schema: str, date: str, after: str | None = None, before: str | None = None, condition: Column | None = None, limit: int | None = None, order: str | None = None) -> DataFrame:
    """Records whose date lies in the range, either end open; of a condition; where asked for only the first so many in the given order."""
    rows = read_lines(spark, path, schema)[0]
    for bound, keep in ((after, F.col(date) >= F.lit(after)), (before, F.col(date) <= F.lit(before)), (condition is not None, condition)):
        rows = rows.filter(keep) if bound else rows
    return rows if limit is None else rows.orderBy(order or date).limit(limit)


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = "|") -> DataFrame:
    """All columns as text; a file that lacks one of them is refused."""
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def numbered(df: DataFrame, order: list[str], cells: int | None = None, rows: int = 100_000) -> DataFrame:
    """Adds position from 0 in the given order: ranges of about `rows` rows are numbered apart, then shifted by what lies before them."""
    cells = cells or max(8, -(-df.count() // rows))
    # written, so that all that follows sees the same ranges
    ranged = kept(df.repartitionByRange(cells, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    inside = ranged.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = inside.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a range
    return inside.join(F.broadcast(before.select("_p", "_b")), "_p").withColumn("position", F.col("_b") + F.col("_i") - 1).drop("_p", "_i", "_b")


def part_of(position: Column, total: Column, parts: int) -> Column:
    """Positional split into parts of ceil(total / parts) rows."""
    return F.floor(position / F.ceil(total / parts))


def shard_of(nct_id: Column, shards: int) -> Column:
    """The number of the id modulo shards; null for an id of another form."""
    return F.when(nct_id.rlike(r"^NCT\d{8}$"), F.pmod(F.substring(nct_id, 4, 8).cast("int"), F.lit(shards)))


def shard_problems(df: DataFrame, key: str) -> DataFrame:
    """(key, problem): ids of another form, and ids that occur more than once."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    found = F.array_compact(F.array(F.when(shard_of(F.col(key), 1).isNull(), "not_an_id"), F.when(F.col("n") > 1, "repeated_id")))
    return n.select(key, F.explode(found).alias("problem"))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """One folder a shard, by the id's number; a table with ids of another form or repeated ids is refused whole."""
    if bad := shard_problems(df, key).limit(3).collect():
        raise ValueError(f"not written: {[(r[key], r['problem']) for r in bad]}")
    df.withColumn("shard", shard_of(F.col(key), shards)).repartition("shard").write.partitionBy("shard").parquet(path)


def mixed_runs(parts: DataFrame, by: list[str], stamps: list[str], part: str, total: str) -> DataFrame:
    """For each dataset whether its parts are one complete run: one stamp, as many parts as they say, and all say the same."""
    counts = parts.groupBy(*by).agg(F.count_distinct(F.struct(*stamps)).alias("n_runs"), F.count_distinct(part).alias("n_parts"), F.max(total).alias("total_parts"), F.count_distinct(total).alias("n_totals"))
    return counts.withColumn("is_one_run", (F.col("n_runs") == 1) & (F.col("n_totals") == 1) & (F.col("n_parts") == F.col("total_parts"))).drop("n_totals")


def split_fields(df: DataFrame, key: str, classes: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Vertical split: a table for each class of fields, the key in each."""
    return {name: df.select(key, *fields) for name, fields in classes.items()}


def merge_losses(whole: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows that differ between the whole and its merged split; empty when nothing is lost."""
    merged = None
    for p in parts.values():
        merged = p if merged is None else merged.join(p, key)
    merged = merged.select(whole.columns)
    return whole.exceptAll(merged).withColumn("side", F.lit("lost")).unionByName(merged.exceptAll(whole).withColumn("side", F.lit("added")))


def archive_problems(good: DataFrame, bad: DataFrame) -> DataFrame:
    """(check_name, n_violations) of an archive's lines: unreadable ones, ids missing, of another form or repeated, and whether there are several snapshots or runs."""
    ids = good.groupBy("nct_id").agg(F.count("*").alias("n"))
    named, odd = F.col("nct_id").isNotNull(), shard_of(F.col("nct_id"), 1).isNull()
    one = ids.agg(F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("b"), F.count_if(named & odd).alias("c"), F.count_if(named & (F.col("n") > 1)).alias("d"))
    runs = good.agg((F.count_distinct("snapshot") > 1).cast("bigint").alias("e"), (F.count_distinct("run") > 1).cast("bigint").alias("f"))
    row = bad.agg(F.count("*").alias("a")).join(one).join(runs)  # one row each
    return row.selectExpr("stack(6, 'not_json', a, 'id_missing', b, 'id_form', c, 'id_repeated', d, 'several_snapshots', e, 'several_runs', f) as (check_name, n_violations)")


def split_problems(classes: dict[str, DataFrame], shards: int) -> DataFrame:
    """(nct_id, problem) of a split layout, (nct_id, shard) by class: ids in a shard that isn't theirs or in several, and ids that a class lacks."""
    every = None
    for name, rows in classes.items():
        one = rows.select("nct_id", "shard", F.lit(name).alias("name"))
        every = one if every is None else every.unionByName(one)
    ids = every.groupBy("nct_id").agg(F.collect_set("name").alias("names"), F.count_distinct("name", "shard").alias("n"), F.size(F.collect_set("name")).alias("k"), F.bool_or(F.col("shard") != shard_of(F.col("nct_id"), shards)).alias("astray"))
    missing = [F.when(~F.array_contains("names", name), F.lit(f"missing_in_{name}")) for name in classes]
    found = F.array_compact(F.array(F.when(F.col("n") > F.col("k"), "in_several_shards").when(F.col("astray"), "in_another_shard"), *missing))
    return ids.select("nct_id", F.explode(found).alias("problem"))


def sum_problems(totals: DataFrame, classes: DataFrame, key: str, denominators: list[str]) -> DataFrame:
    """(key, problem): totals (key, total, denominator) that their classes (key, n) do not add up to, or whose denominator has no definition."""
    summed = classes.groupBy(key).agg(F.sum("n").alias("_sum"))
    found = F.array_compact(F.array(F.when(F.col("total") != F.coalesce("_sum", F.lit(0)), "classes_do_not_add_up"), F.when(~F.coalesce(F.col("denominator").isin(denominators), F.lit(False)), "unknown_denominator")))
    return totals.join(summed, key, "left").select(key, F.explode(found).alias("problem"))
