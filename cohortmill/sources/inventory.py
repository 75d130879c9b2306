"""Delimited inventories with their rows numbered as the files hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .folders import kept


def read_inventory(spark: SparkSession, path: str, columns: list[str], sep: str = ",", breaks_in_cells: bool = False) -> DataFrame:
    """(file, row_number, position, columns, ragged): row_number from 1 within its file, position from 1 over all files by name; cells as they stand,
    empty ones as empty strings, blank lines left out.

    A file whose first line is not exactly these columns is refused. A row with fewer or more cells keeps its line in `ragged`, and what it has of the columns; there
    an empty cell is null too. Large files are read in splits; breaks_in_cells reads each file by one task, as quoted line breaks need."""
    options = {"header": False, "sep": sep, "quote": '"', "escape": '"', "multiLine": breaks_in_cells, "columnNameOfCorruptRecord": "_line", "mode": "PERMISSIVE", "encoding": "UTF-8"}
    named = [f"_c{i}" for i in range(len(columns))]
    rows = spark.read.options(**options).schema(", ".join(f"{c} string" for c in [*named, "_line"])).csv(path)
    # ids rise in reading order within a task, and a task reads a split from its begin to its end
    at = F.struct(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    rows = kept(rows.select(*named, "_line", at.alias("_at"), F.monotonically_increasing_id().alias("_id")), "inventory-rows")
    splits = rows.groupBy("_at").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    earlier = lambda *by: F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a split; every file begins with its header
    splits = splits.withColumns({"_in_file": earlier("_at.path"), "_before": earlier(F.lit(0)), "_headers": F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("_at.file", "_at.path"))})
    placed = rows.join(splits.withColumnRenamed("_at", "_s"), F.col("_at") == F.col("_s"))
    inside = F.col("_id") - F.col("_first")
    placed = placed.select((F.col("_in_file") + inside).alias("row_number"), (F.col("_before") + inside - F.col("_headers") + 1).alias("position"), F.col("_at.file").alias("file"), *named, "_line")
    header = [F.regexp_replace(c, "^\ufeff", "") if i == 0 else F.col(c) for i, c in enumerate(named)]
    same = F.col("_line").isNull()
    for have, want in zip(header, columns):
        same &= have.eqNullSafe(F.lit(want))
    if bad := placed.filter((F.col("row_number") == 0) & ~same).select("file", F.coalesce("_line", F.concat_ws(sep, *named)).alias("line")).limit(3).collect():
        raise ValueError(f"not the header {columns}: " + "; ".join(f"{r['file']}: {r['line'][:200]}" for r in bad))
    whole = F.col("_line").isNull()
    cells = [F.when(whole, F.coalesce(c, F.lit(""))).otherwise(F.col(c)).alias(name) for c, name in zip(named, columns)]
    return placed.filter("row_number > 0").select("file", "row_number", "position", *cells, F.col("_line").alias("ragged"))
