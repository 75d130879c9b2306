"""What the operators of this folder share: written tables in the cluster's shared folder, and small Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that all executors see. Where none is set, a temporary one will do on a local master only."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local($|\[)", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="cohortmill-")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: it is computed once and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_column(name: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the texts of each come to about `limit` bytes; one longer text makes a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(size):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)
