"""Token-count rollups kept up to date by signed changes.

The totals by source, language and tokenizer version are a table of their own, and every commit writes the next one: the
last totals plus the sums of its signed changes, so inserts, deletes and revised counts never need the documents again and
a read never adds up old batches. A commit becomes valid by one small log file with the next number, which exactly one
writer can create; a writer that comes second starts again from the newer totals. A batch id commits once: the
same changes again change nothing, other changes under a known id are refused. What broke off leaves no log file and so
never counts.

Null texts count as empty. Null sources and languages are groups of their own. Repeated rows count each; a null
document id is counted but cannot be revised later. Other columns are ignored; no ties arise. A very long text makes a batch of
its own. A store without batches has no totals, and an empty table of changes commits as a batch that changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_encoder
from .shared import slices

KEYS = ["source", "lang", "version"]
TOTALS = "source string, lang string, version string, n_docs long, n_tokens long"


class Rollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def log(self) -> list[dict]:
        """The commits in order: batch, digest, totals (a folder)."""
        folder = self._path(f"{self.root}/log")
        if not self._fs.exists(folder):
            return []
        files = sorted(s.getPath().toString() for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
        found = {r["file"].rsplit("/", 1)[-1]: json.loads(r["value"]) for r in self.spark.read.text(files, wholetext=True).select("value", F.input_file_name().alias("file")).collect()} if files else {}
        return [found[f.rsplit("/", 1)[-1]] for f in files]

    def batches(self) -> list[str]:
        """The committed batch ids, in order."""
        return [e["batch"] for e in self.log()]

    def _publish(self, number: int, entry: dict) -> bool:
        """Creates the log file of this number, or finds that another writer has."""
        name = self._path(f"{self.root}/log/{number:012d}.json")
        draft = self._path(f"{self.root}/drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        self._fs.mkdirs(name.getParent())
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(name.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(draft, name, none)  # refuses where the name is taken
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def commit(self, batch_id: str, changes: DataFrame, tries: int = 20) -> bool:
        """changes: source, lang, version, sign (+1 or -1), n_tokens. False if the batch was there already."""
        folder = f"{self.root}/deltas/{uuid.uuid4().hex}"
        sums = changes.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
        sums.write.parquet(folder)
        deltas = self.spark.read.schema(TOTALS).parquet(folder)
        digest = str(deltas.filter("n_docs <> 0 or n_tokens <> 0").agg(F.sum(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in deltas.columns]).cast("decimal(38,0)"))).first()[0] or 0)
        for _ in range(tries):
            done = self.log()
            for e in done:
                if e["batch"] == batch_id:
                    if e["digest"] != digest:
                        raise ValueError(f"batch {batch_id!r} was committed with other changes")
                    return False
            new = f"{self.root}/totals/{uuid.uuid4().hex}"
            self._added(self._totals(done), deltas).write.parquet(new)
            if self._publish(len(done), {"batch": batch_id, "digest": digest, "totals": new}):
                return True
        raise RuntimeError(f"batch {batch_id!r}: other writers were first {tries} times")

    def _added(self, totals: DataFrame, deltas: DataFrame) -> DataFrame:
        both = totals.unionByName(deltas).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return both.filter("n_docs <> 0 or n_tokens <> 0")

    def _totals(self, log: list[dict]) -> DataFrame:
        return self.spark.read.schema(TOTALS).parquet(log[-1]["totals"]) if log else self.spark.createDataFrame([], TOTALS)

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens; groups whose documents are all gone are left out."""
        return self._totals(self.log())


def with_counts(rows: DataFrame, texts: list[str], path: str) -> DataFrame:
    """The rows with each text column replaced by its number of tokens."""
    kept = [c for c in rows.columns if c not in texts]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept), *(f"{t} long" for t in texts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in slices(batches, texts[0]):
            counts = [pa.array(np.diff(encoder.encode(batch.column(t).fill_null("").to_pylist())[1]), pa.int64()) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *counts], [*kept, *texts])

    return rows.select(*kept, *texts).mapInArrow(run, schema)


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(1).alias("sign"), "n_tokens")


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(-1).alias("sign"), "n_tokens")


def revisions(counted: DataFrame, old: str, new: str) -> DataFrame:
    """A revised count is one document out and one in; unchanged ones cancel and are left out."""
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col(old).alias("n_tokens")), F.struct(F.lit(1).alias("sign"), F.col(new).alias("n_tokens")))
    return counted.filter(F.col(old) != F.col(new)).select(*KEYS, F.inline(both))
