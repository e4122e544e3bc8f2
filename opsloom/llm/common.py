"""Helpers that the operators of this package share."""
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from opsloom.session import settled  # noqa: F401  (used by the operators)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def released(df: DataFrame) -> DataFrame:
    """As `settled`; then let go of the shuffle files behind it. Spark removes them when the driver's garbage collector finds that no plan
    needs them, which on an idle driver may come after the disks are full."""
    df = settled(df)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def text_of(name="text"):
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batches, size=512):
    """Cut Arrow batches to few rows, so that long texts are held as Python objects a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


class Kept(dict):
    """Results of a function by argument, for arguments that repeat. When it is full, what was used since the last time
    stays at hand; the rest is computed again if it comes back, so memory is bounded and results never change."""

    def __init__(self, function, size=150_000):
        super().__init__()
        self.function, self.size, self.older = function, size, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.function(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


def tasks(df: DataFrame) -> int:
    """Partitions for a shuffle by explicit key: the session's setting, which follows the data's size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stacked(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def starts_of_groups(*columns) -> np.ndarray:
    """Positions at which sorted columns change their value."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    if n:
        change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def kept_rows(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of docs whose (doc_id, XXH64 of the text) stand in keep as (id, h), with all their columns; of rows that
    agree in both one stays. Texts are shuffled once more only where such rows exist."""
    marked = docs.withColumn("_hash_", F.xxhash64(text_of()))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id_")) & (F.col("_hash_") == F.col("_h_"))
    out = marked.join(keep.select(F.col("id").alias("_id_"), F.col("h").alias("_h_")), same, "left_semi")
    if marked.groupBy("doc_id", "_hash_").count().where("count > 1").limit(1).count():
        out = out.dropDuplicates(["doc_id", "_hash_"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def kept_rows_by(docs: DataFrame, judged: DataFrame, condition: str) -> DataFrame:
    """Rows of docs whose (doc_id, XXH64 of the text) are not among the judged rows (doc_id, text_hash) that fail the
    condition. The verdict depends on the text alone, so rows that repeat an id and a text share it."""
    gone = judged.where(f"NOT ({condition})").select(F.col("doc_id").alias("_id_"), F.col("text_hash").alias("_h_"))
    marked = docs.withColumn("_hash_", F.xxhash64(text_of()))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id_")) & (F.col("_hash_") == F.col("_h_"))
    return marked.join(gone, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
