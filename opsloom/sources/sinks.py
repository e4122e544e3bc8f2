"""Writing tables, reports and audit records."""
import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opsloom.functions import week_start
from opsloom.operators.quality import failing_unique
from opsloom.schemas import LAYOUT
from opsloom.session import settled


def write_overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of one or a few rows as a single JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, partition: str, cluster=(), mode="overwrite") -> None:
    """Partitioned by one column and sorted by the cluster columns inside files.

    Rows of a partition value are brought together, but the rebalance hint lets the
    adaptive planner split a value that outgrows one task (a day of 100 TB) into several
    files and merge small values. An overwrite replaces the partitions that occur in df.
    """
    (
        df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def write_known(df: DataFrame, name: str, path: str, mode="overwrite") -> None:
    """Write a table of `schemas.LAYOUT` with its partition and cluster columns; a raw table must have the columns of its schema."""
    schema, partition, cluster, _ = LAYOUT[name]
    if schema is not None:
        schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        absent = [f.name for f in schema if f.name not in df.columns]
        if absent:
            raise ValueError(f"{name} lacks {', '.join(absent)}")
    if partition.startswith("date:"):
        source = partition.removeprefix("date:")
        partition = f"{source}_date"
        df = df.withColumn(partition, F.to_date(source))
    write_table(df, path, partition, cluster, mode)


def expire_known(spark: SparkSession, name: str, path: str, as_of) -> list[str]:
    """Remove the partitions of a table of `schemas.LAYOUT` that are past its expiry, if it has one."""
    _, partition, _, days = LAYOUT[name]
    return [] if days is None else expire_partitions(spark, path, partition, as_of, days)


def replace_partitions(df: DataFrame, path: str, partition: str, key, cluster=()) -> None:
    """Replace the partitions that occur in df, leave the others. The key must be unique."""
    key = [key] if isinstance(key, str) else list(key)
    df = settled(df)  # read twice: by the key test and by the write
    if not failing_unique(df, *key).isEmpty():
        raise ValueError(f"key {key} is not unique in the new rows")
    write_table(df, path, partition, cluster)


def since_days(df: DataFrame, column: str, as_of, days: int, whole_weeks=False) -> DataFrame:
    """Rows to reprocess: the last `days` days, widened to the start of their week on request."""
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where(F.col(column) >= (week_start(start) if whole_weeks else start))


def append_audit(df: DataFrame, path: str, as_of) -> None:
    """Append a query result with the time of the check."""
    stamped = df if "checked_at" in df.columns else df.withColumn("checked_at", F.lit(as_of).cast("timestamp"))
    stamped.write.mode("append").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may carry new columns; `read_evolved` returns the union of all columns."""
    df.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """A model as a view (recomputed by each reader) or as a table (written once)."""
    if kind == "table":
        write_overwrite(df, path)
        df = df.sparkSession.read.parquet(path)
    elif kind != "view":
        raise ValueError(f"unknown kind: {kind}")
    df.createOrReplaceTempView(name)
    return df


def store_failures(tests: dict[str, DataFrame], folder: str) -> list[str]:
    """Write the failing rows of each test, once; return the names of the tests that have any."""
    failed = []
    for name, df in tests.items():
        write_overwrite(df, f"{folder}/{name}")
        if not df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}").isEmpty():
            failed.append(name)
    return failed


def expire_partitions(spark: SparkSession, path: str, partition: str, as_of, days: int) -> list[str]:
    """Remove the folders of date partitions older than `days` days; return their names. Folders whose value is no date stay."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    oldest = datetime.date.fromisoformat(str(as_of)[:10]) - datetime.timedelta(days=days)
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        key, _, value = name.partition("=")
        try:
            old = key == partition and datetime.date.fromisoformat(value) < oldest
        except ValueError:
            continue
        if old and fs.delete(status.getPath(), True):
            gone.append(name)
    return sorted(gone)
