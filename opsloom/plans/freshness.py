"""Freshness of tables against their limits."""
from pyspark.sql import DataFrame, SparkSession, functions as F

from opsloom.functions import hours_between
from opsloom.params import FRESHNESS_SLA, SOURCE_FRESHNESS


def sla_config(spark: SparkSession, limits=None) -> DataFrame:
    """Hours allowed between updates, one row per table."""
    return spark.createDataFrame(limits or FRESHNESS_SLA, "dataset_id string, table_name string, sla_hours int")


def table_freshness(partitions: DataFrame, as_of, limits=None) -> DataFrame:
    """State of each table from its partition statistics: (dataset_id, table_name,
    partition_id, last_modified, row_count), one row per partition."""
    now = F.lit(as_of).cast("timestamp")
    sla = sla_config(partitions.sparkSession, limits)
    age, limit = F.col("hours_since_update"), F.col("sla_hours")
    return (
        partitions.where(~F.col("partition_id").isin("__NULL__", "__UNPARTITIONED__"))
        .groupBy("dataset_id", "table_name")
        .agg(
            F.max("last_modified").alias("latest_modified"),
            F.max(F.expr("try_to_date(partition_id, 'yyyyMMdd')")).alias("latest_partition_date"),
            F.sum(F.col("row_count").cast("bigint")).alias("total_rows"),
        )
        .join(F.broadcast(sla), ["dataset_id", "table_name"])  # a constant list of a few rows
        .withColumn("hours_since_update", hours_between(now, "latest_modified"))
        .withColumn("is_stale", age > limit)
        .withColumn("freshness_status", F.when(age > limit * 3, "CRITICAL").when(age > limit, "WARNING").otherwise("OK"))
        .withColumn("checked_at", now)
        .orderBy(F.desc("is_stale"), F.desc("hours_since_update"))
    )


def partition_statistics(df: DataFrame, dataset: str, table: str, ts: str) -> DataFrame:
    """Partition statistics of a table by the day of its timestamp."""
    return df.groupBy(F.date_format(ts, "yyyyMMdd").alias("partition_id")).agg(
        F.max(ts).alias("last_modified"), F.count(F.lit(1)).alias("row_count"),
    ).select(F.lit(dataset).alias("dataset_id"), F.lit(table).alias("table_name"), "partition_id", "last_modified", "row_count")


def source_freshness(df: DataFrame, table: str, as_of, loaded_at="ingested_at", limits=None) -> DataFrame:
    """pass, warn or error by the age of the newest row."""
    warn, error = (limits or SOURCE_FRESHNESS)[table]
    now = F.lit(as_of).cast("timestamp")
    age = (F.unix_micros(now) - F.unix_micros("max_loaded_at")) / 3_600_000_000.0
    return df.agg(F.max(loaded_at).alias("max_loaded_at")).select(
        F.lit(table).alias("table_name"), "max_loaded_at", age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age > error), "error").when(age > warn, "warn").otherwise("pass").alias("state"),
    )


def has_recent_rows(df: DataFrame, ts: str, as_of, hours=25) -> DataFrame:
    """One row: were there any rows in the last hours?"""
    since = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.where(F.col(ts) >= since).agg(
        F.count(F.lit(1)).alias("recent_rows"), (F.count(F.lit(1)) > 0).alias("is_fresh"))
