"""Cleansing of job telemetry: each step is a DataFrame transformation."""
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from opsloom.functions import duration_bucket, micros
from opsloom.operators.lookup import lookup_join
from opsloom.operators.ordered import exact_percentiles
from opsloom.params import (
    JOB_IDENTITY, JOB_REQUIRED, JOB_RESOURCES, JOB_STATUSES, JOB_TIMESTAMPS, WORKLOAD_TYPES,
)
from opsloom.session import settled


def require_columns(df: DataFrame, required=JOB_REQUIRED) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Required columns missing: {missing}")
    return df


def with_identity(df: DataFrame) -> DataFrame:
    """Rows whose identity columns are all present."""
    return require_columns(df).dropna(subset=JOB_IDENTITY)


def as_utc(df: DataFrame, column: str) -> Column:
    """A column as timestamp; text that does not parse becomes NULL."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(column)
    return F.col(column).cast("timestamp")


def normalise_timestamps(df: DataFrame, columns=JOB_TIMESTAMPS) -> DataFrame:
    return df.withColumns({c: as_utc(df, c) for c in columns if c in df.columns})


def raw_duration(df: DataFrame) -> Column:
    """Duration as reported, else from start to completion."""
    reported = F.col("duration_seconds").cast("double") if "duration_seconds" in df.columns else F.lit(None).cast("double")
    if not {"started_at", "completed_at"} <= set(df.columns):
        return reported
    return F.coalesce(reported, (micros("completed_at") - micros("started_at")) / 1_000_000.0)


def derive_duration(df: DataFrame) -> DataFrame:
    """Fill missing durations; negative ones (clock skew) become NULL."""
    raw = raw_duration(df)
    return df.withColumn("duration_seconds", F.when(raw >= 0, raw))


def canonical_id(df: DataFrame) -> Column:
    return F.coalesce("parent_job_id", "job_id") if "parent_job_id" in df.columns else F.col("job_id")


def final_attempts(df: DataFrame, within=()) -> DataFrame:
    """The last attempt per canonical id. Spark keeps one row per key and task before the
    shuffle (a group limit on row_number), so an id with very many retries is no hot spot."""
    df = df.withColumn("canonical_job_id", canonical_id(df))
    if "retry_attempt" not in df.columns:
        df = df.withColumn("retry_attempt", F.lit(0).cast("bigint"))
    order = [F.desc_nulls_last("retry_attempt")]
    if "ingested_at" in df.columns:
        order.append(F.desc_nulls_last("ingested_at"))
    order.append(F.asc("job_id"))
    w = Window.partitionBy(*within, "canonical_job_id").orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def resource_fills(df: DataFrame, columns, strategy="workload_median") -> DataFrame:
    """One row per workload type with the value that replaces NULL in each column.

    The type median, else the median of the column after the type medians have been
    filled in. Only the type and these columns are written, since every round of the selection reads them.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    values = settled(df.select("workload_type", *columns)).select("workload_type", F.inline(pairs)).withColumn("n", F.lit(1).cast("bigint"))
    nulls = values.groupBy("name", "workload_type").agg(F.count_if(F.col("value").isNull()).alias("nulls"))
    if strategy == "workload_median":
        medians = exact_percentiles(values, ["name", "workload_type"], "value", {"median": 0.5}).drop("n_values")
        typed = settled(nulls.join(medians, ["name", "workload_type"], "left"))
        # Only columns that some type leaves without a median need the overall one.
        open_columns = [r["name"] for r in typed.where("median IS NULL AND nulls > 0").select("name").distinct().collect()]
        filled = values.where("value IS NOT NULL").select("name", "value", "n").unionByName(
            typed.where("median IS NOT NULL AND nulls > 0").selectExpr("name", "median AS value", "nulls AS n"))
    else:
        typed, open_columns = nulls.withColumn("median", F.lit(None).cast("double")), columns
        filled = values.where("value IS NOT NULL").select("name", "value", "n")
    value = F.col("median")
    if open_columns:
        overall = exact_percentiles(
            filled.where(F.col("name").isin(open_columns)), ["name"], "value", {"overall": 0.5}, "n").drop("n_values")
        typed = typed.join(overall, "name", "left")
        value = F.coalesce("median", "overall")
    return (
        typed.groupBy("workload_type")
        .agg(*[F.max(F.when(F.col("name") == c, value)).alias(f"_fill_{c}") for c in columns])
    )


def impute_resources(df: DataFrame, strategy="workload_median", columns=JOB_RESOURCES) -> DataFrame:
    """Fill NULL resource values: workload_median, zero or global_median."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    if strategy == "zero":
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    fills = resource_fills(df, columns, strategy)
    joined = lookup_join(df, fills, ["workload_type"])
    return joined.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_fill_{c}")) for c in columns}
    ).drop(*[f"_fill_{c}" for c in columns])


def valid_enums() -> Column:
    return F.col("status").isin(JOB_STATUSES) & F.col("workload_type").isin(WORKLOAD_TYPES)


def with_flags(df: DataFrame) -> DataFrame:
    """Success and failure flags and the duration bucket."""
    df = df.withColumns({"is_success": F.col("status") == "SUCCESS", "is_failure": F.col("status") == "FAILURE"})
    return df.withColumn("duration_bucket", duration_bucket("duration_seconds")) if "duration_seconds" in df.columns else df


def _prepared(df: DataFrame) -> DataFrame:
    return normalise_timestamps(with_identity(df))


def clean(df: DataFrame, strategy="workload_median") -> DataFrame:
    """All steps in their fixed order. The medians read the deduplicated rows with their few columns only, so nothing of full width is
    written in between."""
    unique = final_attempts(derive_duration(_prepared(df)))
    return with_flags(impute_resources(unique, strategy).where(valid_enums()))


def cleansing_report(df: DataFrame) -> DataFrame:
    """One row of counts: what each step of `clean` dropped or changed."""
    some_missing = F.lit(False)
    for c in JOB_IDENTITY:
        some_missing = some_missing | F.col(c).isNull()
    stamped = normalise_timestamps(require_columns(df))
    before = stamped.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(some_missing).alias("dropped_missing_required"),
        F.count_if(~some_missing & (raw_duration(stamped) < 0)).alias("timestamp_skew_corrections"),
    )
    unique = final_attempts(derive_duration(_prepared(df)))
    nulls = F.lit(0).cast("bigint")
    for c in JOB_RESOURCES:
        if c in unique.columns:
            nulls = nulls + F.count_if(F.col(c).isNull())
    after = unique.agg(
        F.count(F.lit(1)).alias("_unique"),
        nulls.alias("null_values_imputed"),
        F.count_if(~valid_enums()).alias("invalid_enum_rows_dropped"),
    )
    both = before.unionByName(after, allowMissingColumns=True)  # two rows, folded into one
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    valid = F.col("input_rows") - F.col("dropped_missing_required")
    return both.select(
        "input_rows", "dropped_missing_required", "timestamp_skew_corrections",
        (valid - F.col("_unique")).alias("duplicate_retry_records_removed"),
        "null_values_imputed", "invalid_enum_rows_dropped",
        (F.col("_unique") - F.col("invalid_enum_rows_dropped")).alias("output_rows"),
        (F.col("input_rows") - F.col("_unique") + F.col("invalid_enum_rows_dropped")).alias("rows_dropped"),
    )
