"""Schema validation, quality scores and lineage of a table."""
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from opsloom.functions import safe_divide, stable_round
from opsloom.operators.distinct import distinct_counts
from opsloom.operators.quality import combined

MAX_AGE_HOURS = 25

# Spark types that stand for the declared type names.
TYPE_NAMES = {
    "int64": (T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    "float64": (T.DoubleType, T.FloatType, T.DecimalType),
    "bool": (T.BooleanType,),
    "datetime64[ns]": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "object": (T.DataType,),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str
    nullable: bool = True
    unique: bool = False


def validate(df: DataFrame, schema: list[ColumnSpec]) -> DataFrame:
    """One message per violation; no rows when the table is valid."""
    static, aggregates, messages, unique = [], [], [], {}
    for s in schema:
        if s.name not in df.columns:
            static.append(f"no such column: {s.name}")
            continue
        if not isinstance(df.schema[s.name].dataType, TYPE_NAMES.get(s.dtype, (T.DataType,))):
            static.append(f"{s.name} has type {df.schema[s.name].dataType.simpleString()} instead of {s.dtype}")
        c, i = F.col(s.name), len(aggregates)
        if not s.nullable:
            aggregates.append(F.count_if(c.isNull()).alias(f"_m{i}"))
            n = F.col(f"_m{i}")
            messages.append(F.when(n > 0, F.concat(
                F.lit(f"{s.name} may not be null; rows: "), n.cast("string"))))
        if s.unique:
            i = len(aggregates)
            unique[f"_d{i}"] = s.name
            aggregates.append((F.count(F.lit(1)) - F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))).alias(f"_m{i}"))
            n = F.col(f"_m{i}") - F.col(f"_d{i}")
            messages.append(F.when(n > 0, F.concat(
                F.lit(f"{s.name} may not repeat; rows: "), n.cast("string"))))
    every = F.array(*[F.lit(m) for m in static], *messages, F.lit(None).cast("string"))
    found = combined(df.agg(F.count(F.lit(1)).alias("_rows"), *aggregates), *([distinct_counts(df, unique)] if unique else []))
    return found.select(F.explode(every).alias("message")).where(F.col("message").isNotNull())


def quality_score(df: DataFrame, schema: list[ColumnSpec], as_of, ts_column=None, max_age_hours=MAX_AGE_HOURS) -> DataFrame:
    """Completeness, uniqueness, freshness and their weighted sum, in one row."""
    rows = F.col("_rows")
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0))
    keys = [s.name for s in schema if s.unique]
    present = [k for k in keys if k in df.columns]
    aggregates = [F.count(F.lit(1)).alias("_rows"), nulls.alias("_nulls")]
    parts = [distinct_counts(df, {f"_d{i}": k for i, k in enumerate(present)})] if present else []
    fresh = F.lit(True)
    if ts_column and ts_column in df.columns:
        aggregates.append(F.max(F.col(ts_column).cast("timestamp")).alias("_latest"))
        age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("_latest")) / 3_600_000_000.0
        fresh = F.coalesce(age <= max_age_hours, F.lit(True))
    complete = F.lit(1.0) - safe_divide("_nulls", rows * len(df.columns), 0.0)
    if len(present) < len(keys):
        unique = F.when(rows > 0, 0.0).otherwise(1.0)
    elif present:
        shares = [safe_divide(f"_d{i}", rows, 1.0) for i in range(len(present))]
        unique = F.least(*shares) if len(shares) > 1 else shares[0]
    else:
        unique = F.lit(1.0)
    overall = 0.5 * F.col("completeness") + 0.3 * F.col("uniqueness") + 0.2 * F.col("freshness_ok").cast("double")
    return (
        combined(df.agg(*aggregates), *parts)
        .select(complete.alias("completeness"), unique.alias("uniqueness"), fresh.alias("freshness_ok"))
        .withColumn("overall", stable_round(overall, 4))
        .withColumn("completeness", stable_round("completeness", 4))
        .withColumn("uniqueness", stable_round("uniqueness", 4))
    )


def lineage_record(df: DataFrame, source: str, transformation: str, output: str, as_of) -> DataFrame:
    """One row that says where a table came from, with a checksum of its content.

    The checksum folds row hashes with sum and exclusive or, so it depends on the
    rows and not on their order or partitioning.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    folded = df.select(row.alias("_h")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.col("_h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("_sum"),
        F.coalesce(F.expr("bit_xor(_h)"), F.lit(0).cast("bigint")).alias("_xor"),
    )
    text = F.concat_ws(",", F.col("row_count").cast("string"), F.col("_sum").cast("string"), F.col("_xor").cast("string"))
    return folded.select(
        F.lit(source).alias("source"), F.lit(transformation).alias("transformation"), F.lit(output).alias("output"),
        F.lit(as_of).cast("timestamp").alias("run_ts"), "row_count", F.md5(text).alias("checksum"))
