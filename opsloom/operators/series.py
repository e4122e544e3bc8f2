"""Anomalies and trends of numeric series.

A series table has key columns, an order column that is unique within a key, and a value.
Every operator runs for all series at once and for series of any length.
"""
from pyspark.sql import DataFrame, functions as F

from opsloom.functions import severity_ladder, stable_round
from opsloom.operators.lookup import lookup_join
from opsloom.operators.ordered import exact_percentiles, exponential_mean, over_blocks, positions
from opsloom.params import IQR_MULTIPLIER, MIN_OBSERVATIONS, ZSCORE_THRESHOLD


def as_series(df: DataFrame, keys, order, value) -> DataFrame:
    """(keys, order, value, pos): positions per series, NaN as NULL."""
    number = F.col(value).cast("double")
    clean = df.select(*keys, order, F.when(~F.isnan(number), number).alias("value"))
    return positions(clean, keys, [order])


def _flagged(df: DataFrame, z_threshold, iqr_multiplier) -> DataFrame:
    """Score rows that carry their mean, std, q1 and q3; return the anomalies."""
    iqr = F.col("_q3") - F.col("_q1")
    v = F.col("value")
    z = F.when(F.col("_std") > 0, (v - F.col("_mean")) / F.col("_std")).otherwise(0.0)
    out = (
        df.where(v.isNotNull())
        .withColumn("_z", z)
        .withColumn("_low", F.col("_q1") - iqr * iqr_multiplier)
        .withColumn("_high", F.col("_q3") + iqr * iqr_multiplier)
        .withColumn("is_zscore", F.abs("_z") >= z_threshold)
        .withColumn("is_iqr", F.coalesce((v < F.col("_low")) | (v > F.col("_high")), F.lit(False)))
        .where("is_zscore OR is_iqr")
        .withColumn("is_anomaly", F.lit(True))
        .withColumn("severity", severity_ladder("_z"))
    )
    rounded = {"z_score": "_z", "rolling_mean": "_mean", "rolling_std": "_std", "iqr_lower": "_low", "iqr_upper": "_high"}
    return out.withColumns({k: stable_round(c, 4) for k, c in rounded.items()}).drop(
        "_z", "_low", "_high", "_mean", "_std", "_q1", "_q3")


def series_anomalies(df: DataFrame, keys, order, value, z_threshold=ZSCORE_THRESHOLD,
                     iqr_multiplier=IQR_MULTIPLIER, min_rows=MIN_OBSERVATIONS) -> DataFrame:
    """Values far from the mean or outside the quartile fences of their whole series."""
    s = as_series(df, keys, order, value)
    moments = s.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_std"),
    ).where(F.col("_rows") >= min_rows).drop("_rows")
    quartiles = exact_percentiles(s, keys, "value", {"_q1": 0.25, "_q3": 0.75}).drop("n_values")
    stats = moments.join(quartiles, list(keys))
    return _flagged(lookup_join(s, stats, keys, how="inner"), z_threshold, iqr_multiplier)


def rolling_anomalies(df: DataFrame, keys, order, value, window=24, z_threshold=ZSCORE_THRESHOLD,
                      iqr_multiplier=IQR_MULTIPLIER, min_rows=MIN_OBSERVATIONS) -> DataFrame:
    """The same against the `window` values before each one; the first `window` rows and
    series shorter than `min_rows` are not scored."""
    s = as_series(df, keys, order, value)
    if min_rows > window:
        long_enough = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= min_rows)
        s = lookup_join(s, long_enough.drop("_rows"), keys, how="inner")
    framed = over_blocks(s, keys, window, {
        "_mean": lambda w: F.avg("value").over(w.rowsBetween(-window, -1)),
        "_std": lambda w: F.stddev_pop("value").over(w.rowsBetween(-window, -1)),
        "_q1": lambda w: F.percentile("value", F.lit(0.25)).over(w.rowsBetween(-window, -1)),
        "_q3": lambda w: F.percentile("value", F.lit(0.75)).over(w.rowsBetween(-window, -1)),
    })
    return _flagged(framed.where(F.col("pos") >= window), z_threshold, iqr_multiplier)


def moving_averages(df: DataFrame, keys, order, value, window=7) -> DataFrame:
    """Per row: mean of the last `window` rows and the exponential mean of the same span."""
    s = as_series(df, keys, order, value)
    rolled = over_blocks(s, keys, window - 1, {
        "rolling_mean": lambda w: F.avg("value").over(w.rowsBetween(-(window - 1), 0)),
    })
    return exponential_mean(rolled, keys, "value", window)


def slope_direction(slope):
    slope = F.col(slope) if isinstance(slope, str) else slope
    return F.when(slope > 0.1, "improving").when(slope < -0.1, "degrading").otherwise("stable")


def trend(df: DataFrame, keys, order, value, short=7, long=30) -> DataFrame:
    """Per series: slope per step, direction, and the change against `short` and `long` rows ago."""
    s = as_series(df, keys, order, value)
    sizes = s.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.regr_slope("value", F.col("pos").cast("double")).alias("_slope"),
    )
    ends = lookup_join(s, sizes, keys, how="inner").where(
        F.col("pos") >= F.col("n_rows") - 1 - long)

    def back(rows):
        return F.max(F.when(F.col("pos") == F.col("n_rows") - 1 - rows, F.col("value")))

    def change(old):
        return F.when(F.col(old) != 0, stable_round((F.col("_new") - F.col(old)) / F.abs(F.col(old)) * 100, 2))

    return (
        ends.groupBy(*keys, "n_rows", "_slope")
        .agg(back(0).alias("_new"), back(short).alias("_short"), back(long).alias("_long"))
        .select(
            *keys, "n_rows",
            stable_round("_slope", 6).alias("slope"),
            slope_direction("_slope").alias("direction"),
            change("_short").alias(f"pct_change_{short}d"),
            change("_long").alias(f"pct_change_{long}d"),
        )
    )
