"""Baselines per workload type and scores against them."""
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.functions import safe_divide, severity_bins, stable_round
from opsloom.operators.lookup import lookup_join
from opsloom.operators.ordered import exact_percentiles
from opsloom.params import JOB_ZSCORE_THRESHOLD, MIN_BASELINE

TYPE = "workload_type"


def zscore_by(df: DataFrame, keys, value: str, name="z_score") -> DataFrame:
    """Population z within each key: aggregate with map-side combining, then look up."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_std"))
    return lookup_join(df, stats, keys, null_safe=True).withColumn(name, z).drop("_mean", "_std")


def _first_attempts(df: DataFrame, statuses) -> DataFrame:
    if "status" in df.columns:
        df = df.where(F.col("status").isin(*statuses))
    return df.where(F.col("retry_attempt") == 0) if "retry_attempt" in df.columns else df


def workload_baseline(jobs: DataFrame, scan_date, days=30, min_n=MIN_BASELINE) -> DataFrame:
    """First attempts of the `days` days before a date: mean, population deviation, failure rate."""
    day = F.lit(scan_date).cast("date")
    window = jobs.where(F.col("execution_date").between(F.date_sub(day, days), F.date_sub(day, 1)))
    return (
        _first_attempts(window, ("SUCCESS", "FAILURE")).groupBy(TYPE)
        .agg(
            F.avg("duration_seconds").alias("baseline_mean_duration_s"),
            F.stddev_pop("duration_seconds").alias("baseline_stddev_duration_s"),
            F.avg(F.when(F.col("status") == "FAILURE", 1.0).otherwise(0.0)).alias("baseline_failure_rate"),
            F.count(F.lit(1)).alias("baseline_sample_count"),
        )
        .where(F.col("baseline_sample_count") >= min_n)
    )


def workload_baseline_by_day(jobs: DataFrame, days=30, min_n=MIN_BASELINE) -> DataFrame:
    """`workload_baseline` for every execution date at once.

    Jobs are reduced to one row of (count, mean, sum of squared deviations) per type and day. The rows of the `days`
    days before each date, at most one a day, are merged pairwise, so nothing cancels.
    """
    # Days without any first attempt keep a row: they need a baseline as well.
    counted = F.col("status").isin("SUCCESS", "FAILURE") & (F.col("retry_attempt") == 0)
    duration = F.when(counted, F.col("duration_seconds"))
    daily = jobs.groupBy(TYPE, "execution_date").agg(
        F.count_if(counted).alias("_rows"),
        F.count(duration).alias("_n"),
        F.avg(duration).alias("_mean"),
        F.var_pop(duration).alias("_var"),
        F.count_if(counted & (F.col("status") == "FAILURE")).alias("_fails"),
    )
    by_type = Window.partitionBy(TYPE)
    frame = by_type.orderBy(F.unix_date("execution_date")).rangeBetween(-days, -1)
    part = F.struct(F.col("_n").cast("double").alias("n"), F.coalesce("_mean", F.lit(0.0)).alias("mean"),
                    (F.col("_n") * F.coalesce("_var", F.lit(0.0))).alias("m2"))

    def merge(x, y):
        n, delta = x["n"] + y["n"], y["mean"] - x["mean"]
        share = F.coalesce(F.try_divide(y["n"], n), F.lit(0.0))
        return F.struct(n.alias("n"), (x["mean"] + delta * share).alias("mean"), (x["m2"] + y["m2"] + delta * delta * x["n"] * share).alias("m2"))

    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    merged = daily.select(
        TYPE, "execution_date", *[F.sum(c).over(frame).alias(c) for c in ("_rows", "_fails")],
        F.aggregate(F.collect_list(part).over(frame), none, merge).alias("_m"))
    known = F.col("_m.n") > 0
    return merged.where(F.col("_rows") >= min_n).select(
        TYPE, "execution_date",
        F.when(known, F.col("_m.mean")).alias("baseline_mean_duration_s"),
        F.when(known, F.sqrt(F.col("_m.m2") / F.col("_m.n"))).alias("baseline_stddev_duration_s"),
        safe_divide("_fails", "_rows").alias("baseline_failure_rate"),
        F.col("_rows").alias("baseline_sample_count"),
    )


def scored_jobs(jobs: DataFrame, baseline: DataFrame, threshold=JOB_ZSCORE_THRESHOLD) -> DataFrame:
    """z of the duration against a baseline by type, or by type and date if it has dates."""
    keys = [TYPE, "execution_date"] if "execution_date" in baseline.columns else [TYPE]
    std = F.col("baseline_stddev_duration_s")
    z = F.try_divide(F.col("duration_seconds") - F.col("baseline_mean_duration_s"), std)
    return (
        lookup_join(jobs, baseline, keys)
        .withColumn("duration_z_score", z)
        .withColumn("is_duration_anomaly", F.coalesce((std > 0) & (F.abs("duration_z_score") > threshold), F.lit(False)))
    )


def duration_baseline(history: DataFrame, reference_date, window_days=30, min_n=MIN_BASELINE) -> DataFrame:
    """Mean, sample deviation, median, p95 and p99 of successful first attempts, and the
    failure rate of all jobs, in the days before a date."""
    day = F.lit(reference_date).cast("date")
    start = F.date_sub(day, window_days)
    if "execution_date" in history.columns:
        date = F.col("execution_date").cast("date")
        history = history.where((date >= start) & (date < day))
    clean = _first_attempts(history, ("SUCCESS",))
    moments = clean.groupBy(TYPE).agg(
        F.avg("duration_seconds").alias("baseline_mean_duration_s"),
        F.stddev_samp("duration_seconds").alias("baseline_stddev_duration_s"),
        F.count("duration_seconds").alias("sample_count"),
    ).where(F.col("sample_count") >= min_n)
    ranks = exact_percentiles(clean, [TYPE], "duration_seconds", {
        "baseline_median_duration_s": 0.5, "baseline_p95_duration_s": 0.95, "baseline_p99_duration_s": 0.99,
    }).drop("n_values")
    failed = F.avg((F.col("status") == "FAILURE").cast("double")) if "status" in history.columns else F.lit(0.0)
    rates = history.groupBy(TYPE).agg(failed.alias("baseline_failure_rate"))
    numbers = ["baseline_mean_duration_s", "baseline_stddev_duration_s", "baseline_median_duration_s",
               "baseline_p95_duration_s", "baseline_p99_duration_s", "baseline_failure_rate"]
    return moments.join(ranks, TYPE).join(rates, TYPE, "left").select(
        TYPE, *[stable_round(c, 4).alias(c) for c in numbers], "sample_count",
        start.cast("string").alias("window_start"), day.cast("string").alias("window_end"),
        F.lit(window_days).alias("window_days"),
    )


def detector_baseline(history: DataFrame, min_n=MIN_BASELINE) -> DataFrame:
    """Statistics of successful first attempts per type; types with few durations are left out.
    Accepts the output of `duration_baseline` as well."""
    if "baseline_mean_duration_s" in history.columns:
        return history.where(F.col("sample_count") >= min_n).select(
            TYPE, F.col("baseline_mean_duration_s").alias("baseline_mean"),
            F.col("baseline_stddev_duration_s").alias("baseline_std"),
            F.col("baseline_median_duration_s").alias("baseline_median"),
            F.col("baseline_p95_duration_s").alias("baseline_p95"),
            F.col("sample_count").alias("baseline_count"),
        )
    for c in ("duration_seconds", TYPE):
        if c not in history.columns:
            raise ValueError("baseline DataFrame must contain duration_seconds and workload_type")
    clean = _first_attempts(history, ("SUCCESS",))
    moments = clean.groupBy(TYPE).agg(
        F.avg("duration_seconds").alias("baseline_mean"),
        F.stddev_samp("duration_seconds").alias("baseline_std"),
        F.count("duration_seconds").alias("baseline_count"),
    ).where(F.col("baseline_count") >= min_n)
    ranks = exact_percentiles(clean, [TYPE], "duration_seconds", {"baseline_median": 0.5, "baseline_p95": 0.95})
    return moments.join(ranks.drop("n_values"), TYPE).select(
        TYPE, "baseline_mean", "baseline_std", "baseline_median", "baseline_p95", "baseline_count")


def score_against(current: DataFrame, stats: DataFrame, threshold=JOB_ZSCORE_THRESHOLD) -> DataFrame:
    """z, deviation from the mean in percent, anomaly flag and severity of every job."""
    gap = F.col("duration_seconds") - F.col("baseline_mean")
    return (
        lookup_join(current, stats, [TYPE])
        .withColumn("z_score", F.when(F.col("baseline_std") > 0, gap / F.col("baseline_std")))
        .withColumn("abs_z_score", F.abs("z_score"))
        .withColumn("deviation_pct", F.when(F.col("baseline_mean") > 0, gap / F.col("baseline_mean") * 100))
        .withColumn("is_anomaly", F.coalesce(F.col("abs_z_score") > threshold, F.lit(False)))
        .withColumn("anomaly_severity", severity_bins("abs_z_score", threshold))
    )


def detect(current: DataFrame, history: DataFrame | None = None, threshold=JOB_ZSCORE_THRESHOLD,
           min_n=MIN_BASELINE) -> DataFrame:
    """Anomalous jobs, largest |z| first. Without history the batch is its own baseline."""
    stats = detector_baseline(current if history is None else history, min_n)
    return score_against(current, stats, threshold).where("is_anomaly").orderBy(F.desc("abs_z_score"))


def anomalies_by_type(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(TYPE).agg(
        F.count("job_id").alias("count"),
        stable_round(F.avg("deviation_pct"), 2).alias("avg_deviation_pct"),
        stable_round(F.max("abs_z_score"), 2).alias("max_z_score"),
    )


TOP_COLUMNS = ["job_id", "workload_type", "z_score", "deviation_pct", "duration_seconds", "status", "team"]


def top_anomalies(anomalies: DataFrame, n=10) -> DataFrame:
    """The n largest |z|, with those report columns that exist."""
    return anomalies.orderBy(F.desc("abs_z_score"), "job_id").limit(n).select(
        *[c for c in TOP_COLUMNS if c in anomalies.columns])


def anomaly_rate(scored: DataFrame, threshold=JOB_ZSCORE_THRESHOLD) -> DataFrame:
    """One row: jobs, anomalous jobs, their share and the threshold."""
    hits, rows = F.count_if("is_anomaly"), F.count(F.lit(1))
    return scored.agg(
        rows.alias("total_jobs"), hits.alias("anomalous_jobs"),
        stable_round(F.coalesce(safe_divide(hits, rows), F.lit(0.0)), 4).alias("anomaly_rate"),
        F.lit(float(threshold)).alias("z_threshold_used"),
    )


def anomaly_report(scored: DataFrame, as_of, threshold=JOB_ZSCORE_THRESHOLD) -> DataFrame:
    """The whole report as one nested row, ready for a JSON sink."""
    anomalies = scored.where("is_anomaly")
    by_type = anomalies_by_type(anomalies).agg(
        F.map_from_entries(F.collect_list(F.struct(
            TYPE, F.struct("count", "avg_deviation_pct", "max_z_score").alias("v")))).alias("by_workload_type"))
    top = top_anomalies(anomalies)
    tops = top.agg(F.collect_list(F.struct(*top.columns)).alias("top_anomalies"))
    parts = anomaly_rate(scored, threshold)
    for one_row in (by_type, tops):
        parts = parts.unionByName(one_row, allowMissingColumns=True)
    return parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns]).withColumn(
        "generated_at", F.lit(as_of).cast("timestamp"))
