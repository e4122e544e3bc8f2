"""Fleet health: hourly scores, anomaly candidates, daily readiness."""
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.functions import exact_avg, linear_score, ratio_of, severity_ladder, stable_round
from opsloom.params import ANOMALY_LOOKBACK_DAYS, IQR_MULTIPLIER, SLO_READINESS, ZSCORE_THRESHOLD

SERIES = ["cluster_name", "environment"]


def hourly_fleet(telemetry: DataFrame) -> DataFrame:
    """Availability and readiness per cluster, environment and hour."""
    node, task = F.col("node_health_ratio"), F.col("task_running_ratio")
    return telemetry.groupBy(*SERIES, "event_hour", "event_date").agg(
        F.avg(node * 100).alias("avg_node_health"),
        F.avg(task * 100).alias("avg_task_health"),
        F.avg((node + task) / 2 * 100).alias("availability_score"),
        F.avg("readiness_score").alias("avg_readiness_score"),
        F.count(F.lit(1)).alias("event_count"),
    )


def hourly_metrics(metrics: DataFrame) -> DataFrame:
    """Latency score (100 up to 500 ms, 0 at 1000 ms) and error score (100 up to 5 %)."""
    return (
        metrics.groupBy(*SERIES, "metric_hour")
        .agg(F.avg("latency_p99_ms").alias("avg_latency_p99_ms"), F.avg("error_rate").alias("avg_error_rate"))
        .withColumn("metric_date", F.to_date("metric_hour"))
        .withColumn("latency_score", linear_score("avg_latency_p99_ms", 500, 500))
        .withColumn("error_rate_score", linear_score("avg_error_rate", 0.05, 0.95))
    )


def fleet_health_scores(telemetry: DataFrame, metrics: DataFrame, slo_readiness=SLO_READINESS) -> DataFrame:
    """Half availability, three tenths latency, one fifth errors. Hours without metrics
    score 100 on both. Both sides are aggregated to the hour before they meet."""
    scores = hourly_metrics(metrics).select(
        *SERIES, F.col("metric_hour").alias("event_hour"),
        "latency_score", "error_rate_score", "avg_latency_p99_ms", "avg_error_rate",
    )
    weighted = 0.50 * F.col("availability_score") + 0.30 * F.col("latency_score") + 0.20 * F.col("error_rate_score")
    return (
        hourly_fleet(telemetry).drop("avg_node_health", "avg_task_health")
        .join(scores, [*SERIES, "event_hour"], "left")
        .fillna({"latency_score": 100.0, "error_rate_score": 100.0, "avg_latency_p99_ms": 0.0, "avg_error_rate": 0.0})
        .withColumn("fleet_health_score", stable_round(weighted, 2))
        .withColumn("is_slo_compliant", weighted >= slo_readiness)
    )


def score_bounds(scores: DataFrame, iqr_multiplier=IQR_MULTIPLIER) -> DataFrame:
    """Quartile fences per series. Scores carry two decimals in 0..100, so a group has at most
    10,001 distinct values and the built-in exact percentile is bounded."""
    q = F.percentile("fleet_health_score", F.array(F.lit(0.25), F.lit(0.75)))
    return (
        scores.groupBy(*SERIES).agg(q.alias("_q"))
        .select(*SERIES, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
        .withColumn("iqr_range", (F.col("q3") - F.col("q1")) * iqr_multiplier)
        .withColumn("iqr_lower_bound", F.col("q1") - F.col("iqr_range"))
        .withColumn("iqr_upper_bound", F.col("q3") + F.col("iqr_range"))
    )


def rolling_score_stats(scores: DataFrame, lookback_days=ANOMALY_LOOKBACK_DAYS) -> DataFrame:
    """Mean and population deviation of the lookback_days * 24 hours before each hour.

    Spark evaluates a sliding frame of n rows in n steps per row. Growing frames cost
    one step, so the sums are differences of running sums, taken around the series
    mean against cancellation. A series has one row per hour, which bounds the window. Deviations below a
    millionth of the series mean are rounding of the sums and count as 0; scores have two decimals.
    """
    rows = lookback_days * 24
    series = Window.partitionBy(*SERIES)
    ordered = series.orderBy("event_hour")
    growing = ordered.rowsBetween(Window.unboundedPreceding, -1)
    centred = F.col("fleet_health_score") - F.col("_centre")
    sums = (
        scores.withColumn("_centre", F.avg("fleet_health_score").over(series))
        .withColumn("_n", F.count("fleet_health_score").over(growing))
        .withColumn("_s", F.coalesce(F.sum(centred).over(growing), F.lit(0.0)))
        .withColumn("_ss", F.coalesce(F.sum(centred * centred).over(growing), F.lit(0.0)))
    )
    framed = sums
    for c in ("_n", "_s", "_ss"):
        framed = framed.withColumn(f"{c}f", F.col(c) - F.coalesce(F.lag(c, rows).over(ordered), F.lit(0)))
    mean = F.try_divide(F.col("_sf"), F.col("_nf"))
    variance = F.greatest(F.try_divide(F.col("_ssf"), F.col("_nf")) - mean * mean, F.lit(0.0))
    noise = F.lit(1e-12) * F.greatest(F.col("_centre") * F.col("_centre"), F.lit(1.0))
    return framed.select(
        *scores.columns,
        (F.col("_centre") + mean).alias("rolling_mean"),
        F.when(variance > noise, F.sqrt(variance)).when(F.col("_nf") > 0, 0.0).alias("rolling_stddev"),
    )


def anomaly_candidates(scores: DataFrame, lookback_days=ANOMALY_LOOKBACK_DAYS,
                       z_threshold=ZSCORE_THRESHOLD, iqr_multiplier=IQR_MULTIPLIER) -> DataFrame:
    """Hours far from the rolling mean or outside the quartile fences."""
    score = F.col("fleet_health_score")
    is_z = F.abs("z_score") >= z_threshold
    is_iqr = (score < F.col("iqr_lower_bound")) | (score > F.col("iqr_upper_bound"))
    return (
        rolling_score_stats(scores, lookback_days)
        .join(score_bounds(scores, iqr_multiplier), SERIES)
        .withColumn("z_score", F.try_divide(score - F.col("rolling_mean"), F.col("rolling_stddev")))
        .withColumn("is_zscore_anomaly", is_z)
        .withColumn("is_iqr_anomaly", is_iqr)
        .withColumn("is_anomaly", is_z | is_iqr)
        .withColumn("anomaly_severity", severity_ladder("z_score", z_threshold))
        .where("is_anomaly")
    )


def anomaly_log(candidates: DataFrame) -> DataFrame:
    return candidates.select(
        *SERIES, "event_hour", "event_date", "fleet_health_score", "rolling_mean", "rolling_stddev", "z_score",
        "iqr_lower_bound", "iqr_upper_bound", "is_zscore_anomaly", "is_iqr_anomaly", "anomaly_severity",
    )


def daily_anomalies(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy(*SERIES, "event_date").agg(
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.count_if(F.col("anomaly_severity") == "critical").alias("critical_anomaly_count"),
    )


def daily_scores(scores: DataFrame) -> DataFrame:
    """Daily aggregates of the hourly scores."""
    s = "fleet_health_score"
    return scores.groupBy(*SERIES, "event_date").agg(
        stable_round(exact_avg(s, 2), 2).alias("avg_fleet_health_score"),
        stable_round(F.min(s), 2).alias("min_fleet_health_score"),
        stable_round(F.max(s), 2).alias("max_fleet_health_score"),
        stable_round(F.stddev_samp(s), 2).alias("stddev_fleet_health_score"),
        F.count_if("is_slo_compliant").alias("slo_compliant_hours"),
        F.count(F.lit(1)).alias("total_hours"),
        ratio_of(F.col("is_slo_compliant")).alias("slo_compliance_rate"),
        stable_round(F.avg("avg_latency_p99_ms"), 2).alias("avg_latency_p99_ms"),
        stable_round(F.avg("avg_error_rate"), 4).alias("avg_error_rate"),
        F.sum("event_count").alias("total_events"),
    )


def with_readiness_trend(daily: DataFrame) -> DataFrame:
    """Seven-row score and thirty-row compliance averages. One row per day and series."""
    w = Window.partitionBy(*SERIES).orderBy("event_date")
    return daily.withColumns({
        "rolling_7d_avg_score": stable_round(F.avg("avg_fleet_health_score").over(w.rowsBetween(-6, 0)), 2),
        "rolling_30d_slo_rate": stable_round(F.avg("slo_compliance_rate").over(w.rowsBetween(-29, 0)), 4),
    })


def fleet_readiness_daily(scores: DataFrame, candidates: DataFrame) -> DataFrame:
    """The daily readiness mart."""
    return (
        with_readiness_trend(daily_scores(scores))
        .join(daily_anomalies(candidates), [*SERIES, "event_date"], "left")
        .fillna(0, ["anomaly_count", "critical_anomaly_count"])
    )


def health_trend(readiness: DataFrame, as_of, days=30, environment="prod") -> DataFrame:
    """Recent readiness of one environment, newest day first."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return (
        readiness.where((F.col("event_date") >= since) & (F.col("environment") == environment))
        .select("event_date", *SERIES, "avg_fleet_health_score", "rolling_7d_avg_score", "slo_compliance_rate",
                "anomaly_count", "critical_anomaly_count")
        .orderBy(F.desc("event_date"), "cluster_name")
    )


def anomaly_summary(log: DataFrame, as_of, days=7, shown=5) -> DataFrame:
    """Anomalies by day and severity with the first affected clusters. Clusters are counted
    first and ranked, so no task gathers all clusters of a group."""
    keys = ["event_date", "anomaly_severity"]
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    counts = log.where(F.col("event_date") >= since).groupBy(*keys, "cluster_name").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("anomaly_count"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("cluster_name"))
    first = counts.withColumn("_rank", rank).where(F.col("_rank") <= shown).groupBy(*keys).agg(
        F.array_sort(F.collect_list("cluster_name")).alias("affected_clusters"))
    return totals.join(first, keys).orderBy(F.desc("event_date"), "anomaly_severity")


def latest_critical(log: DataFrame, day, n=20) -> DataFrame:
    """The newest critical anomalies of a day."""
    hit = (F.col("event_date") == F.lit(day).cast("date")) & (F.col("anomaly_severity") == "critical")
    return log.where(hit).orderBy(F.desc("event_hour"), *SERIES).limit(n)


def critical_counts(log: DataFrame, as_of) -> DataFrame:
    """Critical anomalies of the day before and of the last hour."""
    now = F.lit(as_of).cast("timestamp")
    critical = F.col("anomaly_severity") == "critical"
    return log.agg(
        F.count_if(critical & (F.col("event_date") == F.date_sub(now.cast("date"), 1))).alias("critical_yesterday"),
        F.count_if(critical & (F.col("event_hour") >= now - F.expr("INTERVAL 1 HOUR"))).alias("critical_last_hour"),
    )
