"""Job telemetry: extraction, infrastructure impact, utilisation, correlation.

Functions that take `scan_date` cover one day when it is given, so that the scan prunes to
its partition, and every day at once when it is None.
"""
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.functions import pct_change, safe_divide
from opsloom.operators.baseline import scored_jobs, workload_baseline, workload_baseline_by_day
from opsloom.operators.cleansing import final_attempts
from opsloom.operators.interval import Overlaps, interval_counts, interval_sums
from opsloom.params import CLOCK_SKEW_SECONDS, CORRELATION_SECONDS, INFRA_EVENT_TYPES, JOB_ZSCORE_THRESHOLD
from opsloom.session import settled

SAME_DAY = [("execution_date", "event_date")]


def on_day(df: DataFrame, column: str, day) -> DataFrame:
    return df if day is None else df.where(F.col(column) == F.lit(day).cast("date"))


def deduplicated_jobs(jobs: DataFrame, scan_date=None) -> DataFrame:
    return final_attempts(on_day(jobs, "execution_date", scan_date), within=["execution_date"])


def resource_summary(logs: DataFrame, scan_date=None) -> DataFrame:
    """Resource use per job and day. A NULL cpu sample is a missed collection window."""
    missed = F.count_if(F.col("cpu_used_cores").isNull())
    return on_day(logs, "log_date", scan_date).groupBy("job_id", "log_date").agg(
        F.avg("cpu_used_cores").alias("avg_cpu_cores"),
        F.max("cpu_used_cores").alias("peak_cpu_cores"),
        F.max("memory_used_gb").alias("peak_memory_gb"),
        F.avg("gpu_utilisation_pct").alias("avg_gpu_utilisation_pct"),
        F.max("gpu_utilisation_pct").alias("peak_gpu_utilisation_pct"),
        F.sum("compute_cost_usd").alias("total_compute_cost_usd"),
        F.avg("cpu_throttle_pct").alias("avg_cpu_throttle_pct"),
        missed.alias("missed_collection_windows"),
        F.count(F.lit(1)).alias("total_collection_windows"),
        F.min("node_type").alias("node_type"),
    )


def missed_window_share(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        "missed_window_share", safe_divide("missed_collection_windows", "total_collection_windows"))


def infra_impact(jobs: DataFrame, events: DataFrame, tolerance=CLOCK_SKEW_SECONDS) -> DataFrame:
    """Infrastructure events of the same day inside each job's run, widened by the clock skew.

    Events of the documented types are summed along the line of time, one column per
    type. Events of any other type, should there be some, take the general path.
    """
    keys, run = ["job_id", "execution_date"], ("started_at", "completed_at", "event_timestamp")
    events = events.where(F.col("event_id").isNotNull())
    kind, critical = F.col("event_type"), F.col("severity") == "CRITICAL"
    known = F.coalesce(kind.isin(INFRA_EVENT_TYPES), F.lit(False))
    names = {t: f"_t{i}" for i, t in enumerate(INFRA_EVENT_TYPES)}
    sums = interval_sums(jobs, events.where(known), keys, *run, {
        "_critical": critical.cast("int"), **{n: (kind == t).cast("int") for t, n in names.items()},
    }, tolerance, tolerance, SAME_DAY)
    counted = F.expr(" + ".join(names.values()))
    types = F.filter(F.array(*[F.when(F.col(n) > 0, F.lit(t)) for t, n in names.items()]), lambda t: t.isNotNull())
    impact = sums.withColumns({"_all": counted, "_types": types})
    others = events.where(~known)
    if others.isEmpty():
        impact = impact.withColumns({"_more": F.lit(0), "_more_critical": F.lit(0), "_more_types": F.array().cast("array<string>")})
    else:
        rest = interval_counts(jobs, others, keys, *run, ["event_type", "severity"], tolerance, tolerance, SAME_DAY)
        rest = rest.groupBy(*keys, "event_type").agg(
            F.sum("n").alias("n"), F.sum(F.when(critical, F.col("n")).otherwise(0)).alias("c"),
        ).groupBy(*keys).agg(
            F.sum("n").alias("_more"), F.sum("c").alias("_more_critical"), F.collect_list("event_type").alias("_more_types"))
        impact = impact.join(rest, keys, "left")
    zero = F.lit(0)
    listed = F.sort_array(F.concat("_types", F.coalesce("_more_types", F.array().cast("array<string>"))))
    filled = ["overlapping_infra_events", "critical_infra_events", "preemption_events", "spot_interruptions",
              "quota_throttle_events"]
    impact = impact.select(
        *keys,
        (F.col("_all") + F.coalesce("_more", zero)).alias("overlapping_infra_events"),
        (F.col("_critical") + F.coalesce("_more_critical", zero)).alias("critical_infra_events"),
        F.col(names["NODE_PREEMPTION"]).alias("preemption_events"),
        F.col(names["SPOT_INTERRUPT"]).alias("spot_interruptions"),
        F.col(names["QUOTA_THROTTLE"]).alias("quota_throttle_events"),
        F.when(F.size(listed) > 0, F.array_join(listed, ", ")).alias("impacting_event_types"),
    )
    return jobs.select(*keys).join(impact, keys, "left").fillna(0, filled)


def jobs_with_zscore(jobs: DataFrame, scan_date=None, threshold=JOB_ZSCORE_THRESHOLD, unique=None) -> DataFrame:
    """Deduplicated jobs scored against the thirty days before their day."""
    baseline = workload_baseline_by_day(jobs) if scan_date is None else workload_baseline(jobs, scan_date)
    unique = deduplicated_jobs(jobs, scan_date) if unique is None else unique
    return scored_jobs(unique, baseline, threshold)


def extract_jobs(jobs: DataFrame, logs: DataFrame, events: DataFrame, as_of, scan_date=None) -> DataFrame:
    """Jobs with scores, resource use and infrastructure impact. Unordered: see `anomalies_first`."""
    unique = settled(deduplicated_jobs(jobs, scan_date))  # scored and matched with events
    scored = jobs_with_zscore(jobs, scan_date, unique=unique)
    impact = infra_impact(unique, on_day(events, "event_date", scan_date))
    resources = resource_summary(logs, scan_date).withColumnRenamed("log_date", "execution_date")
    return (
        scored.join(resources, ["job_id", "execution_date"], "left").join(impact, ["job_id", "execution_date"], "left")
        .withColumn("extracted_at", F.lit(as_of).cast("timestamp"))
    )


def anomalies_first(extracted: DataFrame) -> DataFrame:
    """The order of presentation. Not part of the extraction, as it shuffles every row."""
    return extracted.orderBy(F.desc("is_duration_anomaly"), F.desc_nulls_last(F.abs("duration_z_score")))


def anomalous_jobs(scored: DataFrame, threshold=JOB_ZSCORE_THRESHOLD) -> DataFrame:
    """Successful jobs that ran unusually long."""
    return scored.where(
        (F.col("status") == "SUCCESS") & F.col("duration_seconds").isNotNull() & (F.col("duration_z_score") > threshold)
    ).withColumn("start_hour", F.hour("started_at"))


def overlap_summary(jobs: DataFrame, events: DataFrame, groups, tolerance, match=()) -> DataFrame:
    """Per group of events: jobs whose run contains one, events inside any run, and the
    mean z over all overlaps, from counts per job and group.

    A job that has one run only is counted where its overlaps are found; only jobs of several runs are told apart by a shuffle.
    """
    keys = ["job_id", "execution_date", "duration_z_score"]
    runs = F.struct("execution_date", "duration_z_score")
    once = jobs.groupBy("job_id").agg((F.min(runs) == F.max(runs)).alias("_once"))
    jobs = jobs.select(*keys, "started_at", "completed_at").join(once, "job_id", "left").withColumn("_once", F.coalesce("_once", F.lit(False)))
    overlaps = Overlaps(jobs, events, [*keys, "_once"], "started_at", "completed_at", "event_timestamp",
                        groups, tolerance, tolerance, match, ids="event_id")
    per_group = overlaps.counts().groupBy(*groups).agg(
        (F.count_if("_once") + F.count_distinct(F.when(~F.col("_once"), F.col("job_id")))).alias("affected_anomalous_jobs"),
        F.try_divide(F.sum(F.col("duration_z_score") * F.col("n")), F.sum("n")).alias("avg_anomaly_zscore"),
    )
    inside = overlaps.covered().groupBy(*groups).agg(F.count_distinct("event_id").alias("event_count"))
    return per_group.join(inside, list(groups))


def overlapping_events(jobs: DataFrame, events: DataFrame, tolerance=CORRELATION_SECONDS) -> DataFrame:
    with_hour = events.withColumn("event_hour", F.hour("event_timestamp"))
    return overlap_summary(jobs, with_hour, ["event_type", "severity", "affected_zone", "event_hour"], tolerance, SAME_DAY)


def throttle_overlap(jobs: DataFrame, events: DataFrame, event_type="QUOTA_THROTTLE") -> DataFrame:
    """Events of one type inside anomalous runs, without tolerance."""
    return overlap_summary(jobs, events.where(F.col("event_type") == event_type), ["event_type"], 0)


def hourly_pattern(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("start_hour").agg(
        F.count_distinct("job_id").alias("anomalous_job_count"),
        F.avg("duration_z_score").alias("avg_z_score"),
        F.avg("duration_seconds").alias("avg_duration_s"),
    )


def event_correlation(jobs: DataFrame, events: DataFrame, tolerance=CORRELATION_SECONDS) -> DataFrame:
    """Events around anomalous runs next to the anomalies that started in the same hour of day."""
    jobs = settled(jobs)
    hours = hourly_pattern(jobs).withColumnRenamed("start_hour", "event_hour")
    return (
        overlapping_events(jobs, events, tolerance)
        .join(F.broadcast(hours), "event_hour")  # at most 24 rows
        .orderBy(F.desc("affected_anomalous_jobs"), F.desc("avg_anomaly_zscore"))
    )


USAGE_KEYS = ["summary_date", "workload_type", "team", "cloud_provider", "environment", "node_type"]


def daily_resource_summary(logs: DataFrame, jobs: DataFrame, scan_date=None, lookback_days=30) -> DataFrame:
    """Utilisation per day and workload.

    Samples are first reduced to sums per job, day and node type, so the join and the
    second aggregation handle one row per job instead of one per sample.
    """
    if scan_date is not None:
        day = F.lit(scan_date).cast("date")
        logs = logs.where(F.col("log_date").between(F.date_sub(day, lookback_days), day))
        jobs = jobs.where(F.col("execution_date").between(F.date_sub(day, lookback_days), day))
    means = {
        "avg_cpu_used": F.col("cpu_used_cores"),
        "avg_cpu_requested": F.col("cpu_requested_cores"),
        "avg_cpu_efficiency": safe_divide("cpu_used_cores", "cpu_requested_cores"),
        "avg_cpu_throttle_pct": F.col("cpu_throttle_pct"),
        "avg_memory_used_gb": F.col("memory_used_gb"),
        "avg_memory_pressure": safe_divide("memory_used_gb", "memory_limit_gb"),
        "avg_gpu_utilisation_pct": F.col("gpu_utilisation_pct"),
        "avg_gpu_memory_used_gb": F.col("gpu_memory_used_gb"),
    }
    per_job = logs.where(F.col("cpu_used_cores").isNotNull()).groupBy(
        "job_id", F.to_date("collected_at").alias("summary_date"), "node_type",
    ).agg(
        *[F.sum(c).alias(f"_s_{name}") for name, c in means.items()],
        *[F.count(c).alias(f"_n_{name}") for name, c in means.items()],
        F.max("memory_used_gb").alias("_peak"),
        F.sum("compute_cost_usd").alias("_cost"),
        F.count(F.lit(1)).alias("_samples"),
    )
    owners = jobs.select("job_id", F.col("execution_date").alias("summary_date"), "workload_type", "team",
                         "cloud_provider", "environment")
    return per_job.join(owners, ["job_id", "summary_date"]).groupBy(*USAGE_KEYS).agg(
        *[F.try_divide(F.sum(f"_s_{name}"), F.sum(f"_n_{name}")).alias(name) for name in means],
        F.max("_peak").alias("peak_memory_used_gb"),
        F.sum("_cost").alias("daily_compute_cost_usd"),
        F.count_distinct("job_id").alias("distinct_jobs"),
        F.sum("_samples").alias("sample_count"),
    )


def resource_utilisation(logs: DataFrame, jobs: DataFrame, scan_date=None, lookback_days=30) -> DataFrame:
    """Daily utilisation with the cost change against the previous day of the same series."""
    w = Window.partitionBy(*USAGE_KEYS[1:]).orderBy("summary_date")
    cost = F.col("daily_compute_cost_usd").cast("double")
    trend = (
        daily_resource_summary(logs, jobs, scan_date, lookback_days)
        .withColumn("daily_compute_cost_usd", cost)
        .withColumn("prev_day_cost_usd", F.lag("daily_compute_cost_usd").over(w))
        .withColumn("cost_change_pct", pct_change("daily_compute_cost_usd", "prev_day_cost_usd") * 100)
    )
    return on_day(trend, "summary_date", scan_date).orderBy(F.desc("daily_compute_cost_usd"), "workload_type", "team")


def contention_comparison(scored: DataFrame, hours, threshold=JOB_ZSCORE_THRESHOLD) -> DataFrame:
    """Long runs started in some hours of day: observed against baseline duration, per type."""
    first, last = hours
    hit = anomalous_jobs(scored, threshold).where(F.col("start_hour").between(first, last))
    daily = hit.groupBy("workload_type", "execution_date").agg(
        F.count(F.lit(1)).alias("_jobs"),
        F.sum("duration_seconds").alias("_duration"),
        F.sum("baseline_mean_duration_s").alias("_baseline"),
        F.sum("duration_z_score").alias("_z"),
    )
    observed, baseline = F.sum("_duration") / F.sum("_jobs"), F.sum("_baseline") / F.sum("_jobs")
    return daily.groupBy("workload_type").agg(
        F.sum("_jobs").alias("affected_jobs"),
        observed.alias("observed_mean_duration_s"),
        baseline.alias("baseline_mean_duration_s"),
        (F.try_divide(observed - baseline, baseline) * 100).alias("deviation_pct"),
        (F.sum("_z") / F.sum("_jobs")).alias("avg_z_score"),
        F.min("_jobs").alias("min_jobs_per_day"),
        F.max("_jobs").alias("max_jobs_per_day"),
    )


def throttle_comparison(logs: DataFrame, jobs: DataFrame, hours) -> DataFrame:
    """Mean cpu throttling of each workload type inside and outside some hours of day."""
    first, last = hours
    inside = F.hour("collected_at").between(first, last)
    per_job = logs.groupBy("job_id", F.to_date("collected_at").alias("execution_date")).agg(
        F.sum(F.when(inside, F.col("cpu_throttle_pct"))).alias("_in"),
        F.count(F.when(inside, F.col("cpu_throttle_pct"))).alias("_nin"),
        F.sum(F.when(~inside, F.col("cpu_throttle_pct"))).alias("_out"),
        F.count(F.when(~inside, F.col("cpu_throttle_pct"))).alias("_nout"),
    )
    return per_job.join(jobs.select("job_id", "execution_date", "workload_type"), ["job_id", "execution_date"]).groupBy(
        "workload_type",
    ).agg(
        F.try_divide(F.sum("_in"), F.sum("_nin")).alias("throttle_pct_inside"),
        F.try_divide(F.sum("_out"), F.sum("_nout")).alias("throttle_pct_outside"),
    )
