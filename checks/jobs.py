"""Job telemetry queries: cleansing, baselines, extraction, correlation, utilisation."""
from checks import fleet as fleet_checks
from checks.registry import div, oracle, query, rnd
from opsloom.functions import rolling_zscore, zscore
from opsloom.operators import baseline, cleansing, staging
from opsloom.operators.interval import interval_counts
from opsloom.operators.ordered import positions, rolling_stats
from opsloom.plans import fleet, workloads
from opsloom.sources.adapters import EVENTS_AS_OF
from pyspark.sql import functions as F

# ---------------------------------------------------------------- cleansing

STEP1 = """prepared AS (
    SELECT *, coalesce(duration_seconds, (epoch_us(completed_at) - epoch_us(started_at)) / 1000000.0::DOUBLE) AS raw_duration
    FROM job_metadata WHERE job_id IS NOT NULL AND workload_type IS NOT NULL AND status IS NOT NULL AND submitted_at IS NOT NULL)"""
STEP2 = """derived AS (
    SELECT * EXCLUDE (raw_duration) REPLACE (CASE WHEN raw_duration >= 0 THEN raw_duration END AS duration_seconds) FROM prepared)"""
STEP3 = """uniq AS (
    SELECT *, coalesce(parent_job_id, job_id) AS canonical_job_id FROM derived
    QUALIFY row_number() OVER (PARTITION BY coalesce(parent_job_id, job_id)
                               ORDER BY retry_attempt DESC NULLS LAST, ingested_at DESC NULLS LAST, job_id) = 1)"""
RES = ["cpu_used_cores", "memory_used_gb", "gpu_utilisation_pct"]
MEDIANS = "medians AS (SELECT workload_type, " + ", ".join(f"median({c}) AS m_{c}" for c in RES) + " FROM uniq GROUP BY 1)"
TYPED = ("typed AS (SELECT u.* REPLACE (" + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in RES)
         + ") FROM uniq u LEFT JOIN medians USING (workload_type))")
OVERALL = "overall AS (SELECT " + ", ".join(f"median({c}) AS g_{c}" for c in RES) + " FROM typed)"
IMPUTED = ("imputed AS (SELECT t.* REPLACE (" + ", ".join(f"coalesce({c}, g_{c}) AS {c}" for c in RES)
           + ") FROM typed t CROSS JOIN overall)")
CLEAN = """clean AS (
    SELECT *, status = 'SUCCESS' AS is_success, status = 'FAILURE' AS is_failure,
           CASE WHEN duration_seconds IS NULL THEN 'unknown' WHEN duration_seconds < 60 THEN '<1m' WHEN duration_seconds < 300 THEN '1-5m'
                WHEN duration_seconds < 900 THEN '5-15m' WHEN duration_seconds < 3600 THEN '15-60m' ELSE '>60m' END AS duration_bucket
    FROM imputed WHERE status IN ('SUCCESS', 'FAILURE', 'TIMEOUT', 'CANCELLED', 'RETRYING')
      AND workload_type IN ('model_training', 'inference', 'data_processing', 'fine_tuning'))"""
STEPS = ["job_metadata", STEP1, STEP2, STEP3]
CLEANSED = [*STEPS, MEDIANS, TYPED, OVERALL, IMPUTED, CLEAN]
KEYS = ["job_id", "canonical_job_id", "workload_type", "status", "retry_attempt"]


def prepared(t):
    return cleansing.normalise_timestamps(cleansing.with_identity(t.job_metadata))


def unique(t):
    return cleansing.final_attempts(cleansing.derive_duration(prepared(t)))


@query("P08_required_identity", oracle("SELECT job_id, workload_type, status FROM prepared", *STEPS))
def p08(t):
    return cleansing.with_identity(t.job_metadata).select("job_id", "workload_type", "status")


@query("P09_normalise_timestamps", oracle(
    """SELECT job_id, submitted_at, CASE CAST(job_id AS BIGINT) % 7 WHEN 0 THEN NULL ELSE date_trunc('second', started_at) END AS started_at
       FROM job_metadata""", "job_metadata", t="submitted_at started_at"))
def p09(t):
    text = F.when(F.col("job_id").cast("bigint") % 7 == 0, "not a time").otherwise(
        F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return cleansing.normalise_timestamps(t.job_metadata.withColumn("started_at", text)).select(
        "job_id", "submitted_at", "started_at")


@query("P10_derive_duration", oracle("SELECT job_id, duration_seconds FROM derived", *STEPS, f="duration_seconds"))
def p10(t):
    return cleansing.derive_duration(prepared(t)).select("job_id", "duration_seconds")


@query("P11_canonical_id", oracle("SELECT job_id, coalesce(parent_job_id, job_id) AS canonical_job_id FROM job_metadata", "job_metadata"))
def p11(t):
    df = t.job_metadata
    return df.select("job_id", cleansing.canonical_id(df).alias("canonical_job_id"))


@query("W01_final_attempts", oracle(f"SELECT {', '.join(KEYS)} FROM uniq", *STEPS))
def w01(t):
    return unique(t).select(*KEYS)


@query("P12_impute_resources", oracle(f"SELECT job_id, {', '.join(RES)} FROM imputed", *CLEANSED, f=" ".join(RES)))
def p12(t):
    return cleansing.impute_resources(unique(t)).select("job_id", *RES)


@query("W13_type_median", oracle(
    "SELECT u.job_id, m_memory_used_gb AS type_median FROM uniq u JOIN medians USING (workload_type)", *CLEANSED, f="type_median"))
def w13(t):
    from opsloom.operators.lookup import lookup_join
    from opsloom.operators.ordered import exact_percentiles
    u = unique(t)
    medians = exact_percentiles(u, ["workload_type"], "memory_used_gb", {"type_median": 0.5}).drop("n_values")
    return lookup_join(u, medians, ["workload_type"]).select("job_id", "type_median")


@query("P13_valid_enums", oracle("SELECT job_id, status, workload_type FROM clean", *CLEANSED))
def p13(t):
    return unique(t).where(cleansing.valid_enums()).select("job_id", "status", "workload_type")


@query("P15_flags_and_buckets", oracle(
    "SELECT job_id, duration_seconds, is_success, is_failure, duration_bucket FROM clean", *CLEANSED, f="duration_seconds"))
def p15(t):
    return cleansing.with_flags(unique(t).where(cleansing.valid_enums())).select(
        "job_id", "duration_seconds", "is_success", "is_failure", "duration_bucket")


@query("P16_clean_jobs", oracle(
    f"SELECT {', '.join(KEYS)}, duration_seconds, {', '.join(RES)}, submitted_at, duration_bucket, is_success FROM clean",
    *CLEANSED, f="duration_seconds " + " ".join(RES), t="submitted_at"))
def p16(t):
    return cleansing.clean(t.job_metadata).select(
        *KEYS, "duration_seconds", *RES, "submitted_at", "duration_bucket", "is_success")


@query("Q25_cleansing_report", oracle(
    """SELECT (SELECT count(*) FROM job_metadata) AS input_rows,
              (SELECT count(*) FROM job_metadata) - (SELECT count(*) FROM prepared) AS dropped_missing_required,
              (SELECT count(*) FROM prepared WHERE raw_duration < 0) AS timestamp_skew_corrections,
              (SELECT count(*) FROM prepared) - (SELECT count(*) FROM uniq) AS duplicate_retry_records_removed,
              (SELECT count(*) FILTER (cpu_used_cores IS NULL) + count(*) FILTER (memory_used_gb IS NULL)
                      + count(*) FILTER (gpu_utilisation_pct IS NULL) FROM uniq) AS null_values_imputed,
              (SELECT count(*) FROM uniq) - (SELECT count(*) FROM clean) AS invalid_enum_rows_dropped,
              (SELECT count(*) FROM clean) AS output_rows,
              (SELECT count(*) FROM job_metadata) - (SELECT count(*) FROM clean) AS rows_dropped""", *CLEANSED))
def q25(t):
    return cleansing.cleansing_report(t.job_metadata)


# ---------------------------------------------------------------- baselines and detection

BASELINE = """baseline AS (
    SELECT workload_type, avg(duration_seconds) AS baseline_mean_duration_s, stddev_pop(duration_seconds) AS baseline_stddev_duration_s,
           avg(CASE WHEN status = 'FAILURE' THEN 1.0 ELSE 0.0 END) AS baseline_failure_rate, count(*) AS baseline_sample_count
    FROM job_metadata WHERE execution_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND status IN ('SUCCESS', 'FAILURE')
      AND retry_attempt = 0 GROUP BY 1 HAVING count(*) >= 30)"""
BY_DAY = """by_day AS (
    SELECT d.workload_type, d.execution_date, avg(duration_seconds) AS baseline_mean_duration_s,
           stddev_pop(duration_seconds) AS baseline_stddev_duration_s,
           avg(CASE WHEN status = 'FAILURE' THEN 1.0 ELSE 0.0 END) AS baseline_failure_rate, count(*) AS baseline_sample_count
    FROM (SELECT DISTINCT workload_type, execution_date FROM job_metadata) d
    JOIN (SELECT * FROM job_metadata WHERE status IN ('SUCCESS', 'FAILURE') AND retry_attempt = 0) j
      ON j.workload_type = d.workload_type AND j.execution_date BETWEEN d.execution_date - 30 AND d.execution_date - 1
    GROUP BY 1, 2 HAVING count(*) >= 30)"""
BASELINE_F = "baseline_mean_duration_s baseline_stddev_duration_s baseline_failure_rate"


@query("A16_workload_baseline", oracle("SELECT * FROM baseline", "job_metadata", BASELINE, f=BASELINE_F))
def a16(t):
    return baseline.workload_baseline(t.job_metadata, "2024-01-31")


@query("A16_workload_baseline_by_day", oracle("SELECT * FROM by_day", "job_metadata", BY_DAY, d="execution_date", f=BASELINE_F))
def a16d(t):
    return baseline.workload_baseline_by_day(t.job_metadata)


@query("A17_duration_baseline", oracle(
    f"""SELECT b.workload_type, {rnd('mean_s', 4)} AS baseline_mean_duration_s, {rnd('std_s', 4)} AS baseline_stddev_duration_s,
              {rnd('median_s', 4)} AS baseline_median_duration_s, {rnd('p95_s', 4)} AS baseline_p95_duration_s,
              {rnd('p99_s', 4)} AS baseline_p99_duration_s, {rnd('rate', 4)} AS baseline_failure_rate, sample_count,
              '2024-01-01' AS window_start, '2024-01-31' AS window_end, 30 AS window_days
       FROM (SELECT workload_type, avg(duration_seconds) AS mean_s, stddev_samp(duration_seconds) AS std_s, median(duration_seconds) AS median_s,
                    quantile_cont(duration_seconds, 0.95) AS p95_s, quantile_cont(duration_seconds, 0.99) AS p99_s,
                    count(duration_seconds) AS sample_count
             FROM job_metadata WHERE status = 'SUCCESS' AND retry_attempt = 0 AND execution_date >= DATE '2024-01-01'
               AND execution_date < DATE '2024-01-31' GROUP BY 1 HAVING count(duration_seconds) >= 30) b
       LEFT JOIN (SELECT workload_type, avg(CASE WHEN status = 'FAILURE' THEN 1.0::DOUBLE ELSE 0 END) AS rate FROM job_metadata
                  WHERE execution_date >= DATE '2024-01-01' AND execution_date < DATE '2024-01-31' GROUP BY 1) r USING (workload_type)""",
    "job_metadata", i="window_days",
    f=BASELINE_F + " baseline_median_duration_s baseline_p95_duration_s baseline_p99_duration_s"))
def a17(t):
    return baseline.duration_baseline(t.job_metadata, "2024-01-31")


STATS = """stats AS (
    SELECT workload_type, avg(duration_seconds) AS baseline_mean, stddev_samp(duration_seconds) AS baseline_std,
           median(duration_seconds) AS baseline_median, quantile_cont(duration_seconds, 0.95) AS baseline_p95,
           count(duration_seconds) AS baseline_count
    FROM clean WHERE status = 'SUCCESS' AND retry_attempt = 0 GROUP BY 1 HAVING count(duration_seconds) >= 30)"""
SCORED = """scored AS (
    SELECT *, abs_z_score > 2 AND abs_z_score IS NOT NULL AS is_anomaly,
           CASE WHEN abs_z_score < 2 THEN 'NORMAL' WHEN abs_z_score < 3 THEN 'MEDIUM' WHEN abs_z_score < 4 THEN 'HIGH'
                WHEN abs_z_score IS NOT NULL THEN 'CRITICAL' END AS anomaly_severity
    FROM (SELECT c.job_id, c.workload_type, c.status, c.team, c.duration_seconds, s.* EXCLUDE (workload_type),
                 CASE WHEN baseline_std > 0 THEN (duration_seconds - baseline_mean) / baseline_std END AS z_score,
                 abs(z_score) AS abs_z_score,
                 CASE WHEN baseline_mean > 0 THEN (duration_seconds - baseline_mean) / baseline_mean * 100 END AS deviation_pct
          FROM clean c LEFT JOIN stats s USING (workload_type)))"""
DETECT = [*CLEANSED, STATS, SCORED]
STATS_F = "baseline_mean baseline_std baseline_median baseline_p95"
SCORED_COLS = ("job_id, workload_type, status, team, duration_seconds, baseline_mean, baseline_std, z_score, abs_z_score, "
               "deviation_pct, is_anomaly, anomaly_severity")
SCORED_F = "duration_seconds baseline_mean baseline_std z_score abs_z_score deviation_pct"


def clean_scored(t):
    c = cleansing.clean(t.job_metadata)
    return baseline.score_against(c, baseline.detector_baseline(c))


@query("A18_detector_baseline", oracle("SELECT * FROM stats", *DETECT, f=STATS_F))
def a18(t):
    return baseline.detector_baseline(cleansing.clean(t.job_metadata))


@query("J02_score_against_baseline", oracle(f"SELECT {SCORED_COLS} FROM scored", *DETECT, f=SCORED_F))
def j02(t):
    return clean_scored(t).select(*SCORED_COLS.split(", "))


@query("D01_detect", oracle(f"SELECT {SCORED_COLS} FROM scored WHERE is_anomaly", *DETECT, f=SCORED_F))
def d01(t):
    return baseline.detect(cleansing.clean(t.job_metadata)).select(*SCORED_COLS.split(", "))


@query("A27_anomalies_by_type", oracle(
    f"""SELECT workload_type, count(job_id) AS count, {rnd('avg(deviation_pct)', 2)} AS avg_deviation_pct,
              {rnd('max(abs_z_score)', 2)} AS max_z_score FROM scored WHERE is_anomaly GROUP BY 1""",
    *DETECT, f="avg_deviation_pct max_z_score"))
def a27(t):
    return baseline.anomalies_by_type(clean_scored(t).where("is_anomaly"))


@query("A27_anomaly_rate", oracle(
    f"""SELECT count(*) AS total_jobs, count(*) FILTER (is_anomaly) AS anomalous_jobs,
              {rnd('count(*) FILTER (is_anomaly)::DOUBLE / count(*)', 4)} AS anomaly_rate, 2.0::DOUBLE AS z_threshold_used FROM scored""",
    *DETECT, f="anomaly_rate z_threshold_used"))
def a27r(t):
    return baseline.anomaly_rate(clean_scored(t))


@query("O02_top_anomalies", oracle(
    """SELECT job_id, workload_type, z_score, deviation_pct, duration_seconds, status, team FROM scored WHERE is_anomaly
       ORDER BY abs_z_score DESC, job_id LIMIT 10""", *DETECT, f="z_score deviation_pct duration_seconds"))
def o02(t):
    return baseline.top_anomalies(clean_scored(t).where("is_anomaly"))


@query("W12_zscore_by", oracle(
    """SELECT job_id, (memory_used_gb - avg(memory_used_gb) OVER w) / NULLIF(stddev_pop(memory_used_gb) OVER w, 0) AS z_score
       FROM job_metadata WINDOW w AS (PARTITION BY workload_type, environment)""", "job_metadata", f="z_score"))
def w12(t):
    return baseline.zscore_by(t.job_metadata, ["workload_type", "environment"], "memory_used_gb").select("job_id", "z_score")


@query("W10_rolling_zscore", oracle(
    """SELECT job_id, avg(duration_seconds) OVER w AS rolling_mean, stddev_pop(duration_seconds) OVER w AS rolling_std,
              (duration_seconds - avg(duration_seconds) OVER w) / CASE WHEN stddev_pop(duration_seconds) OVER w > 1e-9 THEN stddev_pop(duration_seconds) OVER w END AS z_score
       FROM job_metadata WHERE status = 'SUCCESS' AND duration_seconds IS NOT NULL
       WINDOW w AS (PARTITION BY workload_type ORDER BY execution_date, started_at, job_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
    "job_metadata", f="rolling_mean rolling_std z_score"))
def w10(t):
    jobs = t.job_metadata.where("status = 'SUCCESS' AND duration_seconds IS NOT NULL").select(
        "job_id", "workload_type", "execution_date", "started_at", "duration_seconds")
    placed = positions(jobs, ["workload_type"], ["execution_date", "started_at", "job_id"])
    return rolling_stats(placed, ["workload_type"], "duration_seconds", 30).select(
        "job_id", "rolling_mean", "rolling_std", "z_score")


# ---------------------------------------------------------------- extraction

UNIQUE_DAY = """unique_day AS (
    SELECT *, coalesce(parent_job_id, job_id) AS canonical_job_id FROM job_metadata
    QUALIFY row_number() OVER (PARTITION BY execution_date, coalesce(parent_job_id, job_id)
                               ORDER BY retry_attempt DESC, ingested_at DESC, job_id) = 1)"""
ZSCORED = """zscored AS (
    SELECT u.*, b.* EXCLUDE (workload_type, execution_date),
           (duration_seconds - baseline_mean_duration_s) / NULLIF(baseline_stddev_duration_s, 0) AS duration_z_score,
           coalesce(baseline_stddev_duration_s > 0 AND abs((duration_seconds - baseline_mean_duration_s) / NULLIF(baseline_stddev_duration_s, 0)) > 2, false) AS is_duration_anomaly
    FROM unique_day u LEFT JOIN by_day b USING (workload_type, execution_date))"""
RESOURCES = """resources AS (
    SELECT job_id, log_date, avg(cpu_used_cores) AS avg_cpu_cores, max(cpu_used_cores) AS peak_cpu_cores, max(memory_used_gb) AS peak_memory_gb,
           avg(gpu_utilisation_pct) AS avg_gpu_utilisation_pct, max(gpu_utilisation_pct) AS peak_gpu_utilisation_pct,
           sum(compute_cost_usd) AS total_compute_cost_usd, avg(cpu_throttle_pct) AS avg_cpu_throttle_pct,
           count(*) FILTER (cpu_used_cores IS NULL) AS missed_collection_windows, count(*) AS total_collection_windows, min(node_type) AS node_type
    FROM resource_allocation_logs GROUP BY 1, 2)"""
IMPACT = """impact AS (
    SELECT u.job_id, u.execution_date, count(e.event_id) AS overlapping_infra_events,
           count(*) FILTER (e.severity = 'CRITICAL') AS critical_infra_events, count(*) FILTER (e.event_type = 'NODE_PREEMPTION') AS preemption_events,
           count(*) FILTER (e.event_type = 'SPOT_INTERRUPT') AS spot_interruptions, count(*) FILTER (e.event_type = 'QUOTA_THROTTLE') AS quota_throttle_events,
           string_agg(DISTINCT e.event_type, ', ' ORDER BY e.event_type) AS impacting_event_types
    FROM unique_day u LEFT JOIN infrastructure_events e ON e.event_date = u.execution_date
      AND e.event_timestamp BETWEEN u.started_at - INTERVAL 30 SECOND AND u.completed_at + INTERVAL 30 SECOND
    GROUP BY 1, 2)"""
EXTRACT = ["job_metadata", "resource_allocation_logs", "infrastructure_events", BY_DAY, UNIQUE_DAY, ZSCORED, RESOURCES, IMPACT]
RES_COLS = ("avg_cpu_cores, peak_cpu_cores, peak_memory_gb, avg_gpu_utilisation_pct, peak_gpu_utilisation_pct, total_compute_cost_usd, "
            "avg_cpu_throttle_pct, missed_collection_windows, total_collection_windows, node_type")
RES_F = "avg_cpu_cores peak_cpu_cores peak_memory_gb avg_gpu_utilisation_pct peak_gpu_utilisation_pct total_compute_cost_usd avg_cpu_throttle_pct"
IMP_COLS = ("overlapping_infra_events, critical_infra_events, preemption_events, spot_interruptions, quota_throttle_events, "
            "impacting_event_types")
Z_COLS = ("baseline_mean_duration_s, baseline_stddev_duration_s, baseline_failure_rate, baseline_sample_count, duration_z_score, "
          "is_duration_anomaly")


@query("D02_jobs_with_zscore", oracle(
    f"SELECT job_id, canonical_job_id, workload_type, execution_date, duration_seconds, {Z_COLS} FROM zscored", *EXTRACT,
    d="execution_date", f=BASELINE_F + " duration_seconds duration_z_score"))
def d02(t):
    return workloads.jobs_with_zscore(t.job_metadata).select(
        "job_id", "canonical_job_id", "workload_type", "execution_date", "duration_seconds", *Z_COLS.split(", "))


@query("A14_resource_summary", oracle("SELECT * FROM resources", *EXTRACT, d="log_date", f=RES_F))
def a14(t):
    return workloads.resource_summary(t.resource_allocation_logs)


@query("A29_missed_window_share", oracle(
    """SELECT job_id, log_date, missed_collection_windows, total_collection_windows,
              missed_collection_windows::DOUBLE / total_collection_windows AS missed_window_share FROM resources""",
    *EXTRACT, d="log_date", f="missed_window_share"))
def a29(t):
    return workloads.missed_window_share(workloads.resource_summary(t.resource_allocation_logs)).select(
        "job_id", "log_date", "missed_collection_windows", "total_collection_windows", "missed_window_share")


@query("J03_overlap_counts", oracle(
    """SELECT u.job_id, e.event_type, e.severity, count(*) AS n FROM job_metadata u JOIN infrastructure_events e
         ON e.event_date = u.execution_date
        AND e.event_timestamp BETWEEN u.started_at - INTERVAL 30 SECOND AND u.completed_at + INTERVAL 30 SECOND GROUP BY 1, 2, 3""",
    "job_metadata", "infrastructure_events"))
def j03(t):
    return interval_counts(t.job_metadata, t.infrastructure_events, ["job_id"], "started_at", "completed_at",
                           "event_timestamp", ["event_type", "severity"], 30, 30, match=workloads.SAME_DAY)


@query("A15_infra_impact", oracle("SELECT * FROM impact", *EXTRACT, d="execution_date"))
def a15(t):
    return workloads.infra_impact(workloads.deduplicated_jobs(t.job_metadata), t.infrastructure_events)


@query("P17_extract_jobs", oracle(
    f"""SELECT z.job_id, z.canonical_job_id, z.job_name, z.workload_type, z.team, z.execution_date, z.duration_seconds, z.status, {Z_COLS},
               {RES_COLS}, {IMP_COLS}, TIMESTAMP '2024-01-31 00:00:00' AS extracted_at
        FROM zscored z LEFT JOIN resources r ON r.job_id = z.job_id AND r.log_date = z.execution_date
        LEFT JOIN impact i ON i.job_id = z.job_id AND i.execution_date = z.execution_date""",
    *EXTRACT, d="execution_date", t="extracted_at", f=BASELINE_F + " duration_seconds duration_z_score " + RES_F))
def p17(t):
    out = workloads.extract_jobs(t.job_metadata, t.resource_allocation_logs, t.infrastructure_events, EVENTS_AS_OF)
    return out.select("job_id", "canonical_job_id", "job_name", "workload_type", "team", "execution_date", "duration_seconds", "status",
                      *Z_COLS.split(", "), *RES_COLS.split(", "), *IMP_COLS.split(", "), "extracted_at")


# ---------------------------------------------------------------- correlation

LONG = """long_jobs AS (
    SELECT *, hour(started_at) AS start_hour FROM zscored
    WHERE status = 'SUCCESS' AND duration_seconds IS NOT NULL AND duration_z_score > 2)"""
OVERLAP = """overlap AS (
    SELECT e.event_type, e.severity, e.affected_zone, hour(e.event_timestamp) AS event_hour,
           count(DISTINCT a.job_id) AS affected_anomalous_jobs, count(DISTINCT e.event_id) AS event_count,
           avg(a.duration_z_score) AS avg_anomaly_zscore
    FROM long_jobs a JOIN infrastructure_events e ON e.event_date = a.execution_date
      AND e.event_timestamp BETWEEN a.started_at - INTERVAL 5 MINUTE AND a.completed_at + INTERVAL 5 MINUTE
    GROUP BY 1, 2, 3, 4)"""
PATTERN = """pattern AS (
    SELECT start_hour, count(DISTINCT job_id) AS anomalous_job_count, avg(duration_z_score) AS avg_z_score,
           avg(duration_seconds) AS avg_duration_s FROM long_jobs GROUP BY 1)"""
CORRELATE = [*EXTRACT, LONG, OVERLAP, PATTERN]


def long_jobs(t):
    return workloads.anomalous_jobs(workloads.jobs_with_zscore(t.job_metadata))


@query("A19_overlapping_events", oracle("SELECT * FROM overlap", *CORRELATE, f="avg_anomaly_zscore", i="event_hour"))
def a19(t):
    return workloads.overlapping_events(long_jobs(t), t.infrastructure_events)


@query("A20_hourly_pattern", oracle("SELECT * FROM pattern", *CORRELATE, f="avg_z_score avg_duration_s", i="start_hour"))
def a20(t):
    return workloads.hourly_pattern(long_jobs(t))


@query("D06_event_correlation", oracle(
    """SELECT o.*, p.anomalous_job_count, p.avg_z_score, p.avg_duration_s FROM overlap o JOIN pattern p ON p.start_hour = o.event_hour""",
    *CORRELATE, f="avg_anomaly_zscore avg_z_score avg_duration_s", i="event_hour"))
def d06(t):
    return workloads.event_correlation(long_jobs(t), t.infrastructure_events)


@query("J12_throttle_overlap", oracle(
    """SELECT e.event_type, count(DISTINCT a.job_id) AS affected_anomalous_jobs, avg(a.duration_z_score) AS avg_anomaly_zscore,
              count(DISTINCT e.event_id) AS event_count
       FROM long_jobs a JOIN infrastructure_events e ON e.event_timestamp BETWEEN a.started_at AND a.completed_at
        AND e.event_type = 'QUOTA_THROTTLE' GROUP BY 1""", *CORRELATE, f="avg_anomaly_zscore"))
def j12(t):
    return workloads.throttle_overlap(long_jobs(t), t.infrastructure_events)


@query("D07_contention_comparison", oracle(
    """SELECT workload_type, sum(n) AS affected_jobs, sum(d) / sum(n) AS observed_mean_duration_s, sum(b) / sum(n) AS baseline_mean_duration_s,
              (sum(d) / sum(n) - sum(b) / sum(n)) / (sum(b) / sum(n)) * 100 AS deviation_pct, sum(z) / sum(n) AS avg_z_score,
              min(n) AS min_jobs_per_day, max(n) AS max_jobs_per_day
       FROM (SELECT workload_type, execution_date, count(*) AS n, sum(duration_seconds) AS d, sum(baseline_mean_duration_s) AS b,
                    sum(duration_z_score) AS z FROM long_jobs WHERE start_hour BETWEEN 8 AND 10 GROUP BY 1, 2) GROUP BY 1""",
    *CORRELATE, f="observed_mean_duration_s baseline_mean_duration_s deviation_pct avg_z_score", i="affected_jobs"))
def d07(t):
    return workloads.contention_comparison(workloads.jobs_with_zscore(t.job_metadata), (8, 10))


@query("D07_throttle_comparison", oracle(
    """SELECT j.workload_type, avg(cpu_throttle_pct) FILTER (hour(collected_at) BETWEEN 8 AND 10) AS throttle_pct_inside,
              avg(cpu_throttle_pct) FILTER (hour(collected_at) NOT BETWEEN 8 AND 10) AS throttle_pct_outside
       FROM resource_allocation_logs r JOIN job_metadata j ON j.job_id = r.job_id AND j.execution_date = CAST(r.collected_at AS DATE)
       GROUP BY 1""", *CORRELATE, f="throttle_pct_inside throttle_pct_outside"))
def d07t(t):
    return workloads.throttle_comparison(t.resource_allocation_logs, t.job_metadata, (8, 10))


# ---------------------------------------------------------------- utilisation

USAGE = f"""usage AS (
    SELECT CAST(r.collected_at AS DATE) AS summary_date, j.workload_type, j.team, j.cloud_provider, j.environment, r.node_type,
           avg(cpu_used) AS avg_cpu_used, avg(cpu_requested_cores) AS avg_cpu_requested, avg({div('cpu_used', 'cpu_requested_cores')}) AS avg_cpu_efficiency,
           avg(cpu_throttle_pct) AS avg_cpu_throttle_pct, avg(mem_used) AS avg_memory_used_gb,
           avg({div('mem_used', 'memory_limit_gb')}) AS avg_memory_pressure, avg(gpu_used) AS avg_gpu_utilisation_pct,
           avg(gpu_memory_used_gb) AS avg_gpu_memory_used_gb, max(mem_used) AS peak_memory_used_gb,
           CAST(sum(compute_cost_usd) AS DOUBLE) AS daily_compute_cost_usd, count(DISTINCT r.job_id) AS distinct_jobs, count(*) AS sample_count
    FROM (SELECT *, cpu_used_cores AS cpu_used, memory_used_gb AS mem_used, gpu_utilisation_pct AS gpu_used FROM resource_allocation_logs
          WHERE cpu_used_cores IS NOT NULL) r
    JOIN (SELECT job_id, execution_date, workload_type, team, cloud_provider, environment FROM job_metadata) j
      ON j.job_id = r.job_id AND j.execution_date = CAST(r.collected_at AS DATE)
    GROUP BY 1, 2, 3, 4, 5, 6)"""
USAGE_F = ("avg_cpu_used avg_cpu_requested avg_cpu_efficiency avg_cpu_throttle_pct avg_memory_used_gb avg_memory_pressure "
           "avg_gpu_utilisation_pct avg_gpu_memory_used_gb peak_memory_used_gb daily_compute_cost_usd")


@query("A21_daily_resource_summary", oracle("SELECT * FROM usage", "job_metadata", "resource_allocation_logs", USAGE,
       d="summary_date", f=USAGE_F))
def a21(t):
    return workloads.daily_resource_summary(t.resource_allocation_logs, t.job_metadata)


@query("W08_resource_utilisation", oracle(
    """SELECT *, lag(daily_compute_cost_usd) OVER w AS prev_day_cost_usd,
              (daily_compute_cost_usd - lag(daily_compute_cost_usd) OVER w) / NULLIF(lag(daily_compute_cost_usd) OVER w, 0) * 100 AS cost_change_pct
       FROM usage WINDOW w AS (PARTITION BY workload_type, team, cloud_provider, environment, node_type ORDER BY summary_date)""",
    "job_metadata", "resource_allocation_logs", USAGE, d="summary_date", f=USAGE_F + " prev_day_cost_usd cost_change_pct"))
def w08(t):
    return workloads.resource_utilisation(t.resource_allocation_logs, t.job_metadata)


@query("O01_anomalies_first", oracle(
    "SELECT job_id, workload_type, duration_z_score, is_duration_anomaly FROM zscored", *EXTRACT, f="duration_z_score"))
def o01(t):
    scored = workloads.jobs_with_zscore(t.job_metadata).select("job_id", "workload_type", "duration_z_score", "is_duration_anomaly")
    return workloads.anomalies_first(scored)


@query("W12_zscore_window", oracle(
    """SELECT cluster_name, environment, event_hour,
              (fleet_health_score - avg(fleet_health_score) OVER w) / NULLIF(stddev_pop(fleet_health_score) OVER w, 0) AS z_score
       FROM scores WINDOW w AS (PARTITION BY cluster_name, environment)""", *fleet_checks.FLEET, t="event_hour", f="z_score"))
def w12w(t):
    return fleet_checks.scores(t).select("cluster_name", "environment", "event_hour", zscore(
        "fleet_health_score", ["cluster_name", "environment"]).alias("z_score"))


@query("W11_rolling_zscore", oracle(
    """SELECT cluster_name, environment, event_hour,
              (avg_readiness_score - avg(avg_readiness_score) OVER w) / CASE WHEN stddev_pop(avg_readiness_score) OVER w > 1e-9 THEN stddev_pop(avg_readiness_score) OVER w END AS z_score
       FROM hourly_fleet WINDOW w AS (PARTITION BY cluster_name, environment ORDER BY event_hour ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
    *fleet_checks.FLEET, t="event_hour", f="z_score"))
def w11(t):
    return fleet.hourly_fleet(staging.fleet_telemetry(t.fleet_telemetry)).select("cluster_name", "environment", "event_hour", rolling_zscore(
        "avg_readiness_score", ["cluster_name", "environment"], ["event_hour"]).alias("z_score"))
