"""Fleet health queries."""
from checks.registry import div, oracle, query, rnd
from opsloom.plans import fleet
from opsloom.sources.adapters import EVENTS_AS_OF
from opsloom.operators import staging

STG_METRICS = """stg_infra_metrics AS (
    SELECT metric_id, service_name, cluster_name, namespace, environment, metric_name, metric_source,
           TRY_CAST(metric_value AS DOUBLE) AS metric_value, TRY_CAST(cpu_utilisation AS DOUBLE) AS cpu_utilisation,
           TRY_CAST(mem_utilisation AS DOUBLE) AS mem_utilisation, TRY_CAST(request_count AS BIGINT) AS request_count,
           error_rate, latency_p99_ms, scraped_ts, CAST(scraped_ts AS DATE) AS metric_date,
           date_trunc('hour', scraped_ts) AS metric_hour
    FROM infra_metrics WHERE metric_id IS NOT NULL AND metric_name IS NOT NULL)"""
STG_TELEMETRY = f"""stg_telemetry AS (
    SELECT event_id, cluster_name, node_group, environment, event_type, service_name, aws_region, readiness_score,
           {div('healthy_nodes', 'node_count')} AS node_health_ratio,
           {div('running_tasks', 'desired_tasks')} AS task_running_ratio,
           event_ts, date_trunc('hour', event_ts) AS event_hour, CAST(event_ts AS DATE) AS event_date
    FROM fleet_telemetry)"""
HOURLY_FLEET = """hourly_fleet AS (
    SELECT cluster_name, environment, event_hour, event_date,
           avg(node_health_ratio * 100) AS avg_node_health, avg(task_running_ratio * 100) AS avg_task_health,
           avg((node_health_ratio + task_running_ratio) / 2 * 100) AS availability_score,
           avg(readiness_score) AS avg_readiness_score, count(*) AS event_count
    FROM stg_telemetry GROUP BY ALL)"""
HOURLY_METRICS = """hourly_metrics AS (
    SELECT *, CAST(metric_hour AS DATE) AS metric_date,
           greatest(0.0, 100.0 - greatest(0.0, avg_latency_p99_ms - 500) / 500 * 100) AS latency_score,
           greatest(0.0, 100.0 - greatest(0.0, avg_error_rate - 0.05::DOUBLE) / 0.95::DOUBLE * 100) AS error_rate_score
    FROM (SELECT cluster_name, environment, metric_hour, avg(latency_p99_ms) AS avg_latency_p99_ms,
                 avg(error_rate) AS avg_error_rate
          FROM stg_infra_metrics GROUP BY ALL))"""
SCORES = f"""scores AS (
    SELECT *, {rnd('w', 2)} AS fleet_health_score, w >= 95 AS is_slo_compliant FROM (
        SELECT *, 0.50::DOUBLE * availability_score + 0.30::DOUBLE * latency_score + 0.20::DOUBLE * error_rate_score AS w FROM (
            SELECT f.cluster_name, f.environment, f.event_hour, f.event_date, f.availability_score, f.avg_readiness_score,
                   f.event_count, coalesce(m.latency_score, 100) AS latency_score,
                   coalesce(m.error_rate_score, 100) AS error_rate_score,
                   coalesce(m.avg_latency_p99_ms, 0) AS avg_latency_p99_ms, coalesce(m.avg_error_rate, 0) AS avg_error_rate
            FROM hourly_fleet f LEFT JOIN hourly_metrics m
              ON f.cluster_name = m.cluster_name AND f.environment = m.environment AND f.event_hour = m.metric_hour)))"""
FLEET = ["fleet_telemetry", "infra_metrics", STG_TELEMETRY, STG_METRICS, HOURLY_FLEET, HOURLY_METRICS, SCORES]


def rolling_sql(days):
    return f"""rolled AS (
    SELECT *, avg(fleet_health_score) OVER w AS rolling_mean, stddev_pop(fleet_health_score) OVER w AS rolling_stddev
    FROM scores WINDOW w AS (PARTITION BY cluster_name, environment ORDER BY event_hour
                             ROWS BETWEEN {days * 24} PRECEDING AND 1 PRECEDING))"""


BOUNDS = """bounds AS (
    SELECT *, q1 - iqr_range AS iqr_lower_bound, q3 + iqr_range AS iqr_upper_bound FROM (
        SELECT cluster_name, environment, quantile_cont(fleet_health_score, 0.25) AS q1,
               quantile_cont(fleet_health_score, 0.75) AS q3, (q3 - q1) * 1.5 AS iqr_range
        FROM scores GROUP BY ALL))"""


def candidates_sql(threshold=3):
    return f"""candidates AS (
    SELECT * FROM (
        SELECT *, abs(z_score) >= {threshold} AS is_zscore_anomaly,
               fleet_health_score < iqr_lower_bound OR fleet_health_score > iqr_upper_bound AS is_iqr_anomaly,
               abs(z_score) >= {threshold} OR fleet_health_score < iqr_lower_bound OR fleet_health_score > iqr_upper_bound AS is_anomaly,
               CASE WHEN abs(z_score) >= 5 THEN 'critical' WHEN abs(z_score) >= 4 THEN 'high'
                    WHEN abs(z_score) >= {threshold} THEN 'medium' ELSE 'low' END AS anomaly_severity
        FROM (SELECT r.*, b.q1, b.q3, b.iqr_range, b.iqr_lower_bound, b.iqr_upper_bound,
                     (fleet_health_score - rolling_mean) / CASE WHEN rolling_stddev > 1e-6 THEN rolling_stddev END AS z_score
              FROM rolled r JOIN bounds b USING (cluster_name, environment)))
    WHERE is_anomaly)"""


# A two-sigma threshold on seven days gives the small test data anomalies of every kind.
DAYS, SIGMA = 7, 2.0
CANDIDATES = [*FLEET, rolling_sql(DAYS), BOUNDS, candidates_sql(SIGMA)]
LOG_COLUMNS = ("cluster_name, environment, event_hour, event_date, fleet_health_score, rolling_mean, rolling_stddev, z_score, "
               "iqr_lower_bound, iqr_upper_bound, is_zscore_anomaly, is_iqr_anomaly, anomaly_severity")
DAILY_ANOMALIES = """daily_anomalies AS (
    SELECT cluster_name, environment, event_date, count(*) FILTER (is_anomaly) AS anomaly_count,
           count(*) FILTER (anomaly_severity = 'critical') AS critical_anomaly_count
    FROM candidates GROUP BY ALL)"""
DAILY = f"""daily AS (
    SELECT cluster_name, environment, event_date,
           {rnd('sum(CAST(round(fleet_health_score * 100) AS BIGINT))::DOUBLE / (100 * count(fleet_health_score))', 2)} AS avg_fleet_health_score,
           min(fleet_health_score) AS min_fleet_health_score, max(fleet_health_score) AS max_fleet_health_score,
           {rnd('stddev_samp(fleet_health_score)', 2)} AS stddev_fleet_health_score,
           count(*) FILTER (is_slo_compliant) AS slo_compliant_hours, count(*) AS total_hours,
           count(*) FILTER (is_slo_compliant)::DOUBLE / count(*) AS slo_compliance_rate,
           {rnd('avg(avg_latency_p99_ms)', 2)} AS avg_latency_p99_ms, {rnd('avg(avg_error_rate)', 4)} AS avg_error_rate,
           sum(event_count) AS total_events
    FROM scores GROUP BY ALL)"""
TREND = f"""trend AS (
    SELECT *, {rnd('avg(avg_fleet_health_score) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 2)} AS rolling_7d_avg_score,
           {rnd('avg(slo_compliance_rate) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)', 4)} AS rolling_30d_slo_rate
    FROM daily WINDOW w AS (PARTITION BY cluster_name, environment ORDER BY event_date))"""
READINESS = """readiness AS (
    SELECT t.*, coalesce(a.anomaly_count, 0) AS anomaly_count, coalesce(a.critical_anomaly_count, 0) AS critical_anomaly_count
    FROM trend t LEFT JOIN daily_anomalies a USING (cluster_name, environment, event_date))"""
READY = [*CANDIDATES, DAILY_ANOMALIES, DAILY, TREND, READINESS]

DAILY_F = ("avg_fleet_health_score min_fleet_health_score max_fleet_health_score stddev_fleet_health_score "
           "slo_compliance_rate avg_latency_p99_ms avg_error_rate")
DAILY_I = "slo_compliant_hours total_hours total_events"
SCORE_F = "availability_score avg_readiness_score latency_score error_rate_score avg_latency_p99_ms avg_error_rate fleet_health_score"


def scores(t):
    return fleet.fleet_health_scores(staging.fleet_telemetry(t.fleet_telemetry), staging.infra_metrics(t.infra_metrics))


def candidates(t):
    return fleet.anomaly_candidates(scores(t), DAYS, SIGMA)


def readiness(t):
    s = scores(t)
    return fleet.fleet_readiness_daily(s, fleet.anomaly_candidates(s, DAYS, SIGMA))


@query("P06_stg_infra_metrics", oracle("SELECT * FROM stg_infra_metrics", "infra_metrics", STG_METRICS,
       f="metric_value cpu_utilisation mem_utilisation error_rate latency_p99_ms", d="metric_date",
       t="scraped_ts metric_hour"))
def p06(t):
    return staging.infra_metrics(t.infra_metrics)


@query("P07_stg_fleet_telemetry", oracle("SELECT * FROM stg_telemetry", "fleet_telemetry", STG_TELEMETRY,
       f="readiness_score node_health_ratio task_running_ratio", d="event_date", t="event_ts event_hour"))
def p07(t):
    return staging.fleet_telemetry(t.fleet_telemetry)


@query("A01_hourly_fleet", oracle("SELECT * FROM hourly_fleet", *FLEET, d="event_date", t="event_hour",
       f="avg_node_health avg_task_health availability_score avg_readiness_score"))
def a01(t):
    return fleet.hourly_fleet(staging.fleet_telemetry(t.fleet_telemetry))


@query("A02_hourly_metrics", oracle("SELECT * FROM hourly_metrics", *FLEET, d="metric_date", t="metric_hour",
       f="avg_latency_p99_ms avg_error_rate latency_score error_rate_score"))
def a02(t):
    return fleet.hourly_metrics(staging.infra_metrics(t.infra_metrics))


@query("A03_fleet_health_scores", oracle("SELECT * EXCLUDE (w) FROM scores", *FLEET, d="event_date", t="event_hour", f=SCORE_F))
def a03(t):
    return scores(t)


@query("A04_daily_scores", oracle("SELECT * FROM daily", *FLEET, DAILY, d="event_date", f=DAILY_F, i=DAILY_I))
def a04(t):
    return fleet.daily_scores(scores(t))


@query("A05_daily_anomalies", oracle("SELECT * FROM daily_anomalies", *CANDIDATES, DAILY_ANOMALIES, d="event_date"))
def a05(t):
    return fleet.daily_anomalies(candidates(t))


@query("W02_rolling_score_stats", oracle(
    "SELECT cluster_name, environment, event_hour, fleet_health_score, rolling_mean, rolling_stddev FROM rolled",
    *FLEET, rolling_sql(30), t="event_hour", f="fleet_health_score rolling_mean rolling_stddev"))
def w02(t):
    return fleet.rolling_score_stats(scores(t)).select(
        "cluster_name", "environment", "event_hour", "fleet_health_score", "rolling_mean", "rolling_stddev")


@query("W03_score_quartiles", oracle("SELECT * FROM bounds", *FLEET, BOUNDS,
       f="q1 q3 iqr_range iqr_lower_bound iqr_upper_bound"))
def w03(t):
    return fleet.score_bounds(scores(t))


@query("W04_readiness_trend", oracle("SELECT * FROM trend", *FLEET, DAILY, TREND, d="event_date",
       f=DAILY_F + " rolling_7d_avg_score rolling_30d_slo_rate", i=DAILY_I))
def w04(t):
    return fleet.with_readiness_trend(fleet.daily_scores(scores(t)))


@query("D05_anomaly_candidates", oracle(
    f"SELECT {LOG_COLUMNS}, is_anomaly FROM candidates", *CANDIDATES, d="event_date", t="event_hour",
    f="fleet_health_score rolling_mean rolling_stddev z_score iqr_lower_bound iqr_upper_bound"))
def d05(t):
    return candidates(t).select(*LOG_COLUMNS.split(", "), "is_anomaly")


@query("P19_anomaly_log", oracle(
    f"SELECT {LOG_COLUMNS} FROM candidates", *FLEET, rolling_sql(30), BOUNDS, candidates_sql(3), d="event_date", t="event_hour",
    f="fleet_health_score rolling_mean rolling_stddev z_score iqr_lower_bound iqr_upper_bound"))
def p19(t):
    return fleet.anomaly_log(fleet.anomaly_candidates(scores(t)))


@query("J11_fleet_readiness_daily", oracle("SELECT * FROM readiness", *READY, d="event_date",
       f=DAILY_F + " rolling_7d_avg_score rolling_30d_slo_rate", i=DAILY_I))
def j11(t):
    return readiness(t)


@query("P18_health_trend", oracle(
    """SELECT event_date, cluster_name, environment, avg_fleet_health_score, rolling_7d_avg_score, slo_compliance_rate,
              anomaly_count, critical_anomaly_count
       FROM readiness WHERE event_date >= DATE '2024-01-01' AND environment = 'prod'""",
    *READY, d="event_date", f="avg_fleet_health_score rolling_7d_avg_score slo_compliance_rate"))
def p18(t):
    return fleet.health_trend(readiness(t), EVENTS_AS_OF)


@query("A23_anomaly_summary", oracle(
    """SELECT event_date, anomaly_severity, count(*) AS anomaly_count,
              list_slice(list_sort(list(DISTINCT cluster_name)), 1, 5) AS affected_clusters
       FROM candidates WHERE event_date >= DATE '2024-01-24' GROUP BY ALL""",
    *CANDIDATES, d="event_date", a="affected_clusters"))
def a23(t):
    return fleet.anomaly_summary(fleet.anomaly_log(candidates(t)), EVENTS_AS_OF)


@query("P22_latest_critical", oracle(
    f"""SELECT {LOG_COLUMNS} FROM candidates WHERE event_date = DATE '2024-01-01' AND anomaly_severity = 'critical'
        ORDER BY event_hour DESC, cluster_name, environment LIMIT 20""",
    *CANDIDATES, d="event_date", t="event_hour",
    f="fleet_health_score rolling_mean rolling_stddev z_score iqr_lower_bound iqr_upper_bound"))
def p22(t):
    return fleet.latest_critical(fleet.anomaly_log(candidates(t)), "2024-01-01")


@query("Q24_critical_counts", oracle(
    """SELECT count(*) FILTER (anomaly_severity = 'critical' AND event_date = DATE '2024-01-01') AS critical_yesterday,
              count(*) FILTER (anomaly_severity = 'critical' AND event_hour >= TIMESTAMP '2024-01-01 23:00:00') AS critical_last_hour
       FROM candidates""", *CANDIDATES))
def q24(t):
    return fleet.critical_counts(fleet.anomaly_log(candidates(t)), "2024-01-02 00:00:00")
