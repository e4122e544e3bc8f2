"""Quality, curation, series, trend and metric queries."""
from pyspark.sql import functions as F

from checks import fleet as fleet_checks, jobs as job_checks_, marts
from checks.registry import div, oracle, query, rnd
from opsloom.operators import curation, expectations, quality, series
from opsloom.operators.curation import ColumnSpec
from opsloom.plans import semantic, services
from opsloom.sources.adapters import EVENTS_AS_OF
from opsloom import params

# ---------------------------------------------------------------- job checks

CHECK_COLS = ["job_id", "workload_type", "status", "submitted_at", "started_at", "completed_at", "duration_seconds",
              "cpu_used_cores", "memory_used_gb", "gpu_utilisation_pct", "parent_job_id"]
AS_OF_CHECKS = "2024-01-30 12:00:00"
NULL_RATES = ", ".join(f"CASE WHEN count(*) FILTER ({c} IS NULL)::DOUBLE / count(*) > 0.3 THEN '{c}' END" for c in CHECK_COLS)
BOUND_TESTS = ", ".join(
    f"CASE WHEN count(*) FILTER ({c} < {lo} OR {c} > {hi}) > 0 THEN '{c}: ' || count(*) FILTER ({c} < {lo} OR {c} > {hi}) END"
    for c, (lo, hi) in params.RESOURCE_BOUNDS.items())
AHEAD = " + ".join(f"count(*) FILTER ({c} > TIMESTAMP '{AS_OF_CHECKS}')" for c in ("submitted_at", "started_at", "completed_at"))
CHECKS_SQL = f"""m AS (
    SELECT count(*) AS n, count(*) - count(DISTINCT job_id) AS dup, count(*) FILTER (duration_seconds > 172800) AS extreme,
           count(*) FILTER (duration_seconds < 0) AS negative, count(*) FILTER (status = 'FAILURE')::DOUBLE / count(*) AS rate,
           min(submitted_at) AS lo, max(submitted_at) AS hi, list_filter([{BOUND_TESTS}], lambda x: x IS NOT NULL) AS bounds,
           list_filter([{NULL_RATES}], lambda x: x IS NOT NULL) AS high, {AHEAD} AS ahead,
           count(DISTINCT workload_type) FILTER (workload_type IN ('model_training', 'inference', 'data_processing')) AS types
    FROM job_metadata)"""
CHECK_ROWS = """
    SELECT 'not_empty' AS name, n > 0 AS passed, 'CRITICAL' AS severity, n || ' rows' AS message FROM m
    UNION ALL SELECT 'no_duplicate_job_ids', dup = 0, 'WARNING', CASE WHEN dup = 0 THEN 'every job_id is unique' ELSE dup || ' rows repeat a job_id' END FROM m
    UNION ALL SELECT 'required_fields_not_null', true, 'CRITICAL', 'no required field is null' FROM m
    UNION ALL SELECT 'timestamp_range', hi <= TIMESTAMP '2024-01-30 12:00:00', 'WARNING',
        'min=' || lo || ', max=' || hi || CASE WHEN hi > TIMESTAMP '2024-01-30 12:00:00' THEN ' FUTURE' ELSE '' END FROM m
    UNION ALL SELECT 'duration_plausible', extreme = 0 AND negative = 0, 'WARNING', extreme || ' above two days, ' || negative || ' below zero' FROM m
    UNION ALL SELECT 'status_distribution', rate <= 0.5, 'WARNING', 'share of failures ' || CAST(round(CAST(rate * 100 AS DECIMAL(18,8)), 1) AS VARCHAR) || '%' FROM m
    UNION ALL SELECT 'workload_type_coverage', types = 3, 'WARNING', 'each expected type occurs' FROM m
    UNION ALL SELECT 'resource_value_bounds', len(bounds) = 0, 'WARNING',
        CASE WHEN len(bounds) = 0 THEN 'readings stay within their limits' ELSE 'readings beyond their limits: ' || array_to_string(bounds, ', ') END FROM m
    UNION ALL SELECT 'null_rate_per_column', len(high) = 0, 'WARNING',
        CASE WHEN len(high) = 0 THEN 'no column is null too often' ELSE 'null too often: ' || array_to_string(high, ', ') END FROM m
    UNION ALL SELECT 'no_future_timestamps', ahead = 0, 'WARNING',
        CASE WHEN ahead = 0 THEN 'nothing lies ahead of the check' ELSE ahead || ' timestamps lie ahead of the check' END FROM m"""


def checked(t):
    return quality.job_checks(t.job_metadata.select(*CHECK_COLS), AS_OF_CHECKS)


@query("Q01_job_checks", oracle(CHECK_ROWS, "job_metadata", CHECKS_SQL))
def q01(t):
    return checked(t).drop("detail")


@query("Q12_quality_report", oracle(
    f"""SELECT DATE '2024-01-30' AS date, TIMESTAMP '{AS_OF_CHECKS}' AS checked_at, count(*) AS total_checks,
               count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
               string_agg(name, ',' ORDER BY name) AS names FROM ({CHECK_ROWS})""",
    "job_metadata", CHECKS_SQL, d="date", t="checked_at"))
def q12(t):
    report = quality.quality_report(checked(t), "2024-01-30", AS_OF_CHECKS)
    return report.withColumn("names", F.array_join("checks.name", ",")).drop("checks")


@query("Q11_gate", oracle(
    """SELECT 'required_fields_not_null' AS name, 'nulls by required field: job_id: ' || count(*) FILTER (right(job_id, 1) = '3') AS message
       FROM job_metadata HAVING count(*) FILTER (right(job_id, 1) = '3') > 0""", "job_metadata"))
def q11(t):
    broken = t.job_metadata.select(*CHECK_COLS).withColumn("job_id", F.when(~F.col("job_id").endswith("3"), F.col("job_id")))
    return quality.critical_failures(quality.job_checks(broken, AS_OF_CHECKS))


@query("A28_status_distribution", oracle("SELECT status, count(*) AS n FROM job_metadata GROUP BY 1", "job_metadata"))
def a28(t):
    return quality.status_distribution(t.job_metadata)


@query("U02_missing_values", oracle(
    """SELECT v AS workload_type FROM (VALUES ('model_training'), ('inference'), ('simulation')) x(v)
       WHERE v NOT IN (SELECT workload_type FROM job_metadata)""", "job_metadata"))
def u02(t):
    return quality.missing_values(t.job_metadata, "workload_type", ["model_training", "inference", "simulation"])


# ---------------------------------------------------------------- curation

DOC_SCHEMA = [
    ColumnSpec("doc_id", "int64", nullable=False, unique=True), ColumnSpec("text", "object", nullable=False, unique=True),
    ColumnSpec("lang", "object", nullable=False), ColumnSpec("n_chars", "float64"), ColumnSpec("author", "object"),
]


@query("Q13_validate_schema", oracle(
    """SELECT 'no such column: author' AS message UNION ALL SELECT 'n_chars has type bigint instead of float64'
       UNION ALL SELECT 'text may not repeat; rows: ' || (count(*) - count(DISTINCT text))
         FROM documents HAVING count(*) > count(DISTINCT text)"""))
def q13(t):
    return curation.validate(t.raw("documents"), DOC_SCHEMA)


JOB_SCHEMA = [ColumnSpec("job_id", "object", False, True), ColumnSpec("job_name", "object", True, True)]
SCORE_COLS = ["job_id", "job_name", "parent_job_id", "duration_seconds", "error_message", "submitted_at"]


@query("Q14_quality_score", oracle(
    f"""SELECT {rnd('c', 4)} AS completeness, {rnd('u', 4)} AS uniqueness, f AS freshness_ok,
              {rnd('0.5 * c + 0.3 * u + 0.2 * CAST(f AS INT)', 4)} AS overall
       FROM (SELECT 1 - ({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in SCORE_COLS)})::DOUBLE / (6 * count(*)) AS c,
                    least(count(DISTINCT job_id)::DOUBLE / count(*), count(DISTINCT job_name)::DOUBLE / count(*)) AS u,
                    max(submitted_at) >= TIMESTAMP '2024-01-29 23:00:00' AS f FROM job_metadata)""",
    "job_metadata", f="completeness uniqueness overall"))
def q14(t):
    return curation.quality_score(t.job_metadata.select(*SCORE_COLS), JOB_SCHEMA, EVENTS_AS_OF, "submitted_at")


@query("Q15_lineage_record")
def q15(t):
    return curation.lineage_record(t.raw("documents"), "raw.documents", "none", "staged.documents", EVENTS_AS_OF)


@query("Q15_checksum_ignores_order", oracle("SELECT count(*) AS row_count, true AS same FROM documents"))
def q15b(t):
    docs = t.raw("documents")
    a = curation.lineage_record(docs, "s", "t", "o", EVENTS_AS_OF).select("row_count", F.col("checksum").alias("a"))
    # Dealt anew in parts of bounded size, however large the table is.
    b = curation.lineage_record(docs.hint("rebalance").select(*reversed(docs.columns)), "s", "t", "o", EVENTS_AS_OF)
    return a.join(b.select("row_count", F.col("checksum").alias("b")), "row_count").select(
        "row_count", (F.col("a") == F.col("b")).alias("same"))


@query("Q15_checksum_sees_changes", oracle("SELECT count(*) AS row_count, true AS same, false AS changed_is_same FROM documents"))
def q15c(t):
    """Copies of the rows agree; one changed value does not."""
    docs = t.raw("documents")
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 0, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    a, b, c = (curation.lineage_record(d, "s", "t", "o", EVENTS_AS_OF).select("row_count", F.col("checksum").alias(n))
               for d, n in ((docs, "a"), (docs.hint("rebalance"), "b"), (changed, "c")))
    return a.join(b, "row_count").join(c, "row_count").select(
        "row_count", (F.col("a") == F.col("b")).alias("same"), (F.col("a") == F.col("c")).alias("changed_is_same"))


EXPECT = "stg_events"


def share(hit, of):
    return f"coalesce(count(*) FILTER ({hit})::DOUBLE / NULLIF(count(*) FILTER ({of}), 0), 1)"


EXPECT_ROWS = [
    (1, "exists", "event_key", "max(1.0)", "true"),
    (2, "not_null", "event_key", share("event_key IS NOT NULL", "true"), "o >= 1"),
    (3, "unique", "event_key", "count(DISTINCT event_key)::DOUBLE / count(event_key)", "o >= 1"),
    (4, "not_null", "event_timestamp", share("event_timestamp IS NOT NULL", "true"), "o >= 1"),
    (5, "not_null", "service_name", share("service_name IS NOT NULL", "true"), "o >= 0.99"),
    (6, "in_set", "event_type", share("event_type IN ('DEPLOY', 'SCALE', 'INCIDENT', 'ALERT', 'HEAL', 'ROLLBACK')", "event_type IS NOT NULL"), "o >= 1"),
    (7, "in_set", "severity", share("severity IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'INFO', 'UNKNOWN')", "severity IS NOT NULL"), "o >= 1"),
    (8, "in_set", "environment", share("environment IN ('dev', 'staging', 'prod')", "environment IS NOT NULL"), "o >= 1"),
    (9, "between", "error_budget_burn", share("error_budget_burn BETWEEN 0 AND 100", "error_budget_burn IS NOT NULL"), "o >= 0.99"),
    (10, "between", "duration_ms", share("duration_ms BETWEEN 0 AND 86400000", "duration_ms IS NOT NULL"), "o >= 0.99"),
    (11, "row_count", None, "count(*)::DOUBLE", "o BETWEEN 100 AND 10000000"),
    (12, "distinct_share", "event_id", "count(DISTINCT event_id)::DOUBLE / count(event_id)", "o >= 0.99"),
    (13, "date_format", "event_date", "max(1.0)", "true"),
]
EXPECT_SQL = " UNION ALL ".join(
    "SELECT {} AS no, '{}' AS kind, {} AS column, o AS observed, {} AS passed FROM (SELECT {} AS o FROM {{t}})".format(
        no, kind, "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'", ok, o)
    for no, kind, col, o, ok in EXPECT_ROWS).replace("column,", '"column",')


@query("Q16_expectations_staged", oracle(EXPECT_SQL.format(t="stg_events"), *marts.SERVICE, i="no", f="observed"))
def q16(t):
    return expectations.evaluate(marts.events(t))


@query("Q16_expectations_raw", oracle(EXPECT_SQL.format(t="fleet_events"), *marts.SERVICE, i="no", f="observed"))
def q16r(t):
    return expectations.evaluate(t.fleet_events)


# ---------------------------------------------------------------- failing rows

@query("Q17_failing_range", oracle(
    "SELECT cluster_name, environment, event_date, slo_compliance_rate FROM readiness WHERE slo_compliance_rate < 0.2",
    *fleet_checks.READY, d="event_date", f="slo_compliance_rate"))
def q17(t):
    return quality.failing_range(fleet_checks.readiness(t), "slo_compliance_rate", 0.2, 1).select(
        "cluster_name", "environment", "event_date", "slo_compliance_rate")


@query("Q17_failing_values", oracle(
    """SELECT event_type, count(*) AS n_records FROM fleet_events
       WHERE event_type NOT IN ('DEPLOY', 'SCALE', 'INCIDENT', 'ALERT', 'HEAL', 'ROLLBACK') GROUP BY 1""", "fleet_events"))
def q17v(t):
    return quality.failing_values(t.fleet_events, "event_type", params.FLEET_EVENT_TYPES)


@query("Q17_failing_unique", oracle(
    "SELECT cost_event_id, count(*) AS n_records FROM cost_events WHERE cost_event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "cost_events"))
def q17u(t):
    return quality.failing_unique(t.cost_events, "cost_event_id")


@query("Q17_failing_not_null", oracle("SELECT event_key, event_id FROM fleet_events WHERE event_id IS NULL", "fleet_events"))
def q17n(t):
    return quality.failing_not_null(t.fleet_events, "event_id").select("event_key", "event_id")


@query("Q17_mart_tests", oracle(
    """SELECT 'readiness_score' AS test, count(*) AS failures FROM readiness WHERE avg_fleet_health_score NOT BETWEEN 0 AND 100
       UNION ALL SELECT 'otp_rate', count(*) FROM summary WHERE otp_rate NOT BETWEEN 0 AND 1
       UNION ALL SELECT 'total_cost', count(*) FROM by_team WHERE total_cost_usd < 0
       UNION ALL SELECT 'severity', count(DISTINCT anomaly_severity) FROM candidates WHERE anomaly_severity NOT IN ('low', 'medium', 'high', 'critical')""",
    *fleet_checks.READY, *marts.FLIGHTS, *marts.COSTS))
def q17m(t):
    return quality.failure_counts({
        "readiness_score": quality.failing_range(fleet_checks.readiness(t), "avg_fleet_health_score", 0, 100),
        "otp_rate": quality.failing_range(marts.summary(t), "otp_rate", 0, 1),
        "total_cost": quality.failing_range(marts.by_team(t), "total_cost_usd", 0),
        "severity": quality.failing_values(fleet_checks.candidates(t), "anomaly_severity", params.ANOMALY_SEVERITIES),
    })


@query("Q18_scores_out_of_bounds", oracle(
    "SELECT cluster_name, environment, event_hour, fleet_health_score FROM scores WHERE fleet_health_score < 0 OR fleet_health_score > 100",
    *fleet_checks.FLEET, t="event_hour", f="fleet_health_score"))
def q18(t):
    return quality.scores_out_of_bounds(fleet_checks.scores(t))


@query("Q18_scores_beyond_found", oracle(
    "SELECT cluster_name, environment, event_hour, fleet_health_score * 3 - 140 AS fleet_health_score FROM scores WHERE fleet_health_score * 3 - 140 < 0 OR fleet_health_score * 3 - 140 > 100",
    *fleet_checks.FLEET, t="event_hour", f="fleet_health_score"))
def q18b(t):
    return quality.scores_out_of_bounds(fleet_checks.scores(t).withColumn("fleet_health_score", F.col("fleet_health_score") * 3 - 140))


@query("Q19_unresolved_critical", oracle(
    """SELECT cluster_name, environment, event_hour, z_score FROM candidates
       WHERE anomaly_severity = 'high' AND event_hour < TIMESTAMP '2024-01-30 20:00:00' AND environment <> 'prod'""",
    *fleet_checks.CANDIDATES, t="event_hour", f="z_score"))
def q19(t):
    resolved = F.when(F.col("environment") == "prod", F.col("event_hour"))
    open_ = fleet_checks.candidates(t).withColumn("resolved_at", resolved)
    return quality.unresolved_critical(open_, EVENTS_AS_OF, "event_hour", "high").select(
        "cluster_name", "environment", "event_hour", "z_score")


@query("Q20_future_events", oracle(
    "SELECT event_id, event_ts FROM fleet_telemetry WHERE event_ts > TIMESTAMP '2024-01-30 12:00:00'", "fleet_telemetry", t="event_ts"))
def q20(t):
    return quality.future_events(t.fleet_telemetry, "event_ts", AS_OF_CHECKS).select("event_id", "event_ts")


@query("Q21_double_counted_snapshots", oracle(
    """SELECT service_name, slo_name, snapshot_timestamp, count(*) AS cnt
       FROM (SELECT service_name, slo_name, date_trunc('hour', snapshot_timestamp) AS snapshot_timestamp FROM stg_slo)
       GROUP BY 1, 2, 3 HAVING count(*) > 1""", *marts.SERVICE, t="snapshot_timestamp"))
def q21(t):
    hourly = marts.slo(t).withColumn("snapshot_timestamp", F.date_trunc("hour", "snapshot_timestamp"))
    return quality.double_counted_snapshots(hourly)


# ---------------------------------------------------------------- series

SERIES = """series AS (
    SELECT event_type, h, CASE WHEN hour(h) = 3 THEN NULL ELSE v END AS value,
           row_number() OVER (PARTITION BY event_type ORDER BY h) - 1 AS pos
    FROM (SELECT event_type, date_trunc('hour', ts) AS h, avg(floor(value * 4) / 4) AS v FROM events GROUP BY 1, 2))"""
SERIES_OUT = ("event_type, h, pos, value, z_score, rolling_mean, rolling_std, iqr_lower, iqr_upper, is_zscore, is_iqr, is_anomaly, severity")
SERIES_F = "value z_score rolling_mean rolling_std iqr_lower iqr_upper"


def flag_sql(source, z=3):
    return f"""SELECT event_type, h, pos, value, {rnd('z', 4)} AS z_score, {rnd('m', 4)} AS rolling_mean, {rnd('s', 4)} AS rolling_std,
           {rnd('lo', 4)} AS iqr_lower, {rnd('hi', 4)} AS iqr_upper, abs(z) >= {z} AS is_zscore, value < lo OR value > hi AS is_iqr,
           true AS is_anomaly, CASE WHEN abs(z) >= 5 THEN 'critical' WHEN abs(z) >= 4 THEN 'high' WHEN abs(z) >= 3 THEN 'medium' ELSE 'low' END AS severity
    FROM (SELECT *, CASE WHEN s > 0 THEN (value - m) / s ELSE 0 END AS z, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM {source})
    WHERE value IS NOT NULL AND (abs(z) >= {z} OR value < lo OR value > hi)"""


WHOLE = """whole AS (
    SELECT x.*, m, s, q1, q3 FROM series x JOIN (
        SELECT event_type, avg(value) AS m, stddev_pop(value) AS s, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
        FROM series GROUP BY 1 HAVING count(*) >= 10) USING (event_type))"""
ROLL = """roll AS (
    SELECT *, avg(value) OVER w AS m, stddev_pop(value) OVER w AS s, quantile_cont(value, 0.25) OVER w AS q1, quantile_cont(value, 0.75) OVER w AS q3
    FROM series WINDOW w AS (PARTITION BY event_type ORDER BY h ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) QUALIFY pos >= 24)"""


def hourly_series(t):
    hour = F.date_trunc("hour", "ts").alias("h")
    means = t.raw("events").groupBy("event_type", hour).agg(F.avg(F.floor(F.col("value") * 4) / 4).alias("value"))
    return means.withColumn("value", F.when(F.hour("h") != 3, F.col("value")))


@query("D03_series_anomalies", oracle(flag_sql("whole"), SERIES, WHOLE, t="h", f=SERIES_F))
def d03(t):
    return series.series_anomalies(hourly_series(t), ["event_type"], "h", "value").select(*SERIES_OUT.split(", "))


@query("D04_rolling_anomalies", oracle(flag_sql("roll"), SERIES, ROLL, t="h", f=SERIES_F))
def d04(t):
    return series.rolling_anomalies(hourly_series(t), ["event_type"], "h", "value").select(*SERIES_OUT.split(", "))


EWM = """walk AS (
    WITH RECURSIVE r AS (
        SELECT event_type, pos, value, value AS y, 1.0::DOUBLE AS w FROM series WHERE pos = 0
        UNION ALL
        SELECT s.event_type, s.pos, s.value,
               CASE WHEN s.value IS NULL THEN r.y WHEN r.y IS NULL THEN s.value
                    ELSE (r.w * 0.75::DOUBLE * r.y + 0.25::DOUBLE * s.value) / (r.w * 0.75::DOUBLE + 0.25::DOUBLE) END,
               CASE WHEN s.value IS NULL AND r.y IS NOT NULL THEN r.w * 0.75::DOUBLE ELSE 1.0 END
        FROM r JOIN series s ON s.event_type = r.event_type AND s.pos = r.pos + 1)
    SELECT event_type, pos, y AS ewm_mean FROM r)"""


@query("T01_moving_averages", oracle(
    """SELECT s.event_type, s.h, s.pos, s.value,
              avg(value) OVER (PARTITION BY s.event_type ORDER BY h ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_mean, ewm_mean
       FROM series s JOIN walk w ON w.event_type = s.event_type AND w.pos = s.pos""",
    SERIES, EWM, t="h", f="value rolling_mean ewm_mean"))
def t01(t):
    return series.moving_averages(hourly_series(t), ["event_type"], "h", "value").select(
        "event_type", "h", "pos", "value", "rolling_mean", "ewm_mean")


@query("T03_trend", oracle(
    f"""SELECT event_type, n AS n_rows, {rnd('slope', 6)} AS slope,
              CASE WHEN slope > 0.1 THEN 'improving' WHEN slope < -0.1 THEN 'degrading' ELSE 'stable' END AS direction,
              {rnd('(new - old7) / abs(NULLIF(old7, 0)) * 100', 2)} AS pct_change_7d, {rnd('(new - old30) / abs(NULLIF(old30, 0)) * 100', 2)} AS pct_change_30d
       FROM (SELECT event_type, count(*) AS n, regr_slope(value, pos) AS slope, max(value) FILTER (pos = m) AS new,
                    max(value) FILTER (pos = m - 7) AS old7, max(value) FILTER (pos = m - 30) AS old30
             FROM (SELECT *, max(pos) OVER (PARTITION BY event_type) AS m FROM series) GROUP BY 1)""",
    SERIES, f="slope pct_change_7d pct_change_30d"))
def t03(t):
    return series.trend(hourly_series(t), ["event_type"], "h", "value")


# ---------------------------------------------------------------- metrics

HEALTH = [*marts.SERVICE]


@query("M01_metrics_by_week", oracle(
    """SELECT CAST(date_trunc('week', report_date + INTERVAL 1 DAY) AS DATE) - 1 AS period, service_name, environment,
              avg(deploy_count) AS deployment_frequency, avg(change_failure_rate) AS change_failure_rate,
              avg(mean_time_to_recovery_mins) AS mean_time_to_recovery, avg(cost_per_deploy_usd) AS cost_per_deploy
       FROM health GROUP BY 1, 2, 3""", *HEALTH, d="period",
    f="deployment_frequency change_failure_rate mean_time_to_recovery cost_per_deploy"))
def m01(t):
    return semantic.metric_query(marts.health(t), [
        "deployment_frequency", "change_failure_rate", "mean_time_to_recovery", "cost_per_deploy"],
        "week", ("service_name", "environment"))


@query("M01_slo_compliance_rate", oracle(
    """SELECT CAST(date_trunc('month', report_week) AS DATE) AS period, slo_name, avg(CAST(is_compliant AS INT)) AS slo_compliance_rate
       FROM slo_week GROUP BY 1, 2""", *HEALTH, marts.SLO_WEEK, d="period", f="slo_compliance_rate"))
def m01s(t):
    return semantic.metric_query(services.slo_compliance(marts.slo(t)), "slo_compliance_rate", "month", ("slo_name",))


@query("M02_health_measures", oracle(
    """SELECT squad, sum(deploy_count) AS total_deploys, sum(incident_count) AS total_incidents, avg(p99_availability) AS avg_availability,
              sum(critical_events) AS critical_event_count, avg(cost_per_deploy_usd) AS avg_cost_per_deploy,
              0 AS services_with_anomalies FROM health GROUP BY 1""",
    *HEALTH, f="avg_availability avg_cost_per_deploy", i="total_deploys total_incidents critical_event_count services_with_anomalies"))
def m02(t):
    return semantic.metric_query(marts.health(t), [
        "total_deploys", "total_incidents", "avg_availability", "critical_event_count", "avg_cost_per_deploy",
        "services_with_anomalies"], None, ("squad",))


@query("M02_total_cost", oracle(
    """SELECT CAST(date_trunc('month', report_date) AS DATE) AS period, squad, sum(c) AS total_daily_cost_usd
       FROM (SELECT report_date, squad, max(daily_cost_usd) AS c FROM health GROUP BY 1, 2) GROUP BY 1, 2""",
    *HEALTH, d="period", f="total_daily_cost_usd"))
def m02c(t):
    return semantic.total_cost(marts.health(t), "month")


@query("M03_time_grains", oracle(
    " UNION ALL ".join(f"SELECT '{g}' AS grain, {e} AS period, sum(deploy_count) AS total_deploys FROM health GROUP BY 2"
                       for g, e in {
                           "day": "report_date",
                           "week": "CAST(date_trunc('week', report_date + INTERVAL 1 DAY) AS DATE) - 1",
                           "month": "CAST(date_trunc('month', report_date) AS DATE)",
                           "quarter": "CAST(date_trunc('quarter', report_date) AS DATE)",
                           "year": "CAST(date_trunc('year', report_date) AS DATE)"}.items()),
    *HEALTH, d="period", i="total_deploys"))
def m03(t):
    return semantic.metric_by_grains(marts.health(t), "total_deploys", ("day", "week", "month", "quarter", "year"))


@query("M04_slo_measures", oracle(
    """SELECT CAST(date_trunc('quarter', report_week) AS DATE) AS period, service_name, avg(CAST(is_compliant AS INT)) AS services_compliant_pct,
              avg(avg_error_budget_remaining) AS avg_error_budget_remaining, sum(breach_count) AS total_breach_count,
              max(peak_burn_rate_1h) AS peak_burn_rate FROM slo_week GROUP BY 1, 2""",
    *HEALTH, marts.SLO_WEEK, d="period", f="services_compliant_pct avg_error_budget_remaining peak_burn_rate", i="total_breach_count"))
def m04(t):
    return semantic.metric_query(services.slo_compliance(marts.slo(t)), [
        "services_compliant_pct", "avg_error_budget_remaining", "total_breach_count", "peak_burn_rate"], "quarter", ("service_name",))


def kpi_sql(expr):
    return f"""SELECT cur AS value, prev AS previous_value, (cur - prev) / NULLIF(prev, 0) AS change FROM (
        SELECT {expr} FILTER (report_date >= DATE '2024-01-16') AS cur, {expr} FILTER (report_date < DATE '2024-01-16') AS prev
        FROM health WHERE report_date >= DATE '2024-01-01' AND report_date < DATE '2024-01-31' AND environment = 'prod')"""


for _name, _metric, _expr in [
    ("M05_kpi_deployment_frequency", "avg_deployment_frequency", "avg(deployment_frequency)"),
    ("M05_kpi_change_failure_rate", "change_failure_rate", "avg(change_failure_rate)"),
    ("M05_kpi_recovery_time", "mean_time_to_recovery_mins", "avg(mean_time_to_recovery_mins)"),
]:
    @query(_name, oracle(kpi_sql(_expr), *HEALTH, f="value previous_value change"))
    def _kpi(t, metric=_metric):
        return semantic.kpi_value(marts.health(t), metric, EVENTS_AS_OF, 15, {"environment": "prod"})


@query("M05_kpi_28_days_of_a_squad", oracle(
    """SELECT cur AS value, prev AS previous_value, (cur - prev) / NULLIF(prev, 0) AS change FROM (
        SELECT sum(deploy_count) FILTER (report_date >= DATE '2024-01-03')::DOUBLE AS cur, sum(deploy_count) FILTER (report_date < DATE '2024-01-03')::DOUBLE AS prev
        FROM health WHERE report_date < DATE '2024-01-31' AND report_date >= DATE '2023-12-06' AND squad = 'squad-2')""", *HEALTH, f="value previous_value change"))
def m05q(t):
    return semantic.kpi_value(marts.health(t), "total_deploys", EVENTS_AS_OF, filters={"squad": "squad-2"})


@query("M02_cost_metric", oracle(
    """SELECT report_date AS period, squad, sum(c) AS total_daily_cost_usd FROM (SELECT report_date, squad, max(daily_cost_usd) AS c FROM health GROUP BY 1, 2) GROUP BY 1, 2""",
    *HEALTH, d="period", f="total_daily_cost_usd"))
def m02c(t):
    return semantic.metric_query(marts.health(t), "total_daily_cost_usd", "day", ("squad",))


SQUAD_DAY = "(SELECT report_date, squad, max(daily_cost_usd) AS c FROM health WHERE environment = 'prod' GROUP BY 1, 2)"


@query("M02_cost_three_ways", oracle(
    f"""SELECT 'query' AS way, 'month' AS grain, CAST(date_trunc('month', report_date) AS DATE) AS period, sum(c) AS cost FROM {SQUAD_DAY} GROUP BY 3
        UNION ALL SELECT 'grains', 'month', CAST(date_trunc('month', report_date) AS DATE), sum(c) FROM {SQUAD_DAY} GROUP BY 3
        UNION ALL SELECT 'grains', 'year', CAST(date_trunc('year', report_date) AS DATE), sum(c) FROM {SQUAD_DAY} GROUP BY 3
        UNION ALL SELECT 'kpi', 'current', NULL, sum(c) FROM {SQUAD_DAY} WHERE report_date >= DATE '2024-01-16' AND report_date < DATE '2024-01-31'
        UNION ALL SELECT 'kpi', 'previous', NULL, sum(c) FROM {SQUAD_DAY} WHERE report_date >= DATE '2024-01-01' AND report_date < DATE '2024-01-16'""",
    *HEALTH, d="period", f="cost"))
def m02w(t):
    """Cost by query, by several grains and as a KPI: every way counts a squad and day once."""
    health, only = marts.health(t), {"environment": "prod"}
    cost = F.col(semantic.COST).cast("double").alias("cost")
    by_query = semantic.metric_query(health, semantic.COST, "month", (), only)
    by_grains = semantic.metric_by_grains(health, semantic.COST, ("month", "year"), (), only)
    kpi = semantic.kpi_value(health, semantic.COST, EVENTS_AS_OF, 15, only)
    none = F.lit(None).cast("date").alias("period")
    return (
        by_query.select(F.lit("query").alias("way"), F.lit("month").alias("grain"), "period", cost)
        .union(by_grains.select(F.lit("grains"), "grain", "period", cost))
        .union(kpi.select(F.lit("kpi"), F.lit("current"), none, "value"))
        .union(kpi.select(F.lit("kpi"), F.lit("previous"), none, "previous_value"))
    )


@query("M03_cost_beside_counts", oracle(
    f"""WITH a AS (SELECT g.grain, CAST(date_trunc(g.grain, report_date) AS DATE) AS period, squad, sum(deploy_count) AS total_deploys
            FROM health, (VALUES ('month'), ('year')) AS g(grain) GROUP BY 1, 2, 3),
        b AS (SELECT g.grain, CAST(date_trunc(g.grain, report_date) AS DATE) AS period, squad, sum(c) AS total_daily_cost_usd
            FROM (SELECT report_date, squad, max(daily_cost_usd) AS c FROM health GROUP BY 1, 2), (VALUES ('month'), ('year')) AS g(grain) GROUP BY 1, 2, 3)
        SELECT a.*, b.total_daily_cost_usd FROM a JOIN b ON a.grain = b.grain AND a.period = b.period AND a.squad IS NOT DISTINCT FROM b.squad""",
    *HEALTH, d="period", f="total_daily_cost_usd", i="total_deploys"))
def m03c(t):
    """An additive and a semi-additive metric in one query."""
    return semantic.metric_by_grains(marts.health(t), ["total_deploys", semantic.COST], ("month", "year"), ("squad",))


@query("M02_anomaly_dimensions", oracle(
    """SELECT CASE WHEN deployment_frequency >= 1 AND change_failure_rate <= 0.05 AND mean_time_to_recovery_mins <= 60 THEN 'Elite'
         WHEN deployment_frequency >= 1/7.0 AND change_failure_rate <= 0.10 AND mean_time_to_recovery_mins <= 1440 THEN 'High'
         WHEN deployment_frequency >= 1/30.0 AND change_failure_rate <= 0.15 THEN 'Medium' ELSE 'Low' END AS dora_tier, incident_anomaly AS has_incident_anomaly, cost_anomaly AS has_cost_anomaly, sum(deploy_count) AS total_deploys
       FROM health GROUP BY 1, 2, 3""", *HEALTH, i="total_deploys"))
def m02d(t):
    return semantic.metric_query(marts.health(t), "total_deploys", None, ("dora_tier", "has_incident_anomaly", "has_cost_anomaly"))


@query("M05_deploy_trend", oracle(
    """SELECT report_date AS period, sum(deploy_count) AS total_deploys, sum(incident_count) AS total_incidents
       FROM health WHERE environment = 'prod' GROUP BY 1 ORDER BY 1 LIMIT 90""", *HEALTH, d="period", i="total_deploys total_incidents"))
def m05t(t):
    return semantic.deploy_trend(marts.health(t), {"environment": "prod"})


@query("M05_slo_table", oracle(
    """SELECT service_name, slo_name, is_compliant, alert_tier, avg(avg_error_budget_remaining) AS avg_error_budget_remaining,
              sum(breach_count) AS total_breach_count FROM slo_week WHERE environment = 'prod' GROUP BY 1, 2, 3, 4""",
    *HEALTH, marts.SLO_WEEK, f="avg_error_budget_remaining", i="total_breach_count"))
def m05s(t):
    return semantic.slo_table(services.slo_compliance(marts.slo(t)), {"environment": "prod"})


@query("M05_cost_by_squad", oracle(
    """SELECT squad, sum(c) AS total_daily_cost_usd FROM (
         SELECT report_date, squad, max(daily_cost_usd) AS c FROM health WHERE environment = 'prod' GROUP BY 1, 2)
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""", *HEALTH, f="total_daily_cost_usd"))
def m05c(t):
    return semantic.cost_by_squad(marts.health(t), {"environment": "prod"})
