"""Sources, sinks and streams. Each query writes what it tests to the shared folder and
returns what is read back."""
import uuid

from pyspark.sql import functions as F

from checks import fleet as fleet_checks, jobs, marts
from checks.registry import oracle, query
from opsloom import schemas
from opsloom.operators import quality, staging
from opsloom.operators.baseline import anomaly_report
from opsloom.plans import costs, fleet, freshness, scripts, services
from opsloom.session import checkpoint_dir
from opsloom.sources import sinks, tables
from opsloom.sources.adapters import EVENTS_AS_OF
from opsloom.streaming import ingest


def scratch(t, name):
    return f"{checkpoint_dir(t.spark)}/opsloom-{name}-{uuid.uuid4().hex}"


@query("S01_read_table", oracle("SELECT * FROM events", f="value", t="ts"))
def s01(t):
    return tables.read_table(t.spark, f"{t.folder}/events.parquet")


@query("S02_read_folder", oracle("SELECT * FROM events", f="value", t="ts"))
def s02(t):
    folder = scratch(t, "folder")
    sinks.write_overwrite(t.raw("events").repartition(5), folder)
    return tables.read_folder(t.spark, folder)


@query("S03_write_overwrite", oracle("SELECT * FROM by_team", *marts.COSTS, d="cost_date", f=marts.BY_TEAM_F))
def s03(t):
    path = scratch(t, "overwrite")
    df = marts.by_team(t)
    sinks.write_overwrite(df.limit(1), path)
    sinks.write_overwrite(df, path)
    return tables.read_table(t.spark, path)


@query("S04_json_report", oracle(
    """SELECT count(*) AS total_jobs, count(*) FILTER (is_anomaly) AS anomalous_jobs,
              count(DISTINCT workload_type) FILTER (is_anomaly) AS types, least(10, count(*) FILTER (is_anomaly)) AS top
       FROM scored""", *__import__("checks.jobs", fromlist=["DETECT"]).DETECT))
def s04(t):
    from checks.jobs import clean_scored
    path = scratch(t, "report")
    sinks.write_report(anomaly_report(clean_scored(t), EVENTS_AS_OF), path)
    report = t.spark.read.json(path)
    types = F.size(F.json_object_keys(F.to_json("by_workload_type")))
    return report.select("total_jobs", "anomalous_jobs", types.alias("types"), F.size("top_anomalies").alias("top"))


@query("S05_run_sql", oracle(
    """SELECT execution_date, workload_type, status, count(*) AS jobs, avg(duration_seconds) AS avg_duration_s
       FROM job_metadata WHERE execution_date = DATE '2024-01-15' GROUP BY 1, 2, 3""",
    "job_metadata", d="execution_date", f="avg_duration_s"))
def s05(t):
    return tables.run_sql(t.spark, "jobs_by_status", "2024-01-15", {"job_metadata": t.job_metadata})


@query("S05_run_sql_costs", oracle(
    "SELECT cost_date, cloud_provider, sum(cost_usd) AS cost_usd FROM cost_events WHERE cost_date <= DATE '2024-01-31' GROUP BY 1, 2",
    "cost_events", d="cost_date", f="cost_usd"))
def s05b(t):
    return tables.run_sql(t.spark, "cost_by_provider", "2024-01-31", {"cost_events": t.cost_events})


@query("S07_write_table", oracle("SELECT fleet_health_key, report_date, service_name, total_events FROM health WHERE report_date >= DATE '2024-01-20'",
       *marts.SERVICE, d="report_date"))
def s07(t):
    path = scratch(t, "layout")
    sinks.write_table(marts.health(t), path, "report_date", ["environment", "service_name", "squad"])
    return tables.read_table(t.spark, path).where("report_date >= DATE '2024-01-20'").select(
        "fleet_health_key", "report_date", "service_name", "total_events")


@query("S07_write_known_tables", oracle(
    """SELECT 'flight_routes' AS name, count(*) AS n, count(DISTINCT CAST(scheduled_departure_ts AS DATE)) AS parts FROM flight_routes
       UNION ALL SELECT 'cost_events', count(*), count(DISTINCT cost_date) FROM cost_events
       UNION ALL SELECT 'infra_metrics', count(*), count(DISTINCT CAST(scraped_ts AS DATE)) FROM infra_metrics
       UNION ALL SELECT 'fleet_health_daily', count(*), count(DISTINCT report_date) FROM health""",
    "flight_routes", "cost_events", "infra_metrics", *marts.SERVICE))
def s07k(t):
    out = None
    for name, df, day in (("flight_routes", t.flight_routes, "scheduled_departure_ts_date"), ("cost_events", t.cost_events, "cost_date"),
                          ("infra_metrics", t.infra_metrics, "scraped_ts_date"), ("fleet_health_daily", marts.health(t), "report_date")):
        path = scratch(t, name)
        sinks.write_known(df, name, path)
        one = t.spark.read.parquet(path).groupBy(day).count().agg(F.sum("count").alias("n"), F.count(day).alias("parts")).select(F.lit(name).alias("name"), "n", "parts")
        out = one if out is None else out.union(one)
    return out


@query("S08_upsert_recent_days", oracle("SELECT * FROM health", *marts.SERVICE, d="report_date", f=marts.HEALTH_F))
def s08(t):
    """The mart as of the 29th, then three days reprocessed on the 31st: equal to a full build."""
    path = scratch(t, "upsert")
    ev, sl, bi = marts.events(t), marts.slo(t), marts.billing(t)
    old = services.fleet_health_daily(ev.where("event_timestamp < TIMESTAMP '2024-01-29 12:00:00'"), sl, bi)
    sinks.write_table(old, path, "report_date")
    recent = services.fleet_health_daily(
        sinks.since_days(ev, "event_date", EVENTS_AS_OF, 3), sinks.since_days(sl, "snapshot_date", EVENTS_AS_OF, 3),
        sinks.since_days(bi, "usage_date", EVENTS_AS_OF, 3))
    sinks.replace_partitions(recent, path, "report_date", "fleet_health_key")
    return tables.read_table(t.spark, path).select(*old.columns)


@query("S08_upsert_whole_weeks", oracle("SELECT * FROM slo_week", *marts.SERVICE, marts.SLO_WEEK, d="report_week", f=marts.SLO_F))
def s08w(t):
    """A weekly mart reprocessed for fourteen days, widened to whole weeks."""
    path = scratch(t, "weekly")
    sl = marts.slo(t)
    old = services.slo_compliance(sl.where("snapshot_timestamp < TIMESTAMP '2024-01-24 12:00:00'"))
    sinks.write_table(old, path, "report_week")
    recent = services.slo_compliance(sinks.since_days(sl, "snapshot_date", EVENTS_AS_OF, 14, whole_weeks=True))
    sinks.replace_partitions(recent, path, "report_week", "slo_key")
    return tables.read_table(t.spark, path).select(*old.columns)


@query("S09_append_audit", oracle(
    """SELECT event_date, anomaly_severity, count(*) AS anomaly_count, TIMESTAMP '2024-01-31 00:00:00' AS checked_at FROM candidates
       WHERE event_date >= DATE '2024-01-24' GROUP BY 1, 2
       UNION ALL SELECT event_date, anomaly_severity, count(*), TIMESTAMP '2024-01-31 04:00:00' FROM candidates
       WHERE event_date >= DATE '2024-01-24' GROUP BY 1, 2""", *fleet_checks.CANDIDATES, d="event_date", t="checked_at"))
def s09(t):
    path = scratch(t, "audit")
    summary = fleet.anomaly_summary(fleet.anomaly_log(fleet_checks.candidates(t)), EVENTS_AS_OF).drop("affected_clusters")
    for at in (EVENTS_AS_OF, "2024-01-31 04:00:00"):
        sinks.append_audit(summary, path, at)
    return tables.read_table(t.spark, path)


@query("S10_sla_config_join", oracle(
    """SELECT 'ops_raw' AS dataset_id, table_name, sla_hours, total_rows FROM
       (SELECT 'fleet_events' AS table_name, count(*) AS total_rows FROM events UNION ALL SELECT 'cost_billing_export', count(*) FROM lineitem)
       JOIN (VALUES ('fleet_events', 2), ('cost_billing_export', 25)) l(table_name, sla_hours) USING (table_name)""", i="sla_hours"))
def s10(t):
    parts = freshness.partition_statistics(t.raw("events"), "ops_raw", "fleet_events", "ts").unionByName(
        freshness.partition_statistics(t.raw("lineitem"), "ops_raw", "cost_billing_export", "l_shipdate"))
    return freshness.table_freshness(parts, EVENTS_AS_OF).select("dataset_id", "table_name", "sla_hours", "total_rows")


@query("S11_materialize", oracle("SELECT * FROM summary", *marts.FLIGHTS, d="event_date",
       f=marts.PERF_F + " rolling_7d_otp_rate rolling_7d_avg_delay wow_otp_delta"))
def s11(t):
    sinks.materialize(staging.flight_routes(t.flight_routes), "stg_flight_routes", "view")
    from opsloom.plans import flights
    days = sinks.materialize(flights.route_day_performance(t.spark.table("stg_flight_routes")), "route_days", "table", scratch(t, "model"))
    return flights.flight_ops_summary(days)


@query("S12_store_failures", oracle(
    "SELECT cost_event_id, count(*) AS n_records FROM cost_events WHERE cost_event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "cost_events"))
def s12(t):
    folder = scratch(t, "failures")
    failed = sinks.store_failures({
        "unique_cost_event_id": quality.failing_unique(t.cost_events, "cost_event_id"),
        "cost_not_negative": quality.failing_range(marts.by_team(t), "total_cost_usd", 0),
    }, folder)
    assert failed == ["unique_cost_event_id"]
    return tables.read_table(t.spark, f"{folder}/unique_cost_event_id")


@query("S13_retention", oracle("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-21'", d="event_date"))
def s13(t):
    path = scratch(t, "retention")
    sinks.write_table(t.raw("events").select("event_id", F.to_date("ts").alias("event_date")), path, "event_date")
    return tables.retained(t.spark.read.parquet(path), "event_date", EVENTS_AS_OF, 10)


@query("S13_expire_partitions", oracle("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-21'", d="event_date"))
def s13e(t):
    """The folders of older days are removed; what is left is read without a filter."""
    path = scratch(t, "expiry")
    sinks.write_table(t.raw("events").select("event_id", F.to_date("ts").alias("event_date")), path, "event_date")
    sinks.expire_partitions(t.spark, path, "event_date", EVENTS_AS_OF, 10)
    return t.spark.read.parquet(path)


@query("S14_append_new_columns", oracle(
    """SELECT event_id, user_id, ts, value, props, CAST(NULL AS VARCHAR) AS event_type FROM events
       UNION ALL SELECT event_id, user_id, ts, value, props, event_type FROM events""", f="value", t="ts"))
def s14(t):
    path = scratch(t, "evolve")
    events = t.raw("events")
    sinks.append_evolving(events.drop("event_type"), path)
    sinks.append_evolving(events, path)
    return sinks.read_evolved(t.spark, path).select("event_id", "user_id", "ts", "value", "props", "event_type")


@query("F14_surrogate_key", oracle(
    f"SELECT service_name, squad, {marts.key_sql('event_date', 'service_name', 'squad', 'cost_centre')} AS key FROM fleet_events", "fleet_events"))
def f14(t):
    from opsloom.functions import surrogate_key
    return t.fleet_events.select("service_name", "squad", surrogate_key("event_date", "service_name", "squad", "cost_centre").alias("key"))


@query("F15_event_key", oracle(
    "SELECT event_key, sha256(concat_ws('|', source_system, coalesce(event_id, ''), CAST(event_date AS VARCHAR))) AS key FROM fleet_events", "fleet_events"))
def f15(t):
    from opsloom.functions import event_key
    return t.fleet_events.select("event_key", event_key("source_system", "event_id", "event_date").alias("key"))


@query("F16_dora_tier", oracle(
    """SELECT fleet_health_key, CASE
         WHEN deployment_frequency >= 1 AND change_failure_rate <= 0.05 AND mean_time_to_recovery_mins <= 60 THEN 'Elite'
         WHEN deployment_frequency >= 1/7.0 AND change_failure_rate <= 0.10 AND mean_time_to_recovery_mins <= 1440 THEN 'High'
         WHEN deployment_frequency >= 1/30.0 AND change_failure_rate <= 0.15 THEN 'Medium' ELSE 'Low' END AS tier FROM health""",
    *marts.SERVICE))
def f16(t):
    from opsloom.functions import dora_tier
    return marts.health(t).select("fleet_health_key", dora_tier(
        "deployment_frequency", "change_failure_rate", "mean_time_to_recovery_mins").alias("tier"))


@query("F01_safe_divide", oracle(
    """SELECT event_id, value / NULLIF(event_id % 3, 0) AS plain, CASE WHEN event_id % 3 = 0 THEN -1 ELSE value / (event_id % 3) END AS fallback
       FROM events""", f="plain fallback"))
def f01(t):
    from opsloom.functions import safe_divide
    third = F.col("event_id") % 3
    return t.raw("events").select("event_id", safe_divide("value", third).alias("plain"), safe_divide("value", third, -1.0).alias("fallback"))


@query("F04_calendar", oracle(
    """SELECT event_id, CAST(date_trunc('week', ts + INTERVAL 1 DAY) AS DATE) - 1 AS week_start, CAST(date_trunc('month', ts) AS DATE) AS month_start,
              CAST(date_trunc('quarter', ts) AS DATE) AS quarter_start, date_trunc('hour', ts) AS hour_start, hour(ts) AS hour_of_day,
              date_sub('minute', ts, TIMESTAMP '2024-01-31 00:00:00') AS minutes_old, date_sub('hour', ts, TIMESTAMP '2024-01-31 00:00:00') AS hours_old,
              (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)) / 3600000000.0::DOUBLE AS age_hours FROM events""",
    d="week_start month_start quarter_start", t="hour_start", f="age_hours", i="hour_of_day"))
def f04(t):
    from opsloom.functions import date_trunc_safe, hours_between, micros, minutes_between, month_start, week_start
    now = F.lit(EVENTS_AS_OF).cast("timestamp")
    return t.raw("events").select(
        "event_id", week_start("ts").alias("week_start"), month_start("ts").alias("month_start"),
        date_trunc_safe("quarter", "ts").alias("quarter_start"), F.date_trunc("hour", "ts").alias("hour_start"),
        F.hour("ts").alias("hour_of_day"), minutes_between(now, "ts").alias("minutes_old"), hours_between(now, "ts").alias("hours_old"),
        ((micros(now) - micros("ts")) / 3_600_000_000.0).alias("age_hours"))


@query("F17_severity_labels", oracle(
    """SELECT event_id, CASE WHEN z >= 5 THEN 'critical' WHEN z >= 4 THEN 'high' WHEN z >= 3 THEN 'medium' ELSE 'low' END AS ladder,
              CASE WHEN z < 2 THEN 'NORMAL' WHEN z < 3 THEN 'MEDIUM' WHEN z < 4 THEN 'HIGH' WHEN z IS NOT NULL THEN 'CRITICAL' END AS bins
       FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE floor(value) / 16 END AS z FROM events)"""))
def f17(t):
    from opsloom.functions import severity_bins, severity_ladder
    z = F.when(F.col("event_id") % 10 != 0, F.floor("value") / 16)
    return t.raw("events").select("event_id", severity_ladder(z).alias("ladder"), severity_bins(z, 2.0).alias("bins"))


# ---------------------------------------------------------------- streams

def messages(t):
    """JSON lines from the telemetry: one in 50 broken, one in 60 without id, one in 70
    without time, one in 80 without cluster, one in 90 sent twice."""
    n = F.col("event_id").cast("bigint")
    row = F.to_json(F.struct(
        F.when(n % 60 == 3, "").otherwise(F.col("event_id")).alias("event_id"),
        F.when(n % 80 != 5, F.col("cluster_name")).alias("cluster_name"), "node_group", "environment", "event_type", "service_name",
        "aws_region", "readiness_score", "node_count", "healthy_nodes", "desired_tasks", "running_tasks",
        F.when(n % 70 != 4, F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("event_ts"),
    ))
    text = F.when(n % 50 == 2, F.expr("substring(_row, 1, 40)")).otherwise(F.col("_row"))
    copies = F.when(n % 90 == 6, F.lit(2)).otherwise(F.lit(1))
    return t.fleet_telemetry.withColumn("_row", row).select(
        F.explode(F.array_repeat(text, copies)).alias("value"), "event_ts")


MESSAGES = """messages AS (
    SELECT *, CASE WHEN n % 50 = 2 THEN 'not parsed' WHEN n % 60 = 3 OR n % 70 = 4 THEN 'no id or time'
                   WHEN n % 80 = 5 THEN 'required field missing' END AS reason, CASE WHEN n % 90 = 6 THEN 2 ELSE 1 END AS copies
    FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM fleet_telemetry))"""
TELEMETRY = "event_id, cluster_name, environment, event_type, readiness_score, healthy_nodes, event_ts"


@query("P20_valid_messages", oracle(
    f"SELECT {TELEMETRY} FROM messages, range(2) r(i) WHERE reason IS NULL AND i < copies", "fleet_telemetry", MESSAGES,
    t="event_ts", f="readiness_score"))
def p20(t):
    return ingest.valid_messages(messages(t)).select(*TELEMETRY.split(", "))


@query("P20_rejected_messages", oracle(
    "SELECT reason, sum(copies) AS n FROM messages WHERE reason IS NOT NULL GROUP BY 1", "fleet_telemetry", MESSAGES, i="n"))
def p20r(t):
    return ingest.rejected_messages(messages(t)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def written_messages(t):
    """The messages as text files, a few per day, in order of time."""
    folder = scratch(t, "messages")
    messages(t).repartitionByRange(6, "event_ts").sortWithinPartitions("event_ts").select("value").write.text(folder)
    return folder


@query("ST01_streaming_ingest", oracle(f"SELECT {TELEMETRY} FROM messages WHERE reason IS NULL", "fleet_telemetry", MESSAGES,
       t="event_ts", f="readiness_score"))
def st01(t):
    source, sink, state = written_messages(t), scratch(t, "sink"), scratch(t, "state")
    ingest.ingest(t.spark, source, sink, state, late="60 days").awaitTermination()
    return tables.read_table(t.spark, sink).select(*TELEMETRY.split(", "))


@query("ST06_ingest_loses_nothing", oracle(
    f"""SELECT 'kept or late' AS kind, event_id AS what, CAST(1 AS BIGINT) AS n FROM messages WHERE reason IS NULL
        UNION ALL SELECT 'rejected', reason, CAST(sum(copies) AS BIGINT) FROM messages WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'input', '', CAST(sum(copies) AS BIGINT) FROM messages""", "fleet_telemetry", MESSAGES))
def st06(t):
    """Three batches or more with the default watermark: every valid id is kept or late, all rejects are there with their reason, and
    kept, late, rejected and repeated messages add up to the input."""
    source, sink, state = written_messages(t), scratch(t, "sink"), scratch(t, "state")
    ingest.ingest(t.spark, source, sink, state, max_files=2).awaitTermination()
    kept, late, rejected = (tables.read_table(t.spark, sink + x) for x in ("", "_late", "_rejected"))
    one = F.lit(1).cast("long").alias("n")
    seen = kept.select("event_id").union(late.select("event_id"))
    valid = ingest.valid_messages(t.spark.read.text(source))
    repeats = valid.groupBy("event_id").count().join(seen.groupBy("event_id").agg(F.count(F.lit(1)).alias("seen")), "event_id")
    parts = [kept.agg(F.count(F.lit(1)).alias("n")), late.agg(F.count(F.lit(1)).alias("n")), rejected.agg(F.count(F.lit(1)).alias("n")),
             repeats.agg(F.coalesce(F.sum(F.col("count") - F.col("seen")), F.lit(0)).alias("n"))]
    total = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).agg(F.sum("n").alias("n"))
    return (seen.distinct().select(F.lit("kept or late").alias("kind"), F.col("event_id").alias("what"), one)
            .union(rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected"), "reason", "n"))
            .union(total.select(F.lit("input"), F.lit(""), "n")))


@query("ST05_streaming_hourly_scores", oracle(
    """SELECT cluster_name, environment, event_hour, avg((node_health_ratio + task_running_ratio) / 2 * 100) AS availability_score,
              avg(readiness_score) AS avg_readiness_score, count(*) AS event_count
       FROM stg_telemetry GROUP BY 1, 2, 3""", "fleet_telemetry", fleet_checks.STG_TELEMETRY,
    t="event_hour", f="availability_score avg_readiness_score"))
def st05(t):
    """Update the hours on the stream; the last state of each hour equals the batch result."""
    source, state = scratch(t, "telemetry"), scratch(t, "state")
    t.fleet_telemetry.repartitionByRange(4, "event_ts").write.parquet(source)
    stream = t.spark.readStream.schema(schemas.FLEET_TELEMETRY).option("maxFilesPerTrigger", 2).parquet(source)
    sink = scratch(t, "hours")

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(sink)

    (ingest.hourly_scores(stream, "60 days").writeStream.outputMode("update").foreachBatch(keep)
     .option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination())
    hours = tables.read_table(t.spark, sink)
    latest = hours.groupBy("cluster_name", "environment", "event_hour").agg(
        F.max_by(F.struct("availability_score", "avg_readiness_score", "event_count"), "batch").alias("s"))
    return latest.select("cluster_name", "environment", "event_hour", "s.*")


# ---------------------------------------------------------------- scripts

DAY = "DATE '2024-01-25'"


def script(t, name, **parameters):
    return scripts.run_script(t.spark, name, {n: getattr(t, n) for n in scripts.SCRIPTS[name].tables}, scan_date="2024-01-25", **parameters)


@query("S05_extract_job_metadata", oracle(
    f"""SELECT z.job_id, z.canonical_job_id, z.workload_type, z.execution_date, z.duration_seconds, {jobs.Z_COLS}, {jobs.RES_COLS},
               {jobs.IMP_COLS}, TIMESTAMP '2024-01-31 00:00:00' AS extracted_at
        FROM zscored z LEFT JOIN resources r ON r.job_id = z.job_id AND r.log_date = z.execution_date
        LEFT JOIN impact i ON i.job_id = z.job_id AND i.execution_date = z.execution_date WHERE z.execution_date = {DAY}""",
    *jobs.EXTRACT, d="execution_date", t="extracted_at", f=jobs.BASELINE_F + " duration_seconds duration_z_score " + jobs.RES_F))
def s05_extract(t):
    return script(t, "extract_job_metadata", as_of="2024-01-31 00:00:00").select(
        "job_id", "canonical_job_id", "workload_type", "execution_date", "duration_seconds", *jobs.Z_COLS.split(", "), *jobs.RES_COLS.split(", "),
        *jobs.IMP_COLS.split(", "), "extracted_at")


@query("S05_infra_event_correlation", oracle(
    "SELECT o.*, p.anomalous_job_count, p.avg_z_score, p.avg_duration_s FROM overlap o JOIN pattern p ON p.start_hour = o.event_hour",
    *jobs.EXTRACT, jobs.LONG.replace("duration_z_score > 2)", f"duration_z_score > 2 AND execution_date = {DAY})"), jobs.OVERLAP, jobs.PATTERN,
    f="avg_anomaly_zscore avg_z_score avg_duration_s", i="event_hour"))
def s05_correlation(t):
    return script(t, "infra_event_correlation")


@query("S05_resource_utilisation", oracle(
    f"""SELECT * FROM (
          SELECT *, lag(daily_compute_cost_usd) OVER w AS prev_day_cost_usd,
                 (daily_compute_cost_usd - lag(daily_compute_cost_usd) OVER w) / NULLIF(lag(daily_compute_cost_usd) OVER w, 0) * 100 AS cost_change_pct
          FROM usage WINDOW w AS (PARTITION BY workload_type, team, cloud_provider, environment, node_type ORDER BY summary_date))
        WHERE summary_date = {DAY}""",
    "job_metadata", "resource_allocation_logs", jobs.USAGE, d="summary_date", f=jobs.USAGE_F + " prev_day_cost_usd cost_change_pct"))
def s05_utilisation(t):
    return script(t, "resource_utilisation")


@query("X06_sql_macros", oracle(
    """SELECT event_id, value / NULLIF(event_id % 3, 0) AS plain, CASE WHEN event_id % 3 = 0 THEN -1 ELSE value / (event_id % 3) END AS fallback,
              CAST(date_trunc('week', ts + INTERVAL 1 DAY) AS DATE) - 1 AS week_start, CAST(date_trunc('quarter', ts) AS DATE) AS quarter_start,
              CASE WHEN value / 50 >= 1 AND event_id % 5 * 0.04 <= 0.05 AND event_id % 7 * 20 <= 60 THEN 'Elite'
                   WHEN value / 50 >= 1 / 7.0::DOUBLE AND event_id % 5 * 0.04 <= 0.10 THEN 'High'
                   WHEN value / 50 >= 1 / 30.0::DOUBLE AND event_id % 5 * 0.04 <= 0.15 THEN 'Medium' ELSE 'Low' END AS tier
       FROM events""", f="plain fallback", d="week_start quarter_start"))
def x06_macros(t):
    scripts.register_macros(t.spark)
    tables.register_views({"raw_events": t.raw("events")})
    return t.spark.sql("""
        SELECT event_id, safe_divide(value, event_id % 3) AS plain, safe_divide_or(value, event_id % 3, -1) AS fallback,
               date_trunc_safe('week', ts) AS week_start, date_trunc_safe('quarter', ts) AS quarter_start,
               dora_tier(value / 50, event_id % 5 * 0.04D, event_id % 7 * 20) AS tier FROM raw_events""")


@query("X06_sql_zscores", oracle(
    """SELECT cluster_name, environment, event_hour,
              (avg_readiness_score - avg(avg_readiness_score) OVER w) / NULLIF(stddev_pop(avg_readiness_score) OVER w, 0) AS z,
              (avg_readiness_score - avg(avg_readiness_score) OVER r) / CASE WHEN stddev_pop(avg_readiness_score) OVER r > 1e-9 THEN stddev_pop(avg_readiness_score) OVER r END AS rolling_z
       FROM hourly_fleet WINDOW w AS (PARTITION BY cluster_name, environment),
            r AS (PARTITION BY cluster_name, environment ORDER BY event_hour ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
    *fleet_checks.FLEET, t="event_hour", f="z rolling_z"))
def x06_zscores(t):
    scripts.register_macros(t.spark)
    tables.register_views({"hourly_fleet": fleet.hourly_fleet(staging.fleet_telemetry(t.fleet_telemetry))})
    return t.spark.sql("""
        SELECT cluster_name, environment, event_hour, zscore(avg_readiness_score, mean, deviation) AS z,
               rolling_zscore(avg_readiness_score, rolling_mean, rolling_deviation) AS rolling_z
        FROM (SELECT *, avg(avg_readiness_score) OVER w AS mean, stddev_pop(avg_readiness_score) OVER w AS deviation,
                     avg(avg_readiness_score) OVER r AS rolling_mean, stddev_pop(avg_readiness_score) OVER r AS rolling_deviation
              FROM hourly_fleet WINDOW w AS (PARTITION BY cluster_name, environment),
                   r AS (PARTITION BY cluster_name, environment ORDER BY event_hour ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))""")
