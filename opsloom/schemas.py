"""Schemas of the raw tables: DDL text, which readers accept, and a struct for the stream."""
from pyspark.sql import types as T


def _struct(ddl: str) -> str:
    return " ".join(ddl.split())


_LABELS = "ARRAY<STRUCT<key: STRING, value: STRING>>"

JOB_METADATA = _struct("""
    job_id STRING, job_name STRING, workload_type STRING, workload_class STRING,
    environment STRING, cloud_provider STRING, region STRING, cluster_id STRING, team STRING,
    submitted_at TIMESTAMP, started_at TIMESTAMP, completed_at TIMESTAMP, execution_date DATE,
    duration_seconds DOUBLE, status STRING, exit_code BIGINT, retry_attempt BIGINT,
    parent_job_id STRING, error_category STRING, error_message STRING, model_name STRING,
    model_version STRING, dataset_size_gb DOUBLE, checkpoint_path STRING, pipeline_name STRING,
    pipeline_run_id STRING, commit_sha STRING, ingested_at TIMESTAMP""")

RESOURCE_ALLOCATION_LOGS = _struct("""
    log_id STRING, job_id STRING, log_date DATE, collected_at TIMESTAMP,
    cpu_requested_cores DOUBLE, cpu_used_cores DOUBLE, cpu_throttle_pct DOUBLE,
    memory_requested_gb DOUBLE, memory_used_gb DOUBLE, memory_limit_gb DOUBLE,
    gpu_count BIGINT, gpu_utilisation_pct DOUBLE, gpu_memory_used_gb DOUBLE,
    network_egress_gb DOUBLE, disk_read_gb DOUBLE, disk_write_gb DOUBLE,
    compute_cost_usd DECIMAL(38,9), node_type STRING, ingested_at TIMESTAMP""")

INFRASTRUCTURE_EVENTS = _struct("""
    event_id STRING, event_date DATE, event_timestamp TIMESTAMP, event_type STRING,
    severity STRING, source_system STRING, affected_node STRING, affected_zone STRING,
    affected_pool STRING, resource_type STRING, impact_description STRING,
    duration_seconds BIGINT, correlated_job_ids ARRAY<STRING>, ingested_at TIMESTAMP""")

FLEET_EVENTS = _struct("""
    event_key STRING, source_system STRING, environment STRING, cluster_name STRING,
    region STRING, event_id STRING, event_type STRING, event_subtype STRING,
    service_name STRING, event_timestamp TIMESTAMP, event_date DATE, duration_ms BIGINT,
    severity STRING, status STRING, message STRING, payload_json STRING, slo_name STRING,
    error_budget_burn DOUBLE, cost_centre STRING, squad STRING, ingested_at TIMESTAMP,
    pipeline_version STRING, source_file STRING""")

# Columns that a message must carry are not nullable.
FLEET_TELEMETRY = (
    T.StructType()
    .add("event_id", "string", False).add("cluster_name", "string", False).add("node_group", "string")
    .add("environment", "string", False).add("event_type", "string", False).add("service_name", "string")
    .add("aws_region", "string").add("readiness_score", "double")
    .add("node_count", "long").add("healthy_nodes", "long")
    .add("desired_tasks", "long").add("running_tasks", "long")
    .add("event_ts", "timestamp", False)
)

SLO_METRICS = _struct("""
    metric_key STRING, service_name STRING, environment STRING, slo_name STRING,
    slo_target DOUBLE, slo_window_days BIGINT, good_events BIGINT, total_events BIGINT,
    error_rate DOUBLE, availability DOUBLE, error_budget_remaining DOUBLE,
    burn_rate_1h DOUBLE, burn_rate_6h DOUBLE, burn_rate_24h DOUBLE, burn_rate_72h DOUBLE,
    is_breaching BOOLEAN, alert_tier STRING, snapshot_timestamp TIMESTAMP,
    snapshot_date DATE, ingested_at TIMESTAMP, source_system STRING""")

COST_BILLING_EXPORT = _struct(f"""
    billing_account_id STRING, service STRUCT<id: STRING, description: STRING>,
    sku STRUCT<id: STRING, description: STRING>, usage_start_time TIMESTAMP,
    usage_end_time TIMESTAMP, usage_date DATE,
    project STRUCT<id: STRING, name: STRING, labels: {_LABELS}, ancestry_numbers: STRING>,
    labels {_LABELS}, system_labels {_LABELS},
    location STRUCT<location: STRING, country: STRING, region: STRING, zone: STRING>,
    resource STRUCT<name: STRING, global_name: STRING>, cost DECIMAL(38,9), currency STRING,
    currency_conversion_rate DOUBLE,
    usage STRUCT<amount: DOUBLE, unit: STRING, amount_in_pricing_units: DOUBLE, pricing_unit: STRING>,
    credits ARRAY<STRUCT<name: STRING, amount: DECIMAL(38,9), full_name: STRING, id: STRING, type: STRING>>,
    invoice STRUCT<month: STRING>, cost_type STRING,
    adjustment_info STRUCT<id: STRING, description: STRING, mode: STRING, type: STRING>,
    ingested_at TIMESTAMP, pipeline_run_id STRING""")

FLIGHT_ROUTES = _struct("""
    flight_id STRING, route_code STRING, origin STRING, dest STRING, airline STRING,
    aircraft_type STRING, cabin_class STRING, event_type STRING, priority STRING,
    scheduled_departure_ts TIMESTAMP, actual_departure_ts TIMESTAMP,
    actual_arrival_ts TIMESTAMP, is_cancelled BOOLEAN, is_diverted BOOLEAN""")

INFRA_METRICS = _struct("""
    metric_id STRING, service_name STRING, cluster_name STRING, namespace STRING,
    environment STRING, metric_name STRING, metric_source STRING, metric_value DOUBLE,
    cpu_utilisation DOUBLE, mem_utilisation DOUBLE, request_count BIGINT, error_rate DOUBLE,
    latency_p99_ms DOUBLE, scraped_ts TIMESTAMP""")

COST_EVENTS = _struct("""
    cost_event_id STRING, team STRING, service_name STRING, environment STRING,
    cost_category STRING, cloud_provider STRING, aws_region STRING, resource_id STRING,
    cost_usd DOUBLE, usage_amount DOUBLE, usage_unit STRING, cost_date DATE""")

FLEET_DAILY = ["cluster_name", "environment"]

# table -> (schema or None for a mart, partition column, cluster columns, expiry in days or None); a partition column
# "date:x" is the date of column x.
LAYOUT = {
    "job_metadata": (JOB_METADATA, "execution_date", ["workload_type", "environment", "status", "team"], 365),
    "resource_allocation_logs": (RESOURCE_ALLOCATION_LOGS, "log_date", ["job_id", "log_date"], None),
    "infrastructure_events": (INFRASTRUCTURE_EVENTS, "event_date", ["event_type", "severity", "source_system"], None),
    "fleet_events": (FLEET_EVENTS, "event_date", ["source_system", "event_type", "environment", "severity"], 365),
    "slo_metrics": (SLO_METRICS, "snapshot_date", ["service_name", "environment", "slo_name"], None),
    "cost_billing_export": (COST_BILLING_EXPORT, "usage_date", ["billing_account_id", "service.id", "project.id"], None),
    "fleet_telemetry": (FLEET_TELEMETRY, "date:event_ts", FLEET_DAILY, None),
    "flight_routes": (FLIGHT_ROUTES, "date:scheduled_departure_ts", ["route_code", "airline"], None),
    "infra_metrics": (INFRA_METRICS, "date:scraped_ts", FLEET_DAILY, None),
    "cost_events": (COST_EVENTS, "cost_date", ["team", "environment"], None),
    "fleet_health_daily": (None, "report_date", ["environment", "service_name", "squad"], None),
    "fleet_readiness_daily": (None, "event_date", FLEET_DAILY, None),
    "anomaly_log": (None, "event_date", ["cluster_name", "anomaly_severity"], None),
    "flight_ops_summary": (None, "event_date", ["route_code", "airline"], None),
    "infra_cost_by_team": (None, "cost_date", ["team", "environment"], None),
    "cost_attribution": (None, "billing_month", ["team_label", "project_id"], None),
    "slo_compliance": (None, "report_week", ["service_name", "environment", "slo_name"], None),
    "ops_kpi_dashboard": (None, "event_date", [], None),
}
