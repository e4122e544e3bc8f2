"""Thresholds and value sets. All of them are fixed values that results depend on."""

# Value sets.
FLEET_EVENT_TYPES = ["DEPLOY", "SCALE", "INCIDENT", "ALERT", "HEAL", "ROLLBACK"]
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO", "UNKNOWN"]
ENVIRONMENTS = ["dev", "staging", "prod"]
JOB_STATUSES = ["SUCCESS", "FAILURE", "TIMEOUT", "CANCELLED", "RETRYING"]
WORKLOAD_TYPES = ["model_training", "inference", "data_processing", "fine_tuning"]
EXPECTED_WORKLOADS = ["model_training", "inference", "data_processing"]
INFRA_EVENT_TYPES = [
    "NODE_PREEMPTION", "SPOT_INTERRUPT", "QUOTA_THROTTLE", "NETWORK_DEGRADATION", "SERVICE_DISRUPTION",
]
ANOMALY_SEVERITIES = ["low", "medium", "high", "critical"]

# Job columns.
JOB_REQUIRED = ["job_id", "workload_type", "status", "submitted_at", "execution_date"]
JOB_IDENTITY = ["job_id", "workload_type", "status", "submitted_at"]
JOB_TIMESTAMPS = ["submitted_at", "started_at", "completed_at", "ingested_at"]
JOB_RESOURCES = [
    "cpu_used_cores", "cpu_throttle_pct", "memory_used_gb", "gpu_utilisation_pct",
    "gpu_memory_used_gb", "network_egress_gb", "disk_read_gb", "disk_write_gb",
]
RESOURCE_BOUNDS = {
    "cpu_used_cores": (0, 512),
    "memory_used_gb": (0, 4096),
    "gpu_utilisation_pct": (0, 100),
}

# Windows and thresholds.
LOOKBACK_DAYS = 90
ANOMALY_LOOKBACK_DAYS = 30
ZSCORE_THRESHOLD = 3.0
IQR_MULTIPLIER = 1.5
SLO_READINESS = 95.0
JOB_ZSCORE_THRESHOLD = 2.0
MIN_BASELINE = 30
MIN_OBSERVATIONS = 10
CLOCK_SKEW_SECONDS = 30
CORRELATION_SECONDS = 300

# (elite, high, medium) lower bounds of deployment frequency.
DORA_DAILY = (1.0, 1.0 / 7.0, 1.0 / 30.0)
DORA_WEEKLY = (7.0, 1.0, 1.0)

# (dataset, table, hours allowed between updates)
FRESHNESS_SLA = [
    ("ops_raw", "fleet_events", 2),
    ("ops_raw", "slo_metrics", 2),
    ("ops_raw", "cost_billing_export", 25),
    ("ops_staging", "stg_fleet_events", 3),
    ("ops_staging", "stg_slo_metrics", 3),
    ("ops_marts", "fleet_health_daily", 26),
    ("ops_marts", "slo_compliance", 26),
    ("ops_marts", "cost_attribution", 49),
]

# table -> (warn hours, error hours)
SOURCE_FRESHNESS = {
    "fleet_events": (2, 4),
    "slo_metrics": (2, 6),
    "cost_billing_export": (26, 50),
}

DURATION_BUCKETS = [(60, "<1m"), (300, "1-5m"), (900, "5-15m"), (3600, "15-60m")]
