"""Domain tables derived from the test tables.

Every adapter is a projection of a whole table, written in expressions that Spark and
other SQL engines read alike, so that an independent check can use the same inputs.
Measures are cut to quarters: sums of quarters are exact in binary floating point, so
results do not depend on the order of summation.
"""
from pyspark.sql import DataFrame, SparkSession, functions as F

# The fixed run date: the day after the last event.
EVENTS_AS_OF = "2024-01-31 00:00:00"

_ENV = "CASE CAST(floor(user_id / 2) AS BIGINT) % 3 WHEN 0 THEN 'prod' WHEN 1 THEN 'staging' ELSE 'dev' END"
_Q = "(floor(value * 4) / 4)"
_ID = "CAST(event_id AS STRING)"
_PART_ENV = "CASE l_partkey % 3 WHEN 0 THEN 'prod' WHEN 1 THEN 'staging' ELSE 'dev' END"
_COST_TS = "(TIMESTAMP '2023-01-10 00:00:00' + INTERVAL 1 SECOND * (86400 * (l_orderkey % 400)))"
_USAGE_TS = "(TIMESTAMP '2023-11-15 00:00:00' + INTERVAL 1 SECOND * (86400 * (l_orderkey % 77)))"
_COST = "(floor(l_extendedprice * (1 - l_discount) * 4) / 4)"

# name -> (source table, {column: expression})
ADAPTERS = {
    "fleet_telemetry": ("events", {
        "event_id": _ID,
        "cluster_name": "'c' || CAST(user_id % 2 AS STRING)",
        "node_group": "'ng-' || CAST(user_id % 4 AS STRING)",
        "environment": _ENV,
        "event_type": "CASE event_type WHEN 'error' THEN 'ECS_TASK' ELSE 'NODE_HEALTH' END",
        "service_name": "'svc-' || CAST(user_id % 10 AS STRING)",
        "aws_region": "'eu-west-2'",
        "readiness_score": f"100 - {_Q} / 8",
        "node_count": "CAST(CASE WHEN event_id % 1000 = 7 THEN 0 ELSE 8 END AS BIGINT)",
        "healthy_nodes": "CAST(8 - event_id % 4 AS BIGINT)",
        "desired_tasks": "CAST(8 AS BIGINT)",
        "running_tasks": "CAST(CASE event_type WHEN 'error' THEN 4 ELSE 8 END AS BIGINT)",
        "event_ts": "ts",
    }),
    "infra_metrics": ("events", {
        "metric_id": _ID,
        "service_name": "'svc-' || CAST(user_id % 10 AS STRING)",
        "cluster_name": "CASE event_type WHEN 'signup' THEN 'c9' ELSE 'c' || CAST(user_id % 2 AS STRING) END",
        "namespace": "'default'",
        "environment": _ENV,
        "metric_name": "event_type",
        "metric_source": "CASE event_id % 2 WHEN 0 THEN 'prometheus' ELSE 'cloudwatch' END",
        "metric_value": f"CASE event_id % 17 WHEN 0 THEN 'n/a' ELSE CAST({_Q} AS STRING) END",
        "cpu_utilisation": "CAST(event_id % 100 AS STRING)",
        "mem_utilisation": "CAST(CAST(NULL AS DOUBLE) AS STRING)",
        "request_count": "CASE event_id % 19 WHEN 0 THEN 'many' ELSE CAST(event_id % 100 AS STRING) END",
        "error_rate": "(event_id % 16) / 64",
        "latency_p99_ms": f"300 + 5 * {_Q}",
        "scraped_ts": "ts",
    }),
    "fleet_events": ("events", {
        "event_key": _ID,
        "source_system": "' EKS '",
        "environment": f"upper({_ENV})",
        "cluster_name": "CASE user_id % 11 WHEN 0 THEN CAST(NULL AS STRING) ELSE 'c' || CAST(user_id % 2 AS STRING) END",
        "region": "CAST(NULL AS STRING)",
        "event_id": "CASE event_id % 101 WHEN 0 THEN CAST(NULL AS STRING) ELSE CAST(event_id AS STRING) END",
        "event_type": "CASE event_type WHEN 'click' THEN 'DEPLOY' WHEN 'view' THEN ' scale ' "
                      "WHEN 'error' THEN 'INCIDENT' WHEN 'purchase' THEN 'ALERT' ELSE 'HEAL' END",
        "event_subtype": "CASE event_id % 3 WHEN 0 THEN CAST(NULL AS STRING) ELSE ' sub ' END",
        "service_name": "CASE user_id % 29 WHEN 0 THEN CAST(NULL AS STRING) ELSE ' Svc-' || CAST(user_id % 10 AS STRING) END",
        "event_timestamp": "ts",
        "event_date": "CAST(ts AS DATE)",
        "duration_ms": "CASE event_id % 9 WHEN 0 THEN CAST(NULL AS BIGINT) ELSE CAST(floor(value) * 1000 AS BIGINT) END",
        "severity": "CASE event_id % 5 WHEN 0 THEN 'critical' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'medium' "
                    "WHEN 3 THEN 'low' ELSE CAST(NULL AS STRING) END",
        "status": "CASE event_id % 7 WHEN 0 THEN 'failure' ELSE 'SUCCESS' END",
        "message": "props",
        "payload_json": "props",
        "slo_name": "event_type",
        "error_budget_burn": "CASE event_id % 8 WHEN 0 THEN CAST(NULL AS DOUBLE) ELSE (event_id % 64) / 32 END",
        "cost_centre": "CAST(NULL AS STRING)",
        "squad": "CASE user_id % 13 WHEN 0 THEN CAST(NULL AS STRING) ELSE 'squad-' || CAST(user_id % 5 AS STRING) END",
        "ingested_at": "ts + INTERVAL 1 SECOND * 90",
        "pipeline_version": "'1'",
        "source_file": "CAST(NULL AS STRING)",
    }),
    "slo_metrics": ("events", {
        "metric_key": _ID,
        "service_name": "CASE user_id % 37 WHEN 0 THEN CAST(NULL AS STRING) ELSE ' Svc-' || CAST(user_id % 10 AS STRING) END",
        "environment": _ENV,
        "slo_name": "event_type",
        "slo_target": "CAST(0.9 AS DOUBLE)",
        "slo_window_days": "CAST(30 AS BIGINT)",
        "good_events": "CASE event_id % 43 WHEN 0 THEN CAST(NULL AS BIGINT) ELSE CAST(greatest(event_id % 50 - event_id % 5, 0) AS BIGINT) END",
        "total_events": "CASE event_id % 47 WHEN 0 THEN CAST(NULL AS BIGINT) ELSE CAST(event_id % 50 AS BIGINT) END",
        "error_rate": "CAST(NULL AS DOUBLE)",
        "availability": "CAST(NULL AS DOUBLE)",
        "error_budget_remaining": "CASE event_id % 6 WHEN 0 THEN CAST(NULL AS DOUBLE) ELSE (event_id % 64) / 64 END",
        "burn_rate_1h": f"{_Q} / 8",
        "burn_rate_6h": f"{_Q} / 16",
        "burn_rate_24h": f"CASE event_id % 12 WHEN 0 THEN CAST(NULL AS DOUBLE) ELSE {_Q} / 32 END",
        "burn_rate_72h": f"{_Q} / 64",
        "is_breaching": "value > 40",
        "alert_tier": "CAST(NULL AS STRING)",
        "snapshot_timestamp": "ts",
        "snapshot_date": "CAST(ts AS DATE)",
        "ingested_at": "ts + INTERVAL 1 SECOND * 60",
        "source_system": "'eks'",
    }),
    "job_metadata": ("events", {
        "job_id": _ID,
        "job_name": "'job-' || CAST(user_id AS STRING)",
        "workload_type": "CASE event_type WHEN 'click' THEN 'inference' WHEN 'view' THEN 'data_processing' "
                         "WHEN 'purchase' THEN 'model_training' WHEN 'signup' THEN 'fine_tuning' ELSE 'unknown_type' END",
        "workload_class": "'batch'",
        "environment": _ENV,
        "cloud_provider": "CASE user_id % 2 WHEN 0 THEN 'gcp' ELSE 'aws' END",
        "region": "'us-central1'",
        "team": "'team-' || CAST(user_id % 3 AS STRING)",
        "submitted_at": "ts",
        "started_at": "ts",
        "completed_at": "CASE event_id % 97 WHEN 0 THEN ts - INTERVAL 1 SECOND * 10 "
                        "ELSE ts + INTERVAL 1 SECOND * CAST(floor(60 * value) AS BIGINT) END",
        "execution_date": "CAST(ts AS DATE)",
        "duration_seconds": "CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS DOUBLE) "
                            "WHEN event_id % 97 = 0 THEN CAST(-10 AS DOUBLE) ELSE CAST(floor(60 * value) AS DOUBLE) END",
        "status": "CASE event_id % 20 WHEN 0 THEN 'FAILURE' WHEN 1 THEN 'TIMEOUT' WHEN 2 THEN 'BOGUS' ELSE 'SUCCESS' END",
        "exit_code": "CAST(CASE event_id % 20 WHEN 0 THEN 1 ELSE 0 END AS BIGINT)",
        "retry_attempt": "CAST(CASE event_id % 10 WHEN 9 THEN 1 ELSE 0 END AS BIGINT)",
        "parent_job_id": "CASE event_id % 10 WHEN 9 THEN CAST(event_id - 1 AS STRING) ELSE CAST(NULL AS STRING) END",
        "error_category": "CAST(NULL AS STRING)",
        "error_message": "CAST(NULL AS STRING)",
        "model_name": "CAST(NULL AS STRING)",
        "dataset_size_gb": _Q,
        "pipeline_name": "'nightly'",
        "pipeline_run_id": "CAST(NULL AS STRING)",
        "cpu_used_cores": f"CASE WHEN event_id % 6 = 0 OR event_type = 'error' THEN CAST(NULL AS DOUBLE) ELSE {_Q} END",
        "memory_used_gb": f"CASE event_id % 4 WHEN 0 THEN CAST(NULL AS DOUBLE) ELSE {_Q} / 2 + (event_id % 8) END",
        "gpu_utilisation_pct": f"CASE event_type WHEN 'purchase' THEN {_Q} / 4 ELSE CAST(NULL AS DOUBLE) END",
        "ingested_at": "ts + INTERVAL 1 SECOND * 60",
    }),
    "resource_allocation_logs": ("events", {
        "k": "EXPLODE_0_1_2",
        "log_id": "CAST(event_id AS STRING) || '-' || CAST(k AS STRING)",
        "job_id": _ID,
        "log_date": "CAST(ts + INTERVAL 1 SECOND * (k * 60) AS DATE)",
        "collected_at": "ts + INTERVAL 1 SECOND * (k * 60)",
        "cpu_requested_cores": "CASE event_id % 31 WHEN 0 THEN CAST(0 AS DOUBLE) ELSE CAST(8 AS DOUBLE) END",
        "cpu_used_cores": f"CASE (event_id + k) % 6 WHEN 0 THEN CAST(NULL AS DOUBLE) ELSE {_Q} / 8 END",
        "cpu_throttle_pct": "CAST((event_id + k) % 64 AS DOUBLE)",
        "memory_used_gb": f"{_Q} / 2 + k",
        "memory_limit_gb": "CAST(256 AS DOUBLE)",
        "gpu_utilisation_pct": f"CASE event_type WHEN 'purchase' THEN {_Q} / 4 ELSE CAST(NULL AS DOUBLE) END",
        "gpu_memory_used_gb": f"CASE event_type WHEN 'purchase' THEN {_Q} / 16 ELSE CAST(NULL AS DOUBLE) END",
        "compute_cost_usd": f"CAST({_Q} AS DECIMAL(18,2))",
        "node_type": "CASE event_id % 3 WHEN 0 THEN 'n1-standard-8' WHEN 1 THEN 'n1-highmem-32' ELSE 'a2-highgpu-1g' END",
    }),
    "infrastructure_events": ("events", {
        "event_id": _ID,
        "event_date": "CAST(ts + INTERVAL 1 SECOND * 20 AS DATE)",
        "event_timestamp": "ts + INTERVAL 1 SECOND * 20",
        "event_type": "CASE event_id % 5 WHEN 0 THEN 'NODE_PREEMPTION' WHEN 1 THEN 'SPOT_INTERRUPT' "
                      "WHEN 2 THEN 'QUOTA_THROTTLE' WHEN 3 THEN 'NETWORK_DEGRADATION' ELSE 'SERVICE_DISRUPTION' END",
        "severity": "CASE event_id % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END",
        "source_system": "'gke'",
        "affected_zone": "'zone-' || CAST(user_id % 3 AS STRING)",
    }),
    "cost_events": ("lineitem", {
        "cost_event_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
        "team": "'team-' || CAST(l_suppkey % 3 AS STRING)",
        "service_name": "'svc-' || CAST(l_partkey % 20 AS STRING)",
        "environment": _PART_ENV,
        "cost_category": "CASE l_linestatus WHEN 'O' THEN 'compute' ELSE 'storage' END",
        "cloud_provider": "CASE l_returnflag WHEN 'A' THEN 'aws' ELSE 'gcp' END",
        "aws_region": "CAST(NULL AS STRING)",
        "resource_id": "CAST(l_partkey AS STRING)",
        "cost_usd": f"CASE l_orderkey % 53 WHEN 0 THEN CAST(NULL AS DOUBLE) ELSE {_COST} END",
        "usage_amount": "CASE l_linenumber WHEN 7 THEN 'unknown' ELSE CAST(l_quantity AS STRING) END",
        "usage_unit": "'hours'",
        "cost_date": f"CAST({_COST_TS} AS DATE)",
    }),
    "cost_lines": ("lineitem", {
        "service_id": "CAST(l_suppkey % 5 AS STRING)",
        "service_description": "'service ' || CAST(l_suppkey % 5 AS STRING)",
        "sku_id": "CAST(l_linenumber AS STRING)",
        "sku_description": "'sku ' || CAST(l_linenumber AS STRING)",
        "project_id": "'p' || CAST(l_partkey % 4 AS STRING)",
        "team_label": "CASE l_partkey % 7 WHEN 0 THEN CAST(NULL AS STRING) ELSE 'squad-' || CAST(l_suppkey % 5 AS STRING) END",
        "env_label": _PART_ENV,
        "region": "CASE l_partkey % 2 WHEN 0 THEN 'europe-west2' ELSE 'us-central1' END",
        "cost": f"CAST({_COST} AS DECIMAL(18,2))",
        "credit": "CASE WHEN l_discount = 0 THEN CAST(NULL AS DECIMAL(18,2)) "
                  "ELSE CAST(-floor(l_extendedprice * l_discount * 4) / 4 AS DECIMAL(18,2)) END",
        "usage_date": f"CAST({_USAGE_TS} AS DATE)",
        "usage_start_time": _USAGE_TS,
    }),
    "flight_routes": ("events", {
        "flight_id": _ID,
        "route_code": "'R' || CAST(user_id % 6 AS STRING)",
        "origin": "'o' || CAST(user_id % 6 AS STRING)",
        "dest": "'d' || CAST(user_id % 6 AS STRING)",
        "airline": "'A' || CAST(user_id % 3 AS STRING)",
        "aircraft_type": "CASE event_id % 2 WHEN 0 THEN 'A320' ELSE 'B738' END",
        "cabin_class": "'mixed'",
        "event_type": "'DEPARTURE'",
        "priority": "CASE event_id % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'NORMAL' WHEN 2 THEN 'HIGH' ELSE 'CRITICAL' END",
        "scheduled_departure_ts": "ts",
        "actual_departure_ts": "CASE event_id % 23 WHEN 0 THEN CAST(NULL AS TIMESTAMP) "
                               "ELSE ts + INTERVAL 1 SECOND * (((7 * event_id) % 60 - 10) * 60 + 30) END",
        "actual_arrival_ts": "CAST(NULL AS TIMESTAMP)",
        "is_cancelled": "event_id % 23 = 0",
        "is_diverted": "event_id % 41 = 0",
    }),
}


def _exprs(columns):
    return [f"{e} AS {c}" for c, e in columns.items() if e != "EXPLODE_0_1_2"]


class Tables:
    """The test tables of one folder and the domain tables made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def raw(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return df.select(*[
            F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name)
            for f in df.schema
        ])

    def __getattr__(self, name: str) -> DataFrame:
        if name == "cost_billing_export":
            return self._billing()
        if name not in ADAPTERS:
            raise AttributeError(name)
        source, columns = ADAPTERS[name]
        df = self.raw(source)
        if "k" in columns:
            df = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
        return df.selectExpr(*_exprs(columns))

    def _billing(self) -> DataFrame:
        """Nested billing lines as a cloud provider exports them."""
        lines = self.cost_lines
        text = lambda v: F.lit(v).cast("string")
        label = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
        env = label("env", F.col("env_label"))
        with_team = F.array(label("team", F.col("team_label")), env, label("team", F.lit("second")))
        credit = F.struct(F.lit("discount").alias("name"), F.col("credit").cast("decimal(38,9)").alias("amount"))
        return lines.select(
            F.lit("acct").alias("billing_account_id"),
            F.struct(F.col("service_id").alias("id"), F.col("service_description").alias("description")).alias("service"),
            F.struct(F.col("sku_id").alias("id"), F.col("sku_description").alias("description")).alias("sku"),
            "usage_start_time", F.col("usage_start_time").alias("usage_end_time"), "usage_date",
            F.struct(F.col("project_id").alias("id"), F.col("project_id").alias("name")).alias("project"),
            F.when(F.col("team_label").isNull(), F.array(env)).otherwise(with_team).alias("labels"),
            F.struct(F.lit("GB").alias("country"), F.col("region").alias("region")).alias("location"),
            F.col("cost").cast("decimal(38,9)").alias("cost"),
            F.lit("USD").alias("currency"), F.lit(None).cast("double").alias("currency_conversion_rate"),
            F.struct(F.lit(1.0).alias("amount"), F.lit("hour").alias("unit")).alias("usage"),
            F.when(F.col("credit").isNull(), F.array().cast("array<struct<name:string,amount:decimal(38,9)>>"))
            .otherwise(F.array(credit)).alias("credits"),
            F.lit("regular").alias("cost_type"),
            F.col("usage_start_time").alias("ingested_at"), text(None).alias("pipeline_run_id"),
        )


def adapter_sql(name: str) -> str:
    """The same projection as a SELECT over the source table."""
    source, columns = ADAPTERS[name]
    if "k" in columns:
        source = f"(SELECT *, unnest([0, 1, 2]) AS k FROM {source})"
    return f"SELECT {', '.join(_exprs(columns))} FROM {source}"
