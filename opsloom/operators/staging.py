"""Row-level staging: one pass of filters and projections, all pushed into the scan."""
from pyspark.sql import DataFrame, functions as F

from opsloom.functions import (
    credit_total, folded, grain_start, label_value, minutes_between, safe_divide,
)
from opsloom.params import FLEET_EVENT_TYPES, LOOKBACK_DAYS


def _since(as_of, days):
    return F.date_sub(F.lit(as_of).cast("date"), days)


def fleet_events(df: DataFrame, as_of, lookback_days=LOOKBACK_DAYS) -> DataFrame:
    """Recent events of the accepted types. Types are accepted as written, before folding."""
    recent = F.col("event_date").between(_since(as_of, lookback_days), F.lit(as_of).cast("date"))
    known = F.col("event_id").isNotNull() & F.col("event_timestamp").isNotNull()
    return df.where(recent & known & F.col("event_type").isin(FLEET_EVENT_TYPES)).select(
        "event_key",
        folded("source_system").alias("source_system"),
        folded("environment").alias("environment"),
        F.coalesce("cluster_name", F.lit("unknown")).alias("cluster_name"),
        F.coalesce("region", F.lit("unknown")).alias("region"),
        "event_id",
        folded("event_type", upper=True).alias("event_type"),
        folded("event_subtype", "UNKNOWN", upper=True).alias("event_subtype"),
        folded("service_name", "unknown").alias("service_name"),
        "event_timestamp",
        "event_date",
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"),
        F.upper(F.coalesce("severity", F.lit("UNKNOWN"))).alias("severity"),
        F.upper(F.coalesce("status", F.lit("UNKNOWN"))).alias("status"),
        F.coalesce("message", F.lit("")).alias("message"),
        "payload_json",
        "slo_name",
        F.coalesce("error_budget_burn", F.lit(0.0)).alias("error_budget_burn"),
        F.coalesce("cost_centre", F.lit("unattributed")).alias("cost_centre"),
        F.coalesce("squad", F.lit("unattributed")).alias("squad"),
        "ingested_at", "pipeline_version", "source_file",
    )


def slo_metrics(df: DataFrame, as_of, lookback_days=LOOKBACK_DAYS) -> DataFrame:
    """Snapshots with availability recomputed from the event counts."""
    good, total = F.coalesce("good_events", F.lit(0)), F.coalesce("total_events", F.lit(0))
    return df.where((F.col("snapshot_date") >= _since(as_of, lookback_days)) & F.col("service_name").isNotNull()).select(
        "metric_key",
        folded("service_name").alias("service_name"),
        folded("environment").alias("environment"),
        "slo_name", "slo_target", "slo_window_days",
        good.alias("good_events"),
        total.alias("total_events"),
        F.coalesce("error_rate", F.lit(0.0)).alias("error_rate"),
        safe_divide(good, total).alias("availability"),
        F.coalesce("error_budget_remaining", F.lit(1.0)).alias("error_budget_remaining"),
        *[F.coalesce(c, F.lit(0.0)).alias(c)
          for c in ("burn_rate_1h", "burn_rate_6h", "burn_rate_24h", "burn_rate_72h")],
        "is_breaching", "alert_tier", "snapshot_timestamp", "snapshot_date", "ingested_at", "source_system",
    )


def cost_billing(df: DataFrame, as_of, lookback_days=LOOKBACK_DAYS) -> DataFrame:
    """Billing lines flattened to columns."""
    return df.where(F.col("usage_date") >= _since(as_of, lookback_days)).select(
        "billing_account_id",
        F.col("service.id").alias("service_id"), F.col("service.description").alias("service_description"),
        F.col("sku.id").alias("sku_id"), F.col("sku.description").alias("sku_description"),
        "usage_start_time", "usage_end_time", "usage_date",
        F.col("project.id").alias("project_id"), F.col("project.name").alias("project_name"),
        label_value("labels", "team").alias("team_label"),
        label_value("labels", "env").alias("env_label"),
        F.col("location.region").alias("region"), F.col("location.country").alias("country"),
        F.coalesce("cost", F.lit(0).cast("decimal(38,9)")).alias("cost_usd"),
        "currency",
        F.coalesce("currency_conversion_rate", F.lit(1.0)).alias("currency_conversion_rate"),
        F.col("usage.amount").alias("usage_amount"), F.col("usage.unit").alias("usage_unit"),
        credit_total("credits").alias("total_credits_usd"),
        "cost_type", "ingested_at", "pipeline_run_id",
    )


def cost_events(df: DataFrame) -> DataFrame:
    """Cost lines with an id, a date and a cost."""
    keep = F.col("cost_event_id").isNotNull() & F.col("cost_date").isNotNull() & F.col("cost_usd").isNotNull()
    text = ["cost_event_id", "team", "service_name", "environment", "cost_category", "cloud_provider",
            "aws_region", "resource_id"]
    return df.where(keep).select(
        *[F.col(c).cast("string").alias(c) for c in text],
        F.col("cost_usd").try_cast("double").alias("cost_usd"),
        F.col("usage_amount").try_cast("double").alias("usage_amount"),
        F.col("usage_unit").cast("string").alias("usage_unit"),
        F.col("cost_date").cast("date").alias("cost_date"),
    )


def flight_routes(df: DataFrame) -> DataFrame:
    """Flight legs with delay and punctuality; a leg without departure is not on time."""
    delay = minutes_between(F.col("actual_departure_ts").cast("timestamp"), F.col("scheduled_departure_ts").cast("timestamp"))
    return df.where(F.col("flight_id").isNotNull()).select(
        F.col("flight_id").cast("string").alias("flight_id"),
        F.col("route_code").cast("string").alias("route_code"),
        F.upper(F.col("origin").cast("string")).alias("origin_iata"),
        F.upper(F.col("dest").cast("string")).alias("dest_iata"),
        *[F.col(c).cast("string").alias(c)
          for c in ("airline", "aircraft_type", "cabin_class", "event_type", "priority")],
        *[F.col(c).cast("timestamp").alias(c)
          for c in ("scheduled_departure_ts", "actual_departure_ts", "actual_arrival_ts")],
        delay.alias("departure_delay_minutes"),
        F.coalesce(delay <= 15, F.lit(False)).alias("is_on_time"),
        F.col("is_cancelled").cast("boolean").alias("is_cancelled"),
        F.col("is_diverted").cast("boolean").alias("is_diverted"),
        F.col("scheduled_departure_ts").cast("date").alias("event_date"),
    )


def infra_metrics(df: DataFrame) -> DataFrame:
    """Scrapes with numbers cast where they parse, NULL where they do not."""
    text = ["metric_id", "service_name", "cluster_name", "namespace", "environment", "metric_name", "metric_source"]
    ts = F.col("scraped_ts").cast("timestamp")
    return df.where(F.col("metric_id").isNotNull() & F.col("metric_name").isNotNull()).select(
        *[F.col(c).cast("string").alias(c) for c in text],
        *[F.col(c).try_cast("double").alias(c) for c in ("metric_value", "cpu_utilisation", "mem_utilisation")],
        F.col("request_count").try_cast("bigint").alias("request_count"),
        *[F.col(c).try_cast("double").alias(c) for c in ("error_rate", "latency_p99_ms")],
        ts.alias("scraped_ts"),
        grain_start(ts, "day").alias("metric_date"),
        F.date_trunc("hour", ts).alias("metric_hour"),
    )


def fleet_telemetry(df: DataFrame) -> DataFrame:
    """Node telemetry with health ratios and the hour of the event."""
    ts = F.col("event_ts").cast("timestamp")
    return df.select(
        "event_id", "cluster_name", "node_group", "environment", "event_type", "service_name", "aws_region",
        "readiness_score",
        safe_divide("healthy_nodes", "node_count").alias("node_health_ratio"),
        safe_divide("running_tasks", "desired_tasks").alias("task_running_ratio"),
        ts.alias("event_ts"),
        F.date_trunc("hour", ts).alias("event_hour"),
        grain_start(ts, "day").alias("event_date"),
    )
