"""Service marts: daily service health, weekly SLO compliance, delivery trends."""
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.functions import (
    dora_tier, pct_change, ratio_of, safe_divide, stable_round, surrogate_key, week_start,
)
from opsloom.params import DORA_WEEKLY

SERVICE_KEYS = ["report_date", "service_name", "environment", "cluster_name", "squad", "cost_centre"]
SLO_KEYS = ["report_week", "service_name", "environment", "slo_name", "slo_target", "slo_window_days"]


def daily_events(events: DataFrame) -> DataFrame:
    """Event counts by type and severity, change failure rate and recovery minutes."""
    kind, severity = F.col("event_type"), F.col("severity")
    deploys = F.count_if(kind == "DEPLOY")
    failed = F.count_if((kind == "DEPLOY") & (F.col("status") == "FAILURE"))
    types = {"deploy": "DEPLOY", "incident": "INCIDENT", "alert": "ALERT", "heal": "HEAL", "scale": "SCALE"}
    levels = {"critical": "CRITICAL", "high": "HIGH", "medium": "MEDIUM", "low": "LOW"}
    return events.withColumnRenamed("event_date", "report_date").groupBy(*SERVICE_KEYS).agg(
        F.count(F.lit(1)).alias("total_events"),
        *[F.count_if(kind == v).alias(f"{k}_count") for k, v in types.items()],
        *[F.count_if(severity == v).alias(f"{k}_events") for k, v in levels.items()],
        deploys.cast("double").alias("deployment_frequency"),
        safe_divide(failed, deploys).alias("change_failure_rate"),
        F.avg(F.when(kind.isin("INCIDENT", "HEAL"), F.col("duration_ms") / 60000.0)).alias("mean_time_to_recovery_mins"),
    )


def daily_slo(slo: DataFrame) -> DataFrame:
    return slo.groupBy(F.col("snapshot_date").alias("report_date"), "service_name", "environment").agg(
        F.avg("availability").alias("p99_availability"),
        F.avg("error_budget_remaining").alias("error_budget_remaining"),
        F.count_if("is_breaching").alias("slo_breach_count"),
    )


def daily_squad_cost(billing: DataFrame) -> DataFrame:
    squad = F.coalesce("team_label", F.lit("unattributed")).alias("squad")
    net = F.col("cost_usd") + F.col("total_credits_usd")
    return billing.groupBy(F.col("usage_date").alias("report_date"), squad).agg(F.sum(net).alias("daily_cost_usd"))


def fleet_health_daily(events: DataFrame, slo: DataFrame, billing: DataFrame) -> DataFrame:
    """Daily service health. All three inputs are aggregated before they are joined. The
    whole daily cost of a squad stands on each of its rows."""
    cost = F.coalesce(F.col("daily_cost_usd").cast("double"), F.lit(0.0))
    return (
        daily_events(events)
        .join(daily_slo(slo), ["report_date", "service_name", "environment"], "left")
        .join(daily_squad_cost(billing), ["report_date", "squad"], "left")
        .withColumn("daily_cost_usd", cost)
        .withColumn("cost_per_deploy_usd", safe_divide("daily_cost_usd", "deploy_count"))
        .withColumn("incident_anomaly", F.lit(False))
        .withColumn("cost_anomaly", F.lit(False))
        .select(surrogate_key(*SERVICE_KEYS).alias("fleet_health_key"), "*")
    )


def with_anomaly_flags(mart: DataFrame, rows=30, z_threshold=3.0, spike=0.20) -> DataFrame:
    """Fill the two anomaly flags: incidents by rolling z, cost by a daily jump."""
    w = Window.partitionBy("service_name", "environment", "cluster_name", "squad", "cost_centre").orderBy("report_date")
    before = w.rowsBetween(-rows, -1)
    z = F.try_divide(F.col("incident_count") - F.avg("incident_count").over(before), F.stddev_pop("incident_count").over(before))
    jump = pct_change("daily_cost_usd", F.lag("daily_cost_usd").over(w)) > spike
    return mart.withColumns({
        "incident_anomaly": F.coalesce(F.abs(z) >= z_threshold, F.lit(False)),
        "cost_anomaly": F.coalesce(jump, F.lit(False)),
    })


def slo_compliance(slo: DataFrame) -> DataFrame:
    """Weekly SLO compliance with the alert tier of the burn rates."""
    burn = {h: F.avg(f"burn_rate_{h}") for h in ("1h", "6h", "24h")}
    tier = F.when(burn["1h"] >= 14.4, "P0").when(burn["6h"] >= 6.0, "P1").when(burn["24h"] >= 3.0, "P2").otherwise("OK")
    weekly = slo.withColumn("report_week", week_start("snapshot_date")).groupBy(*SLO_KEYS).agg(
        F.avg("availability").alias("avg_availability"),
        F.min("availability").alias("min_availability"),
        F.avg("error_budget_remaining").alias("avg_error_budget_remaining"),
        F.min("error_budget_remaining").alias("min_error_budget_remaining"),
        burn["1h"].alias("avg_burn_rate_1h"),
        F.max("burn_rate_1h").alias("peak_burn_rate_1h"),
        burn["6h"].alias("avg_burn_rate_6h"),
        F.count_if("is_breaching").alias("breach_count"),
        F.count(F.lit(1)).alias("snapshot_count"),
        ratio_of(F.col("is_breaching")).alias("breach_pct"),
        (F.avg("availability") >= F.col("slo_target")).alias("is_compliant"),
        tier.alias("alert_tier"),
    )
    return weekly.select(surrogate_key(*SLO_KEYS).alias("slo_key"), "*")


WEEK_KEYS = ["service_name", "environment", "squad"]


def weekly_delivery(mart: DataFrame, as_of, weeks=8) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), weeks * 7)
    return (
        mart.where(F.col("report_date") >= since)
        .groupBy(week_start("report_date").alias("report_week"), *WEEK_KEYS)
        .agg(
            F.sum("deploy_count").alias("weekly_deploys"),
            F.avg("change_failure_rate").alias("avg_cfr"),
            F.avg("mean_time_to_recovery_mins").alias("avg_mttr_mins"),
            F.sum("incident_count").alias("weekly_incidents"),
            F.avg("p99_availability").alias("avg_availability"),
            F.avg("error_budget_remaining").alias("avg_error_budget"),
        )
    )


def deployment_trends(mart: DataFrame, as_of, weeks=8, shown_weeks=4) -> DataFrame:
    """Week-over-week delivery changes and tiers; changes are taken before the last weeks are cut out."""
    w = Window.partitionBy(*WEEK_KEYS).orderBy("report_week")

    def change(c):
        return stable_round(pct_change(c, F.lag(c).over(w)) * 100, 1)

    shown = F.date_sub(F.lit(as_of).cast("date"), shown_weeks * 7)
    return (
        weekly_delivery(mart, as_of, weeks)
        .withColumns({"deploy_wow_pct": change("weekly_deploys"), "mttr_wow_pct": change("avg_mttr_mins")})
        .where(F.col("report_week") >= shown)
        .select(
            "report_week", *WEEK_KEYS, "weekly_deploys",
            stable_round(F.col("avg_cfr") * 100, 2).alias("cfr_pct"),
            stable_round("avg_mttr_mins", 1).alias("mttr_mins"),
            stable_round(F.col("avg_availability") * 100, 4).alias("availability_pct"),
            stable_round(F.col("avg_error_budget") * 100, 2).alias("error_budget_pct"),
            "weekly_incidents", "deploy_wow_pct", "mttr_wow_pct",
            dora_tier("weekly_deploys", "avg_cfr", "avg_mttr_mins", DORA_WEEKLY).alias("dora_tier"),
        )
        .orderBy(F.desc("report_week"), "squad", "service_name")
    )
