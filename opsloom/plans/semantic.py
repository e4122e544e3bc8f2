"""Metrics by name, grain, dimensions and filters."""
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from opsloom.functions import dora_tier, grain_start, pct_change
from opsloom.operators.lookup import null_safe_join


@dataclass(frozen=True)
class Metric:
    """A measure of a mart: an aggregate, its date column and what it may be cut by."""
    name: str
    model: str
    time: str
    measure: Callable[[], Column]
    grains: tuple = ("day", "week", "month")
    dimensions: tuple = ("service_name", "environment", "squad")
    once: tuple = ()  # semi-additive: the mart repeats `column` on all rows of these keys, and it counts once for each
    column: str = ""


def _avg(c):
    return lambda: F.avg(c)


HEALTH, SLO = "fleet_health_daily", "slo_compliance"
COST = "total_daily_cost_usd"
SLO_DIMENSIONS = ("service_name", "environment", "slo_name", "is_compliant", "alert_tier")
SLO_GRAINS = ("week", "month", "quarter")
VIEW_GRAINS = ("raw", "date", "day", "week", "month", "quarter", "year")


# Dimensions that are no columns of their name.
DERIVED = {
    "has_incident_anomaly": lambda: F.col("incident_anomaly"), "has_cost_anomaly": lambda: F.col("cost_anomaly"),
    "dora_tier": lambda: dora_tier("deployment_frequency", "change_failure_rate", "mean_time_to_recovery_mins"),
}
HEALTH_DIMENSIONS = ("service_name", "environment", "squad", "dora_tier", "has_incident_anomaly", "has_cost_anomaly")


def _health(name, measure, dimensions=HEALTH_DIMENSIONS, **more):
    return Metric(name, HEALTH, "report_date", measure, VIEW_GRAINS, dimensions, **more)


METRICS = {m.name: m for m in [
    Metric("deployment_frequency", HEALTH, "report_date", _avg("deploy_count")),
    Metric("change_failure_rate", HEALTH, "report_date", _avg("change_failure_rate")),
    Metric("mean_time_to_recovery", HEALTH, "report_date", _avg("mean_time_to_recovery_mins")),
    Metric("cost_per_deploy", HEALTH, "report_date", _avg("cost_per_deploy_usd")),
    Metric("slo_compliance_rate", SLO, "report_week", lambda: F.avg(F.col("is_compliant").cast("double")),
           SLO_GRAINS, SLO_DIMENSIONS),
    _health(COST, lambda: F.sum("daily_cost_usd"), ("squad",), once=("report_date", "squad"), column="daily_cost_usd"),
    _health("total_deploys", lambda: F.sum("deploy_count")),
    _health("total_incidents", lambda: F.sum("incident_count")),
    _health("avg_deployment_frequency", _avg("deployment_frequency")),
    _health("mean_time_to_recovery_mins", _avg("mean_time_to_recovery_mins")),
    _health("avg_availability", _avg("p99_availability")),
    _health("avg_cost_per_deploy", _avg("cost_per_deploy_usd")),
    _health("critical_event_count", lambda: F.sum("critical_events")),
    _health("services_with_anomalies", lambda: F.count_distinct(
        F.when(F.col("incident_anomaly") | F.col("cost_anomaly"), F.col("service_name")))),
    Metric("services_compliant_pct", SLO, "report_week", lambda: F.avg(F.col("is_compliant").cast("double")),
           SLO_GRAINS, SLO_DIMENSIONS),
    Metric("avg_error_budget_remaining", SLO, "report_week", _avg("avg_error_budget_remaining"), SLO_GRAINS, SLO_DIMENSIONS),
    Metric("total_breach_count", SLO, "report_week", lambda: F.sum("breach_count"), SLO_GRAINS, SLO_DIMENSIONS),
    Metric("peak_burn_rate", SLO, "report_week", lambda: F.max("peak_burn_rate_1h"), SLO_GRAINS, SLO_DIMENSIONS),
]}


def filtered(df: DataFrame, time: str, filters=None, since=None, until=None) -> DataFrame:
    """Rows with the given values in [since, until)."""
    for column, value in (filters or {}).items():
        df = df.where(F.col(column).isin(value) if isinstance(value, (list, tuple)) else F.col(column) == value)
    if since is not None:
        df = df.where(F.col(time) >= F.lit(since).cast("date"))
    return df if until is None else df.where(F.col(time) < F.lit(until).cast("date"))


def _chosen(metrics, grains, dimensions) -> list[Metric]:
    """The named metrics, which must share a model and know the grains and dimensions."""
    chosen = [METRICS[m] for m in ([metrics] if isinstance(metrics, str) else metrics)]
    for m in chosen:
        if m.model != chosen[0].model:
            raise ValueError("metrics of one query must share a model")
        for g in grains:
            if g not in m.grains:
                raise ValueError(f"{m.name} has no grain {g}")
        for d in dimensions:
            if d not in m.dimensions:
                raise ValueError(f"{m.name} has no dimension {d}")
    return chosen


def measured(df: DataFrame, chosen: list[Metric], keys) -> DataFrame:
    """The metrics of filtered mart rows by `keys`, a function from a DataFrame to the same with its key columns (all of which it adds).

    Every way to a metric ends here. Metrics that count once per some grain are reduced to that grain first; those of one grain share an
    aggregation, and the parts, one row per key each, are joined.
    """
    parts = []
    for once in dict.fromkeys(m.once for m in chosen):
        own = [m for m in chosen if m.once == once]
        rows = df if not once else df.groupBy(*once).agg(*[F.max(c).alias(c) for c in dict.fromkeys(m.column for m in own)])
        keyed, names = keys(rows)
        parts.append(keyed.groupBy(*names).agg(*[m.measure().alias(m.name) for m in own]))
    out = parts[0]
    for more in parts[1:]:
        out = null_safe_join(out, more, names, "full") if names else out.crossJoin(more)  # one row each
    return out.select(*names, *[m.name for m in chosen])


def _dimensions(df: DataFrame, dimensions) -> DataFrame:
    return df.withColumns({d: DERIVED[d]() for d in dimensions if d in DERIVED})


def metric_query(df: DataFrame, metrics, grain=None, dimensions=(), filters=None, since=None, until=None,
                 monday_weeks=False) -> DataFrame:
    """Metrics of one mart by period and dimensions."""
    chosen = _chosen(metrics, [] if grain is None else [grain], dimensions)
    time = chosen[0].time

    def keys(rows):
        rows = _dimensions(rows, dimensions)
        if grain is None:
            return rows, list(dimensions)
        return rows.withColumn("period", grain_start(time, grain, monday_weeks)), ["period", *dimensions]

    return measured(filtered(df, time, filters, since, until), chosen, keys)


def metric_by_grains(df: DataFrame, metrics, grains, dimensions=(), filters=None, since=None, until=None) -> DataFrame:
    """Metrics at several grains from one scan of the mart."""
    chosen = _chosen(metrics, grains, dimensions)
    time = chosen[0].time
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), grain_start(time, g).alias("period")) for g in grains])

    def keys(rows):
        return _dimensions(rows, dimensions).select("*", F.inline(periods)), ["grain", "period", *dimensions]

    return measured(filtered(df, time, filters, since, until), chosen, keys)


def total_cost(mart: DataFrame, grain=None, dimensions=("squad",), filters=None, since=None, until=None) -> DataFrame:
    """Cost by period and squad, each squad's daily cost once. No other dimension divides it, so any other is an error."""
    return metric_query(mart, COST, grain, dimensions, filters, since, until)


# ---------------------------------------------------------------- dashboard

def kpi_value(mart: DataFrame, metric: str, as_of, days=28, filters=None) -> DataFrame:
    """A metric over the last days next to the same number of days before, in one scan."""
    m = METRICS[metric]
    end = F.lit(as_of).cast("date")
    start, before = F.date_sub(end, days), F.date_sub(end, 2 * days)
    period = F.when(F.col(m.time) >= start, "current").otherwise("previous")
    both = filtered(mart, m.time, filters).where((F.col(m.time) >= before) & (F.col(m.time) < end))
    parts = measured(both, [m], lambda rows: (rows.withColumn("_p", period), ["_p"])).withColumn("_v", F.col(m.name).cast("double"))
    return parts.agg(
        F.max(F.when(F.col("_p") == "current", F.col("_v"))).alias("value"),
        F.max(F.when(F.col("_p") == "previous", F.col("_v"))).alias("previous_value"),
    ).withColumn("change", pct_change("value", "previous_value"))


def deploy_trend(mart: DataFrame, filters=None, since=None, until=None, limit=90) -> DataFrame:
    """Deployments and incidents per day, first `limit` days."""
    return metric_query(mart, ["total_deploys", "total_incidents"], "day", (), filters, since, until).orderBy("period").limit(limit)


def slo_table(slo: DataFrame, filters=None, since=None, until=None) -> DataFrame:
    return metric_query(slo, ["avg_error_budget_remaining", "total_breach_count"], None,
                        ("service_name", "slo_name", "is_compliant", "alert_tier"), filters, since, until)


def cost_by_squad(mart: DataFrame, filters=None, since=None, until=None, limit=15) -> DataFrame:
    return total_cost(mart, None, ("squad",), filters, since, until).orderBy(F.desc("total_daily_cost_usd"), "squad").limit(limit)
