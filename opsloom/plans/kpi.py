"""The executive view: one row per day over fleet, flights and cost."""
from pyspark.sql import DataFrame, functions as F

from opsloom.functions import stable_round


def ops_kpi_dashboard(readiness: DataFrame, flights: DataFrame, costs: DataFrame) -> DataFrame:
    """Three daily aggregates, full outer joined on the day, gaps filled with zero."""
    fleet = readiness.groupBy("event_date").agg(
        stable_round(F.avg("avg_fleet_health_score"), 2).alias("fleet_health_score"),
        stable_round(F.avg("slo_compliance_rate"), 4).alias("fleet_slo_rate"),
        F.sum("anomaly_count").alias("fleet_anomaly_count"),
        F.sum("critical_anomaly_count").alias("critical_anomaly_count"),
    )
    flight = flights.groupBy("event_date").agg(
        stable_round(F.avg("otp_rate"), 4).alias("avg_otp_rate"),
        stable_round(F.avg("avg_delay_minutes"), 2).alias("avg_delay_minutes"),
        stable_round(F.avg("cancellation_rate"), 4).alias("avg_cancellation_rate"),
        F.sum("total_flights").alias("total_flights"),
    )
    cost = costs.groupBy(F.col("cost_date").alias("event_date")).agg(
        stable_round(F.sum("total_cost_usd"), 2).alias("total_cost_usd"),
        F.count_if("is_cost_spike").alias("cost_spike_count"),
    )
    return (
        fleet.join(flight, "event_date", "full_outer").join(cost, "event_date", "full_outer")
        .fillna(0).orderBy(F.desc("event_date"))
    )
