"""Flight operations: route performance and its trend."""
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.functions import ratio_of, stable_round

ROUTE_DAY = ["route_code", "airline", "event_date"]
LEG_KEYS = ["route_code", "origin_iata", "dest_iata", "airline", "aircraft_type", "event_date"]


def _flown_delay():
    return F.when(~F.col("is_cancelled"), F.col("departure_delay_minutes"))


def p90_delay(legs: DataFrame) -> DataFrame:
    """90th percentile delay per route, airline and day. Delays are whole minutes, so the
    value counts that the exact percentile keeps per group are few."""
    return legs.groupBy(*ROUTE_DAY).agg(F.percentile(_flown_delay(), F.lit(0.9)).alias("p90_delay_minutes"))


def _performance(legs: DataFrame, keys) -> DataFrame:
    delay = _flown_delay()
    return legs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if("is_on_time").alias("on_time_flights"),
        F.count_if("is_cancelled").alias("cancelled_flights"),
        F.count_if("is_diverted").alias("diverted_flights"),
        ratio_of(F.col("is_on_time")).alias("otp_rate"),
        ratio_of(F.col("is_cancelled")).alias("cancellation_rate"),
        ratio_of(F.col("is_diverted")).alias("diversion_rate"),
        F.avg(delay).alias("avg_delay_minutes"),
        F.max(delay).alias("max_delay_minutes"),
        F.count_if(F.col("priority").isin("HIGH", "CRITICAL")).alias("high_priority_count"),
    )


def _graded(df: DataFrame) -> DataFrame:
    rate = F.col("otp_rate")
    status = F.when(rate >= 0.90, "healthy").when(rate >= 0.80, "degraded").otherwise("critical")
    return df.withColumns({"meets_otp_slo": rate >= 0.85, "route_health_status": status})


def route_performance(legs: DataFrame) -> DataFrame:
    """Punctuality, cancellations and delays per route, airline, aircraft type and day."""
    return _graded(_performance(legs, LEG_KEYS).join(p90_delay(legs), ROUTE_DAY))


def route_day_performance(legs: DataFrame) -> DataFrame:
    """The same at route x airline x day, the grain of the daily summary."""
    return _graded(_performance(legs, ROUTE_DAY).join(p90_delay(legs), ROUTE_DAY))


def flight_ops_summary(route_days: DataFrame) -> DataFrame:
    """Seven-row averages and the change against seven rows before. One row per day and route."""
    w = Window.partitionBy("route_code", "airline").orderBy("event_date")
    week = w.rowsBetween(-6, 0)
    return route_days.withColumns({
        "rolling_7d_otp_rate": stable_round(F.avg("otp_rate").over(week), 4),
        "rolling_7d_avg_delay": stable_round(F.avg("avg_delay_minutes").over(week), 2),
        "wow_otp_delta": F.col("otp_rate") - F.lag("otp_rate", 7).over(w),
    })
