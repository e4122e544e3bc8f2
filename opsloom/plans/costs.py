"""Cost marts: daily cost by team, weekly rollup, monthly attribution."""
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.functions import month_start, pct_change, stable_round, surrogate_key, week_start
from opsloom.operators.distinct import distinct_counts

TEAM_KEYS = ["team", "environment", "cost_category", "cloud_provider"]
SPIKE = 0.20


def daily_costs(costs: DataFrame) -> DataFrame:
    """Cost, lines, services and resources per team, environment, category, provider and day, from one scan."""
    return distinct_counts(
        costs, {"service_count": "service_name", "resource_count": "resource_id"}, [*TEAM_KEYS, "cost_date"],
        {"total_cost_usd": F.col("cost_usd"), "line_item_count": F.lit(1).cast("bigint")})


def infra_cost_by_team(costs: DataFrame) -> DataFrame:
    """Daily cost with rolling sums and day-over-day spikes, one series per provider."""
    w = Window.partitionBy(*TEAM_KEYS).orderBy("cost_date")
    previous = F.lag("total_cost_usd").over(w)
    return daily_costs(costs).withColumns({
        "rolling_7d_cost_usd": F.sum("total_cost_usd").over(w.rowsBetween(-6, 0)),
        "rolling_30d_avg_daily_cost": F.avg("total_cost_usd").over(w.rowsBetween(-29, 0)),
        "dod_cost_delta_usd": F.col("total_cost_usd") - previous,
        "is_cost_spike": pct_change("total_cost_usd", previous) > SPIKE,
    })


def weekly_costs(by_team: DataFrame, as_of, days=90) -> DataFrame:
    """Weekly cost by team, environment and category."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return (
        by_team.where(F.col("cost_date") >= since)
        .groupBy(week_start("cost_date").alias("week_start"), "team", "environment", "cost_category")
        .agg(
            stable_round(F.sum("total_cost_usd"), 2).alias("weekly_cost_usd"),
            stable_round(F.avg("rolling_30d_avg_daily_cost"), 2).alias("avg_daily_cost_usd"),
            F.count_if("is_cost_spike").alias("spike_days"),
        )
        .orderBy(F.desc("week_start"), F.desc("weekly_cost_usd"))
    )


def cost_spikes(by_team: DataFrame, day, n=None) -> DataFrame:
    """Spikes of one day by size, all of them or the largest n."""
    spikes = (
        by_team.where((F.col("cost_date") == F.lit(day).cast("date")) & F.col("is_cost_spike"))
        .select(*TEAM_KEYS, "total_cost_usd", "dod_cost_delta_usd")
        .orderBy(F.desc("dod_cost_delta_usd"), *TEAM_KEYS)
    )
    return spikes.limit(n) if n else spikes


BILLING_KEYS = ["project_id", "team_label", "env_label", "service_description", "sku_description", "region"]


def cost_attribution(billing: DataFrame) -> DataFrame:
    """Monthly gross, credit and net cost with the change against the month before.
    Aggregation comes first; the window sees one row per month and key. Neither cost nor
    credits are NULL after staging, so the net sum is the sum of both sums."""
    monthly = (
        billing.withColumns({
            "billing_month": month_start("usage_date"),
            "team_label": F.coalesce("team_label", F.lit("unattributed")),
            "env_label": F.coalesce("env_label", F.lit("unknown")),
        })
        .groupBy("billing_month", *BILLING_KEYS, "usage_date")
        .agg(F.sum("cost_usd").alias("_cost"), F.sum("total_credits_usd").alias("_credits"))
        .groupBy("billing_month", *BILLING_KEYS)
        .agg(
            F.sum("_cost").alias("gross_cost_usd"),
            F.sum("_credits").alias("total_credits_usd"),
            F.count("usage_date").alias("billing_days"),
        )
        .withColumn("net_cost_usd", F.col("gross_cost_usd") + F.col("total_credits_usd"))
    )
    previous = F.lag("net_cost_usd").over(Window.partitionBy(*BILLING_KEYS).orderBy("billing_month"))
    change = pct_change(F.col("net_cost_usd").cast("double"), previous.cast("double"))
    return monthly.withColumn("mom_cost_change_pct", change).select(
        surrogate_key("billing_month", *BILLING_KEYS).alias("cost_key"), "*")
