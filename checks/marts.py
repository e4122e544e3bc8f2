"""Flights, cost, service health, SLO and KPI queries."""
from checks import fleet as fleet_checks
from checks.registry import div, oracle, query, rnd
from opsloom.operators import staging
from opsloom.plans import costs, flights, freshness, kpi, services
from opsloom.sources.adapters import EVENTS_AS_OF

# ---------------------------------------------------------------- flights

STG_FLIGHTS = """stg_flights AS (
    SELECT flight_id, route_code, upper(origin) AS origin_iata, upper(dest) AS dest_iata, airline, aircraft_type,
           cabin_class, event_type, priority, scheduled_departure_ts, actual_departure_ts, actual_arrival_ts,
           date_sub('minute', scheduled_departure_ts, actual_departure_ts) AS departure_delay_minutes,
           coalesce(date_sub('minute', scheduled_departure_ts, actual_departure_ts) <= 15, false) AS is_on_time,
           is_cancelled, is_diverted, CAST(scheduled_departure_ts AS DATE) AS event_date
    FROM flight_routes WHERE flight_id IS NOT NULL)"""


def performance_sql(name, keys):
    return f"""{name} AS (
    SELECT *, otp_rate >= 0.85 AS meets_otp_slo,
           CASE WHEN otp_rate >= 0.90 THEN 'healthy' WHEN otp_rate >= 0.80 THEN 'degraded' ELSE 'critical' END AS route_health_status
    FROM (SELECT {keys}, count(*) AS total_flights, count(*) FILTER (is_on_time) AS on_time_flights,
                 count(*) FILTER (is_cancelled) AS cancelled_flights, count(*) FILTER (is_diverted) AS diverted_flights,
                 count(*) FILTER (is_on_time)::DOUBLE / count(*) AS otp_rate,
                 count(*) FILTER (is_cancelled)::DOUBLE / count(*) AS cancellation_rate,
                 count(*) FILTER (is_diverted)::DOUBLE / count(*) AS diversion_rate,
                 avg(departure_delay_minutes) FILTER (NOT is_cancelled) AS avg_delay_minutes,
                 max(departure_delay_minutes) FILTER (NOT is_cancelled) AS max_delay_minutes,
                 count(*) FILTER (priority IN ('HIGH', 'CRITICAL')) AS high_priority_count
          FROM stg_flights GROUP BY {keys}) JOIN p90 USING (route_code, airline, event_date))"""


P90 = """p90 AS (
    SELECT route_code, airline, event_date,
           quantile_cont(departure_delay_minutes, 0.9) FILTER (NOT is_cancelled) AS p90_delay_minutes
    FROM stg_flights GROUP BY ALL)"""
ROUTE_PERF = performance_sql("route_perf", "route_code, origin_iata, dest_iata, airline, aircraft_type, event_date")
ROUTE_DAY = performance_sql("route_day", "route_code, airline, event_date")
SUMMARY = f"""summary AS (
    SELECT *, {rnd('avg(otp_rate) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 4)} AS rolling_7d_otp_rate,
           {rnd('avg(avg_delay_minutes) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 2)} AS rolling_7d_avg_delay,
           otp_rate - lag(otp_rate, 7) OVER w AS wow_otp_delta
    FROM route_day WINDOW w AS (PARTITION BY route_code, airline ORDER BY event_date))"""
FLIGHTS = ["flight_routes", STG_FLIGHTS, P90, ROUTE_PERF, ROUTE_DAY, SUMMARY]
PERF_F = "otp_rate cancellation_rate diversion_rate avg_delay_minutes p90_delay_minutes"


def legs(t):
    return staging.flight_routes(t.flight_routes)


@query("P05_stg_flight_routes", oracle("SELECT * FROM stg_flights", *FLIGHTS, d="event_date",
       t="scheduled_departure_ts actual_departure_ts actual_arrival_ts"))
def p05(t):
    return legs(t)


@query("W14_p90_delay", oracle("SELECT * FROM p90", *FLIGHTS, d="event_date", f="p90_delay_minutes"))
def w14(t):
    return flights.p90_delay(legs(t))


@query("A06_route_performance", oracle("SELECT * FROM route_perf", *FLIGHTS, d="event_date", f=PERF_F))
def a06(t):
    return flights.route_performance(legs(t))


def summary(t):
    return flights.flight_ops_summary(flights.route_day_performance(legs(t)))


@query("W05_flight_ops_summary", oracle("SELECT * FROM summary", *FLIGHTS, d="event_date",
       f=PERF_F + " rolling_7d_otp_rate rolling_7d_avg_delay wow_otp_delta"))
def w05(t):
    return summary(t)


# ---------------------------------------------------------------- cost by team

STG_COST_EVENTS = """stg_cost_events AS (
    SELECT cost_event_id, team, service_name, environment, cost_category, cloud_provider, aws_region, resource_id,
           cost_usd, TRY_CAST(usage_amount AS DOUBLE) AS usage_amount, usage_unit, cost_date
    FROM cost_events WHERE cost_event_id IS NOT NULL AND cost_date IS NOT NULL AND cost_usd IS NOT NULL)"""
DAILY_COSTS = """daily_costs AS (
    SELECT team, environment, cost_category, cloud_provider, cost_date, sum(cost_usd) AS total_cost_usd,
           count(*) AS line_item_count, count(DISTINCT service_name) AS service_count, count(DISTINCT resource_id) AS resource_count
    FROM stg_cost_events GROUP BY ALL)"""
BY_TEAM = """by_team AS (
    SELECT *, sum(total_cost_usd) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_cost_usd,
           avg(total_cost_usd) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30d_avg_daily_cost,
           total_cost_usd - lag(total_cost_usd) OVER w AS dod_cost_delta_usd,
           (total_cost_usd - lag(total_cost_usd) OVER w) / NULLIF(lag(total_cost_usd) OVER w, 0) > 0.2 AS is_cost_spike
    FROM daily_costs WINDOW w AS (PARTITION BY team, environment, cost_category, cloud_provider ORDER BY cost_date))"""
COSTS = ["cost_events", STG_COST_EVENTS, DAILY_COSTS, BY_TEAM]
BY_TEAM_F = "total_cost_usd rolling_7d_cost_usd rolling_30d_avg_daily_cost dod_cost_delta_usd"


def by_team(t):
    return costs.infra_cost_by_team(staging.cost_events(t.cost_events))


@query("P04_stg_cost_events", oracle("SELECT * FROM stg_cost_events", *COSTS, d="cost_date", f="cost_usd usage_amount"))
def p04(t):
    return staging.cost_events(t.cost_events)


@query("A07_daily_costs", oracle("SELECT * FROM daily_costs", *COSTS, d="cost_date", f="total_cost_usd"))
def a07(t):
    return costs.daily_costs(staging.cost_events(t.cost_events))


@query("W06_infra_cost_by_team", oracle("SELECT * FROM by_team", *COSTS, d="cost_date", f=BY_TEAM_F))
def w06(t):
    return by_team(t)


@query("A24_weekly_costs", oracle(
    f"""SELECT CAST(date_trunc('week', cost_date + INTERVAL 1 DAY) AS DATE) - 1 AS week_start, team, environment, cost_category,
              {rnd('sum(total_cost_usd)', 2)} AS weekly_cost_usd, {rnd('avg(rolling_30d_avg_daily_cost)', 2)} AS avg_daily_cost_usd,
              count(*) FILTER (is_cost_spike) AS spike_days
       FROM by_team WHERE cost_date >= DATE '2023-11-02' GROUP BY ALL""",
    *COSTS, d="week_start", f="weekly_cost_usd avg_daily_cost_usd"))
def a24(t):
    return costs.weekly_costs(by_team(t), EVENTS_AS_OF)


SPIKES = """SELECT team, environment, cost_category, cloud_provider, total_cost_usd, dod_cost_delta_usd
            FROM by_team WHERE cost_date = DATE '2024-01-30' AND is_cost_spike"""


@query("O03_top_cost_spikes", oracle(
    SPIKES + " ORDER BY dod_cost_delta_usd DESC, team, environment, cost_category, cloud_provider LIMIT 10",
    *COSTS, f="total_cost_usd dod_cost_delta_usd"))
def o03(t):
    return costs.cost_spikes(by_team(t), "2024-01-30", 10)


@query("P22_cost_spikes", oracle(SPIKES, *COSTS, f="total_cost_usd dod_cost_delta_usd"))
def p22(t):
    return costs.cost_spikes(by_team(t), "2024-01-30")


@query("A25_ops_kpi_dashboard", oracle(
    f"""SELECT coalesce(f.event_date, l.event_date, c.event_date) AS event_date,
              coalesce(fleet_health_score, 0) AS fleet_health_score, coalesce(fleet_slo_rate, 0) AS fleet_slo_rate,
              coalesce(fleet_anomaly_count, 0) AS fleet_anomaly_count, coalesce(critical_anomaly_count, 0) AS critical_anomaly_count,
              coalesce(avg_otp_rate, 0) AS avg_otp_rate, coalesce(avg_delay_minutes, 0) AS avg_delay_minutes,
              coalesce(avg_cancellation_rate, 0) AS avg_cancellation_rate, coalesce(total_flights, 0) AS total_flights,
              coalesce(total_cost_usd, 0) AS total_cost_usd, coalesce(cost_spike_count, 0) AS cost_spike_count
       FROM (SELECT event_date, {rnd('avg(avg_fleet_health_score)', 2)} AS fleet_health_score,
                    {rnd('avg(slo_compliance_rate)', 4)} AS fleet_slo_rate, sum(anomaly_count) AS fleet_anomaly_count,
                    sum(critical_anomaly_count) AS critical_anomaly_count FROM readiness GROUP BY 1) f
       FULL JOIN (SELECT event_date, {rnd('avg(otp_rate)', 4)} AS avg_otp_rate, {rnd('avg(avg_delay_minutes)', 2)} AS avg_delay_minutes,
                    {rnd('avg(cancellation_rate)', 4)} AS avg_cancellation_rate, sum(total_flights) AS total_flights
                  FROM summary GROUP BY 1) l ON f.event_date = l.event_date
       FULL JOIN (SELECT cost_date AS event_date, {rnd('sum(total_cost_usd)', 2)} AS total_cost_usd,
                    count(*) FILTER (is_cost_spike) AS cost_spike_count FROM by_team GROUP BY 1) c
         ON coalesce(f.event_date, l.event_date) = c.event_date""",
    *fleet_checks.READY, *FLIGHTS, *COSTS, d="event_date",
    f="fleet_health_score fleet_slo_rate avg_otp_rate avg_delay_minutes avg_cancellation_rate total_cost_usd",
    i="fleet_anomaly_count critical_anomaly_count total_flights cost_spike_count"))
def a25(t):
    return kpi.ops_kpi_dashboard(fleet_checks.readiness(t), summary(t), by_team(t))


# ---------------------------------------------------------------- billing

BILLING = """stg_billing AS (
    SELECT 'acct' AS billing_account_id, service_id, service_description, sku_id, sku_description,
           usage_start_time, usage_start_time AS usage_end_time, usage_date, project_id, project_id AS project_name,
           team_label, env_label, region, 'GB' AS country, cost AS cost_usd, 'USD' AS currency,
           1.0::DOUBLE AS currency_conversion_rate, 1.0::DOUBLE AS usage_amount, 'hour' AS usage_unit,
           coalesce(credit, 0) AS total_credits_usd, 'regular' AS cost_type, usage_start_time AS ingested_at,
           CAST(NULL AS VARCHAR) AS pipeline_run_id
    FROM cost_lines WHERE usage_date >= DATE '2023-11-02')"""


def key_sql(*cols):
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


ATTRIBUTION = f"""attribution AS (
    SELECT {key_sql('billing_month', 'project_id', 'team_label', 'env_label', 'service_description', 'sku_description', 'region')} AS cost_key,
           *, (net_cost_usd::DOUBLE - lag(net_cost_usd::DOUBLE) OVER w) / NULLIF(lag(net_cost_usd::DOUBLE) OVER w, 0) AS mom_cost_change_pct
    FROM (SELECT CAST(date_trunc('month', usage_date) AS DATE) AS billing_month, project_id,
                 coalesce(team_label, 'unattributed') AS team_label, coalesce(env_label, 'unknown') AS env_label,
                 service_description, sku_description, region, sum(cost_usd) AS gross_cost_usd,
                 sum(total_credits_usd) AS total_credits_usd, sum(cost_usd + total_credits_usd) AS net_cost_usd,
                 count(DISTINCT usage_date) AS billing_days
          FROM stg_billing GROUP BY 1, 2, 3, 4, 5, 6, 7)
    WINDOW w AS (PARTITION BY project_id, team_label, env_label, service_description, sku_description, region ORDER BY billing_month))"""


def billing(t):
    return staging.cost_billing(t.cost_billing_export, EVENTS_AS_OF)


@query("P03_stg_cost_billing", oracle("SELECT * FROM stg_billing", "cost_lines", BILLING, d="usage_date",
       t="usage_start_time usage_end_time ingested_at", f="cost_usd total_credits_usd currency_conversion_rate usage_amount"))
def p03(t):
    return billing(t)


@query("A13_cost_attribution", oracle("SELECT * FROM attribution", "cost_lines", BILLING, ATTRIBUTION, d="billing_month",
       f="gross_cost_usd total_credits_usd net_cost_usd mom_cost_change_pct"))
def a13(t):
    return costs.cost_attribution(billing(t))


@query("W07_month_over_month", oracle(
    "SELECT billing_month, project_id, team_label, net_cost_usd, mom_cost_change_pct FROM attribution",
    "cost_lines", BILLING, ATTRIBUTION, d="billing_month", f="net_cost_usd mom_cost_change_pct"))
def w07(t):
    return costs.cost_attribution(billing(t)).select(
        "billing_month", "project_id", "team_label", "net_cost_usd", "mom_cost_change_pct")


# ---------------------------------------------------------------- events, SLO, service health

STG_EVENTS = """stg_events AS (
    SELECT event_key, lower(trim(source_system)) AS source_system, lower(trim(environment)) AS environment,
           coalesce(cluster_name, 'unknown') AS cluster_name, coalesce(region, 'unknown') AS region, event_id,
           upper(trim(event_type)) AS event_type, upper(trim(coalesce(event_subtype, 'UNKNOWN'))) AS event_subtype,
           lower(trim(coalesce(service_name, 'unknown'))) AS service_name, event_timestamp, event_date,
           coalesce(duration_ms, 0) AS duration_ms, upper(coalesce(severity, 'UNKNOWN')) AS severity,
           upper(coalesce(status, 'UNKNOWN')) AS status, coalesce(message, '') AS message, payload_json, slo_name,
           coalesce(error_budget_burn, 0) AS error_budget_burn, coalesce(cost_centre, 'unattributed') AS cost_centre,
           coalesce(squad, 'unattributed') AS squad, ingested_at, pipeline_version, source_file
    FROM fleet_events
    WHERE event_date BETWEEN DATE '2023-11-02' AND DATE '2024-01-31' AND event_id IS NOT NULL AND event_timestamp IS NOT NULL
      AND event_type IN ('DEPLOY', 'SCALE', 'INCIDENT', 'ALERT', 'HEAL', 'ROLLBACK'))"""
STG_SLO = f"""stg_slo AS (
    SELECT metric_key, lower(trim(service_name)) AS service_name, lower(trim(environment)) AS environment, slo_name, slo_target,
           slo_window_days, coalesce(good_events, 0) AS good_events, coalesce(total_events, 0) AS total_events,
           coalesce(error_rate, 0) AS error_rate, {div('coalesce(good_events, 0)', 'coalesce(total_events, 0)')} AS availability,
           coalesce(error_budget_remaining, 1) AS error_budget_remaining, coalesce(burn_rate_1h, 0) AS burn_rate_1h,
           coalesce(burn_rate_6h, 0) AS burn_rate_6h, coalesce(burn_rate_24h, 0) AS burn_rate_24h,
           coalesce(burn_rate_72h, 0) AS burn_rate_72h, is_breaching, alert_tier, snapshot_timestamp, snapshot_date,
           ingested_at, source_system
    FROM slo_metrics WHERE snapshot_date >= DATE '2023-11-02' AND service_name IS NOT NULL)"""
EVENT_AGG = f"""event_agg AS (
    SELECT event_date AS report_date, service_name, environment, cluster_name, squad, cost_centre, count(*) AS total_events,
           count(*) FILTER (event_type = 'DEPLOY') AS deploy_count, count(*) FILTER (event_type = 'INCIDENT') AS incident_count,
           count(*) FILTER (event_type = 'ALERT') AS alert_count, count(*) FILTER (event_type = 'HEAL') AS heal_count,
           count(*) FILTER (event_type = 'SCALE') AS scale_count, count(*) FILTER (severity = 'CRITICAL') AS critical_events,
           count(*) FILTER (severity = 'HIGH') AS high_events, count(*) FILTER (severity = 'MEDIUM') AS medium_events,
           count(*) FILTER (severity = 'LOW') AS low_events,
           CAST(count(*) FILTER (event_type = 'DEPLOY') AS DOUBLE) AS deployment_frequency,
           {div("count(*) FILTER (event_type = 'DEPLOY' AND status = 'FAILURE')", "count(*) FILTER (event_type = 'DEPLOY')")} AS change_failure_rate,
           avg(duration_ms / 60000.0::DOUBLE) FILTER (event_type IN ('INCIDENT', 'HEAL')) AS mean_time_to_recovery_mins
    FROM stg_events GROUP BY 1, 2, 3, 4, 5, 6)"""
SLO_AGG = """slo_agg AS (
    SELECT snapshot_date AS report_date, service_name, environment, avg(availability) AS p99_availability,
           avg(error_budget_remaining) AS error_budget_remaining, count(*) FILTER (is_breaching) AS slo_breach_count
    FROM stg_slo GROUP BY 1, 2, 3)"""
COST_AGG = """cost_agg AS (
    SELECT usage_date AS report_date, coalesce(team_label, 'unattributed') AS squad,
           sum(cost_usd + total_credits_usd) AS daily_cost_usd
    FROM stg_billing GROUP BY 1, 2)"""
HEALTH = f"""health AS (
    SELECT {key_sql('e.report_date', 'e.service_name', 'e.environment', 'e.cluster_name', 'e.squad', 'e.cost_centre')} AS fleet_health_key,
           e.*, s.p99_availability, s.error_budget_remaining, s.slo_breach_count,
           coalesce(c.daily_cost_usd::DOUBLE, 0) AS daily_cost_usd,
           {div('coalesce(c.daily_cost_usd::DOUBLE, 0)', 'e.deploy_count')} AS cost_per_deploy_usd,
           false AS incident_anomaly, false AS cost_anomaly
    FROM event_agg e LEFT JOIN slo_agg s USING (report_date, service_name, environment)
    LEFT JOIN cost_agg c ON c.report_date = e.report_date AND c.squad = e.squad)"""
SERVICE = ["fleet_events", "slo_metrics", "cost_lines", BILLING, STG_EVENTS, STG_SLO, EVENT_AGG, SLO_AGG, COST_AGG, HEALTH]
EVENT_F = "deployment_frequency change_failure_rate mean_time_to_recovery_mins"
HEALTH_F = EVENT_F + " p99_availability error_budget_remaining daily_cost_usd cost_per_deploy_usd"
SLO_WEEK = f"""slo_week AS (
    SELECT {key_sql('report_week', 'service_name', 'environment', 'slo_name', "'0.9'", 'slo_window_days')} AS slo_key, * FROM (
    SELECT CAST(date_trunc('week', snapshot_date + INTERVAL 1 DAY) AS DATE) - 1 AS report_week, service_name, environment,
           slo_name, slo_target, slo_window_days, avg(availability) AS avg_availability, min(availability) AS min_availability,
           avg(error_budget_remaining) AS avg_error_budget_remaining, min(error_budget_remaining) AS min_error_budget_remaining,
           avg(burn_rate_1h) AS avg_burn_rate_1h, max(burn_rate_1h) AS peak_burn_rate_1h, avg(burn_rate_6h) AS avg_burn_rate_6h,
           count(*) FILTER (is_breaching) AS breach_count, count(*) AS snapshot_count,
           count(*) FILTER (is_breaching)::DOUBLE / count(*) AS breach_pct, avg(availability) >= slo_target AS is_compliant,
           CASE WHEN avg(burn_rate_1h) >= 14.4 THEN 'P0' WHEN avg(burn_rate_6h) >= 6 THEN 'P1'
                WHEN avg(burn_rate_24h) >= 3 THEN 'P2' ELSE 'OK' END AS alert_tier
    FROM stg_slo GROUP BY 1, 2, 3, 4, 5, 6))"""


def events(t):
    return staging.fleet_events(t.fleet_events, EVENTS_AS_OF)


def slo(t):
    return staging.slo_metrics(t.slo_metrics, EVENTS_AS_OF)


def health(t):
    return services.fleet_health_daily(events(t), slo(t), billing(t))


@query("P01_stg_fleet_events", oracle("SELECT * FROM stg_events", *SERVICE, d="event_date", t="event_timestamp ingested_at",
       f="error_budget_burn"))
def p01(t):
    return events(t)


@query("P02_stg_slo_metrics", oracle("SELECT * FROM stg_slo", *SERVICE, d="snapshot_date", t="snapshot_timestamp ingested_at",
       f="slo_target error_rate availability error_budget_remaining burn_rate_1h burn_rate_6h burn_rate_24h burn_rate_72h"))
def p02(t):
    return slo(t)


@query("A08_daily_events", oracle("SELECT * FROM event_agg", *SERVICE, d="report_date", f=EVENT_F))
def a08(t):
    return services.daily_events(events(t))


@query("A09_daily_slo", oracle("SELECT * FROM slo_agg", *SERVICE, d="report_date", f="p99_availability error_budget_remaining"))
def a09(t):
    return services.daily_slo(slo(t))


@query("A10_daily_squad_cost", oracle("SELECT * FROM cost_agg", *SERVICE, d="report_date", f="daily_cost_usd"))
def a10(t):
    return services.daily_squad_cost(billing(t))


@query("A11_fleet_health_daily", oracle("SELECT * FROM health", *SERVICE, d="report_date", f=HEALTH_F))
def a11(t):
    return health(t)


@query("W11_anomaly_flags", oracle(
    """SELECT report_date, service_name, environment, cluster_name, squad,
              coalesce(abs((incident_count - avg(incident_count) OVER b) / CASE WHEN stddev_pop(incident_count) OVER b > 1e-9 THEN stddev_pop(incident_count) OVER b END) >= 3, false) AS incident_anomaly,
              coalesce((daily_cost_usd - lag(daily_cost_usd) OVER w) / NULLIF(lag(daily_cost_usd) OVER w, 0) > 0.2, false) AS cost_anomaly
       FROM health WINDOW w AS (PARTITION BY service_name, environment, cluster_name, squad, cost_centre ORDER BY report_date),
            b AS (PARTITION BY service_name, environment, cluster_name, squad, cost_centre ORDER BY report_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
    *SERVICE, d="report_date"))
def w11(t):
    return services.with_anomaly_flags(health(t)).select(
        "report_date", "service_name", "environment", "cluster_name", "squad", "incident_anomaly", "cost_anomaly")


SLO_F = ("slo_target avg_availability min_availability avg_error_budget_remaining min_error_budget_remaining avg_burn_rate_1h "
         "peak_burn_rate_1h avg_burn_rate_6h breach_pct")


@query("A12_slo_compliance", oracle("SELECT * FROM slo_week", *SERVICE, SLO_WEEK, d="report_week", f=SLO_F))
def a12(t):
    return services.slo_compliance(slo(t))


WEEKLY = """weekly AS (
    SELECT CAST(date_trunc('week', report_date + INTERVAL 1 DAY) AS DATE) - 1 AS report_week, service_name, environment, squad,
           sum(deploy_count) AS weekly_deploys, avg(change_failure_rate) AS avg_cfr,
           avg(mean_time_to_recovery_mins) AS avg_mttr_mins, sum(incident_count) AS weekly_incidents,
           avg(p99_availability) AS avg_availability, avg(error_budget_remaining) AS avg_error_budget
    FROM health WHERE report_date >= DATE '2023-12-06' GROUP BY 1, 2, 3, 4)"""


@query("A22_weekly_delivery", oracle("SELECT * FROM weekly", *SERVICE, WEEKLY, d="report_week",
       f="avg_cfr avg_mttr_mins avg_availability avg_error_budget", i="weekly_deploys weekly_incidents"))
def a22(t):
    return services.weekly_delivery(health(t), EVENTS_AS_OF)


@query("W09_deployment_trends", oracle(
    f"""SELECT report_week, service_name, environment, squad, weekly_deploys, {rnd('avg_cfr * 100', 2)} AS cfr_pct,
               {rnd('avg_mttr_mins', 1)} AS mttr_mins, {rnd('avg_availability * 100', 4)} AS availability_pct,
               {rnd('avg_error_budget * 100', 2)} AS error_budget_pct, weekly_incidents,
               {rnd('deploy_wow', 1)} AS deploy_wow_pct, {rnd('mttr_wow', 1)} AS mttr_wow_pct,
               CASE WHEN weekly_deploys >= 7 AND avg_cfr <= 0.05 AND avg_mttr_mins <= 60 THEN 'Elite'
                    WHEN weekly_deploys >= 1 AND avg_cfr <= 0.10 AND avg_mttr_mins <= 1440 THEN 'High'
                    WHEN weekly_deploys >= 1 AND avg_cfr <= 0.15 THEN 'Medium' ELSE 'Low' END AS dora_tier
        FROM (SELECT *, (weekly_deploys - lag(weekly_deploys) OVER w)::DOUBLE / NULLIF(lag(weekly_deploys) OVER w, 0) * 100 AS deploy_wow,
                     (avg_mttr_mins - lag(avg_mttr_mins) OVER w) / NULLIF(lag(avg_mttr_mins) OVER w, 0) * 100 AS mttr_wow
              FROM weekly WINDOW w AS (PARTITION BY service_name, environment, squad ORDER BY report_week))
        WHERE report_week >= DATE '2024-01-03'""",
    *SERVICE, WEEKLY, d="report_week", f="cfr_pct mttr_mins availability_pct error_budget_pct deploy_wow_pct mttr_wow_pct",
    i="weekly_deploys weekly_incidents"))
def w09(t):
    return services.deployment_trends(health(t), EVENTS_AS_OF)


# ---------------------------------------------------------------- freshness

LIMITS = [("ops_raw", "events", 2), ("ops_raw", "orders", 25), ("ops_raw", "lineitem", 500), ("ops_raw", "absent", 1)]


@query("A26_table_freshness", oracle(
    """SELECT dataset_id, table_name, latest_partition_date, latest_modified, total_rows, sla_hours, hours_since_update,
              hours_since_update > sla_hours AS is_stale,
              CASE WHEN hours_since_update > sla_hours * 3 THEN 'CRITICAL' WHEN hours_since_update > sla_hours THEN 'WARNING' ELSE 'OK' END AS freshness_status,
              TIMESTAMP '2024-01-31 00:00:00' AS checked_at
       FROM (SELECT 'ops_raw' AS dataset_id, table_name, max(ts) AS latest_modified, CAST(max(ts) AS DATE) AS latest_partition_date,
                    count(*) AS total_rows, date_sub('hour', max(ts), TIMESTAMP '2024-01-31 00:00:00') AS hours_since_update
             FROM (SELECT 'events' AS table_name, ts FROM events UNION ALL SELECT 'orders', o_orderdate FROM orders
                   UNION ALL SELECT 'lineitem', l_shipdate FROM lineitem) GROUP BY 2)
       JOIN (VALUES ('events', 2), ('orders', 25), ('lineitem', 500)) l(table_name, sla_hours) USING (table_name)""",
    d="latest_partition_date", t="latest_modified checked_at", i="sla_hours"))
def a26(t):
    parts = freshness.partition_statistics(t.raw("events"), "ops_raw", "events", "ts")
    for table, ts in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        parts = parts.unionByName(freshness.partition_statistics(t.raw(table), "ops_raw", table, ts))
    return freshness.table_freshness(parts, EVENTS_AS_OF, LIMITS)


@query("Q22_source_freshness", oracle(
    """SELECT 'fleet_events' AS table_name, max(ingested_at) AS max_loaded_at,
              (epoch_us(TIMESTAMP '2024-01-31 03:00:00') - epoch_us(max(ingested_at))) / 3600000000.0::DOUBLE AS age_hours,
              CASE WHEN age_hours > 4 THEN 'error' WHEN age_hours > 2 THEN 'warn' ELSE 'pass' END AS state
       FROM fleet_events""", "fleet_events", t="max_loaded_at", f="age_hours"))
def q22(t):
    return freshness.source_freshness(t.fleet_events, "fleet_events", "2024-01-31 03:00:00")


@query("Q22_all_sources", oracle(
    " UNION ALL ".join(f"""SELECT '{n}' AS table_name, max(ingested_at) AS max_loaded_at, (epoch_us(TIMESTAMP '2024-01-31 03:00:00') - epoch_us(max(ingested_at))) / 3600000000.0::DOUBLE AS age_hours,
        CASE WHEN max(ingested_at) IS NULL OR (epoch_us(TIMESTAMP '2024-01-31 03:00:00') - epoch_us(max(ingested_at))) / 3600000000.0::DOUBLE > {e} THEN 'error'
             WHEN (epoch_us(TIMESTAMP '2024-01-31 03:00:00') - epoch_us(max(ingested_at))) / 3600000000.0::DOUBLE > {w} THEN 'warn' ELSE 'pass' END AS state FROM {x}"""
                       for n, x, w, e in (("fleet_events", "fleet_events", 2, 4), ("slo_metrics", "slo_metrics", 2, 6),
                                          ("cost_billing_export", "(SELECT usage_start_time AS ingested_at FROM cost_lines)", 26, 50))),
    "fleet_events", "slo_metrics", "cost_lines", t="max_loaded_at", f="age_hours"))
def q22a(t):
    at = "2024-01-31 03:00:00"
    return freshness.source_freshness(t.fleet_events, "fleet_events", at).union(
        freshness.source_freshness(t.slo_metrics, "slo_metrics", at)).union(freshness.source_freshness(t.cost_billing_export, "cost_billing_export", at))


@query("Q23_recent_rows", oracle(
    """SELECT count(*) AS recent_rows, count(*) > 0 AS is_fresh FROM fleet_telemetry
       WHERE event_ts >= TIMESTAMP '2024-01-29 23:00:00'""", "fleet_telemetry"))
def q23(t):
    return freshness.has_recent_rows(t.fleet_telemetry, "event_ts", EVENTS_AS_OF)
