"""Named SQL scripts with bound parameters, and the macros that their text uses.

A script is a list of steps. A step is SQL text, whose parameters (`:scan_date`) are bound and never pasted, or an operator over earlier
steps, for what SQL would write as a range join. Its result is a temporary view that later steps name; the last one is the result.
"""
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from opsloom.params import CLOCK_SKEW_SECONDS, CORRELATION_SECONDS, DORA_DAILY, JOB_ZSCORE_THRESHOLD, MIN_BASELINE
from opsloom.plans import workloads
from opsloom.session import settled
from opsloom.sources.tables import register_views

# Signature and expression of each macro. Deviations and denominators of zero give NULL.
MACROS = {
    "safe_divide": ("(num DOUBLE, den DOUBLE) RETURNS DOUBLE", "try_divide(num, den)"),
    "safe_divide_or": ("(num DOUBLE, den DOUBLE, fallback DOUBLE) RETURNS DOUBLE", "if(coalesce(den, 0) = 0, fallback, num / den)"),
    "zscore": ("(x DOUBLE, mean DOUBLE, deviation DOUBLE) RETURNS DOUBLE", "try_divide(x - mean, deviation)"),
    "rolling_zscore": ("(x DOUBLE, mean DOUBLE, deviation DOUBLE) RETURNS DOUBLE", "if(deviation > 1e-9, (x - mean) / deviation, NULL)"),
    "date_trunc_safe": ("(part STRING, at TIMESTAMP) RETURNS DATE", """CASE WHEN part IN ('raw', 'day', 'date') THEN CAST(at AS DATE)
        WHEN part = 'week' THEN date_sub(CAST(at AS DATE), dayofweek(at) - 1) ELSE trunc(CAST(at AS DATE), part) END"""),
    "dora_tier": ("(freq DOUBLE, failures DOUBLE, recovery DOUBLE) RETURNS STRING", """CASE
        WHEN freq >= {0!r} AND failures <= 0.05 AND recovery <= 60 THEN 'Elite' WHEN freq >= {1!r} AND failures <= 0.10 AND recovery <= 1440 THEN 'High'
        WHEN freq >= {2!r} AND failures <= 0.15 THEN 'Medium' ELSE 'Low' END""".format(*map(float, DORA_DAILY))),
}


def register_macros(spark: SparkSession) -> None:
    """Make the macros callable from SQL text of this session; they are inlined, so no Python runs."""
    for name, (signature, body) in MACROS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{signature} RETURN {body}")


@dataclass
class Script:
    """Steps as (view, text or operator of the session's views), tables that the text names, parameters with their defaults (None: required) and
    the steps whose rows are read twice and therefore written once."""

    tables: tuple
    steps: list
    parameters: dict = field(default_factory=dict)
    kept: frozenset = frozenset()


DAY = "CAST(:scan_date AS DATE)"
UNIQUE = ("unique_jobs", f"""
    SELECT * EXCEPT (place) FROM (
        SELECT *, coalesce(parent_job_id, job_id) AS canonical_job_id,
               row_number() OVER (PARTITION BY coalesce(parent_job_id, job_id) ORDER BY retry_attempt DESC, ingested_at DESC, job_id) AS place
        FROM job_metadata WHERE execution_date = {DAY})
    WHERE place = 1""")
SCORED = ("scored_jobs", f"""
    WITH usual AS (
        SELECT workload_type, avg(duration_seconds) AS baseline_mean_duration_s, stddev_pop(duration_seconds) AS baseline_stddev_duration_s,
               avg(if(status = 'FAILURE', 1D, 0D)) AS baseline_failure_rate, count(*) AS baseline_sample_count
        FROM job_metadata
        WHERE execution_date BETWEEN date_sub({DAY}, :baseline_days) AND date_sub({DAY}, 1) AND status IN ('SUCCESS', 'FAILURE') AND retry_attempt = 0
        GROUP BY workload_type HAVING count(*) >= :min_jobs),
    compared AS (
        SELECT j.*, u.* EXCEPT (workload_type), zscore(duration_seconds, baseline_mean_duration_s, baseline_stddev_duration_s) AS duration_z_score
        FROM unique_jobs j LEFT JOIN usual u ON u.workload_type = j.workload_type)
    SELECT *, coalesce(abs(duration_z_score) > :anomaly_z_threshold, false) AS is_duration_anomaly FROM compared""")
EVENTS = ("day_events", f"SELECT * FROM infrastructure_events WHERE event_date = {DAY}")
BASELINE = {"scan_date": None, "baseline_days": 30, "min_jobs": MIN_BASELINE, "anomaly_z_threshold": float(JOB_ZSCORE_THRESHOLD)}


def _impact(view, args):
    return workloads.infra_impact(view("unique_jobs"), view("day_events"), args["skew_seconds"])


def _overlaps(view, args):
    return workloads.overlapping_events(view("long_jobs"), view("day_events"), args["tolerance_seconds"])


_MEANS = {
    "avg_cpu_used": "cpu_used_cores", "avg_cpu_requested": "cpu_requested_cores", "avg_cpu_efficiency": "safe_divide(cpu_used_cores, cpu_requested_cores)",
    "avg_cpu_throttle_pct": "cpu_throttle_pct", "avg_memory_used_gb": "memory_used_gb", "avg_memory_pressure": "safe_divide(memory_used_gb, memory_limit_gb)",
    "avg_gpu_utilisation_pct": "gpu_utilisation_pct", "avg_gpu_memory_used_gb": "gpu_memory_used_gb",
}
_PARTS = ", ".join(f"sum({x}) AS s_{name}, count({x}) AS n_{name}" for name, x in _MEANS.items())
_MERGED = ", ".join(f"try_divide(sum(s_{name}), sum(n_{name})) AS {name}" for name in _MEANS)
_SERIES = "workload_type, team, cloud_provider, environment, node_type"

SCRIPTS = {
    "extract_job_metadata": Script(("job_metadata", "resource_allocation_logs", "infrastructure_events"), [
        UNIQUE, EVENTS, ("infra_impact", _impact), SCORED,
        ("result", f"""
            WITH used AS (
                SELECT job_id, avg(cpu_used_cores) AS avg_cpu_cores, max(cpu_used_cores) AS peak_cpu_cores, max(memory_used_gb) AS peak_memory_gb,
                       avg(gpu_utilisation_pct) AS avg_gpu_utilisation_pct, max(gpu_utilisation_pct) AS peak_gpu_utilisation_pct,
                       sum(compute_cost_usd) AS total_compute_cost_usd, avg(cpu_throttle_pct) AS avg_cpu_throttle_pct,
                       count_if(cpu_used_cores IS NULL) AS missed_collection_windows, count(*) AS total_collection_windows, min(node_type) AS node_type
                FROM resource_allocation_logs WHERE log_date = {DAY} GROUP BY job_id)
            SELECT s.*, used.* EXCEPT (job_id), i.* EXCEPT (job_id, execution_date), CAST(:as_of AS TIMESTAMP) AS extracted_at
            FROM scored_jobs s LEFT JOIN used ON used.job_id = s.job_id LEFT JOIN infra_impact i ON i.job_id = s.job_id"""),
    ], BASELINE | {"as_of": None, "skew_seconds": CLOCK_SKEW_SECONDS}, frozenset({"unique_jobs"})),
    "infra_event_correlation": Script(("job_metadata", "infrastructure_events"), [
        UNIQUE, EVENTS, SCORED,
        ("long_jobs", """SELECT *, hour(started_at) AS start_hour FROM scored_jobs
            WHERE status = 'SUCCESS' AND duration_seconds IS NOT NULL AND duration_z_score > :anomaly_z_threshold"""),
        ("overlaps", _overlaps),
        ("result", """
            SELECT o.*, h.* EXCEPT (start_hour)
            FROM overlaps o JOIN (
                SELECT start_hour, count(DISTINCT job_id) AS anomalous_job_count, avg(duration_z_score) AS avg_z_score, avg(duration_seconds) AS avg_duration_s
                FROM long_jobs GROUP BY start_hour) h ON h.start_hour = o.event_hour
            ORDER BY affected_anomalous_jobs DESC, avg_anomaly_zscore DESC"""),
    ], BASELINE | {"tolerance_seconds": CORRELATION_SECONDS}, frozenset({"long_jobs"})),
    "resource_utilisation": Script(("job_metadata", "resource_allocation_logs"), [
        ("usage", f"""
            WITH per_job AS (
                SELECT job_id, CAST(collected_at AS DATE) AS summary_date, node_type, {_PARTS}, max(memory_used_gb) AS peak,
                       sum(compute_cost_usd) AS cost, count(*) AS samples
                FROM resource_allocation_logs
                WHERE log_date BETWEEN date_sub({DAY}, :lookback_days) AND {DAY} AND cpu_used_cores IS NOT NULL
                GROUP BY job_id, CAST(collected_at AS DATE), node_type)
            SELECT summary_date, {_SERIES}, {_MERGED}, max(peak) AS peak_memory_used_gb, CAST(sum(cost) AS DOUBLE) AS daily_compute_cost_usd,
                   count(DISTINCT job_id) AS distinct_jobs, sum(samples) AS sample_count
            FROM per_job JOIN (SELECT job_id, execution_date AS summary_date, workload_type, team, cloud_provider, environment FROM job_metadata
                               WHERE execution_date BETWEEN date_sub({DAY}, :lookback_days) AND {DAY}) USING (job_id, summary_date)
            GROUP BY summary_date, {_SERIES}"""),
        ("result", f"""
            SELECT *, safe_divide(daily_compute_cost_usd - prev_day_cost_usd, prev_day_cost_usd) * 100 AS cost_change_pct
            FROM (SELECT *, lag(daily_compute_cost_usd) OVER (PARTITION BY {_SERIES} ORDER BY summary_date) AS prev_day_cost_usd FROM usage)
            WHERE summary_date = {DAY} ORDER BY daily_compute_cost_usd DESC, workload_type, team"""),
    ], {"scan_date": None, "lookback_days": 30}),
}


def run_script(spark: SparkSession, script: str | Script, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """Run a script, by name or given, over some tables.

    Parameters without a default must be given, and only those that the script has. Missing tables are an error, others are not read. Views
    of the session with the names of tables or steps are replaced.
    """
    script = SCRIPTS[script] if isinstance(script, str) else script
    unknown, absent = set(parameters) - set(script.parameters), set(script.tables) - set(tables)
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    if absent:
        raise ValueError(f"missing tables: {', '.join(sorted(absent))}")
    args = script.parameters | parameters
    unset = sorted(name for name, value in args.items() if value is None)
    if unset:
        raise ValueError(f"parameters without a value: {', '.join(unset)}")
    register_macros(spark)
    register_views({name: tables[name] for name in script.tables})
    made = None
    for view, step in script.steps:
        made = spark.sql(step, args=args) if isinstance(step, str) else step(spark.table, args)
        if view in script.kept:
            made = settled(made)
        made.createOrReplaceTempView(view)
    return made
