"""Cleansing, detection and quality checks on small tables with fixed numbers."""
import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsloom.operators import baseline, cleansing, quality
from opsloom.plans import workloads



def spread(n):
    """n deviations of a normal shape, in a fixed order, by the logistic quantile function."""
    out = [0.55 * math.log(q / (1 - q)) for q in ((k + 0.5) / n for k in range(n))]
    return [out[(k * 29) % n] for k in range(n)] if n % 29 else out


SCHEMA = "job_id string, workload_type string, status string, retry_attempt int, duration_seconds double"


def jobs(spark, prefix, durations, kind="fine_tuning"):
    return spark.createDataFrame([(f"{prefix}{i}", kind, "SUCCESS", 0, float(d)) for i, d in enumerate(durations)], SCHEMA)


@pytest.fixture(scope="module")
def history(spark):
    return jobs(spark, "old-", [900 + 40 * z for z in spread(120)])


@pytest.fixture(scope="module")
def current(spark):
    return jobs(spark, "new-", [1300.0, 1450.0] + [900 + 30 * z for z in spread(13)])


def test_flags_long_jobs(history, current):
    ids = {r.job_id for r in baseline.detect(current, history).collect()}
    assert {"new-0", "new-1"} <= ids


def test_few_flags_on_normal_data(spark):
    df = jobs(spark, "j", [240 + 15 * z for z in spread(80)], "inference")
    assert baseline.detect(df, df).count() <= 6


def test_report_keys_and_json(history, current, tmp_path):
    from opsloom.sources.sinks import write_report
    stats = baseline.detector_baseline(history)
    report = baseline.anomaly_report(baseline.score_against(current, stats), "2023-11-06")
    assert {"total_jobs", "anomalous_jobs", "anomaly_rate", "by_workload_type", "top_anomalies"} <= set(report.columns)
    write_report(report, str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("*.json"))
    assert len(files) == 1
    row = json.loads(files[0].read_text())
    assert row["total_jobs"] == 15 and row["anomalous_jobs"] >= 2 and "fine_tuning" in row["by_workload_type"]


def test_deviation_from_the_mean(spark):
    base = jobs(spark, "b", [800.0, 1000.0, 1200.0] * 4)
    r = baseline.detect(jobs(spark, "x", [2500.0]), base, min_n=5).collect()
    assert len(r) == 1 and r[0].deviation_pct == pytest.approx(150.0)


def test_too_small_a_baseline_scores_nothing(spark):
    few = jobs(spark, "b", [10.0 * i for i in range(29)])
    scored = baseline.score_against(few, baseline.detector_baseline(few))
    assert scored.where("z_score IS NOT NULL OR is_anomaly").count() == 0


def test_severity_at_the_threshold_is_medium_but_no_anomaly(spark):
    stats = spark.createDataFrame([("fine_tuning", 70.0, 4.0, 70.0, 77.0, 44)],
                                  "workload_type string, baseline_mean double, baseline_std double, baseline_median double, baseline_p95 double, baseline_count long")
    r = baseline.score_against(jobs(spark, "x", [78.0]), stats).first()
    assert (r.z_score, r.is_anomaly, r.anomaly_severity) == (2.0, False, "MEDIUM")


def test_daily_baseline_output_is_accepted_as_history(spark, history, current):
    dated = history.withColumn("execution_date", F.lit("2023-10-20").cast("date"))
    base = baseline.duration_baseline(dated, "2023-11-06")
    assert baseline.detect(current, base).count() >= 2


# ---------------------------------------------------------------- cleansing

RAW = ("job_id string, workload_type string, status string, retry_attempt int, parent_job_id string, execution_date string, submitted_at string, "
       "started_at string, completed_at string, cpu_used_cores double, memory_used_gb double, gpu_utilisation_pct double")
NIGHT = ("2023-11-05", "2023-11-05T22:10:00Z", "2023-11-05T22:15:00Z", "2023-11-05T23:45:00Z")


def raw(spark, change=lambda row: row):
    """An encoder run that was repeated once, a failed load without readings, and a tuning run without GPU readings."""
    rows = [
        ("emb-9", "inference", "FAILURE", 0, None, *NIGHT, 6.0, 24.0, 40.0),
        ("emb-9b", "inference", "SUCCESS", 1, "emb-9", *NIGHT, 8.0, 26.0, 44.0),
        ("etl-4", "data_processing", "FAILURE", 0, None, *NIGHT, None, None, None),
        ("ft-2", "fine_tuning", "SUCCESS", 0, None, *NIGHT, 2.0, 10.0, None),
    ]
    names = [c.split()[0] for c in RAW.split(", ")]
    return spark.createDataFrame([tuple(change(dict(zip(names, r))).values()) for r in rows], RAW)


def setting(job, **values):
    return lambda row: {**row, **values} if job in (None, row["job_id"]) else row


def test_keeps_the_last_attempt(spark):
    out = cleansing.clean(raw(spark))
    assert {(r.canonical_job_id, r.job_id) for r in out.collect()} == {("emb-9", "emb-9b"), ("etl-4", "etl-4"), ("ft-2", "ft-2")}
    assert cleansing.cleansing_report(raw(spark)).first().duplicate_retry_records_removed == 1


def test_hot_parent_is_reduced_before_the_shuffle(spark):
    plan = cleansing.final_attempts(raw(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_imputation_falls_back_to_the_overall_median(spark):
    out = {r.job_id: r for r in cleansing.clean(raw(spark)).collect()}
    assert (out["etl-4"].cpu_used_cores, out["etl-4"].memory_used_gb) == (5.0, 18.0)
    assert out["ft-2"].gpu_utilisation_pct == 44.0
    assert cleansing.cleansing_report(raw(spark)).first().null_values_imputed == 4


@pytest.mark.parametrize("strategy, cpu", [("zero", 0.0), ("global_median", 5.0)])
def test_other_strategies(spark, strategy, cpu):
    assert cleansing.clean(raw(spark), strategy).where("job_id = 'etl-4'").first().cpu_used_cores == cpu


def test_overall_median_counts_imputed_values(spark):
    rows = [("p", "fine_tuning", 4.0), ("q", "fine_tuning", None), ("r", "fine_tuning", None), ("s", "inference", 20.0), ("t", "other", None)]
    df = spark.createDataFrame(rows, "job_id string, workload_type string, cpu_used_cores double")
    assert {r.job_id: r.cpu_used_cores for r in cleansing.impute_resources(df).collect()} == {"p": 4.0, "q": 4.0, "r": 4.0, "s": 20.0, "t": 4.0}


def test_timestamps_and_duration(spark):
    out = cleansing.clean(raw(spark, lambda r: setting("etl-4", started_at="soon")(setting("ft-2", started_at="2023-11-06T00:43:20+01:00")(r))))
    assert dict(out.dtypes)["submitted_at"] == "timestamp"
    rows = {r.job_id: (r.duration_seconds, r.duration_bucket) for r in out.collect()}
    assert rows == {"emb-9b": (5400, ">60m"), "etl-4": (None, "unknown"), "ft-2": (100, "1-5m")}


def test_negative_duration_becomes_null(spark):
    df = raw(spark, setting(None, completed_at="2023-11-05T20:00:00Z"))
    assert cleansing.clean(df).where("duration_seconds IS NOT NULL").count() == 0
    assert cleansing.cleansing_report(df).first().timestamp_skew_corrections == 4


def test_invalid_values_are_dropped(spark):
    out = cleansing.clean(raw(spark, setting("etl-4", status="PAUSED")))
    assert {r.job_id for r in out.collect()} == {"emb-9b", "ft-2"}
    out = cleansing.clean(raw(spark, setting("ft-2", workload_type="mining")))
    assert {r.job_id for r in out.collect()} == {"emb-9b", "etl-4"}


def test_missing_required_column_raises(spark):
    with pytest.raises(ValueError, match="execution_date"):
        cleansing.clean(raw(spark).drop("execution_date"))


# ---------------------------------------------------------------- quality gate

@pytest.fixture(scope="module")
def good(spark):
    kinds = ("inference", "fine_tuning", "data_processing", "model_training")
    rows = [(f"n-{i}", kinds[i % 4] if i % 4 else "model_training" if i % 8 else "inference", "SUCCESS" if i % 5 else "FAILURE", "2023-11-01T07:30:00+00:00",
             30.0 + 7 * i, 0.5 + i % 9, 1.0 + i % 33, float(3 * i % 90)) for i in range(64)]
    return spark.createDataFrame(rows, "job_id string, workload_type string, status string, submitted_at string, duration_seconds double, "
                                       "cpu_used_cores double, memory_used_gb double, gpu_utilisation_pct double")


NOW = "2023-11-06 00:00:00"


def test_good_table_passes(good):
    results = quality.job_checks(good, NOW)
    assert results.count() == 10 and results.where("NOT passed").count() == 0
    quality.assert_no_critical_failures(results)


def test_empty_table_fails(spark, good):
    for df in (good.limit(0), good.limit(0).select("job_id")):
        results = quality.job_checks(df, NOW)
        assert results.where("name = 'not_empty' AND NOT passed AND severity = 'CRITICAL'").count() == 1
        with pytest.raises(RuntimeError, match="CRITICAL"):
            quality.assert_no_critical_failures(results)


def test_absent_required_column_is_critical(good):
    failed = quality.job_checks(good.drop("job_id"), NOW).where("NOT passed AND severity = 'CRITICAL'")
    assert [r.name for r in failed.collect()] == ["required_fields_not_null"]


def test_warnings(good):
    bad = good.withColumn("duration_seconds", F.lit(200000.0)).withColumn("cpu_used_cores", F.lit(-1.0)).withColumn(
        "status", F.lit("FAILURE")).withColumn("job_id", F.lit("same")).withColumn("memory_used_gb", F.lit(None).cast("double"))
    failed = {r["name"] for r in quality.job_checks(bad, "2024-06-01").where("NOT passed").collect()}
    assert failed == {"no_duplicate_job_ids", "timestamp_range", "duration_plausible", "status_distribution", "resource_value_bounds",
                      "null_rate_per_column"}


def test_null_ids_count_as_one_value(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), (None,)], "job_id string")
    r = quality.job_checks(df, NOW).where("name = 'no_duplicate_job_ids'").first()
    assert json.loads(r.detail) == {"duplicate_count": 2}


# ---------------------------------------------------------------- impact and baselines

def test_unknown_event_types_take_the_general_path(spark):
    d = datetime(2024, 1, 1)
    j = spark.createDataFrame([("j", d, d.replace(hour=1), d.date())], "job_id string, started_at timestamp, completed_at timestamp, execution_date date")
    e = spark.createDataFrame([("1", d, d.date(), "QUOTA_THROTTLE", "LOW"), ("2", d, d.date(), "DISK_FULL", "CRITICAL"),
                               ("3", d.replace(hour=2), d.date(), "DISK_FULL", "LOW")],
                              "event_id string, event_timestamp timestamp, event_date date, event_type string, severity string")
    r = workloads.infra_impact(j, e).first()
    assert (r.overlapping_infra_events, r.critical_infra_events, r.quota_throttle_events, r.impacting_event_types) == (2, 1, 1, "DISK_FULL, QUOTA_THROTTLE")


def test_single_day_equals_all_days(spark):
    from opsloom.sources.adapters import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    day = "2024-01-20"
    one = workloads.extract_jobs(t.job_metadata, t.resource_allocation_logs, t.infrastructure_events, "2024-02-01 00:00:00", day)
    every = workloads.extract_jobs(t.job_metadata, t.resource_allocation_logs, t.infrastructure_events, "2024-02-01 00:00:00").where(F.col("execution_date") == day)
    a, b = sorted(one.collect(), key=lambda r: r.job_id), sorted(every.select(*one.columns).collect(), key=lambda r: r.job_id)
    assert len(a) == len(b) > 10
    for x, y in zip(a, b):
        for c in one.columns:
            if isinstance(x[c], float):
                assert math.isclose(x[c], y[c], rel_tol=1e-9), c
            else:
                assert x[c] == y[c], c


def test_daily_and_all_days_baselines_agree_on_large_means(spark):
    rows = [("fine_tuning", "SUCCESS", 0, f"2023-11-{d:02d}", 1_000_000.0 + i % 2) for d in range(1, 11) for i in range(300)]
    df = spark.createDataFrame(rows, "workload_type string, status string, retry_attempt int, execution_date string, duration_seconds double")
    df = df.withColumn("execution_date", F.to_date("execution_date"))
    one = baseline.workload_baseline(df, "2023-11-10").first()
    every = baseline.workload_baseline_by_day(df).where("execution_date = DATE '2023-11-10'").first()
    assert one.baseline_stddev_duration_s == pytest.approx(0.5) and every.baseline_stddev_duration_s == pytest.approx(0.5)
    assert every.baseline_mean_duration_s == pytest.approx(one.baseline_mean_duration_s)


def test_distinct_counts_expand_no_rows(good):
    plan = quality.job_checks(good, NOW)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_date_format_of_text_dates(spark):
    from opsloom.operators.expectations import evaluate
    df = spark.createDataFrame([("2023-11-05",), ("05.11.2023",), (None,), ("2023-11-07",)], "day string")
    r = evaluate(df, [{"kind": "date_format", "column": "day", "format": "yyyy-MM-dd", "mostly": 0.6}]).first()
    assert r.observed == pytest.approx(2 / 3) and r.passed
