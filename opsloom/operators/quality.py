"""Data quality: all checks of a table come out of one aggregation."""
from pyspark.sql import Column, DataFrame, functions as F

from opsloom.operators.cleansing import as_utc
from opsloom.operators.distinct import distinct_counts
from opsloom.params import EXPECTED_WORKLOADS, JOB_IDENTITY, RESOURCE_BOUNDS

CRITICAL, WARNING, INFO = "CRITICAL", "WARNING", "INFO"
MAX_NULL_RATE = 0.3
MAX_FAILURE_RATE = 0.5
MAX_AGE_DAYS = 90
MAX_DURATION_SECONDS = 172_800


def combined(*parts: DataFrame) -> DataFrame:
    """One-row results as one row with all their columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns]) if len(parts) > 1 else out


class _Battery:
    """Collects aggregates and the checks that read them."""

    def __init__(self):
        self.aggregates, self.checks, self.distinct = {}, [], {}

    def measure(self, name: str, column: Column) -> Column:
        self.aggregates[name] = column.alias(name)
        return F.col(name)

    def add(self, name, passed, severity, message, **detail):
        as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
        self.checks.append(F.struct(
            F.lit(name).alias("name"), as_col(passed).alias("passed"), as_col(severity).alias("severity"),
            as_col(message).alias("message"),
            F.to_json(F.struct(*[c.alias(k) for k, c in detail.items()]) if detail
                      else F.struct(F.lit(None).cast("string").alias("none"))).alias("detail"),
        ))

    def skip(self, name, why):
        self.add(name, True, INFO, why)

    def run(self, df: DataFrame) -> DataFrame:
        parts = [distinct_counts(df, self.distinct)] if self.distinct else []
        return combined(df.agg(*self.aggregates.values()), *parts).select(F.inline(F.array(*self.checks)))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _listed(pairs) -> Column:
    """'a: 1, b: 2' of the (name, count) pairs with a count above zero."""
    return F.array_join(F.filter(F.array(*[
        F.when(c > 0, _text(f"{n}: ", c)) for n, c in pairs]), lambda x: x.isNotNull()), ", ")


def job_checks(df: DataFrame, as_of, max_null_rate=MAX_NULL_RATE) -> DataFrame:
    """Ten checks of a job table: (name, passed, severity, message, detail)."""
    b, have, now = _Battery(), set(df.columns), F.lit(as_of).cast("timestamp")
    rows = b.measure("rows", F.count(F.lit(1)))
    b.add("not_empty", rows > 0, CRITICAL, F.when(rows > 0, _text(rows, " rows")).otherwise("the table has no rows"))

    if "job_id" in have:
        b.distinct["ids"] = "job_id"
        seen = F.col("ids") + b.measure("null_ids", F.max(F.col("job_id").isNull().cast("int")))
        dup = F.when(rows > 0, rows - seen).otherwise(0)
        b.add("no_duplicate_job_ids", dup == 0, WARNING,
              F.when(dup == 0, "every job_id is unique").otherwise(_text(dup, " rows repeat a job_id")), duplicate_count=dup)
    else:
        b.skip("no_duplicate_job_ids", "job_id column absent")

    absent = [c for c in JOB_IDENTITY if c not in have]
    nulls = [(c, b.measure(f"null_{c}", F.count_if(F.col(c).isNull()))) for c in JOB_IDENTITY if c in have]
    if absent:
        b.add("required_fields_not_null", False, CRITICAL, f"columns not found: {', '.join(absent)}")
    else:
        total = sum((c for _, c in nulls), F.lit(0))
        b.add("required_fields_not_null", total == 0, CRITICAL,
              F.when(total == 0, "no required field is null").otherwise(_text("nulls by required field: ", _listed(nulls))),
              **dict(nulls))

    if "submitted_at" in have:
        ts = as_utc(df, "submitted_at")
        lo, hi = b.measure("ts_min", F.min(ts)), b.measure("ts_max", F.max(ts))
        age_days = F.floor((F.unix_micros(now) - F.unix_micros(lo)) / 86_400_000_000.0)
        stale, future = F.coalesce(age_days > MAX_AGE_DAYS, F.lit(False)), F.coalesce(hi > now, F.lit(False))
        b.add("timestamp_range", ~(stale | future), WARNING,
              _text("min=", F.coalesce(lo.cast("string"), F.lit("NULL")), ", max=", F.coalesce(hi.cast("string"), F.lit("NULL")),
                    F.when(stale, " STALE").otherwise(""), F.when(future, " FUTURE").otherwise("")), stale=stale, future=future)
    else:
        b.skip("timestamp_range", "submitted_at absent")

    if "duration_seconds" in have:
        d = F.col("duration_seconds")
        known = b.measure("durations", F.count(d))
        extreme = b.measure("extreme", F.count_if(d > MAX_DURATION_SECONDS))
        negative = b.measure("negative", F.count_if(d < 0))
        b.add("duration_plausible", (extreme == 0) & (negative == 0), F.when(known == 0, INFO).otherwise(WARNING),
              F.when(known == 0, "durations are all null")
              .otherwise(_text(extreme, " above two days, ", negative, " below zero")),
              extreme_count=extreme, negative_count=negative)
    else:
        b.skip("duration_plausible", "duration_seconds absent")

    if "status" in have:
        failed = b.measure("failed", F.count_if(F.col("status") == "FAILURE"))
        rate = F.try_divide(failed.cast("double"), rows.cast("double"))
        # A mean over no rows is undefined and does not pass.
        b.add("status_distribution", F.coalesce(rate <= MAX_FAILURE_RATE, F.lit(False)), WARNING,
              _text("share of failures ", F.coalesce(F.format_number(rate * 100, 1), F.lit("NULL")), "%"), failure_rate=rate)
    else:
        b.skip("status_distribution", "status absent")

    if "workload_type" in have:
        counts = [(w, b.measure(f"type_{w}", F.count_if(F.col("workload_type") == w))) for w in EXPECTED_WORKLOADS]
        missing = F.filter(F.array(*[F.when(c == 0, F.lit(w)) for w, c in counts]), lambda x: x.isNotNull())
        b.add("workload_type_coverage", F.size(missing) == 0, WARNING,
              F.when(F.size(missing) == 0, "each expected type occurs")
              .otherwise(_text("types that do not occur: ", F.array_join(missing, ", "))), missing=missing)
    else:
        b.skip("workload_type_coverage", "workload_type absent")

    bounded = [(c, b.measure(f"out_{c}", F.count_if((F.col(c) < lo) | (F.col(c) > hi))))
               for c, (lo, hi) in RESOURCE_BOUNDS.items() if c in have]
    bad = sum((c for _, c in bounded), F.lit(0))
    b.add("resource_value_bounds", bad == 0, WARNING,
          F.when(bad == 0, "readings stay within their limits")
          .otherwise(_text("readings beyond their limits: ", _listed(bounded))) if bounded else "readings stay within their limits")

    rates = {c: F.try_divide(b.measure(f"nulls_{i}", F.count_if(F.col(f"`{c}`").isNull())).cast("double"), rows.cast("double"))
             for i, c in enumerate(df.columns)}
    if rates:
        high = F.filter(F.array(*[F.when(r > max_null_rate, F.lit(c)) for c, r in rates.items()]), lambda x: x.isNotNull())
        b.add("null_rate_per_column", F.size(high) == 0, WARNING,
              F.when(F.size(high) == 0, "no column is null too often")
              .otherwise(_text("null too often: ", F.array_join(high, ", "))), columns=high)
    else:
        b.add("null_rate_per_column", True, WARNING, "no column is null too often")

    stamps = [c for c in ("submitted_at", "started_at", "completed_at") if c in have]
    ahead = sum((b.measure(f"ahead_{c}", F.count_if(as_utc(df, c) > now)) for c in stamps), F.lit(0))
    b.add("no_future_timestamps", ahead == 0, WARNING,
          F.when(ahead == 0, "nothing lies ahead of the check").otherwise(_text(ahead, " timestamps lie ahead of the check")), future_count=ahead)
    return b.run(df)


def critical_failures(results: DataFrame) -> DataFrame:
    """(name, message) of the CRITICAL checks that failed."""
    return results.where(~F.col("passed") & (F.col("severity") == CRITICAL)).select("name", "message")


def assert_no_critical_failures(results: DataFrame) -> None:
    """Raise when a CRITICAL check failed. The results are one row per check."""
    failed = critical_failures(results).collect()
    if failed:
        text = "; ".join(f"{r['name']}: {r['message']}" for r in failed)
        raise RuntimeError(f"stopped by CRITICAL checks: {text}")


def quality_report(results: DataFrame, date, as_of) -> DataFrame:
    """The check results as one nested row."""
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.sort_array(F.collect_list(F.struct("name", "passed", "severity", "message"))).alias("checks"),
    ).select(F.lit(date).alias("date"), F.lit(as_of).cast("timestamp").alias("checked_at"), "*")


def status_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def missing_values(df: DataFrame, column: str, expected) -> DataFrame:
    """Expected values that do not occur, one row each."""
    found = F.array(*[F.when(F.max(F.col(column) == v), F.lit(v)) for v in expected])
    every = F.array(*[F.lit(v) for v in expected])
    return df.agg(found.alias("_f")).select(F.explode(F.array_except(every, "_f")).alias(column))


# ---------------------------------------------------------------- tests that return failing rows

def failing_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    out = F.lit(False)
    if low is not None:
        out = out | (F.col(column) < low)
    if high is not None:
        out = out | (F.col(column) > high)
    return df.where(out)


def failing_values(df: DataFrame, column: str, accepted) -> DataFrame:
    """Values outside the accepted set with their counts."""
    return df.where(~F.col(column).isin(accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def failing_unique(df: DataFrame, *columns) -> DataFrame:
    """Non-null keys that occur more than once."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return df.where(known).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def failure_counts(tests: dict[str, DataFrame]) -> DataFrame:
    """(test, failures) of named failing-row tables."""
    out = None
    for name, df in tests.items():
        one = df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures")
        out = one if out is None else out.unionByName(one)
    return out


def scores_out_of_bounds(scores: DataFrame) -> DataFrame:
    return failing_range(scores, "fleet_health_score", 0, 100).select(
        "cluster_name", "environment", "event_hour", "fleet_health_score")


def unresolved_critical(anomalies: DataFrame, as_of, detected="detected_at", severity="CRITICAL", hours=4) -> DataFrame:
    """Critical anomalies that have stayed open for hours."""
    limit = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return anomalies.where(
        (F.col("anomaly_severity") == severity) & (F.col(detected) < limit) & F.col("resolved_at").isNull())


def future_events(df: DataFrame, ts: str, as_of) -> DataFrame:
    return df.where(F.col(ts) > F.lit(as_of).cast("timestamp"))


def double_counted_snapshots(slo: DataFrame) -> DataFrame:
    return (
        slo.groupBy("service_name", "slo_name", "snapshot_timestamp").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
    )
