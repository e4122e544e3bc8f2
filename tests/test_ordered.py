"""Distributed order-dependent operators against single-machine answers."""
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from opsloom.operators import ordered, series


@pytest.fixture(scope="module")
def hot(spark):
    """Four series; one holds most of the rows; values repeat and some are NULL."""
    rnd = random.Random(7)
    rows = []
    for key, n in (("hot", 700), ("b", 60), ("c", 1), ("d", 30)):
        for i in range(n):
            v = None if rnd.random() < 0.15 else float(rnd.choice([1, 2, 2, 2, 5, 9, 30]) + rnd.random() * (i % 3))
            rows.append((key, i * 2, v))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k string, o int, v double").repartition(5), rows


def by_key(rows):
    out = {}
    for k, o, v in sorted(rows):
        out.setdefault(k, []).append((o, v))
    return out


def test_positions(hot):
    df, rows = hot
    got = {(r.k, r.o): r.pos for r in ordered.positions(df, ["k"], ["o"]).collect()}
    want = {(k, o): i for k, s in by_key(rows).items() for i, (o, _) in enumerate(s)}
    assert got == want


def test_positions_without_keys(hot):
    df, _ = hot
    flat = df.select((F.col("o") + F.when(F.col("k") == "hot", 0).otherwise(F.hash("k") % 100 * 10_000 + 5_000_000)).alias("x"))
    got = [r.pos for r in ordered.positions(flat.distinct(), [], ["x"]).orderBy("x").collect()]
    assert got == list(range(len(got)))


def test_running_totals_with_ties_and_null_keys(spark):
    rows = [(None if i % 3 == 0 else "a", i // 10, i, 1) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, tie int, n int").repartition(6)
    got = ordered.running_totals(df, ["k"], ["t", "tie"], ["n"], whole=["n"])
    w = Window.partitionBy("k").orderBy("t", "tie").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("n", F.sum("n").over(w)).withColumn("total_n", F.when(F.col("k").isNull(), 67).otherwise(133))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_exact_percentiles(hot):
    df, rows = hot
    qs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in ordered.exact_percentiles(df, ["k"], "v", qs).collect()}
    for k, s in by_key(rows).items():
        values = [v for _, v in s if v is not None]
        if not values:
            assert k not in got
            continue
        assert got[k].n_values == len(values)
        for name, q in qs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, q))


def test_percentiles_by_selection(spark):
    """Skewed, tied, negative, huge and infinite values; every bin is narrowed to a few rows or one value."""
    rnd = np.random.default_rng(4)
    series = {
        "skewed": np.exp(rnd.normal(0, 12, 3000)), "tied": np.repeat([-1.5, 2.0, 2.0000001, 7.0], [10, 2000, 500, 3]), "uniform": rnd.random(2500) - 0.5,
        "huge": np.concatenate([rnd.random(900) * 1e308, -rnd.random(900) * 1e308]), "infinite": np.concatenate([[-np.inf, np.inf], rnd.random(700)]),
        "near": 1e9 + rnd.integers(0, 5, 2000) * 1e-7, "one": np.array([3.25]), None: rnd.normal(size=800),
    }
    df = spark.createDataFrame([(k, float(v)) for k, vs in series.items() for v in vs], "k string, v double").repartition(5)
    qs = {"p1": 0.01, "p50": 0.5, "p90": 0.9, "p99": 0.99}
    got = {r.k: r for r in ordered.exact_percentiles(df, ["k"], "v", qs, most=20).collect()}
    assert set(got) == set(series)
    for k, values in series.items():
        values = np.sort(values)
        assert got[k].n_values == len(values)
        for name, q in qs.items():
            at = q * (len(values) - 1)
            a, b = float(values[int(np.floor(at))]), float(values[int(np.ceil(at))])
            assert got[k][name] == pytest.approx(a + (b - a) * (at - np.floor(at)), rel=1e-15), (k, name)


def test_weighted_percentiles(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 10.0, 1), ("a", 2.0, 2)], "k string, v double, w int")
    r = ordered.exact_percentiles(df, ["k"], "v", {"m": 0.5, "q": 0.9}, weight="w").first()
    assert (r.n_values, r.m, r.q) == (6, 1.5, pytest.approx(np.quantile([1, 1, 1, 2, 2, 10], 0.9)))


def test_rolling_stats_across_blocks(hot):
    df, _ = hot
    placed = ordered.positions(df, ["k"], ["o"])
    got = ordered.rolling_stats(placed, ["k"], "v", rows=5, size=16)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(-5, -1)
    want = {(r.k, r.o): r.m for r in df.withColumn("m", F.avg("v").over(w)).collect()}
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r.rolling_mean == pytest.approx(want[(r.k, r.o)])


@pytest.mark.parametrize("size", [3, 16, 1000])
def test_exponential_mean_across_blocks(hot, size):
    df, rows = hot
    placed = ordered.positions(df, ["k"], ["o"])
    got = {(r.k, r.o): r.e for r in ordered.exponential_mean(placed, ["k"], "v", 7, "e", size=size).collect()}
    assert len(got) == len(rows)
    for k, s in by_key(rows).items():
        want = pd.Series([v for _, v in s], dtype=float).ewm(span=7, adjust=False).mean()
        for (o, _), y in zip(s, want):
            assert got[(k, o)] == pytest.approx(y, nan_ok=True) or (got[(k, o)] is None and np.isnan(y))


def test_exponential_mean_over_long_gaps(spark):
    values = [1.0] + [None] * 40 + [5.0, None, 7.0] + [None] * 20 + [2.0]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "k string, pos long, v double")
    got = [r.e for r in ordered.exponential_mean(df, ["k"], "v", 7, "e", size=4).orderBy("pos").collect()]
    want = pd.Series(values, dtype=float).ewm(span=7, adjust=False).mean()
    assert got == pytest.approx(list(want))


# ---------------------------------------------------------------- trends

def one_series(spark, values):
    return spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "k string, o int, v double")


@pytest.mark.parametrize("values, direction", [
    ([float(i) for i in range(40)], "improving"),
    ([float(40 - i) for i in range(40)], "degrading"),
    ([95.0] * 40, "stable"),
])
def test_trend_direction(spark, values, direction):
    r = series.trend(one_series(spark, values), ["k"], "o", "v").first()
    assert r.direction == direction
    assert r.slope == pytest.approx(np.polyfit(range(40), values, 1)[0], abs=1e-6)


def test_change_over_seven_rows(spark):
    r = series.trend(one_series(spark, [80.0] + [85.0] * 8 + [100.0]), ["k"], "o", "v").first()
    assert r.pct_change_7d == pytest.approx(17.65) and r.pct_change_30d is None


def test_no_change_for_short_series_or_zero(spark):
    assert series.trend(one_series(spark, [95.0, 96.0, 94.0]), ["k"], "o", "v").first().pct_change_7d is None
    assert series.trend(one_series(spark, [0.0] * 8 + [1.0]), ["k"], "o", "v").first().pct_change_7d is None


def test_slope_skips_missing_values(spark):
    values = [1.0, None, 3.0, float("nan"), 5.5]
    r = series.trend(one_series(spark, values), ["k"], "o", "v").first()
    assert r.n_rows == 5 and r.slope == pytest.approx(np.polyfit([0, 2, 4], [1, 3, 5.5], 1)[0], abs=1e-6)


def test_rolling_mean_has_one_value_per_row(spark):
    out = series.moving_averages(one_series(spark, [95.0] * 20), ["k"], "o", "v").collect()
    assert len(out) == 20 and all(r.rolling_mean == 95.0 and r.ewm_mean == pytest.approx(95.0) for r in out)


# ---------------------------------------------------------------- series anomalies

def test_short_series_are_not_scored(spark):
    df = one_series(spark, [1.0] * 8 + [99.0])
    assert series.series_anomalies(df, ["k"], "o", "v").count() == 0
    assert series.rolling_anomalies(df, ["k"], "o", "v", window=4, min_rows=10).count() == 0


def test_constant_series_has_zero_z_but_a_fence(spark):
    df = one_series(spark, [5.0] * 30)
    assert series.series_anomalies(df, ["k"], "o", "v").count() == 0
    r = series.rolling_anomalies(one_series(spark, [5.0] * 30 + [6.0]), ["k"], "o", "v").first()
    assert (r.pos, r.z_score, r.is_zscore, r.is_iqr, r.severity) == (30, 0.0, False, True, "low")


def test_spike_is_critical(spark):
    values = [float(i % 4) for i in range(60)] + [100.0]
    r = series.series_anomalies(one_series(spark, values), ["k"], "o", "v").first()
    assert r.pos == 60 and r.severity == "critical" and r.is_zscore and r.is_iqr
    assert r.rolling_mean == pytest.approx(np.mean(values), abs=1e-4)


def test_exponential_mean_over_a_gap_of_any_length(spark):
    import pandas as pd
    from opsloom.operators.ordered import exponential_mean
    n, span = 260_000, 400_000
    df = spark.range(n).select(F.lit("s").alias("k"), F.col("id").alias("pos"), F.when(F.col("id") == 0, 1.0).when(F.col("id") == n - 1, 0.0).alias("v"))
    got = exponential_mean(df, ["k"], "v", span).where(F.col("pos") == n - 1).first().ewm_mean
    x = pd.Series([1.0] + [None] * (n - 2) + [0.0], dtype="float64")
    assert got == pytest.approx(x.ewm(span=span, adjust=False).mean().iloc[-1], rel=1e-9)
