"""Interval operators against brute force, with hot moments, ties and odd bounds."""
import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsloom.operators.interval import covered_points, interval_counts, interval_sums

BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    jobs, events = [], []
    for i in range(150):
        start = BASE + timedelta(seconds=0 if i % 3 == 0 else rnd.randrange(4000), microseconds=rnd.choice([0, 1, 999999]))
        end = start + timedelta(seconds=rnd.choice([0, 1, 10, 600, 5000]), microseconds=rnd.randrange(3))
        if i % 20 == 7:
            end = None
        if i % 20 == 9:
            end = start - timedelta(seconds=200)
        jobs.append((f"j{i}", start, end, date(2024, 1, 1 + i % 2)))
    for i in range(400):
        at = BASE + timedelta(seconds=5 if i % 3 == 0 else rnd.randrange(6000), microseconds=rnd.choice([0, 1, 2]))
        events.append((f"e{i}", at if i % 50 else None, rnd.choice(["a", "b", None]), date(2024, 1, 1 + i % 2)))
    j = spark.createDataFrame(jobs, "id string, s timestamp, e timestamp, d date").repartition(4)
    p = spark.createDataFrame(events, "eid string, at timestamp, g string, day date").repartition(4)
    return j, p, jobs, events


def pairs(jobs, events, before, after, same_day=False):
    for j in jobs:
        if j[2] is None:
            continue
        lo, hi = j[1] - timedelta(seconds=before), j[2] + timedelta(seconds=after)
        for e in events:
            if e[1] is not None and lo <= e[1] <= hi and (not same_day or j[3] == e[3]):
                yield j, e


@pytest.mark.parametrize("tolerance", [0, 30, 300])
@pytest.mark.parametrize("same_day", [False, True])
@pytest.mark.parametrize("top", [1, 14])
def test_counts(data, tolerance, same_day, top):
    j, p, jobs, events = data
    match = [("d", "day")] if same_day else []
    got = interval_counts(j, p, ["id"], "s", "e", "at", ["g"], tolerance, tolerance, match, top)
    want = Counter((a[0], b[2]) for a, b in pairs(jobs, events, tolerance, tolerance, same_day))
    assert {(r.id, r.g): r.n for r in got.collect()} == dict(want)


def test_sums(data):
    j, p, jobs, events = data
    got = interval_sums(j, p, ["id"], "s", "e", "at", {"n": F.lit(1), "a": F.coalesce(F.col("g") == "a", F.lit(False)).cast("int")}, 30, 0)
    n, a = Counter(), Counter()
    for x, y in pairs(jobs, events, 30, 0):
        n[x[0]] += 1
        a[x[0]] += y[2] == "a"
    for r in got.collect():
        assert (r.n, r.a) == (n[r.id], a[r.id])
    assert set(n) <= {r.id for r in got.collect()}


@pytest.mark.parametrize("same_day", [False, True])
def test_covered(data, same_day):
    j, p, jobs, events = data
    some = j.where("id IN ('j1', 'j2', 'j4', 'j5', 'j6')")
    picked = [x for x in jobs if x[0] in ("j1", "j2", "j4", "j5", "j6")]
    got = covered_points(p, some, "s", "e", "at", match=[("d", "day")] if same_day else [])
    assert {r.eid for r in got.collect()} == {b[0] for _, b in pairs(picked, events, 0, 0, same_day)}


def test_no_interval_or_no_point(data):
    j, p, _, _ = data
    none = j.where("id = 'absent'")
    assert interval_counts(none, p, ["id"], "s", "e", "at", ["g"]).count() == 0
    assert covered_points(p.where("eid = 'absent'"), j, "s", "e", "at").count() == 0


def shuffled_rows(df):
    """Rows written to shuffles by a query that has run, each exchange once."""
    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "ReusedExchange":
            return 0
        rows = node.metrics().get("shuffleRecordsWritten")
        below = node.children()
        return (rows.get().value() if rows.isDefined() else 0) + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_counts_are_made_where_the_points_are(spark):
    """Only intervals that cross ranges have rows of their result shuffled."""
    jobs = spark.sql("SELECT id, timestamp_seconds(id * 60) AS s, timestamp_seconds(id * 60 + 3000) AS e, DATE '2024-01-01' AS d FROM range(2000)")
    events = spark.sql("SELECT timestamp_seconds(id * 24) AS at, id % 20 AS g, DATE '2024-01-01' AS day FROM range(5000)")
    for match in ([], [("d", "day")]):
        got = interval_counts(jobs, events, ["id"], "s", "e", "at", ["g"], match=match)
        rows = got.collect()
        assert len(rows) > 39_000 and sum(r.n for r in rows) > 240_000
        assert shuffled_rows(got) < len(rows)


def test_long_intervals_and_keys_of_several_days(spark):
    """Intervals over many ranges, groups of NaN and null, and keys with an interval on each of two days."""
    rnd, nan = random.Random(8), float("nan")
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    jobs = [(f"j{i // 2}", BASE + timedelta(seconds=(a := rnd.randrange(3000))), BASE + timedelta(seconds=a + rnd.choice([1, 40, 9000])), days[i % 2]) for i in range(120)]
    events = [(BASE + timedelta(seconds=rnd.randrange(9000)), rnd.choice([1.5, nan, None]), rnd.choice(days)) for _ in range(900)]
    j = spark.createDataFrame(jobs, "id string, s timestamp, e timestamp, d date").repartition(3)
    p = spark.createDataFrame(events, "at timestamp, g double, day date").repartition(3)
    want = Counter((a[0], str(g)) for a in jobs for t, g, day in events if a[1] <= t <= a[2] and a[3] == day)
    got = interval_counts(j, p, ["id"], "s", "e", "at", ["g"], match=[("d", "day")]).collect()
    assert {(r.id, str(r.g)): r.n for r in got} == dict(want) and len(got) == len(want)


def test_summary_counts_jobs_without_shuffling_their_pairs(spark):
    from opsloom.plans.workloads import overlap_summary
    runs = [(None if i % 50 == 0 else f"j{i - i % 10 if i % 10 == 3 else i}", date(2024, 1, 1), 2 + i / 1000,
             BASE + timedelta(seconds=30 * i), BASE + timedelta(seconds=30 * i + 2500)) for i in range(600)]
    events = [(f"e{i}", BASE + timedelta(seconds=5 * i), i % 40) for i in range(4000)]
    jobs = spark.createDataFrame(runs, "job_id string, execution_date date, duration_z_score double, started_at timestamp, completed_at timestamp")
    points = spark.createDataFrame(events, "event_id string, event_timestamp timestamp, g long")
    out = overlap_summary(jobs, points, ["g"], 0)
    got = {r.g: (r.affected_anomalous_jobs, round(r.avg_anomaly_zscore, 9), r.event_count) for r in out.collect()}
    want, pairs = {}, 0
    for g in range(40):
        hits = [(r, e) for r in runs for e in events[g::40] if r[3] <= e[1] <= r[4]]
        pairs += len({r for r, _ in hits})
        want[g] = (len({r[0] for r, _ in hits if r[0]}), round(sum(r[2] for r, _ in hits) / len(hits), 9), len({e[0] for _, e in hits}))
    assert got == want
    assert shuffled_rows(out) < 2 * pairs  # points and bounds, each a few times
