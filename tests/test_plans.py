"""Physical plans: pruning, pushdown, checked broadcasts."""
import re

import pytest
from pyspark.sql import functions as F

from opsloom.operators import staging
from opsloom.operators.lookup import lookup_join
from opsloom.plans import costs
from opsloom.sources import sinks
from opsloom.sources.adapters import EVENTS_AS_OF, Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw tables on disk, events partitioned by day."""
    t, root = Tables(spark, FOLDER), tmp_path_factory.mktemp("raw")
    sinks.write_table(t.fleet_events, f"{root}/fleet_events", "event_date")
    sinks.write_overwrite(t.cost_events, f"{root}/cost_events")
    spark.conf.set("spark.sql.maxMetadataValueLength", "2000")
    yield root
    spark.conf.unset("spark.sql.maxMetadataValueLength")


def test_staging_prunes_partitions_and_pushes_filters(spark, stored):
    text = plan(staging.fleet_events(spark.read.parquet(f"{stored}/fleet_events"), EVENTS_AS_OF, 5))
    assert "PartitionFilters: [isnotnull(event_date" in text, text
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text, re.S).group(1)
    assert "IsNotNull(event_id)" in pushed and "In(event_type" in pushed


def test_marts_read_only_their_columns(spark, stored):
    text = plan(costs.daily_costs(staging.cost_events(spark.read.parquet(f"{stored}/cost_events"))))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "cost_event_id", "team", "service_name", "environment", "cost_category", "cloud_provider", "resource_id", "cost_usd",
        "cost_date"}


def test_lookup_broadcasts_only_below_the_bound(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    small = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inside, beyond = lookup_join(left, small, ["k"]), lookup_join(left, small, ["k"], max_rows=3)
        assert "BroadcastHashJoin" in plan(inside) and "SortMergeJoin" in plan(beyond)
        assert inside.count() == beyond.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_counts_reduce_in_tasks_and_scan_once(spark, stored):
    df = costs.daily_costs(staging.cost_events(spark.read.parquet(f"{stored}/cost_events")))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1 and "Expand" not in text and text.count("Exchange") == 2
    values = text[text.rindex("Exchange"):]  # below the exchange of values: the partial aggregation of a task
    assert "partial_sum" in values and "Generate explode" in values


def test_bytes_bound_a_broadcast(spark, monkeypatch):
    from opsloom.operators import lookup
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 10)
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(lookup_join(left, left.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_exchange_for_a_line_of_time(spark):
    """Counts and covered points come from one exchange of the line; nothing is written in between."""
    from opsloom.operators.interval import Overlaps
    jobs = spark.sql("SELECT CAST(id AS STRING) AS id, timestamp_seconds(id * 60) AS s, timestamp_seconds(id * 60 + 300) AS e FROM range(2000)")
    events = spark.sql("SELECT id AS eid, timestamp_seconds(id * 7) AS at, id % 3 AS g FROM range(5000)")
    o = Overlaps(jobs, events, ["id"], "s", "e", "at", ["g"], ids="eid")
    both = o.counts().groupBy("g").agg(F.sum("n").alias("n")).join(o.covered().groupBy("g").agg(F.count_distinct("eid").alias("c")), "g")
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    line = [x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x]
    assert len(line) == 3 and sum("ReusedExchange" in x for x in line) == 2
    assert "ExistingRDD" not in plan


def test_scripts_bind_their_parameters_and_name_what_is_missing(spark):
    import pytest
    from opsloom.plans import scripts
    from opsloom.schemas import JOB_METADATA, RESOURCE_ALLOCATION_LOGS
    tables = {"job_metadata": spark.createDataFrame([], JOB_METADATA), "resource_allocation_logs": spark.createDataFrame([], RESOURCE_ALLOCATION_LOGS)}
    with pytest.raises(ValueError, match="without a value: scan_date"):
        scripts.run_script(spark, "resource_utilisation", tables)
    with pytest.raises(ValueError, match="unknown parameters: day"):
        scripts.run_script(spark, "resource_utilisation", tables, day="2024-01-01")
    with pytest.raises(ValueError, match="missing tables: infrastructure_events"):
        scripts.run_script(spark, "infra_event_correlation", tables, scan_date="2024-01-01")
    assert scripts.run_script(spark, "resource_utilisation", tables, scan_date="2024-01-01").count() == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        scripts.run_script(spark, "resource_utilisation", tables, scan_date="2024-01-01' OR true --").collect()


def test_a_script_of_ones_own_and_its_days(spark):
    from opsloom.plans.scripts import Script, run_script
    days = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS day FROM range(9)")
    own = Script(("days",), [("of_day", "SELECT id FROM days WHERE day = CAST(:day AS DATE)"),
                             ("doubled", lambda view, args: view("of_day").selectExpr(f"id * {args['factor']} AS id")),
                             ("result", "SELECT safe_divide(sum(id), count(*)) AS mean FROM doubled")], {"day": None, "factor": 2})
    assert run_script(spark, own, {"days": days}, day="2024-01-02").first().mean == 8
    assert run_script(spark, own, {"days": days}, day="2024-01-03", factor=1).first().mean == 5


def test_macros_give_null_for_zero_and_null(spark):
    from opsloom.plans.scripts import register_macros
    register_macros(spark)
    row = spark.sql("""SELECT safe_divide(1, 0) AS a, safe_divide(NULL, 2) AS b, safe_divide_or(1, 0, 7) AS c, zscore(3, 1, 0) AS d, zscore(3, 1, 2) AS e,
        rolling_zscore(1, 0, 1e-12) AS f, date_trunc_safe('month', NULL) AS g, CAST(date_trunc_safe('week', TIMESTAMP '2024-01-03 05:00:00') AS STRING) AS h,
        dora_tier(NULL, 0, 0) AS i, dora_tier(1, 0.05, 60) AS j""").first()
    assert tuple(row) == (None, None, 7.0, None, 1.0, None, None, "2023-12-31", "Low", "Elite")


def test_distinct_counts_of_several_columns(spark):
    from opsloom.operators.distinct import distinct_counts
    rows = [("a", "x", 1, 0.0, 2.0), ("a", "x", 2, -0.0, 3.0), ("a", None, 2, None, None), ("b", "y", None, 1.0, 1.0), (None, "x", 1, 1.0, 5.0), ("a", "", 2, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, t string, n long, d double, cost double").withColumn("s", F.struct("t", "n"))
    got = distinct_counts(df, {"texts": "t", "numbers": "n", "doubles": "d", "pairs": "s"}, ["k"], {"cost": F.col("cost"), "lines": F.lit(1).cast("long")})
    assert {r.k: tuple(r)[1:] for r in got.collect()} == {"a": (6.0, 4, 2, 2, 2, 4), "b": (1.0, 1, 1, 0, 1, 1), None: (5.0, 1, 1, 1, 1, 1)}
    assert distinct_counts(df, {"texts": "t", "numbers": "n"}).first() == (3, 2)
    long = spark.createDataFrame([("x" * 64,), ("x" * 64,), ("x" * 65,), ("x" * 63,)], "t string")
    assert distinct_counts(long, {"texts": "t"}).first() == (3,)
    assert distinct_counts(df.limit(0), {"texts": "t"}).first() == (0,) and distinct_counts(df.limit(0), {"texts": "t"}, ["k"]).count() == 0


def test_checksums_deal_rows_in_parts_that_do_not_grow(spark, tmp_path):
    """The larger the table, the more parts it is dealt in, however many rows share a language."""
    from checks.registry import QUERIES
    import checks.catalog  # noqa: F401
    import random
    rnd = random.Random(1)
    rows = [(i, "%0800x" % rnd.getrandbits(3200), "en", "web", 800) for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")

    def parts(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return parts(node.executedPlan())
        if "QueryStage" in name:
            return parts(node.plan())
        own = node.metrics().get("numPartitions") if name == "AQEShuffleRead" else None
        below = node.children()
        return max([own.get().value() if own is not None and own.isDefined() else 0, *[parts(below.apply(i)) for i in range(below.size())]])

    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "64",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for name, want in (("Q15_checksum_ignores_order", (3000, True)), ("Q15_checksum_sees_changes", (3000, True, False))):
            out = QUERIES[name](spark, str(tmp_path))
            assert [tuple(r) for r in out.collect()] == [want]
            assert parts(out._jdf.queryExecution().executedPlan()) > 10
    finally:
        for k in conf:
            spark.conf.unset(k)
