"""Sinks and streams."""
import json

import pytest
from pyspark.sql import functions as F

from opsloom.sources import sinks, tables
from opsloom.streaming import ingest


def days(spark, values):
    return spark.createDataFrame(values, "day string, id string, n int").withColumn("day", F.col("day").cast("date"))


def rows(df):
    return sorted((str(r.day), r.id, r.n) for r in df.collect())


def test_replacing_partitions_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(days(spark, [("2024-01-01", "a", 1), ("2024-01-02", "b", 1), ("2024-01-02", "c", 1)]), path, "day", ["id"])
    sinks.replace_partitions(days(spark, [("2024-01-02", "b", 2), ("2024-01-03", "d", 2)]), path, "day", "id")
    assert rows(spark.read.parquet(path)) == [("2024-01-01", "a", 1), ("2024-01-02", "b", 2), ("2024-01-03", "d", 2)]


def test_repeated_keys_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unique"):
        sinks.replace_partitions(days(spark, [("2024-01-02", "b", 2), ("2024-01-02", "b", 3)]), str(tmp_path / "t"), "day", "id")


def test_partition_filter_prunes_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(days(spark, [(f"2024-01-0{i}", "a", i) for i in range(1, 8)]), path, "day")
    kept = tables.retained(spark.read.parquet(path), "day", "2024-01-07", 2)
    assert kept.count() == 3
    assert "PartitionFilters: [isnotnull(day" in kept._jdf.queryExecution().executedPlan().toString()


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_folder(spark, str(tmp_path))


def test_nan_reads_as_null(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(str(tmp_path / "n"))
    assert tables.read_table(spark, str(tmp_path / "n"), nan_as_null=True).where("x IS NULL").count() == 1


def test_schema_fills_absent_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "n"))
    assert tables.read_table(spark, str(tmp_path / "n"), "id long, extra string").where("extra IS NULL").count() == 2


def message(i, **changes):
    base = {"event_id": f"e{i}", "cluster_name": "c", "environment": "prod", "event_type": "NODE_HEALTH", "node_count": 4,
            "healthy_nodes": 2, "event_ts": f"2024-01-01T{i % 24:02d}:00:00Z"}
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not None})


LINES = [message(1), message(2, event_id=""), message(3, event_ts=None), "{broken", message(4, cluster_name=None), message(1),
         message(5, event_ts="not a time"), message(6, unknown_field=1), "[]", ""]


def test_reasons(spark):
    raw = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = {r.event_id or r.message: r.reason for r in ingest.parse_messages(raw).collect()}
    assert got["e1"] is None and got["e6"] is None
    assert got["e4"] == "required field missing" and got["e3"] == "no id or time"
    assert ingest.valid_messages(raw).count() == 3 and ingest.rejected_messages(raw).count() == 7


def test_restart_continues_and_repeats_are_dropped(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(source)
    ingest.ingest(spark, source, sink, state, late="2 days").awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == ["e1", "e6"]
    spark.createDataFrame([(message(6),), (message(7),)], "value string").coalesce(1).write.mode("append").text(source)
    ingest.ingest(spark, source, sink, state, late="2 days").awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == ["e1", "e6", "e7"]


def test_stream_scores_close_hours_behind_the_watermark(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    lines = [(message(i),) for i in (1, 2, 3, 5)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(source)
    events = ingest.valid_messages(ingest.message_stream(spark, source))
    ingest.append_to(ingest.hourly_scores(events, "30 minutes"), sink, state).awaitTermination()
    hours = [r.event_hour.hour for r in spark.read.parquet(sink).orderBy("event_hour").collect()]
    assert hours == [1, 2, 3]


def test_filters_on_floats_reach_the_scan(spark):
    from opsloom.sources import tables
    plan = tables.read_table(spark, "/root/testdata/sf0.001/events.parquet").where("value > 400")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,400.0)" in plan


def test_expired_partitions_are_removed(spark, tmp_path):
    from opsloom.sources import sinks
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2023-11-01"), (2, "2023-11-05"), (3, None)], "id int, day string").selectExpr("id", "CAST(day AS DATE) AS day")
    sinks.write_table(df, path, "day")
    assert sinks.expire_partitions(spark, path, "day", "2023-11-06", 3) == ["day=2023-11-01"]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3]


def test_unknown_columns_of_a_known_table(spark, tmp_path):
    import pytest
    from opsloom.sources import sinks
    with pytest.raises(ValueError, match="cost_events lacks"):
        sinks.write_known(spark.range(1), "cost_events", str(tmp_path / "t"))


def test_late_messages_are_kept_apart_and_batches_repeat_safely(spark, tmp_path):
    import json
    from opsloom.streaming import ingest
    from opsloom.streaming.ingest import REQUIRED

    def message(i, hour):
        return json.dumps({c: f"{c}" for c in REQUIRED} | {"event_id": i, "event_ts": f"2023-11-05T{hour}:00:00Z"} | {
            c: 1 for c in REQUIRED if c in ("readiness_score", "node_count", "healthy_nodes", "desired_tasks", "running_tasks")})

    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    runs = [[message("a", "12"), message("b", "14"), "broken"], [message("c", "10"), message("e", "15"), message("b", "14")], [message("f", "15")]]
    for lines in runs:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(source)
        ingest.ingest(spark, source, sink, state).awaitTermination()
    ids = lambda path: sorted(r.event_id for r in spark.read.parquet(path).collect())
    assert ids(sink) == ["a", "b", "e", "f"] and ids(sink + "_late") == ["c"]
    assert [r.message for r in spark.read.parquet(sink + "_rejected").collect()] == ["broken"]


def test_ingest_remembers_ids_in_state_and_not_in_the_sink(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.createDataFrame([(message(1),), (message(2),), ("broken",), ("broken",)], "value string").coalesce(1).write.text(source)
    ingest.ingest(spark, source, sink, state).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert spark.read.parquet(sink + "_rejected").count() == 2
    for path in (sink, sink + "_late", sink + "_rejected"):
        spark.read.parquet(path + "/batch=0").limit(0).write.mode("overwrite").parquet(path + "/batch=0")
    spark.createDataFrame([(message(1),), (message(2),), (message(3),)], "value string").coalesce(1).write.mode("append").text(source)
    ingest.ingest(spark, source, sink, state).awaitTermination()
    assert [r.event_id for r in spark.read.parquet(sink).collect()] == ["e3"]
    assert spark.read.parquet(sink + "_late").count() == spark.read.parquet(sink + "_rejected").count() == 0


def test_ingest_state_expires_and_a_batch_can_run_again(spark, tmp_path):
    import os
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    held = []
    for i in (1, 2, 3, 4):
        spark.createDataFrame([(message(i),)], "value string").coalesce(1).write.mode("append").text(source)
        query = ingest.ingest(spark, source, sink, state, remember="0 seconds")
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 2
    kept = sorted(r.event_id for r in spark.read.parquet(sink).collect())
    last = max(int(x) for x in os.listdir(state + "/commits") if x.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{state}/commits/{name}")
    ingest.ingest(spark, source, sink, state, remember="0 seconds").awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == kept == ["e1", "e2", "e3", "e4"]
