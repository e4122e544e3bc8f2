"""Streaming ingest of JSON messages and hourly scores on the stream."""
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opsloom.operators.staging import fleet_telemetry
from opsloom.plans.fleet import SERIES
from opsloom.schemas import FLEET_TELEMETRY
from opsloom.session import settled

REQUIRED = [f.name for f in FLEET_TELEMETRY if not f.nullable]
_CORRUPT = "_corrupt"


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def parse_messages(raw: DataFrame, schema: T.StructType = FLEET_TELEMETRY, value="value") -> DataFrame:
    """Messages as columns, with `reason` for those to be dropped: not JSON, no event id
    or time, or a required field missing. Works on batches and streams."""
    wide = T.StructType([*_nullable(schema), T.StructField(_CORRUPT, T.StringType())])
    text = F.col(value).cast("string")
    parsed = raw.select(
        text.alias("message"),
        F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}).alias("m"),
    ).select("message", "m.*")
    no_id = F.coalesce(F.col("event_id"), F.lit("")) == ""
    missing = F.lit(False)
    for c in REQUIRED:
        missing = missing | F.col(c).isNull()
    reason = (
        F.when(F.col(_CORRUPT).isNotNull(), "not parsed").when(no_id | F.col("event_ts").isNull(), "no id or time")
        .when(missing, "required field missing")
    )
    return parsed.withColumn("reason", reason).drop(_CORRUPT)


def valid_messages(raw: DataFrame, **kw) -> DataFrame:
    return parse_messages(raw, **kw).where("reason IS NULL").drop("reason", "message")


def rejected_messages(raw: DataFrame, **kw) -> DataFrame:
    return parse_messages(raw, **kw).where("reason IS NOT NULL").select("message", "reason")


def message_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Text lines of the files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of a Kafka topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("failOnDataLoss", "true").load()
    )


def deduplicated(events: DataFrame, late="1 hour", key="event_id", ts="event_ts") -> DataFrame:
    """The first message per key within the watermark, so state stays bounded."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def first_arrivals(parsed: DataFrame, remember="1 day") -> DataFrame:
    """Parsed messages of a stream without repeats of an id that arrive within `remember` of the first; rejected messages all stay.

    State is keyed by id and expires on the time of arrival, which never runs behind the watermark, so the operator drops nothing
    but repeats, however old their event time is."""
    key = F.when(F.col("reason").isNull(), F.col("event_id")).otherwise(F.uuid())
    stamped = parsed.withColumn("_key", key).withColumn("_arrived", F.current_timestamp())
    return deduplicated(stamped, remember, "_key", "_arrived").drop("_key", "_arrived")


def hourly_scores(events: DataFrame, late="1 hour") -> DataFrame:
    """Availability and readiness per cluster, environment and tumbling hour."""
    staged = fleet_telemetry(events)
    if events.isStreaming:
        staged = staged.withWatermark("event_ts", late)
    node, task = F.col("node_health_ratio"), F.col("task_running_ratio")
    return staged.groupBy(F.window("event_ts", "1 hour").alias("w"), *SERIES).agg(
        F.avg((node + task) / 2 * 100).alias("availability_score"),
        F.avg("readiness_score").alias("avg_readiness_score"),
        F.count(F.lit(1)).alias("event_count"),
    ).select(*SERIES, F.col("w.start").alias("event_hour"), "availability_score", "avg_readiness_score", "event_count")


def append_to(stream: DataFrame, path: str, checkpoint: str, available_now=True):
    """Start an appending file sink. The checkpoint folder makes restarts exactly-once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


# Ids of a long memory do not fit on the heap: state in RocksDB, of which a batch uploads its changes only.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _start(writer, spark: SparkSession):
    """Start a query with STATE; the query keeps these settings, the session gets its own back."""
    own = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        for name, value in own.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, late="1 hour", available_now=True, max_files: int | None = None,
           remember="1 day"):
    """Files of JSON lines to append-only tables; no message is lost.

    `sink` gets the first message of each id, `sink`_rejected what does not parse or lacks a field, with the reason, and
    `sink`_late what is older than the newest time of earlier batches minus `late`. A repeat of an id that arrives within `remember` of
    the first is dropped, late or not; ids are held in keyed state that expires then, and no batch reads what earlier ones wrote, but
    for the one row with the newest time so far. Each batch writes its own partition `batch`, so a batch that is run again
    replaces what it wrote.
    """
    rejected, too_late, marks = f"{sink}_rejected", f"{sink}_late", f"{sink}_marks"
    none = spark.createDataFrame([], T.StructType([T.StructField("value", T.StringType())]))
    empty = valid_messages(none)
    newest = T.StructType([T.StructField("newest", T.TimestampType())])
    seeds = {sink: empty, too_late: empty, rejected: rejected_messages(none), marks: spark.createDataFrame([], newest)}
    for path, df in seeds.items():
        df.write.mode("overwrite").parquet(f"{path}/batch=-1")

    def keep(batch, number):
        def put(df, path):
            df.write.mode("overwrite").parquet(f"{path}/batch={number}")

        before = batch.sparkSession.read.schema(newest).parquet(f"{marks}/batch={number - 1}")
        floor = before.agg((F.max("newest") - F.expr(f"INTERVAL {late}")).alias("f")).first().f
        firsts = settled(batch)
        put(firsts.where("reason IS NOT NULL").select("message", "reason"), rejected)
        good = firsts.where("reason IS NULL").drop("reason", "message")
        old = F.lit(False) if floor is None else F.col("event_ts") < F.lit(floor)
        put(good.where(old), too_late)
        put(good.where(~old), sink)
        seen = before.union(good.agg(F.max("event_ts").alias("newest"))).agg(F.max("newest").alias("newest"))
        put(seen.where("newest IS NOT NULL"), marks)

    firsts = first_arrivals(parse_messages(message_stream(spark, source, max_files)), remember)
    writer = firsts.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return _start(writer, spark)
