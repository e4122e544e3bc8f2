"""Session settings and the shared checkpoint folder."""
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Shuffles start with many partitions, which adaptive execution merges where they are small; it never splits a sort's.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build(app="opsloom", master=None, **conf) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode without any."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="opsloom-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def settled(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder once; later readers see exactly these rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
