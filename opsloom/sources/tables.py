"""Reading tables and running parameterised SQL."""
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, nan_as_null=False) -> DataFrame:
    """A Parquet table; with a schema, columns that are absent read as NULL.

    Files written from pandas may hold NaN for NULL; `nan_as_null` reads it so, at the price that filters on float columns
    no longer reach the scan.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if not nan_as_null:
        return df
    floats = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def read_folder(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files below a folder as one scan; an empty folder is an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")) if fs.exists(path) else []
    if not files:
        raise FileNotFoundError(f"No parquet files found in {folder}")
    return read_table(spark, f"{folder}/*.parquet", schema)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# Named queries; the run date is a bound parameter, so the text never changes.
SQL = {
    "jobs_by_status": """
        SELECT execution_date, workload_type, status, count(*) AS jobs, avg(duration_seconds) AS avg_duration_s
        FROM job_metadata WHERE execution_date = CAST(:scan_date AS DATE)
        GROUP BY execution_date, workload_type, status""",
    "cost_by_provider": """
        SELECT cost_date, cloud_provider, sum(cost_usd) AS cost_usd
        FROM cost_events WHERE cost_date <= CAST(:scan_date AS DATE)
        GROUP BY cost_date, cloud_provider""",
}


def run_sql(spark: SparkSession, name: str, scan_date: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run a named query for a date over the given tables."""
    register_views(tables)
    return spark.sql(SQL[name], args={"scan_date": scan_date})


def retained(df: DataFrame, column: str, as_of, days: int) -> DataFrame:
    """Rows young enough to be kept; on a partition column whole partitions are skipped."""
    return df.where(F.col(column) >= F.date_sub(F.lit(as_of).cast("date"), days))
