"""Exact distinct counts of several columns from one scan."""
from pyspark.sql import Column, DataFrame, functions as F

DIGEST = 64  # characters of a hexadecimal sha256; texts that stay as they are are shorter, so the two never meet


def distinct_counts(df: DataFrame, columns: dict, keys=(), sums: dict | None = None) -> DataFrame:
    """Per key (one row without keys) the number of different non-null values of each column, and the sums of some expressions.

    `columns` maps names of counts to column names, `sums` names to Columns. Each row becomes one (number of the column, value) per
    column, which tasks reduce to different ones before the only exchange of values; a text as long as its digest goes as that. A value that fills a third of
    the rows is one row per task there, and the counts of a key are combined map-side. NULL keys are a key.
    """
    keys, sums = list(keys), dict(sums or {})
    values = {}
    for i, column in enumerate(columns.values()):
        c = F.col(f"`{column}`")
        text = df.schema[column].dataType.typeName() == "string"
        values[f"_v{i}"] = F.when(F.length(c) >= DIGEST, F.sha2(c, 256)).otherwise(c) if text else c

    def only(i):
        return F.struct(F.lit(i).alias("_at"), *[(v if f"_v{i}" == n else F.when(F.lit(False), v)).alias(n) for n, v in values.items()])

    added = {name: f"_s{i}" for i, name in enumerate(sums)}
    spread = df.select(*keys, *[sums[n].alias(c) for n, c in added.items()], F.explode(F.array(*[only(i) for i in range(len(values))])).alias("_p"))
    first: Column = F.col("_at") == 0
    reduced = spread.select(*keys, *added.values(), "_p.*").groupBy(*keys, "_at", *values).agg(
        F.lit(1).alias("_one"), *[F.sum(F.when(first, F.col(c))).alias(c) for c in added.values()])
    return reduced.groupBy(*keys).agg(
        *[F.sum(c).alias(n) for n, c in added.items()], *[F.count(v).alias(n) for n, v in zip(columns, values)])
