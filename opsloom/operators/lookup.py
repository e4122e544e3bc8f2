"""Joins against a side that is expected, but not known, to be small."""
from pyspark.sql import DataFrame, functions as F

from opsloom.session import settled

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def null_safe_join(left: DataFrame, right: DataFrame, keys, how="left") -> DataFrame:
    """Equi-join in which NULL keys meet NULL keys; each key column appears once."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    joined = left.withColumn("_left", F.lit(True)).join(renamed, on, how) if how == "full" else left.join(renamed, on, how)
    if how == "full":  # a key that only the right side has
        joined = joined.withColumns({k: F.when(F.col("_left"), F.col(k)).otherwise(F.col(f"_r_{k}")) for k in keys}).drop("_left")
    return joined.drop(*[f"_r_{k}" for k in keys])


def lookup_join(left: DataFrame, small: DataFrame, keys, how="left", max_rows=BROADCAST_ROWS,
                null_safe=False) -> DataFrame:
    """Join `left` with an aggregate that holds one row per key.

    The aggregate is computed once and measured. Up to `max_rows` rows and BROADCAST_BYTES bytes it is broadcast, so
    a key with a third of all rows on the left costs no shuffle. Beyond that the
    join is an ordinary shuffle join, whose hot partitions the adaptive
    skew handling splits.
    """
    small = settled(small)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in small.schema if f.dataType.typeName() in ("string", "binary")]
    size = small.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(texts, F.lit(16 * len(small.columns)))), F.lit(0)).alias("bytes")).first()
    if size.n <= max_rows and size.bytes <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return null_safe_join(left, small, keys, how) if null_safe else left.join(small, list(keys), how)
