"""Exact deduplication by a tree of sorted digest runs.

Each input partition makes one sorted run of (digest, smallest row, count). In binomial rounds FAN runs at a time
exchange their entries and are merged into one; a round's entries are dealt out by (run, slice of the digest range),
so that every round keeps all tasks busy and none gathers a whole run. A text that fills a third of the rows is one
entry per run from the first level on. Replies go down the same way, one entry per first-level run, so the way back
has no hot key either.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import kept_rows, settled, starts_of_groups, tasks, text_of

FAN = 8
SLICES = 256
KEY = ["run", "short", "digest"]
ENTRY = "run int, short long, digest binary, no_id boolean, id long, row long, n long"


def normalised(column):
    """One space for every run of ASCII white space."""
    return F.regexp_replace(column, r"[\x20\x09-\x0D]+", " ")


def merge_sorted(batches):
    """Merge neighbouring entries that agree in run, short digest and whole digest (the whole one verifies the
    short one). The entries are sorted, so the first of a group is its smallest row; counts add up."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        t = t.combine_chunks()
        first = starts_of_groups(*(t.column(k).to_numpy(zero_copy_only=False) for k in KEY))
        n = np.add.reduceat(t.column("n").to_numpy(), first)
        # The field as it came: a batch whose n cannot be null concatenates with no other kind.
        merged = t.take(pa.array(first)).set_column(6, t.schema.field("n"), pa.array(n, pa.int64()))
        held = merged.slice(merged.num_rows - 1)
        yield from merged.slice(0, merged.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def exact_groups(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """Group documents by equal normalised text.

    Returns one row per document: doc_id, keep_id, group_size, kept, text_sha256. Null texts are empty texts. Of equal
    texts the smallest doc_id stays, null ids last; of rows that repeat an id, one stays. No documents: no rows.
    """
    text = normalised(text_of())
    digests = settled(docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_of()).alias("text_hash"), text.alias("t")).select(
        "id", "text_hash", F.unhex(F.sha2("t", 256)).alias("digest"), F.xxhash64("t").alias("short"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row")))
    order = [*KEY, "no_id", "id", "row"]
    entries = digests.select(
        "run", "short", "digest", F.isnull("id").alias("no_id"), "id", "row", F.lit(1).cast("long").alias("n"))
    local = entries.sortWithinPartitions(*order).mapInArrow(merge_sorted, ENTRY)
    level, runs = local, digests.rdd.getNumPartitions()
    while runs > 1:
        level = (
            level.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
            .repartition(tasks(docs), "run", F.shiftright("short", 56) % SLICES)
            .sortWithinPartitions(*order).mapInArrow(merge_sorted, ENTRY)
        )
        runs = -(-runs // fan)
    whole = level.select(F.col("short").alias("s"), F.col("digest").alias("d"), F.col("id").alias("keep_id"),
                         F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    replies = local.select("run", "short", "digest").join(
        whole, (F.col("short") == F.col("s")) & (F.col("digest") == F.col("d"))).drop("s", "d")
    return digests.join(replies, KEY).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "text_hash")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. Rows are told apart by their id; of rows with an id in
    common and equal text one stays."""
    return kept_rows(docs, exact_groups(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")))
