"""Order-dependent work for keys of any size.

A window partitioned by a key sorts all rows of that key in one task. The functions
here never do: rows are range-partitioned by (key, order), so a hot key spreads over
many tasks, and windows run on blocks of fixed size that carry as many earlier rows as
the frame needs.
"""
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, Window, functions as F, types as T

from opsloom.operators.lookup import BROADCAST_ROWS, lookup_join
from opsloom.session import settled

BLOCK = 65_536


SAMPLE = 64


def splitters(df: DataFrame, order_by, ranges: int, each: int | None = None) -> list:
    """Up to `ranges` - 1 rows of the sort columns that cut df into ranges of similar size, from one sample of fixed size. Any
    splitters give right results; a poor sample only makes ranges uneven. With `each`, no more ranges are made than give that many rows
    to each (rows are counted as the sample is taken), but one for each core."""
    if ranges < 2:
        return []
    places, seen = df.select(*order_by), Observation()
    if each is not None:
        places = places.observe(seen, F.count(F.lit(1)).alias("rows"))
    taken = places.withColumn("_at", F.rand(11)).orderBy("_at").limit(SAMPLE * ranges).drop("_at")
    rows = taken.orderBy(*order_by).collect()
    if each is not None:
        ranges = min(ranges, max(seen.get["rows"] // each + 1, df.sparkSession.sparkContext.defaultParallelism))
    cuts = [rows[len(rows) * i // ranges] for i in range(1, ranges)] if rows else []
    return [row for i, row in enumerate(cuts) if i == 0 or row != cuts[i - 1]]


def range_of(cuts: list, types, places=None) -> F.Column:
    """Number of the range of a row: how many splitters are not behind it, by binary search in a tree of comparisons. `places` stands
    for the sort columns where they have other names."""
    row = F.struct(*[(F.col(f.name) if places is None else place).cast(f.dataType).alias(f.name) for f, place in zip(types, places or types)])

    def literal(cut):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, types)])

    def tree(low, high):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(row < literal(cuts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(cuts))


def with_range(df: DataFrame, order_by, sample: DataFrame | None = None):
    """(df with `_range`, number of ranges): the range ascends with the sort columns. The splitters are literals of the plan, so every
    use agrees on them. `sample` stands for df where it is cheaper to evaluate and spread alike."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order_by = list(order_by)
    cuts = splitters(df if sample is None else sample, order_by, wanted)
    return df.withColumn("_range", range_of(cuts, [df.select(c).schema[0] for c in order_by])), len(cuts) + 1


def positions(df: DataFrame, keys, order_by, name="pos") -> DataFrame:
    """Add the 0-based position of each row within its key.

    `order_by` must order the rows of a key totally.
    """
    numbered = running_totals(df.withColumn(name, F.lit(1).cast("bigint")), keys, order_by, [name])
    return numbered.withColumn(name, F.col(name) - 1)


def blocks(df: DataFrame, history: int, pos="pos", size=BLOCK) -> DataFrame:
    """Assign rows to blocks of `size` positions and copy the last `history` rows of
    each block into the next one. Rows with `_own` false are such copies."""
    size = max(size, history)
    own = F.floor(F.col(pos) / size)
    tail = F.col(pos) % size >= size - history
    return (
        df.withColumn("_block", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))))
        .withColumn("_own", F.col("_block") == own)
    )


def over_blocks(df: DataFrame, keys, history: int, columns, pos="pos", size=BLOCK) -> DataFrame:
    """Evaluate window columns on frames that reach at most `history` rows back.

    `columns` maps a name to a function from the ordered window to a Column.
    """
    w = Window.partitionBy(*keys, "_block").orderBy(pos)
    out = blocks(df, history, pos, size)
    return (
        out.select("*", *[make(w).alias(name) for name, make in columns.items()])
        .where("_own").drop("_block", "_own")
    )


def rolling_stats(df: DataFrame, keys, value, rows: int, pos="pos", size=BLOCK) -> DataFrame:
    """Mean, population deviation and z against the `rows` rows before each row."""
    out = over_blocks(df, keys, rows, {
        "rolling_mean": lambda w: F.avg(value).over(w.rowsBetween(-rows, -1)),
        "rolling_std": lambda w: F.stddev_pop(value).over(w.rowsBetween(-rows, -1)),
    }, pos, size)
    z = F.try_divide(F.col(value) - F.col("rolling_mean"), F.col("rolling_std"))
    return out.withColumn("z_score", z)


def running_totals(df: DataFrame, keys, order_by, columns, whole=(), sample: DataFrame | None = None, ties=()) -> DataFrame:
    """Replace columns by their running sums within each key, the row itself included.

    A distributed prefix sum with one exchange of the rows: they are dealt out by ranges of (key, order), summed inside their range, and
    get the totals of the ranges before. Those totals are combined map-side; only keys that cross a boundary have any, of which a
    range has two at most, so what is broadcast is bounded by the number of ranges. `order_by` must split ties well, because
    rows that are equal in it land in one task. For columns in `whole` the sum over the key is added as total_<column>. Columns in
    `ties` order what is equal; no use of the result can prune them, so that all uses share the one exchange.
    """
    keys, columns = list(keys), list(columns)
    numbered, ranges = with_range(df, [*keys, *order_by], sample)
    return totals_in_ranges(numbered, numbered.repartition(ranges, "_range"), keys, order_by, columns, whole, ties)


def totals_in_ranges(numbered: DataFrame, line: DataFrame, keys, order_by, columns, whole=(), ties=()) -> DataFrame:
    """`running_totals` of rows with `_range`; `line` are the same rows, dealt out by it."""
    names = [c for c in numbered.columns if c != "_range"]
    per_range = numbered.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in columns])
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carries = per_range.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_r"), F.count(F.lit(1)).over(by_key).alias("_ranges"),
        *[F.sum(f"_t_{c}").over(earlier).alias(f"_before_{c}") for c in columns],
        *[F.sum(f"_t_{c}").over(by_key).alias(f"_whole_{c}") for c in whole],
    ).where("_ranges > 1").drop("_ranges")
    in_range = Window.partitionBy(*keys, "_range")
    inside = in_range.orderBy(*order_by, *ties, *(columns if ties else [])).rowsBetween(Window.unboundedPreceding, 0)
    summed = line.select(
        *[c for c in names if c not in columns], "_range", *[F.sum(c).over(inside).alias(c) for c in columns],
        *[F.sum(c).over(in_range).alias(f"_own_{c}") for c in whole])
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return summed.join(F.broadcast(carries), same, "left").withColumns({
        **{c: F.col(c) + F.coalesce(f"_before_{c}", F.lit(0)) for c in columns},
        **{f"total_{c}": F.coalesce(f"_whole_{c}", f"_own_{c}") for c in whole},
    }).select(*names, *[f"total_{c}" for c in whole])


SELECT_ROWS = 100_000
STEPS = 64


def _inside(rows: DataFrame, brackets: DataFrame, keys) -> DataFrame:
    """Rows (keys, _v, _w) with the bracket of their key that holds their value; brackets of a key do not overlap."""
    named = brackets.withColumnsRenamed({k: f"_b_{k}" for k in keys})
    if brackets.count() <= BROADCAST_ROWS:  # a few numbers each
        named = F.broadcast(named)
    same = (F.col("_v") >= F.col("_from")) & (F.col("_v") <= F.col("_to"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    return rows.join(named, same).drop(*[f"_b_{k}" for k in keys])


def exact_percentiles(df: DataFrame, keys, value: str, quantiles: dict, weight: str | None = None, most=SELECT_ROWS) -> DataFrame:
    """Exact, linearly interpolated percentiles per key; NULL values do not count.

    Selection by histograms: the range of a key's values is cut into bins (STEPS in each octave above its least value), counted
    map-side, and only the bins that hold a wanted rank go on, with the least and greatest value they really have, until they
    hold `most` rows at most or a single value. Only those are sorted, so a key with a third of all rows sorts a bounded share. `quantiles` maps
    names to fractions; the count of values is returned as `n_values`. `df` is read once a round.
    """
    keys = list(keys)
    amount = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), amount.alias("_w"))
    held = [F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_from"), F.max("_v").alias("_to")]
    brackets = settled(rows.groupBy(*keys).agg(*held).select(
        *keys, F.col("_n").alias("n_values"), "_rows", "_from", "_to", F.lit(0).cast("bigint").alias("_before")))

    def target(q):
        return F.lit(float(q)) * (F.col("n_values") - 1)

    wanted = F.array(*[f(target(q)).cast("bigint") for q in quantiles.values() for f in (F.floor, F.ceil)])
    wide = (F.col("_rows") > most) & (F.col("_from") != F.col("_to"))
    last = None
    # A round that narrows nothing (values apart by less than a double tells) leaves the rest to the sort.
    while (widest := brackets.where(wide).agg(F.max("_rows")).first()[0]) is not None and widest != last:
        last = widest
        low, high, v = (F.col(c).cast("double") / 2 for c in ("_from", "_to", "_v"))
        share = (v - low) / (high - low)
        octave = F.floor(F.log2(share))
        step = F.floor(octave * STEPS + (share / F.pow(F.lit(2.0), octave) - 1) * STEPS)
        place = F.when(F.col("_v") == F.col("_from"), F.lit(-(1 << 40))).when(F.col("_v") == F.col("_to"), F.lit(1 << 40)).otherwise(
            F.coalesce(step, F.lit(0))).cast("bigint")
        bins = _inside(rows, brackets.where(wide), keys).drop("_rows").groupBy(*keys, "n_values", "_before", place.alias("_bin")).agg(*held)
        earlier = Window.partitionBy(*keys, "_before").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        hit = F.exists(wanted, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_n")))
        narrowed = bins.where(hit).select(*keys, "n_values", "_rows", "_from", "_to", F.col("_start").alias("_before"))
        brackets = settled(brackets.where(~wide).unionByName(narrowed))

    merged = _inside(rows, brackets, keys).groupBy(*keys, "n_values", "_before", "_v").agg(F.sum("_w").alias("_n"))
    up_to = Window.partitionBy(*keys, "_before").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("_hi", F.col("_before") + F.sum("_n").over(up_to)).withColumn("_lo", F.col("_hi") - F.col("_n"))

    def at(rank):
        return F.max(F.when((rank >= F.col("_lo")) & (rank < F.col("_hi")), F.col("_v")))

    picks = ranked.groupBy(*keys, "n_values").agg(*[
        c for i, q in enumerate(quantiles.values())
        for c in (at(F.floor(target(q))).alias(f"_a{i}"), at(F.ceil(target(q))).alias(f"_b{i}"))
    ])
    return picks.select(*keys, "n_values", *[
        (F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * (target(q) - F.floor(target(q)))).alias(name)
        for i, (name, q) in enumerate(quantiles.items())
    ])


def exponential_mean(df: DataFrame, keys, value: str, span: int, name="ewm_mean", pos="pos", size=BLOCK) -> DataFrame:
    """Exponential mean started from the first value; gaps decay the old weight.

    The recurrence is affine in the mean that enters a block, so blocks are reduced in
    parallel to one row each, the block rows are chained, and each block is then
    filled in with the mean it starts from.
    """
    alpha = 2.0 / (span + 1.0)
    keys = list(keys)
    work = df.withColumn("_block", F.floor(F.col(pos) / size))
    key_fields = [df.schema[k] for k in keys]

    def smooth(values):
        return pd.Series(values, dtype="float64").ewm(span=span, adjust=False).mean().to_numpy()

    def merge(mean, gap, first):
        """The mean after a gap of any length and one more value."""
        w = (1.0 - alpha) ** (gap + 1)
        return (w * mean + alpha * first) / (w + alpha)

    def reduce_block(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(pos)[value].to_numpy(dtype="float64")
        seen = np.flatnonzero(~np.isnan(x))
        head = pdf[[*keys, "_block"]].iloc[:1].reset_index(drop=True)
        if len(seen) == 0:
            return head.assign(rows=len(x), lead=len(x), first=np.nan, last=np.nan, keep=1.0, trail=len(x))
        impulse = np.where(np.isnan(x), np.nan, 0.0)
        impulse[seen[0]] = 1.0
        return head.assign(
            rows=len(x), lead=int(seen[0]), first=x[seen[0]], last=smooth(x)[-1],
            keep=smooth(impulse)[-1], trail=int(len(x) - 1 - seen[-1]),
        )

    reduced = work.groupBy(*keys, "_block").applyInPandas(reduce_block, T.StructType([
        *key_fields, T.StructField("_block", T.LongType()), T.StructField("rows", T.LongType()),
        T.StructField("lead", T.LongType()), T.StructField("first", T.DoubleType()),
        T.StructField("last", T.DoubleType()), T.StructField("keep", T.DoubleType()),
        T.StructField("trail", T.LongType()),
    ]))

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        mean, gap, means, gaps = math.nan, 0, [], []
        for row in pdf.itertuples(index=False):
            means.append(mean)
            gaps.append(gap)
            if math.isnan(row.first):
                gap += row.rows
            else:
                if math.isnan(mean):
                    mean = row.last
                else:
                    mean = row.last + row.keep * (merge(mean, gap + row.lead, row.first) - row.first)
                gap = row.trail
        return pdf[[*keys, "_block"]].assign(_mean_in=means, _gap_in=gaps)

    carried = reduced.groupBy(*keys).applyInPandas(chain, T.StructType([
        *key_fields, T.StructField("_block", T.LongType()),
        T.StructField("_mean_in", T.DoubleType()), T.StructField("_gap_in", T.LongType()),
    ]))
    columns = df.columns
    out_schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        x = pdf[value].to_numpy(dtype="float64").copy()
        mean, gap = pdf["_mean_in"].iloc[0], int(pdf["_gap_in"].iloc[0])
        seen = np.flatnonzero(~np.isnan(x))
        if mean is None or math.isnan(mean):
            y = smooth(x)
        elif len(seen) == 0:
            y = np.full(len(x), mean)
        else:
            lead = seen[0]
            x[lead] = merge(mean, gap + lead, x[lead])
            y = np.concatenate([np.full(lead, mean), smooth(x[lead:])])
        return pdf[columns].assign(**{name: y})

    joined = lookup_join(work, carried, [*keys, "_block"], null_safe=True)
    return joined.groupBy(*keys, "_block").applyInPandas(fill, out_schema)
