"""Points inside intervals, without forming (interval, point) pairs.

Points and interval bounds are sorted into one line of time, and running sums along that
line answer everything: how many points lie before a bound, or how many intervals are
open at a point. The cost is linear in points plus intervals, however many of them fall
into the same moment. Bounds are inclusive; intervals with a NULL bound or an end
before the start contain nothing.

`match` lists (interval column, point column) pairs that must be equal as well, such as a
common date; the line of time is then cut by those columns.
"""
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opsloom.functions import micros
from opsloom.operators.ordered import range_of, running_totals, splitters, totals_in_ranges

START, POINT, END = 0, 1, 2  # order of rows with the same time
TOP_LEVEL = 14  # runs of 4^14 ranges; more of them use several
RANGE_ROWS = 1 << 18  # fewer rows make no range of their own: intervals that cross ranges cost a shuffle
CELLS = 1 << 18  # counts that are held at once
WHOLE, PART, CUT = 0, 1, 2  # an interval that is all of its key inside one range, one of several of its key, one that crosses ranges


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _spans(intervals: DataFrame, keys, start, end, before, after, match) -> DataFrame:
    """Intervals with proper bounds: keys, match columns, first and last moment."""
    lo = micros(start) - int(before * 1_000_000)
    hi = micros(end) + int(after * 1_000_000)
    return intervals.where(lo <= hi).dropna(subset=[start, end, *[i for i, _ in match]]).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(i).alias(p) for i, p in match], lo.alias("_lo"), hi.alias("_hi"))


def _ends(spans: DataFrame, columns) -> DataFrame:
    rows = F.array(*[F.struct(F.col(us).alias("_us"), F.lit(kind).alias("_kind")) for us, kind in (("_lo", START), ("_hi", END))])
    return spans.select(*columns, F.inline(rows))


def _bounds(intervals: DataFrame, keys, start, end, before, after, match) -> DataFrame:
    """Two rows per interval: its keys, the match columns, the time and the kind of bound."""
    spans = _spans(intervals, keys, start, end, before, after, match)
    return _ends(spans, [c for c in spans.columns if c not in ("_lo", "_hi")])


def _points(points: DataFrame, at, same=()) -> DataFrame:
    return points.dropna(subset=[at, *same]).withColumn("_us", micros(at))


def _on_line(line: DataFrame, same, columns, sample: DataFrame, ties=()) -> DataFrame:
    """Running sums along the line. Rows of one moment are told apart by `_salt`, so that a moment with very many bounds is cut as well."""
    return running_totals(line, same, ["_us", "_kind", "_salt"], columns, sample=sample, ties=ties)


def _salted(rows: DataFrame, columns) -> DataFrame:
    return rows.withColumn("_salt", F.xxhash64(*columns) if columns else F.lit(0).cast("bigint"))


def _places(bounds: DataFrame, points: DataFrame, same) -> DataFrame:
    """What splitters are sampled from: bounds and points before any of them are merged, so that sampling shuffles nothing."""
    spread = F.expr("CAST(rand(5) * 9.0e18 AS BIGINT)").alias("_salt")
    return bounds.select(*same, "_us", "_kind", "_salt").unionByName(points.select(*same, "_us", F.lit(POINT).alias("_kind"), spread))


def _difference(c) -> Column:
    """Running sum at the end of an interval minus the one at its start."""
    return F.sum(F.when(F.col("_kind") == END, F.col(c)).otherwise(-F.col(c)))


def _restored(keys):
    return [F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]


def interval_sums(intervals: DataFrame, points: DataFrame, keys, start, end, at, measures: dict,
                  before=0, after=0, match=()) -> DataFrame:
    """(keys, measures): sums over the points inside [start - before, end + after].

    `measures` maps names to integer columns of the points; points of the same moment are
    added up before they are sorted. Every interval with proper bounds is returned.
    """
    same, key_columns = [p for _, p in match], [f"_k{i}" for i in range(len(keys))]
    raw = _points(points, at, same)
    moments = raw.groupBy(*same, "_us").agg(
        *[F.sum(c).cast("bigint").alias(n) for n, c in measures.items()]).withColumn("_kind", F.lit(POINT))
    bounds = _salted(_bounds(intervals, keys, start, end, before, after, match), key_columns)
    line = _union(bounds, _salted(moments, [])).fillna(0, list(measures))
    return (
        _on_line(line, same, list(measures), _places(bounds, raw, same)).where(F.col("_kind") != POINT)
        .groupBy(*_restored(keys)).agg(*[_difference(n).alias(n) for n in measures])
    )


def _block_list(lo: str, hi: str, top: int) -> Column:
    """Aligned blocks of 4^0, 4^1, ... numbers that make up lo .. hi - 1."""
    def first(level):
        return f"shiftright({lo} + shiftleft(1L, 2 * ({level})) - 1L, 2 * ({level}))"

    def stop(level):
        return f"shiftright({hi}, 2 * ({level}))"

    a, b, ua, ub = first("l"), stop("l"), f"4L * {first('l + 1')}", f"4L * {stop('l + 1')}"
    none = "cast(array() as array<bigint>)"

    def span(x, y):
        return f"CASE WHEN {x} < {y} THEN sequence({x}, {y} - 1L) ELSE {none} END"

    return F.expr(f"""
        flatten(transform(sequence(0, {top}), l -> transform(
            CASE WHEN l = {top} OR {ua} >= {ub} THEN {span(a, b)}
                 ELSE concat({span(a, ua)}, {span(ub, b)}) END,
            x -> struct(l AS level, x AS block))))""")


class Codes:
    """Numbers for tuples of column values, in order of appearance."""

    def __init__(self):
        self.known = {}

    def of(self, columns, rows: int, add=True) -> np.ndarray:
        """The number of each row; -1 for what is not known if nothing is to be added."""
        mixed, values = np.zeros(rows, np.int64), []
        for column in columns:
            coded = column.dictionary_encode(null_encoding="encode")
            values.append(["NaN" if isinstance(v, float) and v != v else v for v in coded.dictionary.to_pylist()])
            _, mixed = np.unique(mixed * len(values[-1]) + coded.indices.to_numpy(), return_inverse=True)
        _, first, inverse = np.unique(mixed, return_index=True, return_inverse=True)
        indices = [c.dictionary_encode(null_encoding="encode").indices.to_numpy()[first].tolist() for c in columns]
        own = [tuple(v[i] for v, i in zip(values, at)) for at in (zip(*indices) if columns else [()] * len(first))]
        if add:
            return np.array([self.known.setdefault(t, len(self.known)) for t in own], np.int64)[inverse]
        return np.array([self.known.get(t, -1) for t in own], np.int64)[inverse]

    def column(self, i: int, type_: pa.DataType) -> pa.Array:
        return pa.array([float("nan") if t[i] == "NaN" and pa.types.is_floating(type_) else t[i] for t in self.known], type_)


class Moments:
    """The points of one range of the line, sorted by match columns and time, and the places of each group among them."""

    def __init__(self, same, us, group, groups: int):
        self.times = np.unique(us)
        self.width, self.groups = len(self.times) + 1, groups
        key = same * self.width + np.searchsorted(self.times, us)
        order = np.argsort(key, kind="stable")
        self.key, self.group = key[order], group[order]
        self.stride = len(us) + 1
        self.by_group = np.sort(self.group * self.stride + np.arange(len(us)))

    def place(self, same, step) -> np.ndarray:
        """How many points lie before a step of the times of a match value."""
        return np.searchsorted(self.key, same * self.width + step)

    def before(self, us) -> np.ndarray:
        return np.searchsorted(self.times, us)

    def up_to(self, us) -> np.ndarray:
        return np.searchsorted(self.times, us, "right")

    def counts(self, low, high):
        """(row, group, n) of the groups among the points low .. high - 1 of each row, some rows at a time. Short stretches are counted
        point by point, longer ones by the difference of the places of each group."""
        short = high - low <= 4 * self.groups
        for rows, most in ((np.flatnonzero(short), 4 * self.groups), (np.flatnonzero(~short), self.groups)):
            step = max(1, CELLS // max(1, most))
            for at in range(0, len(rows), step):
                own = rows[at:at + step]
                lo, hi = low[own], high[own]
                if most != self.groups:
                    size = hi - lo
                    point = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
                    cell, n = np.unique(np.repeat(np.arange(len(own)), size) * self.groups + self.group[point], return_counts=True)
                    yield own[cell // self.groups], cell % self.groups, n
                else:
                    first = np.arange(self.groups) * self.stride
                    n = np.searchsorted(self.by_group, first + hi[:, None]) - np.searchsorted(self.by_group, first + lo[:, None])
                    row, group = np.nonzero(n)
                    yield own[row], group, n[row, group]


def _counter(same, groups, key_columns, modes, schema: pa.Schema):
    """A function over the batches of ranges (of each the points, then the bounds) to rows (keys, groups, n): points inside the part of an
    interval that its range holds. Only bounds of the given modes are counted."""
    def run(batches):
        at, held, moments, days, kinds = None, [], None, Codes(), Codes()
        for batch in batches:
            number = batch.column("_range").to_numpy()
            edges = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if number[lo] != at:
                    at, held, moments, days, kinds = number[lo], [], None, Codes(), Codes()
                own = batch.slice(lo, hi - lo)
                point = pc.equal(own.column("_kind"), POINT)
                marks = own.filter(point)
                if marks.num_rows:
                    held.append((days.of([marks.column(c) for c in same], marks.num_rows), marks.column("_us").to_numpy(),
                                 kinds.of([marks.column(c) for c in groups], marks.num_rows)))
                bounds = own.filter(pc.and_(pc.invert(point), pc.fill_null(pc.is_in(own.column("_mode"), pa.array(modes, pa.int32())), False)))
                if not bounds.num_rows or not held:
                    continue
                if moments is None:
                    moments = Moments(*[np.concatenate(x) for x in zip(*held)], len(kinds.known))
                    names = [kinds.column(i, schema.field(len(key_columns) + i).type) for i in range(len(groups))]
                day = days.of([bounds.column(c) for c in same], bounds.num_rows, add=False)
                us, other = bounds.column("_us").to_numpy(), bounds.column("_other").to_numpy()
                end, cut = bounds.column("_kind").to_numpy() == END, bounds.column("_mode").to_numpy() == CUT
                first = np.where(end, 0, moments.before(us))
                last = np.where(end, moments.up_to(us), np.where(cut, moments.width - 1, moments.up_to(other)))
                low, high = moments.place(day, first), moments.place(day, last)
                some = np.flatnonzero((day >= 0) & (low < high))
                for row, group, n in moments.counts(low[some], high[some]):
                    yield pa.RecordBatch.from_arrays(
                        [bounds.column(k).take(pa.array(some[row])) for k in key_columns] + [v.take(pa.array(group)) for v in names]
                        + [pa.array(n, pa.int64())], schema=schema)

    return run


class Overlaps:
    """One line of time for everything about groups of points inside intervals.

    Points and bounds are dealt out by ranges of the line. An interval inside one range is counted there, and no row of the result is shuffled;
    of one that crosses ranges the first and the last hold a part each, and what lies between comes from the counts of whole ranges. Another use of the
    same exchange sums the intervals that are open at a point.
    """

    def __init__(self, intervals: DataFrame, points: DataFrame, keys, start, end, at, groups, before=0, after=0, match=(),
                 ids: str | None = None):
        self.keys, self.groups, self.same = list(keys), list(groups), [p for _, p in match]
        self.key_columns = [f"_k{i}" for i in range(len(keys))]
        self.ids = [] if ids is None else [ids]
        raw = _points(points, at, self.same)
        order = [*self.same, "_us", "_kind", "_salt"]
        # Points of one moment are spread by what tells them apart.
        marks = _salted(raw, self.ids or points.columns).select(*self.same, "_us", "_salt", *self.groups, *self.ids).withColumn("_kind", F.lit(POINT))
        spans = _salted(_spans(intervals, keys, start, end, before, after, match), self.key_columns)
        bounds = _ends(spans, [*self.same, *self.key_columns, "_salt"])
        places = _union(bounds.select(*order), marks.select(*order))
        cuts = splitters(places, order, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), RANGE_ROWS)
        types = [places.schema[c] for c in order]

        def range_at(us, kind):
            return range_of(cuts, types, [*[F.col(c) for c in self.same], us, kind, F.col("_salt")])

        # One interval per key and match value: the last start to the last end.
        merged = _salted(spans.groupBy(*self.key_columns, *self.same).agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")), self.key_columns)
        alone = F.lit(True)
        if not {i for i, _ in match} <= set(keys):  # a key may have intervals of several match values
            alone = F.count(F.lit(1)).over(Window.partitionBy(*self.key_columns)) == 1
        self.spans = merged.withColumn("_alone", alone).withColumns({
            "_range": range_at(F.col("_lo"), F.lit(START)), "_to": range_at(F.col("_hi"), F.lit(END))}).withColumn(
            "_mode", F.when(F.col("_range") != F.col("_to"), CUT).when(F.col("_alone"), WHOLE).otherwise(PART))
        first, last = (F.struct(F.col(r).alias("_range"), F.col(us).alias("_us"), F.col(o).alias("_other"), F.lit(kind).alias("_kind"))
                       for r, us, o, kind in (("_range", "_lo", "_hi", START), ("_to", "_hi", "_lo", END)))
        parts = self.spans.select(*self.key_columns, *self.same, "_salt", "_mode", F.inline(
            F.when(F.col("_mode") == CUT, F.array(first, last)).otherwise(F.array(first))))
        self.marks = marks.withColumn("_range", range_at(F.col("_us"), F.col("_kind")))
        rows = [self.marks, parts]
        if self.ids:
            rows.append(bounds.select(*order, F.when(F.col("_kind") == START, 1).otherwise(-1).cast("bigint").alias("_open"),
                                      range_at(F.col("_us"), F.col("_kind")).alias("_range")))
        else:
            rows = [r.withColumn("_open", F.lit(0).cast("bigint")) for r in rows]
        self.numbered = _union(*rows).fillna(0, ["_open"])
        self.order, self.line = order[len(self.same):], self.numbered.repartition(len(cuts) + 1, "_range")

    def covered(self) -> DataFrame:
        """Points (match columns, groups, ids) at which an interval is open."""
        ties = [*self.key_columns, *self.groups, *self.ids, "_other", "_mode"]
        line = totals_in_ranges(self.numbered, self.line, self.same, self.order, ["_open"], ties=ties)
        return line.where((F.col("_kind") == POINT) & (F.col("_open") > 0)).select(*self.same, *self.groups, *self.ids)

    def _counted(self, modes) -> DataFrame:
        """(key columns, groups, n) of the bounds of some modes, each for its range."""
        fields = [*[self.line.schema[c] for c in [*self.key_columns, *self.groups]], T.StructField("n", T.LongType())]
        schema = to_arrow_schema(T.StructType(fields))
        run = _counter(self.same, self.groups, self.key_columns, modes, schema)
        return self.line.sortWithinPartitions("_range", F.col("_kind") != POINT).mapInArrow(run, T.StructType(fields))

    def _between(self, top) -> DataFrame:
        """(key columns, groups, n) of the ranges that lie wholly inside an interval: a few aligned blocks of ranges each."""
        same, groups = self.same, self.groups
        per_range = self.marks.groupBy("_range", *same, *groups).agg(F.count(F.lit(1)).alias("_n"))
        counted = (
            per_range.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
            .groupBy("level", F.expr("shiftright(CAST(_range AS BIGINT), 2 * level)").alias("block"), *same, *groups).agg(F.sum("_n").alias("n"))
        )
        far = self.spans.where("_to > _range + 1").select(*self.key_columns, *same, F.expr("_range + 1L").alias("_first"), F.expr("CAST(_to AS BIGINT)").alias("_last"))
        pieces = far.withColumn("_b", F.explode(_block_list("_first", "_last", top))).select(*self.key_columns, *same, "_b.level", "_b.block")
        return pieces.join(counted, ["level", "block", *same]).select(*self.key_columns, *groups, "n")

    def counts(self, top=TOP_LEVEL) -> DataFrame:
        """(keys, groups, n): points of each group inside an interval, n > 0."""
        whole = self._counted([WHOLE]).select(*_restored(self.keys), *self.groups, "n")
        parts = _union(self._counted([PART, CUT]), self._between(top))
        return whole.unionByName(parts.groupBy(*_restored(self.keys), *self.groups).agg(F.sum("n").alias("n")))


def interval_counts(intervals: DataFrame, points: DataFrame, keys, start, end, at, groups,
                    before=0, after=0, match=(), top=TOP_LEVEL) -> DataFrame:
    """(keys, groups, n): points of each group inside [start - before, end + after], n > 0, for groups that are not known beforehand."""
    return Overlaps(intervals, points, keys, start, end, at, groups, before, after, match).counts(top)


def covered_points(points: DataFrame, intervals: DataFrame, start, end, at, before=0, after=0, match=()) -> DataFrame:
    """Points that lie in at least one interval: those at which an interval is open."""
    same = [p for _, p in match]
    raw = _points(points, at, same)
    # Equal bounds are merged, and each one adds or ends that many intervals.
    bounds = _bounds(intervals, [], start, end, before, after, match).groupBy(*same, "_us", "_kind").agg(
        F.count(F.lit(1)).alias("_n"))
    steps = bounds.select(*same, "_us", "_kind", F.when(F.col("_kind") == START, F.col("_n")).otherwise(-F.col("_n")).alias("_open"))
    times = raw.select(*same, "_us").distinct().select("*", F.lit(POINT).alias("_kind"), F.lit(0).cast("bigint").alias("_open"))
    places = _places(_salted(_bounds(intervals, [], start, end, before, after, match), []), raw, same)
    inside = _on_line(_salted(_union(steps, times), []), same, ["_open"], places).where((F.col("_kind") == POINT) & (F.col("_open") > 0))
    return raw.join(inside.select(*same, "_us"), [*same, "_us"], "left_semi").drop("_us")
