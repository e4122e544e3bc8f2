"""Exact top-k by inner product without random access.

Vectors are packed into blocks. Each block keeps one list per dimension, sorted by value. A query reads all lists of a
block in step, slice by slice, each from the end that helps its score. It holds for every vector a lower bound of the score, a running sum:
what was read, plus the worst that the unread lists can add. The upper bound adds, for every unread list, the distance from that worst to the
value at the frontier. Reading stops as soon as no vector outside the k with the best lower bounds can still qualify, or at the end of the lists,
where bounds are scores; the scores of the vectors that are left are then resolved. The k best of all blocks are merged by rank.

No pair of blocks is shuffled. Queries are dealt into groups of bounded size, vectors into shelves; a cell is one group on one shelf. A task holds
the queries of a cell, streams its vectors block by block and keeps the k best of each query. Shelves are about as many as there are vectors per query,
so that copies of queries are no more rows than the vectors; nothing is joined, broadcast or sent to the driver but counts.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.llm.common import settled, starts_of_groups

BLOCK = 4096
QUERY_BLOCK = 512
GROUP = 65536
SLICE = 256


def quantised(vectors: DataFrame, key="vec_id", column="embedding", scale=256) -> DataFrame:
    """(row, vec_id, q): floor(scale * x) of every component. Rows without id, null vectors and vectors that hold null or
    non-finite components are left out. Rows that share an id stay rows of their own, told apart by `row`."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & x.isNotNull() & ~bad)
    q = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    return settled(rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"), q.alias("q")))


def matrix(rows: pa.Table):
    """(row numbers, ids, vectors) by id, of rows (row, vec_id, q); shorter vectors are padded with zeros."""
    rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")]).combine_chunks()
    q = rows.column("q").combine_chunks()
    size, flat = q.value_lengths().to_numpy(), q.flatten().to_numpy()
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return rows.column("row").to_numpy(), rows.column("vec_id").to_numpy(), out


class Block:
    """Sorted lists of a block of vectors. `ends` has the values of each list in order, `rank` the place of each component in its list. What
    queries read in a step from either end of a list is the same for all of them, so a batch of queries is advanced by one product with that slice."""

    def __init__(self, rows, ids, vectors):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.ends = np.take_along_axis(vectors, order, 0).astype(float)
        self.rank = np.empty(order.shape, np.int32)
        np.put_along_axis(self.rank, order, np.arange(len(ids), dtype=np.int32)[:, None], 0)

    def read(self, done: int, depth: int):
        """What the entries from `done` to `depth` of each list add to lower bounds (vector x list): their distance to the far end of the list.
        The first half of the columns is read from the end, for positive weights, the other from the start."""
        n = len(self.ids)
        late = (self.rank >= n - depth) & (self.rank < n - done)
        early = (self.rank >= done) & (self.rank < depth)
        return np.hstack([np.where(late, self.vectors - self.ends[0], 0.0), np.where(early, self.vectors - self.ends[-1], 0.0)])

    def unread(self, depth: int):
        """(vector x list) what is not read yet, and per list the distance from the frontier to the far end."""
        n = len(self.ids)
        return np.hstack([self.rank < n - depth, self.rank >= depth]).astype(float), self.ends[n - depth] - self.ends[0], self.ends[depth - 1] - self.ends[-1]

    def qualified(self, owns, queries: np.ndarray, k: int, step: int):
        """Per query, as (number, places of the vectors that can be among its k best, depth at which reading stopped)."""
        n = len(self.ids)
        plus, minus = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
        lower = np.repeat((plus @ self.ends[0] + minus @ self.ends[-1])[None], n, 0)
        lower[self.rows[:, None] == owns[None]] = -np.inf
        # Rounding of the bounds; nothing below 2**53, where sums of integers are exact.
        slack = 1e-12 * (np.abs(queries) @ np.abs(self.ends).max(0))
        live, depth = np.arange(len(owns)), 0
        while len(live):
            done, depth = depth, min(n, depth + step)
            weights = np.hstack([plus[live], minus[live]])
            lower += self.read(done, depth) @ weights.T
            rest, high, low = self.unread(depth)
            upper = lower + rest @ (weights * np.hstack([high, low])).T
            floor = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(len(live), -np.inf)
            able = (upper >= floor - slack[live]) & np.isfinite(lower)
            stop = (able.sum(0) <= k) | (depth == n)
            for column in np.flatnonzero(stop).tolist():
                yield int(live[column]), np.flatnonzero(able[:, column]), depth
            live, lower = live[~stop], lower[:, ~stop]

    def top(self, owns, queries: np.ndarray, k: int, step: int = SLICE):
        """Per query the k best (score, id) other than the query's own row, ties to the smaller id."""
        owns = np.asarray(owns)
        n, width = self.vectors.shape
        queries = np.pad(queries, ((0, 0), (0, max(0, width - queries.shape[1]))))[:, :width]
        if n == 0 or width == 0:
            return [[(0, int(i)) for i in sorted(self.ids[self.rows != own].tolist())[:k]] for own in owns]
        out = [[] for _ in owns]
        for j, left, _ in self.qualified(owns, queries, k, step):
            score = self.vectors[left] @ queries[j]
            best = np.lexsort((self.ids[left], -score))[:k]
            out[j] = [(int(score[i]), int(self.ids[left[i]])) for i in best]
        return out


def in_blocks(batches, block: int, query_block: int):
    """(cell, asked, table) of sorted rows (cell, asked, row, vec_id, q): whole blocks as they fill up, the rest of a cell's queries or vectors as one."""
    held, at = [], None

    def full(size):
        t = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        for start in range(0, t.num_rows, size):
            yield (*at, t.slice(start, size))

    for batch in batches:
        cell, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "asked"))
        first = starts_of_groups(cell, asked)
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(cell)]):
            now = (int(cell[lo]), int(asked[lo]))
            if held and now != at:
                yield from full(query_block if at[1] == 0 else block)
            at = now
            size = query_block if at[1] == 0 else block
            while lo < hi:
                take = min(hi - lo, size - sum(h.num_rows for h in held))
                held.append(batch.slice(lo, take))
                lo += take
                if sum(h.num_rows for h in held) == size:
                    yield from full(size)
    if held:
        yield from full(query_block if at[1] == 0 else block)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK, group: int = GROUP) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for quantised queries against quantised vectors (row, vec_id, q).

    A row is never its own query's answer; rows that share an id are queries and answers of their own. Shorter vectors count as padded with zeros. Fewer than k candidates give
    fewer rows; empty tables give none. Scores are exact while they and their parts stay below 2**63, that is for components below 2**28 at
    64 dimensions; beyond, an OverflowError tells so.
    """
    n_vectors, n_queries = vectors.count(), queries.count()
    groups = max(1, -(-n_queries // group))
    wide = max(n_vectors // max(1, n_queries), 2 * vectors.sparkSession.sparkContext.defaultParallelism // groups)
    shelves = max(1, min(-(-n_vectors // block), wide))
    own = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    left = queries.select(own(groups).alias("g"), every(shelves).alias("s"), F.lit(0).alias("asked"), "row", "vec_id", "q")
    right = vectors.select(every(groups).alias("g"), own(shelves).alias("s"), F.lit(1).alias("asked"), "row", "vec_id", "q")
    dealt = left.union(right).select((F.col("g") * shelves + F.col("s")).alias("cell"), "asked", "row", "vec_id", "q")
    dealt = dealt.repartitionByRange(max(groups * shelves, 1), "cell").sortWithinPartitions("cell", "asked")
    schema = pa.schema([(n, pa.int64()) for n in ("query_row", "query_id", "vec_id", "score")])

    def search(batches):
        def answers():
            for (rows, ids, _), lists in zip(asked, best):
                found = [(r, q, v, s) for r, q, own in zip(rows.tolist(), ids.tolist(), lists) for s, v in own]
                yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], pa.int64()) for j in range(4)], schema=schema)

        cell, asked, best = None, [], []
        for number, kind, rows in in_blocks(batches, block, query_block):
            if number != cell:
                yield from answers()
                cell, asked, best = number, [], []
            if kind == 0:
                asked.append(matrix(rows))
                best.append([[] for _ in range(rows.num_rows)])
                continue
            some = Block(*matrix(rows))
            for (own_rows, _, wanted), lists in zip(asked, best):
                if wanted.size and some.vectors.size and int(np.abs(wanted).max()) * int(np.abs(some.vectors).max()) * wanted.shape[1] >= 2 ** 63:
                    raise OverflowError("scores of these vectors can exceed a long")
                for i, found in enumerate(some.top(own_rows, wanted, k)):
                    lists[i] = sorted(lists[i] + found, key=lambda f: (-f[0], f[1]))[:k]
        yield from answers()

    found = dealt.mapInArrow(search, "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
