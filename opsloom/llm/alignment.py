"""Alignment of two tokenizations of the same bytes by coalescing intervals.

The tokens of both sides are intervals of bytes. All of them are sorted by start; where a start reaches the greatest end so far, a group
begins. Groups are the finest cuts at which tokens of both sides end. Within a group, overlapping tokens are expanded to pairs; those
that end together are links. Many documents lie one behind the other on one line of bytes, so numpy sees a few large arrays.

What a link counts for depends on the whole corpus. Documents come in blocks, and a block holds the different pairs of its links once; pairs are
counted over blocks, and each block gets the counts of its own pairs back. So nothing is broadcast, and the commonest pair is
one row per block, however many links it has.
"""
import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from opsloom.llm.common import settled, slices, tasks, text_of
from opsloom.llm.packing import byte_bpe

BLOCK = 4 << 20
RUN = 1 << 18
MASK = (1 << 32) - 1
# Decimal digits of every id below 100,000, and how many there are.
DIGITS = np.array([list(b"%-6d" % i) for i in range(100_000)], np.uint8)
WIDTH = np.array([len(str(i)) for i in range(100_000)])


class Sides:
    """Both tokenizers: A (byte-level, over space and text) and B (pieces, which adds the space itself)."""

    def __init__(self, path_a: str, path_b: str):
        self.path_a, self.fast, self.slow = path_a, byte_bpe(path_a).encoding, None
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        tokens = range(self.b.get_piece_size())
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in tokens]
        self.bytes_a = [self.fast.decode_single_token_bytes(i) for i in range(len(self.fast.token_byte_values()))]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))

    def ids_a(self, text: str) -> np.ndarray:
        """Control strings are plain text. The faster encoder refuses very long white space; the tokenizer itself takes it."""
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:
            if self.slow is None:
                self.slow = Tokenizer.from_file(self.path_a)
                self.slow.no_truncation()
                self.slow.no_padding()
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)

    def tokens(self, text: str | None):
        """(ids of A, ids of B), both empty unless both sides spell space and text."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        a, b = self.ids_a(" " + text), np.array(self.b.encode(text), np.int64)
        whole = (" " + text).encode()
        if any(b"".join(map(table.__getitem__, ids.tolist())) != whole for table, ids in ((self.bytes_a, a), (self.bytes_b, b))):
            return none, none
        return a, b


@lru_cache(maxsize=4)
def sides(path_a: str, path_b: str) -> Sides:
    return Sides(path_a, path_b)


def runs(end_a, end_b, size: int = RUN):
    """(A from, to, B from, to): a document's tokens in runs of at least `size` of A, each cut where both sides end."""
    place = np.searchsorted(end_b, end_a)
    both = np.flatnonzero(end_b[place] == end_a)
    i = j = 0
    while i < len(end_a):
        last = both[min(np.searchsorted(both, i + size - 1), len(both) - 1)]
        stop, at = int(last) + 1, int(place[last]) + 1
        yield i, stop, j, at
        i, j = stop, at


def coalesced(size_a: np.ndarray, size_b: np.ndarray):
    """(group of each A token, of each B token, A and B place of each overlapping pair, whether the pair ends together)."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    start, end = np.concatenate([end_a - size_a, end_b - size_b]), np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(end_a), len(end_b)])
    order = np.lexsort((side, start))
    top = np.maximum.accumulate(end[order])
    first = np.ones(len(order), bool)
    first[1:] = start[order][1:] >= top[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    low = np.searchsorted(end_b, start[:len(end_a)], "right")
    many = np.searchsorted(start[len(end_a):], end_a, "left") - low
    of_a = np.repeat(np.arange(len(end_a)), many)
    of_b = np.arange(len(of_a)) + np.repeat(low - np.cumsum(many) + many, many)
    return group[:len(end_a)], group[len(end_a):], of_a, of_b, end_a[of_a] == end_b[of_b]


def spelled(a, b, group_a, group_b):
    """(text, the place behind each token in it): ids of each group, A before B, as `a1,a2|b1;`."""
    key = np.concatenate([2 * group_a, 2 * group_b + 1])
    order = np.argsort(key, kind="stable")
    ids, key = np.concatenate([a, b])[order], key[order]
    mark = np.full(len(ids), ord(","), np.uint8)
    last = np.append(key[1:] != key[:-1], True)
    mark[last] = np.where(key[last] & 1, ord(";"), ord("|"))
    cells, width = DIGITS[ids], WIDTH[ids]
    cells[np.arange(len(ids)), width] = mark
    return cells[np.arange(6) <= width[:, None]].tobytes(), np.cumsum(width + 1)


class Block:
    """Documents whose pairs share one list."""

    def __init__(self, own: Sides):
        self.own, self.rows, self.waiting, self.held, self.links = own, [], [], 0, []

    def add(self, doc, text):
        a, b = self.own.tokens(text)
        self.rows.append([doc, len(a), len(b), 0, 0, 0, hashlib.sha256() if len(a) else None])
        if not len(a):
            return
        end_a, end_b = np.cumsum(self.own.size_a[a]), np.cumsum(self.own.size_b[b])
        for i, stop, j, at in runs(end_a, end_b) if len(a) > RUN else [(0, len(a), 0, len(b))]:
            self.waiting.append((len(self.rows) - 1, a[i:stop], b[j:at], stop == len(a)))
            self.held += stop - i
            if self.held >= RUN:
                self.work()

    def work(self):
        """Align what waits."""
        if not self.waiting:
            return
        row, a, b, last = zip(*self.waiting)
        count_a, count_b = [len(x) for x in a], [len(x) for x in b]
        a, b = np.concatenate(a), np.concatenate(b)
        group_a, group_b, of_a, of_b, together = coalesced(self.own.size_a[a], self.own.size_b[b])
        text, places = spelled(a, b, group_a, group_b)
        part = np.repeat(np.arange(len(row)), count_a)
        groups = np.diff(group_a[np.cumsum(count_a) - 1] + 1, prepend=0)
        overlaps, links = np.bincount(part[of_a], minlength=len(row)), np.bincount(part[of_a[together]], minlength=len(row))
        stop = places[np.cumsum(count_a) + np.cumsum(count_b) - 1].tolist()
        for k, (r, done) in enumerate(zip(row, last)):
            own = self.rows[r]
            own[3] += int(groups[k])
            own[4] += int(links[k])
            own[5] += int(overlaps[k])
            own[6].update(text[stop[k - 1] if k else 0:stop[k] - done])
        pair = a[of_a[together]] << 32 | b[of_b[together]]
        self.links.append((np.array(row)[part[of_a[together]]], pair))
        self.waiting, self.held = [], 0

    def made(self):
        """(rows, their pairs as places in the list of pairs and numbers of links, the list of pairs, numbers of links of the block)."""
        self.work()
        row, pair = (np.concatenate(x) for x in zip(*self.links)) if self.links else (np.zeros(0, np.int64),) * 2
        pairs, at, count = np.unique(pair, return_inverse=True, return_counts=True)
        key, times = np.unique(row * max(len(pairs), 1) + at, return_counts=True)
        cuts = np.searchsorted(key, np.arange(len(self.rows) + 1) * max(len(pairs), 1))
        own = [(pack(key[lo:hi] - r * max(len(pairs), 1)), pack(times[lo:hi])) for r, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
        rows = [(*r[:6], r[6].hexdigest() if r[6] else "") for r in self.rows]
        return rows, own, pairs, count


def pack(numbers) -> bytes:
    return zlib.compress(numbers.astype("<u4").tobytes(), 1)


def unpack(data: bytes):
    return np.frombuffer(zlib.decompress(data), "<u4")


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
MADE = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("groups_sha256", pa.string()),
                  ("at", pa.binary()), ("times", pa.binary()), ("pairs", pa.binary()), ("counts", pa.binary())])
MADE_SQL = f"block long, doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string, at binary, times binary, pairs binary, counts binary"


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document (pairs null), and one per block (doc_id and counts null) with its pairs and their numbers of links."""
    def run(batches):
        from pyspark import TaskContext
        own, number = sides(path_a, path_b), TaskContext.get().partitionId() << 32
        block, size = Block(own), 0

        def out():
            rows, lists, pairs, count = block.made()
            whole = (number, *[None] * 9, pairs.astype("<i8").tobytes(), count.astype("<i8").tobytes())
            table = [(number, *r, *x, None, None) for r, x in zip(rows, lists)] + [whole]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in table], f.type) for i, f in enumerate(MADE)], schema=MADE)

        for batch in slices(batches, 64):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                block.add(doc, text)
                size += len(text)
                if size >= BLOCK:
                    yield out()
                    block, size, number = Block(own), 0, number + 1
        if block.rows:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, MADE_SQL)


def entries(made: DataFrame) -> DataFrame:
    """(block, pair, n): the different pairs of each block."""
    def run(batches):
        for batch in slices(batches, 1):
            block, pairs, counts = (batch.column(c)[0].as_py() for c in ("block", "pairs", "counts"))
            pair, n = np.frombuffer(pairs, "<i8"), np.frombuffer(counts, "<i8")
            for lo in range(0, len(pair), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair[part]), block)), pa.array(pair[part]), pa.array(n[part])], names=["block", "pair", "n"])

    return made.where("pairs IS NOT NULL").select("block", "pairs", "counts").mapInArrow(run, "block long, pair long, n long")


def pair_counts(made: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold a pair (A id << 32 | B id), and whether no other pair of its B id has more."""
    totals = entries(made).groupBy("pair").agg(F.sum("n").alias("n"))
    return totals.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(MASK)))))


def alignment_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps: one row per row of docs.

    Null and empty texts, and texts that a side does not spell byte by byte, have no tokens: zeros and an empty digest. Repeated rows
    are documents of their own. No documents: no rows."""
    made = settled(blocks(docs, path_a, path_b))
    found = settled(pair_counts(made))
    back = entries(made).join(found.withColumnRenamed("n", "count"), "pair")
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
    schema = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in names])

    def run(batches):
        counts, now, lists = np.zeros((2, 0), np.int64), None, []
        for batch in batches:
            cells = {c: batch.column(c).to_pylist() for c in ("block", "doc_id", *COUNTS, "groups_sha256", "at", "times")}
            count, best = (batch.column(c).cast(pa.int64()).fill_null(0).to_numpy() for c in ("count", "best"))
            block, is_doc = batch.column("block").to_numpy(), batch.column("is_doc").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (is_doc[1:] != is_doc[:-1]))).tolist() if len(block) else []
            out = []
            for lo, hi in zip(cut, [*cut[1:], len(block)]):
                if not is_doc[lo]:
                    if block[lo] != now:
                        now, lists = block[lo], []
                    lists.append(np.stack([count[lo:hi], best[lo:hi]]))
                    continue
                if block[lo] != now:
                    now, lists = block[lo], []
                counts = np.concatenate(lists, axis=1) if lists else np.zeros((2, 0), np.int64)
                lists = [counts]
                for k in range(lo, hi):
                    own, times = (unpack(cells[c][k]).astype(np.int64) for c in ("at", "times"))
                    total, best_of = counts[:, own] @ times
                    out.append((cells["doc_id"][k], *(cells[c][k] for c in COUNTS[:4]), int(best_of), int(total), cells["groups_sha256"][k], cells["n_overlaps"][k]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    documents = made.where("pairs IS NULL").drop("pairs", "counts").select(
        "*", F.lit(True).alias("is_doc"), F.lit(None).cast("long").alias("pair"), F.lit(None).cast("long").alias("count"), F.lit(None).cast("boolean").alias("best"))
    rest = back.select("block", *[F.lit(None).cast(documents.schema[c].dataType).alias(c) for c in documents.columns[1:10]],
                       F.lit(False).alias("is_doc"), "pair", "count", "best")
    return documents.unionByName(rest).repartition(tasks(docs), "block").sortWithinPartitions("block", "is_doc", "pair").mapInArrow(
        run, ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in names))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, groups: of each group its bytes (of space and text) and the ids of both sides."""
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches):
        own = sides(path_a, path_b)
        for batch in slices(batches, 16):
            out = []
            for text in batch.column("text").to_pylist():
                a, b = own.tokens(text)
                group_a, group_b, *_ = coalesced(own.size_a[a], own.size_b[b])
                size, n = np.cumsum(own.size_a[a]), int(group_a[-1]) + 1 if len(a) else 0
                ends = size[np.searchsorted(group_a, np.arange(n), "right") - 1].tolist() if n else []
                split = lambda ids, g: [x.tolist() for x in np.split(ids, np.searchsorted(g, np.arange(1, n)))] if n else []
                out.append([{"begin": s, "end": e, "a": x, "b": y} for s, e, x, y in zip([0, *ends], ends, split(a, group_a), split(b, group_b))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, groups array<struct<begin:long,end:long,a:array<int>,b:array<int>>>")
