"""Packing of token pieces into sequences of fixed capacity by bulk-synchronous best fit.

A superstep takes the documents of one band of lengths, longest band first. Documents and gaps (free space of open
sequences) are range-sorted and numbered within equal lengths and equal gaps. A sweep over the distinct values, longest
document first, sends each run of equal documents to the smallest gap that holds them; conflicts are resolved by rank:
as many documents as the run of gaps has go there in order, the next ones to the next gap, and what finds none opens
sequences. The sweep sees counts by value only, at most twice the capacity of them, so it is a small plan; rows are
matched to it by value and rank on the cluster. Then the gaps are updated and the next band follows.
"""
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from opsloom.llm.bpe import byte_symbols
from opsloom.llm.common import settled, slices, text_of

CAPACITY = 2048
# Fixed value: the split of the byte-level vocabulary.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """Ids of a byte-level tokenizer file, in which ids stand in the order of merges. Texts that hold a control string of the
    vocabulary are left to the tokenizer itself, the others go to a faster encoder (tiktoken) over the same vocabulary. Its pattern
    backtracks on white space and refuses runs of about a million characters; the tokenizer takes those texts too."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except ValueError:  # the pattern's stack is used up
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per worker process, whatever the number of tasks."""
    return ByteBpe(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): token pieces of whole texts, each followed by the id `end`. A document
    over the capacity is cut so that only its first piece is shorter. Null and empty texts are one piece of one id."""
    schema = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in ("doc_id", "piece", "start", "length", "ids_crc32")])

    def run(batches):
        bpe, last = byte_bpe(path), int(end).to_bytes(4, "little")
        for batch in slices(batches, 256):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = bpe.ids(text).tobytes() + last
                total = len(ids) // 4
                stop = (total - 1) % capacity + 1
                start = 0
                for number in range(-(-total // capacity)):
                    out.append((doc, number, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                    start, stop = stop, stop + capacity
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def bands(capacity: int):
    """(low, high] ranges of lengths, longest first."""
    edges = sorted({0, capacity // 8, capacity // 2, capacity}, reverse=True)
    return list(zip(edges[1:], edges))


def sweep(documents: dict, gaps: dict, capacity: int):
    """Plan of one superstep: rows (length, first, count, kind, key, target, used).

    Documents of `length` with ranks first .. first + count - 1 go, in order, to ranks target, target + 1, ... of the
    gaps of size `key` (kind 0) or of the sequences opened by documents of length `key` (kind 1), after `used`
    tokens that this superstep has already put there.
    """
    runs = {f: [(0, f, 0, n, 0)] for f, n in gaps.items() if n}
    open_ = sum(1 << f for f in runs)
    plan = []
    for length in sorted(documents, reverse=True):
        first, left = 0, documents[length]
        while left:
            fitting = open_ >> length
            if not fitting:
                per = capacity // length
                groups = [(left // per, per)] * (left >= per) + [(1, left % per)] * (left % per > 0)
                for many, slots in groups:
                    opener = first
                    for slot in range(slots):
                        plan.append((length, first, many, 1, length, opener, slot * length))
                        first += many
                    left -= many * slots
                    free = capacity - slots * length
                    if free:
                        runs.setdefault(free, []).append((1, length, opener, many, slots * length))
                        open_ |= 1 << free
                continue
            free = length + (fitting & -fitting).bit_length() - 1
            kind, key, target, many, used = runs[free].pop()
            taken = min(left, many)
            plan.append((length, first, taken, kind, key, target, used))
            if taken < many:
                runs[free].append((kind, key, target + taken, many - taken, used))
            if not runs[free]:
                open_ ^= 1 << free
                del runs[free]
            if free > length:
                runs.setdefault(free - length, []).append((kind, key, target, taken, used + length))
                open_ |= 1 << (free - length)
            first, left = first + taken, left - taken
    return plan


class Ranked:
    """Rows range-sorted by (value, key). `runs` has a row (part, value, first row, count, rank of the first) for each value in each
    range; as the ranges are sorted, those are at most as many as ranges and values together."""

    def __init__(self, df: DataFrame, value: str, key: str):
        place = F.monotonically_increasing_id()
        self.value = value
        self.rows = settled(df.repartitionByRange(value, key).sortWithinPartitions(value, key).withColumn("_place", place).select(
            "*", F.shiftright("_place", 33).alias("_part"), F.col("_place").bitwiseAND((1 << 33) - 1).alias("_row")).drop("_place"))
        seen = self.rows.groupBy(value, "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first")).collect()
        self.counts, self.runs = {}, []
        for r in sorted(seen, key=lambda r: (r[value], r._part)):
            self.runs.append((r._part, r[value], r.first, r.n, self.counts.get(r[value], 0)))
            self.counts[r[value]] = self.counts.get(r[value], 0) + r.n

    def joined(self, pieces: list, names: list) -> DataFrame:
        """The rows of the pieces (part, value, first row, count, ...), with `_at`, the row's number in its piece, and the named values."""
        frame = pd.DataFrame(pieces, columns=["_part", self.value, "_first", "_count", *names], dtype="int64")
        near = F.broadcast(self.rows.sparkSession.createDataFrame(frame))
        return self.rows.join(near, ["_part", self.value]).withColumn("_at", F.col("_row") - F.col("_first")).where("_at >= 0 AND _at < _count")

    def ranked(self) -> DataFrame:
        return self.joined([(*r[:4], r[4]) for r in self.runs], ["_rank"]).withColumn("rank", F.col("_rank") + F.col("_at"))

    def planned(self, plan: list) -> DataFrame:
        """The rows that a plan speaks of, with kind, key, rank (of the target) and used."""
        pieces, by_value = [], {}
        for length, first, many, kind, key, target, used in plan:
            by_value.setdefault(length, []).append((first, many, kind, key, target, used))
        for part, value, row, n, rank in self.runs:
            for first, many, kind, key, target, used in by_value.get(value, ()):
                low, high = max(first, rank), min(first + many, rank + n)
                if low < high:
                    pieces.append((part, value, row + low - rank, high - low, kind, key, target + low - first, used))
        return self.joined(pieces, ["kind", "key", "_target", "used"]).withColumn("rank", F.col("_target") + F.col("_at"))


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, sequence_id, offset) for items (item: unique long, length: 1 .. capacity).

    A sequence is named by the length and rank of the document that opened it; items of full length fill one each. Ties
    go by item. No items: no rows.
    """
    whole = items.where(F.col("length") >= capacity).select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    documents = Ranked(items.where(F.col("length") < capacity).select("item", "length"), "length", "item")
    placed, gaps, free = [whole], None, F.lit(capacity).cast("long")
    for low, high in bands(capacity):
        band = {v: n for v, n in documents.counts.items() if low < v <= high}
        if not band:
            continue
        lines = None if gaps is None else Ranked(gaps, "free", "sequence_id")
        goes = documents.planned(sweep(band, {} if lines is None else lines.counts, capacity))
        matched = goes.where("kind = 1").select(
            "item", "length", F.expr("shiftleft(key, 40) + rank").alias("sequence_id"), F.col("used").alias("offset"))
        if lines is not None:
            matched = matched.union(goes.where("kind = 0").join(lines.ranked().select(F.col("free").alias("key"), "rank", "sequence_id"), ["key", "rank"]).select(
                "item", "length", "sequence_id", (capacity - F.col("key") + F.col("used")).alias("offset")))
        matched = settled(matched)
        placed.append(matched.drop("length"))
        change = matched.select("sequence_id", (F.when(F.col("offset") == 0, free).otherwise(0) - F.col("length")).alias("free"))
        if lines is not None:
            change = change.union(lines.rows.select("sequence_id", "free"))
        gaps = change.groupBy("sequence_id").agg(F.sum("free").alias("free")).where("free > 0")
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Repeated rows and null ids give pieces of their own; no documents give no rows.
    """
    made = settled(pieces(docs, path, capacity).withColumn("item", F.monotonically_increasing_id()))
    return made.join(pack(made.select("item", "length"), capacity), "item").drop("item")
