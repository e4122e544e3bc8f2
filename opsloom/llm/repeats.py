"""Removal of long repeated byte strings, by anchored window hashing.

Sorting all suffixes of a corpus moves every byte several times. This is not the difference-cover method: nothing is ranked, sorted
as a suffix or merged. Windows are grouped by hash, and only a sample of positions, chosen by content, is named: a window of WIDTH bytes is decided by its pivot, the place in it whose GRAM-byte hash is least. Equal windows have their pivot at
the same place, and a pivot decides one run of windows, so the sample is about a sixtieth of the positions.

1. Sample: each pivot with the bytes before and after it that its windows reach (its context) is named. Pivots whose
   gram occurs once cannot take part in a repeat and are left out. Contexts that occur twice are repeated whole.
2. Blocks: a context that is alone, though its gram is not, is cut into blocks of BLOCK windows. Each has two names,
   of the bytes that all its windows share and of the bytes that they reach. A block whose shared part occurs once is done with,
   one that is repeated whole is repeated.
3. The rest is counted window by window: a window's key is its place relative to the pivot and its name; windows with
   equal keys share WIDTH bytes, so both are repeats.

Groups are formed on (gram, name), never on the gram alone, and are counted before they are shuffled, so a passage
that fills a third of the rows is one entry per task.
"""
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import released, settled, slices, starts_of_groups, text_of

WIDTH = 200
GRAM = 32
BLOCK = 13
CHUNK = 1 << 20
PLACE = np.uint64((1 << 21) - 1)


def gram_hashes(b: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of every run of `gram` bytes (a power of two), by doubling."""
    h = b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    factor, size = 0xD6E8FEB86659FD93, 1
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor & 0xFFFFFFFFFFFFFFFF, size * 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def pivots(text: bytes, width: int = WIDTH, gram: int = GRAM):
    """(pivot, first window, last window, gram hash) of each run of windows with a common pivot, as arrays."""
    out = []
    for start in range(0, max(0, len(text) - width + 1), CHUNK):
        b = np.frombuffer(text, np.uint8, min(len(text) - start, CHUNK + width - 1), start)
        h = gram_hashes(b, gram)
        least = sliding_min((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), width - gram + 1)
        at = (least & PLACE).astype(np.int64)
        first = starts_of_groups(at)
        out.append(np.stack([at[first] + start, first + start, np.append(first[1:], len(at)) - 1 + start, h[at[first]].view(np.int64)]))
    return np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)


def name(data) -> int:
    """64-bit name as a signed long; it is only compared among strings with a common 64-bit gram hash."""
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def identified(docs: DataFrame) -> DataFrame:
    """(doc, hash, text): a document is known by its id and the XXH64 of its text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text_of()).alias("hash"), text_of().cast("binary").alias("text"))


PIVOT = pa.schema([(c, pa.int64()) for c in ("doc", "hash", "gram", "name", "place")])


def place_of(at, low, high):
    """A pivot's position and the least and greatest distance to the starts of its windows, in one long."""
    return (at << 16) | (low << 8) | high


AT, LOW, HIGH = "shiftright(place, 16)", "shiftright(place, 8) & 255", "place & 255"


def sampled(texts: DataFrame, width: int) -> DataFrame:
    """One row per pivot: its document, gram hash, context name and place."""
    def run(batches):
        for batch in slices(batches, 64):
            parts = []
            for doc, h, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "hash", "text"))):
                at, first, last, gram = pivots(text, width)
                names = [name(text[a:b]) for a, b in zip(first.tolist(), (last + width).tolist())]
                n = len(at)
                parts.append((np.full(n, doc or 0), np.full(n, doc is None), np.full(n, h), gram, np.array(names, np.int64), place_of(at, at - last, at - first)))
            if parts:
                doc, none, h, gram, names, place = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc.astype(np.int64), mask=none.astype(bool)), pa.array(h.astype(np.int64)), pa.array(gram), pa.array(names), pa.array(place)], schema=PIVOT)

    return texts.mapInArrow(run, "doc long, hash long, gram long, name long, place long")


def decided(rows: DataFrame, shared: str, whole: str):
    """(repeated, open) among rows that have a name of the part they share and of the whole.

    repeated: rows whose whole occurs twice. open: one row per different whole of a shared part that has several, at
    least one of them alone; `wanted` stays on those that are alone.
    """
    wholes = released(rows.groupBy(shared, whole).agg(
        F.count(F.lit(1)).alias("n"), F.max("wanted").alias("any"), *[F.first(c).alias(c) for c in ("doc", "hash", "place", "wanted")]))
    parts = wholes.groupBy(shared).agg(F.count(F.lit(1)).alias("k"), F.max((F.col("n") == 1) & F.col("wanted")).alias("any")).where("k > 1 AND any").select(shared)
    # Written before it is joined: adaptive execution splits a hot key only where shuffles meet in the join.
    parts = settled(parts)
    open_ = wholes.join(parts, shared, "left_semi").select("doc", "hash", "place", (F.col("wanted") & (F.col("n") == 1)).alias("wanted"))
    return _repeated(rows, wholes.where("n > 1 AND any").select(shared, whole)), released(open_)


def _repeated(rows, twice):
    return released(rows.where("wanted").join(twice, twice.columns, "left_semi").select("doc", "hash", "place"))


def spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, hash, start, end): byte ranges that repeated windows cover; they overlap."""
    texts = identified(docs)
    pivot = _repeated_grams(texts, width)
    by_context, open_ = decided(pivot.withColumn("wanted", F.lit(True)), "gram", "name")
    del pivot

    need = open_.groupBy("doc", "hash").agg(F.collect_list(F.struct("place", "wanted")).alias("pivots"))
    cut = released(_by_document(texts, need).mapInArrow(_contexts(width), "doc long, hash long, place long, wanted boolean, context binary"))
    blocks = released(cut.mapInArrow(_blocks(width), BLOCK_TYPES))
    by_block, still = decided(blocks, "shared", "whole")
    del blocks, need, open_

    asked = still.select(F.col("doc").alias("d"), F.col("hash").alias("h"), F.col("place").alias("block"), F.col("wanted").alias("want"), F.expr(AT).alias("a"))
    windows = cut.drop("wanted").join(
        asked, F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")) & (F.expr(AT) == F.col("a")))
    windows = released(windows.select("doc", "hash", "place", "context", "block", "want").mapInArrow(_windows(width), BLOCK_TYPES))
    del cut, asked, still
    twice = windows.groupBy("shared", "whole").agg(F.count(F.lit(1)).alias("n"), F.max("wanted").alias("any")).where("n > 1 AND any").select("shared", "whole")
    by_window = _repeated(windows, settled(twice))

    return by_context.union(by_block).union(by_window).select(
        "doc", "hash", F.expr(f"{AT} - ({HIGH})").alias("start"), F.expr(f"{AT} - ({LOW}) + {width}").alias("end"))


def _repeated_grams(texts: DataFrame, width: int) -> DataFrame:
    """The pivots whose gram occurs twice."""
    rows = settled(sampled(texts, width))
    grams = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    grams = settled(grams)
    return released(rows.join(grams, "gram", "left_semi"))


def _by_document(texts: DataFrame, need: DataFrame, how="inner") -> DataFrame:
    other = need.withColumnRenamed("doc", "d").withColumnRenamed("hash", "h")
    return texts.join(other, F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")), how).drop("d", "h")


def _contexts(width):
    """Cut the contexts of listed pivots out of their documents. Rows of equal id and text would say the same twice, but
    their contexts occur twice and are decided before."""
    schema = pa.schema([("doc", pa.int64()), ("hash", pa.int64()), ("place", pa.int64()), ("wanted", pa.bool_()), ("context", pa.binary())])

    def run(batches):
        for batch in slices(batches, 64):
            out = []
            for doc, h, text, listed in zip(*(batch.column(c).to_pylist() for c in ("doc", "hash", "text", "pivots"))):
                for p in listed:
                    at, low, high = unpacked(p["place"])
                    out.append((doc, h, p["place"], p["wanted"], text[at - high:at - low + width]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def unpacked(place):
    return place >> 16, place >> 8 & 255, place & 255


BLOCK_TYPES = "shared long, whole long, doc long, hash long, place long, wanted boolean"
BLOCK_SCHEMA = pa.schema([*((c, pa.int64()) for c in ("shared", "whole", "doc", "hash", "place")), ("wanted", pa.bool_())])


def _put(out):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)


def seeded(data, seed):
    """As `name`, with a number mixed in."""
    return xxhash.xxh3_64_intdigest(data, seed) - (1 << 63)


def _blocks(width):
    """Blocks of windows on a fixed grid of distances to the pivot, with names of their shared and whole bytes."""
    def run(batches):
        for batch in slices(batches, 1024):
            out = []
            for doc, h, place, wanted, context in zip(*(batch.column(c).to_pylist() for c in ("doc", "hash", "place", "wanted", "context"))):
                at, low, high = unpacked(place)
                for cell in range(low // BLOCK, high // BLOCK + 1):
                    near, far = cell * BLOCK, cell * BLOCK + BLOCK - 1
                    a, b = max(near, low), min(far, high)
                    out.append((seeded(context[high - near:high - far + width], cell), seeded(context[high - b:high - a + width], a * 256 + b),
                                doc, h, place_of(at, a, b), wanted))
            yield _put(out)

    return run


def _windows(width):
    """Single windows of open blocks: two names of the distance to the pivot and all their bytes."""
    def run(batches):
        for batch in slices(batches, 1024):
            out = []
            for doc, h, place, context, block, want in zip(*(batch.column(c).to_pylist() for c in ("doc", "hash", "place", "context", "block", "want"))):
                at, low, high = unpacked(place)
                _, a, b = unpacked(block)
                if low <= a and b <= high:
                    for far in range(a, b + 1):
                        window = context[high - far:high - far + width]
                        out.append((seeded(window, far), seeded(window, far + 256), doc, h, place_of(at, far, far), want))
            yield _put(out)

    return run


def merged(ranges):
    """Disjoint sorted ranges of overlapping or touching ones."""
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def spans_by_document(docs: DataFrame, width: int) -> DataFrame:
    """The spans of each document that has any."""
    return spans(docs, width).groupBy("doc", "hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of whole texts as UTF-8 bytes.

    A byte goes if a string of `width` bytes that covers it also starts anywhere else, in the same document or another;
    all such copies go. Null texts are empty; shorter texts lose nothing. Repeated rows are copies of each other.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for batch in slices(batches, 256):
            out = []
            for doc, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "spans"))):
                gone = merged((r["start"], r["end"]) for r in ranges or ())
                out.append((doc, len(text), sum(b - a for a, b in gone), len(gone), hashlib.sha256(_kept(text, gone)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return _by_document(identified(docs), spans_by_document(docs, width), "left").select("doc", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _kept(text: bytes, gone) -> bytes:
    if not gone:
        return text
    edges = [0, *(x for r in gone for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with repeated passages taken out of their texts; bytes that no longer form a character
    go as well. All columns stay, and n_chars, where there is one, counts the new text. Null texts stay null."""
    columns = docs.columns
    marked = docs.withColumn("_hash_", F.xxhash64(text_of()))
    by_doc = spans_by_document(docs, width)
    joined = marked.join(by_doc, F.col("doc_id").cast("long").eqNullSafe(F.col("doc")) & (F.col("_hash_") == F.col("hash")), "left")

    @F.pandas_udf("string")
    def cut(texts, ranges):
        return texts.combine(ranges, lambda t, r: t if t is None or r is None else _kept(
            t.encode(), merged((x["start"], x["end"]) for x in r)).decode(errors="ignore"))

    out = joined.withColumn("text", cut(F.col("text"), F.col("spans")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in columns])
