"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints that differ in at most 3 bits agree wholly on one of their four 16-bit segments (pigeonhole). The other 48
bits are two Golay blocks of 23 bits and two loose bits, and one of the blocks differs in at most one bit (pigeonhole
again). The perfect Golay code decodes a block to the one codeword within 3 bits; the codewords within 4 bits are that
one alone, or six if it is 3 bits away. Of two blocks that differ in one bit, the nearest codeword of either is
within 4 bits of the other. So every fingerprint has the keys (segment, its bits, block, codeword) of all codewords
within 4 bits, two fingerprints within 3 bits share one, and those that share one are compared.

Equal fingerprints are merged first. A bucket emits no pairs: its verified links are merged on the spot, and each
fingerprint keeps one edge to the smallest of its component. A bucket larger than PART is cut further: its pairs
still agree on one of four segments of what is left, and so on, whatever the key was.
"""
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import kept_rows, settled, slices, starts_of_groups, tasks, text_of
from opsloom.llm.components import components

SEED = 42
BITS = 3
PART = 2048
# Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011


def syndromes(words):
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


def error_patterns():
    """Per syndrome, six error patterns that lead to codewords within 4 bits: the nearest first, repeated where
    there is no other."""
    masks = [np.array([sum(c) for c in combinations([1 << i for i in range(23)], size)], np.int64) for size in range(5)]
    near = np.zeros(2048, np.int64)
    for rows in masks[1:4]:
        near[syndromes(rows)] = rows
    table = np.repeat(near[:, None], 6, 1)
    filled = np.ones(2048, np.int64)
    for mask, s in zip(masks[4].tolist(), syndromes(masks[4]).tolist()):
        table[s, filled[s]] = mask
        filled[s] += 1
    return table


def fingerprint(text: bytes) -> int:
    """64 bits: set where over half of the 3-word shingles' hashes have a one."""
    words = text.lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) < 3:
        hashes = [h(b" ".join(words), SEED)]
    else:
        hashes = [h(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:])]
    n, ones = len(hashes), np.zeros(64, np.int64)
    array = np.array(hashes, np.uint64)
    for start in range(0, n, 65536):
        ones += np.unpackbits(array[start:start + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(ones * 2 > n).tolist()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long. Null texts are empty: fingerprint zero."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in slices(batches, 256):
            made = np.array([fingerprint(t) for t in batch.column("text").cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(made, pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, text_hash long, fp long")


def keys_of(fp: np.ndarray, errors: np.ndarray):
    """(keys, fingerprints): up to 48 keys per fingerprint."""
    f = fp.view(np.uint64)
    keys, owners = [], []
    for segment in range(4):
        low = np.uint64(16 * segment)
        exact = (f >> low) & np.uint64(0xFFFF)
        below = f & ((np.uint64(1) << low) - np.uint64(1))
        above = (f >> low >> np.uint64(16)) << low
        rest = (below | above).astype(np.int64)
        for block in range(2):
            word = rest >> (23 * block) & 0x7FFFFF
            mask = errors[syndromes(word)]
            code = (word[:, None] ^ mask) >> 11
            key = (exact.astype(np.int64)[:, None] << 15) | (code << 3) | (segment * 2 + block)
            first = np.zeros(mask.shape, bool)
            first[:, 0] = True
            use = first | (mask != mask[:, :1])
            keys.append(key[use])
            owners.append(np.repeat(fp, 6).reshape(-1, 6)[use])
    return np.concatenate(keys), np.concatenate(owners)


def near(a, b):
    return np.bitwise_count((a ^ b).view(np.uint64)) <= BITS


def join_up(label, left, right):
    """Give linked members the smaller of their labels."""
    while len(open_ := np.flatnonzero(label[left] != label[right])):
        x, y = label[left[open_[0]]], label[right[open_[0]]]
        label[label == max(x, y)] = min(x, y)
        left, right = left[open_], right[open_]


def linked(fp: np.ndarray, label: np.ndarray, members: np.ndarray, bits=tuple(range(64))):
    """Join up all pairs of `members` within BITS; parts over PART are cut by four segments of the bits not yet used."""
    if len(members) <= PART or len(bits) < 8:
        own = fp[members]
        for shift in range(1, len(members)):
            hit = np.flatnonzero(near(own[shift:], own[:-shift]))
            if len(hit):
                join_up(label, members[hit], members[hit + shift])
        return
    u = fp[members].view(np.uint64)
    for s in range(4):
        own = bits[s::4]
        value = np.zeros(len(members), np.uint64)
        for b in own:
            value = (value << np.uint64(1)) | (u >> np.uint64(b) & np.uint64(1))
        order = np.argsort(value, kind="stable")
        first = starts_of_groups(value[order])
        for lo, hi in zip(first, [*first[1:], len(order)]):
            if hi - lo > 1:
                linked(fp, label, members[order[lo:hi]], tuple(b for b in bits if b not in own))


def bucket_edges(batches):
    """Edges (fingerprint, smallest of its component) of the buckets of sorted rows (key, fp)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(key, fp):
        first = starts_of_groups(key)
        size = np.diff([*first, len(key)])
        left, right = [], []
        group = np.repeat(np.arange(len(first)), size)
        small = size <= 32
        for shift in range(1, int(size[small].max(initial=1))):
            i = np.flatnonzero((group[shift:] == group[:-shift]) & small[group[shift:]])
            hit = i[near(fp[i], fp[i + shift])]
            left.append(fp[hit]), right.append(fp[hit + shift])
        for g in np.flatnonzero(~small):
            own = np.unique(fp[first[g]:first[g] + size[g]])
            top = np.arange(len(own))
            linked(own, top, np.arange(len(own)))
            moved = np.flatnonzero(top != np.arange(len(own)))
            left.append(own[top[moved]]), right.append(own[moved])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], schema=schema)

    held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        key = np.concatenate([held_key, batch.column("key").to_numpy()])
        fp = np.concatenate([held_fp, batch.column("fp").to_numpy()])
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        yield edges(key[:cut], fp[:cut])
        held_key, held_fp = key[cut:], fp[cut:]
    yield edges(held_key, held_fp)


def fingerprint_edges(distinct: DataFrame) -> DataFrame:
    """Edges between distinct fingerprints (column fp) that join up exactly those linked by chains of pairs within BITS."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def keyed(batches):
        errors = error_patterns()
        for batch in slices(batches, 4096):
            key, owner = keys_of(batch.column("fp").to_numpy(), errors)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(owner)], schema=schema)

    keys = distinct.select("fp").mapInArrow(keyed, "key long, fp long")
    return keys.repartition(tasks(distinct), "key").sortWithinPartitions("key", "fp").mapInArrow(bucket_edges, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id, label, text_hash): component_id is the smallest doc_id reachable over links of at most 3 differing bits.

    Null texts are empty, empty texts have fingerprint zero. Repeated rows stay repeated; a null doc_id is no candidate
    for the smallest, and a component of null ids only has a null id. No documents: no rows.
    """
    made = settled(fingerprints(docs))
    groups = settled(made.groupBy("fp").agg(F.min("doc_id").alias("least")))
    parts = components(fingerprint_edges(groups))
    rooted = groups.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    rooted = settled(rooted)
    smallest = settled(rooted.groupBy("label").agg(F.min("least").alias("component_id")))
    named = settled(rooted.join(smallest, "label").select("fp", "label", "component_id"))
    return made.join(named, "fp").select("doc_id", "fp", "component_id", "label", "text_hash")


def near_dedup(docs: DataFrame) -> DataFrame:
    """One document of each component stays (the smallest doc_id; null ids last), with all its columns. Rows are told
    apart by id and text; of rows that repeat both one stays."""
    who = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
    keep = near_duplicates(docs).groupBy("label").agg(F.min(who).alias("k")).select("k.id", "k.h")
    return kept_rows(docs, keep)
