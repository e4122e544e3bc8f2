"""Near copies: documents whose sets of 5-word shingles have a Jaccard similarity of at least 0.8.

Candidates come from two places, and every link is verified on the shingles of both texts. First the fingerprints of `simhash`: texts of one
fingerprint, and fingerprints that its Golay keys bring together within 3 bits. At 0.8 two fingerprints differ in some 10 bits, with a
deviation of 3, so many pairs are too far apart for that; the others come from min-hashes: BANDS keys of ROWS minima each. A pair at 0.8 shares
a key with probability 1 - (1 - 0.8**4)**20, that is all but 3 in 100,000.

A bucket emits no square of pairs. Its members are sorted by their sketch (a byte of each minimum), from a place that differs by band, so texts
that are alike stand near each other; each is compared with the WINDOW next ones by sketch, and the most alike becomes a candidate. As the order
differs by band, a text meets other neighbours in each of its buckets. All candidates are verified. Rows are linear in members; a hot bucket is
range-sorted over as many tasks as it needs. This brings most texts into their components at little cost.

What the windows leave is done whole. In every bucket that still holds several components, all members of different components meet: the
bucket is cut into blocks of its largest component and blocks of the others, two blocks make a cell, and a cell is compared by one task, by
sketches (or fingerprints) first and by shingles where those allow a link. So every two texts that share a key, or that a chain of fingerprints
within 3 bits joins and that are within 3 bits themselves, are in one component or have been compared. Cells emit links, at most one per member, and no pairs.
Their number grows with the square of a bucket only as far as that bucket holds many components.
"""
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import kept_rows, released, settled, slices, starts_of_groups, tasks, text_of
from opsloom.llm.components import components
from opsloom.llm.simhash import fingerprint, fingerprint_edges, near

WORDS = 5
LEAST = 0.8
BANDS = 20
ROWS = 4
SLOTS = BANDS * ROWS
WINDOW = 8
# Slots that must agree: at 0.8 this is five deviations below the mean.
AGREE = int(SLOTS * (LEAST - 5 * (LEAST * (1 - LEAST) / SLOTS) ** 0.5))
# And in cells: a pair at 0.8 has fewer than these with a probability below 1 in 10**10.
ABLE = 35
BLOCK = 256
SMALL = 32
CHUNK = 4096
MIX = np.uint64(0x9E3779B97F4A7C15)
# An odd multiplier per min-hash.
ODD = np.array([xxhash.xxh64_intdigest(b"%d" % i, 5) | 1 for i in range(SLOTS)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Different hashes of runs of `words` words, sorted. A shorter text is one shingle."""
    own = text.lower().split()
    if len(own) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(own))], np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w) for w in own], np.uint64)
    n, out = len(own) - words + 1, np.zeros(len(own) - words + 1, np.uint64)
    for i in range(words):
        out = mixed(out * MIX + h[i:i + n])
    return np.unique(out)


def minima(hashes: np.ndarray) -> np.ndarray:
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        least = np.minimum(least, (hashes[start:start + CHUNK, None] * ODD).min(0))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band: the hash of its minima."""
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = mixed(key * MIX + row)
    return key.view(np.int64)


def sketch(least: np.ndarray) -> bytes:
    """A byte of each minimum. Bytes of different minima agree once in 256."""
    return mixed(least).astype(np.uint8).tobytes()


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Jaccard similarity of at least `least`, of sorted sets."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def shared(batches):
    """Of rows (key, band, node) sorted by key: those whose key another row has too."""
    held = None
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in ("key", "band", "node")]
        if held is not None:
            rows = [np.concatenate([h[0], r]) for h, r in zip(held[:3], rows)]
        key = rows[0]
        if not len(key):
            continue
        same = key[1:] == key[:-1]
        use = np.append(False, same) | np.append(same, False)
        if held is not None:
            use[0] |= held[3]
        # The last row waits for the next one; whether it has a partner before is kept.
        held = [[r[-1:]] for r in rows] + [bool(use[-1])]
        yield pa.RecordBatch.from_arrays([pa.array(r[:-1][use[:-1]]) for r in rows], names=["key", "band", "node"])
    if held is not None and held[3]:
        yield pa.RecordBatch.from_arrays([pa.array(h[0]) for h in held[:3]], names=["key", "band", "node"])


def windows(batches):
    """Of sorted rows (key, node, label, sketch): (a, b), a < b, of each row with that of its WINDOW next ones that agrees in most slots, AGREE
    at least, of those with the same key and another label."""
    held = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, node, label = (batch.column(c).to_numpy() for c in ("key", "node", "label"))
        code = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(n, SLOTS)
        if held is not None:
            key, node, label, code = (np.concatenate([h, x]) for h, x in zip(held, (key, node, label, code)))
        old = 0 if held is None else len(held[0])
        agree = np.full((WINDOW, len(key)), -1, np.int16)
        for step in range(1, min(WINDOW, len(key) - 1) + 1):
            right = np.arange(step, len(key))
            # Pairs of rows that were both held have been seen.
            right = right[(right >= old) & (key[right] == key[right - step]) & (label[right] != label[right - step])]
            agree[step - 1, right - step] = (code[right] == code[right - step]).sum(1)
        step = agree.argmax(0)
        left = np.flatnonzero(agree[step, np.arange(len(key))] >= AGREE)
        a, b = node[left], node[left + step[left] + 1]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        held = tuple(x[-WINDOW:] for x in (key, node, label, code))


def met(rows: pa.Table):
    """(cell, left, right): the places of rows (cell, side, node, label, band, fp, keys, sketch), sorted by cell, that are to be compared by their
    shingles. Two rows meet in the first band whose key they share, or by their fingerprints (band BANDS) if they share none."""
    cell, side, label, band, fp = (rows.column(c).to_numpy() for c in ("cell", "side", "label", "band", "fp"))
    n = rows.num_rows
    keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(n, BANDS)
    code = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(n, SLOTS)
    first = starts_of_groups(cell)
    size = np.diff([*first, n])
    group = np.repeat(np.arange(len(first)), size)

    def able(left, right):
        use = label[left] != label[right]
        left, right = left[use], right[use]
        by_key = band[left] < BANDS
        use = np.where(by_key, True, near(fp[left], fp[right]))
        use[by_key] = (code[left[by_key]] == code[right[by_key]]).sum(1) >= ABLE
        left, right = left[use], right[use]
        same = keys[left] == keys[right]
        use = np.where(same.any(1), same.argmax(1), BANDS) == band[left]
        return left[use], right[use]

    few = size <= SMALL
    for shift in range(1, int(size[few].max(initial=1))):
        i = np.flatnonzero((group[shift:] == group[:-shift]) & few[group[shift:]])
        yield able(i, i + shift)
    for g in np.flatnonzero(~few):
        own = np.arange(first[g], first[g] + size[g])
        a, b = own[side[own] == 0], own[side[own] == 1]
        if len(a) and len(b):
            for i in range(0, len(a), SMALL):
                yield able(np.repeat(a[i:i + SMALL], len(b)), np.tile(b, len(a[i:i + SMALL])))
        else:
            for shift in range(1, len(own)):
                yield able(own[:-shift], own[shift:])


def whole_cells(batches):
    """Tables of sorted rows in which no cell is cut."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
        if not t.num_rows:
            continue
        cell = t.column("cell").to_numpy()
        cut = int(np.searchsorted(cell, cell[-1]))
        if cut:
            yield t.slice(0, cut)
        held = t.slice(cut)
    if held is not None:
        yield held


def cells(rows: DataFrame) -> DataFrame:
    """Rows (key, band, node, label, fp, keys, sketch) of the keys with several labels, as often as they have cells to stand in. Members of a key's
    largest component meet those of others, and these meet each other; a cell has about BLOCK rows of each side."""
    parts = rows.groupBy("key", "label").agg(F.count("*").alias("n"))
    heads = settled(parts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n")).where("top.n < n").select(
        "key", F.col("top.label").alias("top"), F.ceil(F.col("top.n") / BLOCK).alias("g"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK).alias("h")))
    rows = rows.join(heads, "key").withColumn("in_top", F.col("label") == F.col("top"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("in_top"), F.col("g")).otherwise(F.col("h"))))
    place = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    of_top = F.transform(upto("h"), lambda j: place(0, F.col("own"), j, F.lit(0)))
    of_rest = F.concat(F.transform(upto("g"), lambda i: place(0, i, F.col("own"), F.lit(1))),
                       F.transform(upto("h"), lambda j: place(1, F.least(j, "own"), F.greatest(j, "own"), F.col("own") > j)))
    at = F.explode(F.when(F.col("in_top"), of_top).otherwise(of_rest)).alias("at")
    return rows.select(at, "key", "node", "label", "band", "fp", "keys", "sketch").select(
        F.xxhash64("key", "at.kind", "at.i", "at.j").alias("cell"), F.col("at.side").alias("side"), "node", "label", "band", "fp", "keys", "sketch")


def left_over(rows: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between labels, a < b, that join up all similar texts of different labels that share a key. rows as for `cells`."""
    names = "cell long, side int, node long, label long, band int, fp long, keys array<long>, sketch binary"

    def candidates(batches):
        for t in whole_cells(batches):
            use = np.zeros(t.num_rows, bool)
            for left, right in met(t):
                use[left] = use[right] = True
            yield from t.filter(pa.array(use)).combine_chunks().to_batches()

    def links(batches):
        for t in whole_cells(batches):
            cell, label = (t.column(c).to_numpy() for c in ("cell", "label"))
            hashes, root, out = t.column("hashes").combine_chunks(), {}, []

            def top(x):
                while x in root:
                    x = root[x]
                return x

            for left, right in met(t):
                for i, j in zip(left.tolist(), right.tolist()):
                    x, y = top((cell[i], label[i])), top((cell[j], label[j]))
                    if x != y and similar(*(np.frombuffer(hashes[k].as_buffer(), np.uint64) for k in (i, j)), least):
                        root[max(x, y)] = min(x, y)
                        out.append((min(label[i], label[j]), max(label[i], label[j])))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in range(2)], names=["a", "b"])

    n = tasks(sets)
    able = settled(cells(rows).repartition(n, "cell").sortWithinPartitions("cell", "side", "node").mapInArrow(candidates, names))
    return settled(able.join(sets, "node").repartition(n, "cell").sortWithinPartitions("cell", "side", "node").mapInArrow(links, "a long, b long").distinct())


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles are similar."""
    def run(batches):
        for batch in slices(batches, 64):
            left, right = (batch.column(c).to_pylist() for c in ("sa", "sb"))
            use = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), least) for x, y in zip(left, right)], pa.bool_())
            yield batch.select(["a", "b"]).filter(use)

    first = settled(pairs.join(sets.withColumnsRenamed({"node": "a", "hashes": "sa"}), "a"))
    return settled(first.join(sets.withColumnsRenamed({"node": "b", "hashes": "sb"}), "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long"))


def labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    return rows.join(labels.select(F.col("node").alias(node), F.col("label").alias("_l")), node, "left").withColumn(name, F.coalesce("_l", node)).drop("_l")


def fingerprint_pairs(known: DataFrame) -> DataFrame:
    """(a, b), a < b: each text with the smallest node of its fingerprint, and the smallest nodes of fingerprints within 3 bits. Their
    components are the classes of fingerprints that chains of at most 3 bits join up."""
    groups = settled(known.groupBy("fp").agg(F.min("node").alias("first")))
    left, right = (groups.select(F.col("fp").alias(fp), F.col("first").alias(node)) for fp, node in (("a", "u"), ("b", "v")))
    close = fingerprint_edges(groups).join(left, "a").join(right, "b").select("u", "v")
    same = known.join(groups, "fp").where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v"))
    return settled(close.union(same).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct())


def near_links(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """(node, label) of the texts that are near copies of others; a node is the XXH64 of a text, a label the smallest of its component."""
    def keyed(batches):
        for batch in slices(batches, 256):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            made = [minima(shingles(t, words)) for t in texts]
            prints = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([band_keys(m) for m in made], pa.list_(pa.int64())), pa.array(
                [sketch(m) for m in made], pa.binary()), pa.array(prints, pa.int64())], names=["node", "keys", "sketch", "fp"])

    def hashed(batches):
        for batch in slices(batches, 256):
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(
                [shingles(t, words).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()], pa.binary())], names=["node", "hashes"])

    nodes = docs.select(F.xxhash64(text_of()).alias("node"), text_of().alias("text"))
    known = settled(nodes.mapInArrow(keyed, "node long, keys array<long>, sketch binary, fp long").dropDuplicates(["node"]))
    tried = fingerprint_pairs(known)
    keys = known.select("node", F.posexplode("keys").alias("band", "key"))
    members = settled(keys.repartition(tasks(docs), "key").sortWithinPartitions("key", F.xxhash64("node", "key")).mapInArrow(
        shared, "key long, band int, node long"))
    alike = settled(members.select("node").union(tried.select("a")).union(tried.select("b")).distinct())
    sets = settled(nodes.join(alike, "node", "left_semi").mapInArrow(hashed, "node long, hashes binary").dropDuplicates(["node"]))
    members = settled(members.join(known.select("node", "sketch"), "node"))
    # The sketch, read from a place of its own in each band.
    place = F.substring(F.concat("sketch", "sketch"), F.pmod(F.col("band") * 7, F.lit(SLOTS)) + 1, F.lit(8))
    rows = released(members.select("key", place.alias("place"), "node", F.col("node").alias("label"), "sketch"))
    found = rows.repartitionByRange("key", "place", "node").sortWithinPartitions("key", "place", "node").select("key", "node", "label", "sketch").mapInArrow(
        windows, "a long, b long").distinct()
    found = settled(found.join(tried, ["a", "b"], "left_anti"))
    edges = verified(tried, sets, least).union(verified(found, sets, least))
    # Components of links and, as nodes of other names, classes of fingerprints, in the same rounds.
    other = lambda n: F.xxhash64(n, F.lit("fingerprint"))
    parts = components(edges.union(tried.select(other("a"), other("b"))))
    classes = alike.join(parts.select(F.col("node").alias("_n"), F.col("label").alias("key")), other("node") == F.col("_n")).select(
        "node", "key", F.lit(BANDS).alias("band"))
    labels = parts.join(alike, "node", "left_semi")
    rows = labelled(members.select("node", "key", "band").union(classes), labels, "node", "label")
    open_keys = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    rows = rows.join(open_keys, "key", "left_semi").join(known.select("node", "fp", "keys", "sketch"), "node")
    merged = components(left_over(released(rows), sets, least))
    # A text without links so far is its own label.
    named = labels.union(merged.select("node", F.col("node").alias("label"))).distinct()
    return named.join(merged.select(F.col("node").alias("label"), F.col("label").alias("whole")), "label", "left").select("node", F.coalesce("whole", "label").alias("label"))


def without_near_copies(docs: DataFrame, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """One document of each component of near copies stays (the smallest doc_id; null ids last), with all its columns. Rows are told
    apart by id and text; of rows that repeat both one stays. Null texts are empty. No documents: no rows."""
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"))
    named = made.join(near_links(docs, words, least).withColumnRenamed("node", "text_hash"), "text_hash", "left").withColumn(
        "label", F.coalesce("label", "text_hash"))
    who = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
    keep = named.groupBy("label").agg(F.min(who).alias("k")).select("k.id", "k.h")
    return kept_rows(docs, keep)
