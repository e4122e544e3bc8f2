"""Merkle manifest of a dataset: a postorder append log per tree, and proofs read from it by position.

The leaves of a tree are numbered by order. Aligned builders (FAN ** HEIGHT leaves each) append a node to the log as soon as it is
complete: a leaf, then its parent if that was the run's last child, and so on; runs that stay short are closed in order of level at the
end. Builders need not know of each other, because positions have a closed form. Before the first n leaves are followed by another,
sum(n // FAN ** j) nodes are complete (subtree sizes), so the node of level h that n leaves complete stands at
sum((n - 1) // FAN ** j) + h; nodes closed at the end follow the complete ones in order of level. A builder's nodes are contiguous
in the log but for its root, which later builders (over roots, HEIGHT levels up) take as a leaf.

A proof reads the run of siblings of every level at their positions: levels inside a builder from its segment, those above once
per run. Subroots of all trees are the leaves of one more tree, built and read in the same way.
"""
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.llm.common import settled, slices, tasks

BITS = 4
FAN = 1 << BITS
HEIGHT = 2
TOP = ""
DIGEST = 32


def digest(data: bytes) -> bytes:
    """Lowercase hex text of the SHA-256."""
    return hashlib.sha256(data).hexdigest().encode()


def height(size: int) -> int:
    """Levels above the leaves."""
    return -(-max(size - 1, 0).bit_length() // BITS)


def position(level: int, index: int, size: int) -> int:
    """Place in the log of node `index` of `level`, in a tree of `size` leaves."""
    top, end = height(size), (index + 1) << BITS * level
    if end <= size:
        return sum((end - 1) >> BITS * j for j in range(top + 1)) + level
    short = next(j for j in range(top + 1) if size & ((1 << BITS * j) - 1))
    return sum(size >> BITS * j for j in range(top + 1)) + level - short


def height_sql(size: str) -> str:
    return f"CAST(ceil((CASE WHEN {size} > 1 THEN length(bin({size} - 1)) ELSE 0 END) / {BITS}) AS INT)"


def position_sql(level: str, index: str, size: str) -> str:
    """The same as an expression; every argument is a column or a literal."""
    top = height_sql(size)
    end = f"shiftleft({index} + 1, {BITS} * {level})"
    whole = f"aggregate(sequence(0, {top}), {level} * 1L, (s, j) -> s + shiftright({end} - 1, {BITS} * j))"
    # Every level from the first short one up to this has a short last node.
    after = f"size(filter(sequence(0, {level}), j -> {size} % shiftleft(1L, {BITS} * j) <> 0)) - 1"
    late = f"aggregate(sequence(0, {top}), {after} * 1L, (s, j) -> s + shiftright({size}, {BITS} * j))"
    return f"CASE WHEN {end} <= {size} THEN {whole} ELSE {late} END"


def field(value) -> bytes:
    return b"-" if value is None else b"%d:%b" % (len(value), value)


def leaves(docs: DataFrame, columns=("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """(doc_id, tree, leaf, altered): the leaf of each row, and that of the row with A-Z of its text lower-cased where 5 divides the
    CRC-32 of the decimal doc_id (null elsewhere, and for a null doc_id). Columns are taken as text, each `-` if null. The tree is
    named by the source, so that names ascend as sources do, null first."""
    schema = pa.schema([("doc_id", pa.int64()), ("tree", pa.string()), ("leaf", pa.binary()), ("altered", pa.binary())])

    def run(batches):
        for batch in slices(batches, 256):
            out = []
            values = [batch.column(f"v{i}").to_pylist() for i in range(len(columns))]
            for doc, *own in zip(batch.column("doc_id").to_pylist(), *values):
                head = b"".join(map(field, own[:-1]))
                leaf = hashlib.sha256(head + field(own[-1])).digest()
                changed = None
                if doc is not None and zlib.crc32(b"%d" % doc) % 5 == 0:
                    changed = leaf if own[-1] is None else hashlib.sha256(head + field(own[-1].lower())).digest()
                out.append((leaf, changed))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tree"), pa.array([a for a, _ in out], pa.binary()),
                                              pa.array([b for _, b in out], pa.binary())], schema=schema)

    text = [F.col(c).cast("string").cast("binary").alias(f"v{i}") for i, c in enumerate(columns)]
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree, *text).mapInArrow(run, "doc_id long, tree string, leaf binary, altered binary")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with `index` (from 0, by order) and `size` of their tree: range-sorted once, then counted per range and tree."""
    place = settled(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("_place", F.monotonically_increasing_id()))
    place = place.withColumn("_part", F.shiftright("_place", 33))
    parts = place.groupBy("tree", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of = Window.partitionBy("tree")
    parts = settled(parts.select("tree", "_part", "_first", F.sum("_n").over(of).alias("size"), F.coalesce(
        F.sum("_n").over(of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")))
    return place.join(parts, ["tree", "_part"]).withColumn("index", F.col("_before") + F.col("_place") - F.col("_first")).drop("_place", "_part", "_first", "_before")


LOG = "tree string, size long, level int, index long, first long, digests binary"


def append(batches, base: int):
    """Log rows of sorted nodes (tree, size, index, digest) of level `base`, builder by builder.

    Nodes that stand alone carry their level and index; the segment of a builder over leaves has level -1 and its own number."""
    schema = pa.schema([("tree", pa.string()), ("size", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("first", pa.int64()), ("digests", pa.binary())])
    now, open_, log, out = None, [], [], []

    def parent(level, index):
        """Complete or close the run that is open below `level`."""
        node = digest(b"".join(open_[level - 1]))
        open_[level - 1] = []
        open_[level].append(node)
        log.append(node)
        if base:
            out.append((*now[:2], base + level, index, position(base + level, index, now[1]), bytes.fromhex(node.decode())))

    def close():
        tree, size, block = now
        top = len(open_) - 1
        for level in range(1, top + 1):
            if open_[level - 1]:
                parent(level, (size - 1) >> BITS * (base + level))
        if not base:
            *own, root = log
            if own:
                out.append((tree, size, -1, block, position(0, block << BITS * HEIGHT, size), bytes.fromhex(b"".join(own).decode())))
            out.append((tree, size, top, block, position(top, block, size), bytes.fromhex(root.decode())))

    def made():
        rows = out.copy()
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    for batch in batches:
        for tree, size, index, node in zip(*(batch.column(c).to_pylist() for c in ("tree", "size", "index", "digest"))):
            if now != (tree, size, index >> BITS * HEIGHT):
                if now:
                    close()
                now = (tree, size, index >> BITS * HEIGHT)
                open_, log = [[] for _ in range(1 + min(HEIGHT, height(size) - base))], []
            open_[0].append(node.hex().encode())
            log.append(open_[0][-1])
            level = 1
            while level < len(open_) and len(open_[level - 1]) == FAN:
                parent(level, index >> BITS * level)
                level += 1
        yield made()
    if now:
        close()
    yield made()


def append_log(nodes: DataFrame) -> DataFrame:
    """The log of numbered leaves (tree, size, index, digest): tree, size, level, index, first (position), digests (32 bytes a node).

    One round of builders per HEIGHT levels of the largest tree. No leaves: no rows."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    made, base, level = None, 0, nodes.select("tree", "size", "index", "digest")
    while made is None or base < height(most):
        block = F.shiftright("index", BITS * HEIGHT)
        grown = settled(level.repartition(tasks(nodes), "tree", block).sortWithinPartitions("tree", "index").mapInArrow(
            lambda batches, base=base: append(batches, base), LOG))
        made = grown if made is None else made.union(grown)
        base += HEIGHT
        level = grown.where(F.col("level") == base).where(F.expr(f"{height_sql('size')} > {base}")).select(
            "tree", "size", "index", F.col("digests").alias("digest"))
    return made


def roots(log: DataFrame) -> DataFrame:
    """(tree, size, root): the last node of each tree's log."""
    return log.where("level >= 0").where(F.expr(f"level = {height_sql('size')}")).select("tree", "size", F.col("digests").alias("root"))


def paths_above(log: DataFrame) -> DataFrame:
    """(tree, size, block, steps): the siblings above each builder over leaves, as pairs (left, right) of hex text in order of level.

    The first builder below a node asks for it, at its position in the log; the nodes of a run are gathered once, and every builder
    below a run takes it."""
    top = height_sql("size")
    blocks = log.where("level >= 0").where(F.expr(f"level = least({HEIGHT}, {top})")).select("tree", "size", F.col("index").alias("block"))
    steps = blocks.withColumn("at", F.expr(f"explode_outer(CASE WHEN {top} > {HEIGHT} THEN sequence({HEIGHT}, {top} - 1) END)")).withColumn(
        "node", F.expr(f"shiftright(block, {BITS} * (at - {HEIGHT}))"))
    steps = settled(steps)
    asked = steps.where(F.expr(f"shiftleft(node, {BITS} * (at - {HEIGHT})) = block")).withColumn("first", F.expr(position_sql("at", "node", "size")))
    run = F.shiftright("node", BITS).alias("run")
    runs = settled(asked.join(log.where("level >= 0").select("tree", "first", "digests"), ["tree", "first"]).groupBy("tree", "at", run).agg(
        F.array_sort(F.collect_list(F.struct("node", F.lower(F.hex("digests")).alias("h")))).alias("nodes")))
    side = "array_join(transform(filter(nodes, x -> x.node {} node), x -> x.h), '')"
    step = F.struct("at", F.expr(side.format("<")).alias("l"), F.expr(side.format(">")).alias("r"))
    return steps.withColumn("run", run).join(runs, ["tree", "at", "run"], "left").groupBy("tree", "size", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), step))), lambda x: F.struct(x.l.alias("l"), x.r.alias("r"))).alias("steps"))


STEPS = "array<struct<l:string,r:string>>"


def paths(rows: DataFrame, log: DataFrame, keep, run, schema: str, above: DataFrame | None = None) -> DataFrame:
    """`run` over sorted rows: of each builder first one (index -1) with its segment, the steps above it and its tree's root, then its
    leaves in order, with the columns `keep`. `above` (tree, upper) has more steps, from a tree's root on."""
    block = F.shiftright("index", BITS * HEIGHT)
    heads = paths_above(log).join(log.where("level = -1").select("tree", F.col("index").alias("block"), "digests"), ["tree", "block"], "left").join(
        roots(log).drop("size"), "tree")
    if above is not None:
        heads = heads.join(above, "tree").withColumn("steps", F.concat("steps", "upper"))
    heads = heads.select("tree", "size", "block", F.lit(-1).cast("long").alias("index"), "digests", "steps", "root",
                         *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in keep])
    own = rows.select("tree", "size", block.alias("block"), "index", F.lit(None).cast("binary"), F.lit(None).cast(STEPS), F.lit(None).cast("binary"), *keep)
    return heads.union(own).repartition(tasks(rows), "tree", "block").sortWithinPartitions("tree", "block", "index").mapInArrow(run, schema)


class Segment:
    """The nodes of one builder over leaves, read by their closed-form positions."""

    def __init__(self, size: int, block: int, digests: bytes | None, above, root: bytes):
        self.size, self.first, self.root = size, position(0, block << BITS * HEIGHT, size), root.hex()
        self.digests, self.above = (digests or b"").hex().encode(), [(s["l"].encode(), s["r"].encode()) for s in above]
        self.levels, self.runs = min(HEIGHT, height(size)), {}

    def run(self, level: int, run: int) -> bytes:
        """Hex text of the up to FAN nodes of a run."""
        found = self.runs.get((level, run))
        if found is None:
            last = min((run + 1) << BITS, -(-self.size >> BITS * level))
            at = [position(level, i, self.size) - self.first for i in range(run << BITS, last)]
            found = self.runs[level, run] = b"".join(self.digests[2 * DIGEST * p:2 * DIGEST * (p + 1)] for p in at)
        return found

    def path(self, index: int):
        """Pairs (left siblings, right siblings) from the leaf up."""
        out = []
        for level in range(self.levels):
            node = index >> BITS * level
            run, slot = self.run(level, node >> BITS), (node & (FAN - 1)) * 2 * DIGEST
            out.append((run[:slot], run[slot + 2 * DIGEST:]))
        return out + self.above


def fold(node: bytes, path) -> bytes:
    """The root that a leaf (hex text) and its siblings give."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def walked(batches, columns):
    """Per batch, (segment, path, values of `columns`) of the leaf rows of `paths`."""
    segment = None
    for batch in batches:
        out = []
        lists = [batch.column(c).to_pylist() for c in ("size", "block", "index", "digests", "steps", "root", *columns)]
        for size, block, index, digests, steps, root, *values in zip(*lists):
            if index < 0:
                segment = Segment(size, block, digests, steps, root)
            else:
                out.append((segment, segment.path(index), values))
        yield out


def subtree_paths(top: DataFrame, top_log: DataFrame) -> DataFrame:
    """(tree, upper): siblings of each subroot up to the root."""
    pair = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))

    def run(batches):
        for rows in walked(batches, ["name"]):
            steps = [[{"l": left.decode(), "r": right.decode()} for left, right in path] for _, path, _ in rows]
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for *_, v in rows], pa.string()), pa.array(steps, pair)], names=["tree", "upper"])

    return paths(top, top_log, ["name"], run, f"tree string, upper {STEPS}")


def manifest(docs: DataFrame):
    """(numbered leaves, log of the sources' trees, numbered subroots, log of the tree over them).

    Leaves of a source ascend by doc_id (null first), rows that share one by their leaf; subroots ascend by source, null first."""
    rows = settled(numbered(settled(leaves(docs)), "doc_id", "leaf"))
    log = append_log(rows.withColumn("digest", F.col("leaf")))
    subroots = roots(log).select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    top = settled(numbered(settled(subroots), "name"))
    return rows, log, top, append_log(top)


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of docs.

    Null columns are `-` in the leaf; a null doc_id is never altered; repeated rows are leaves of their own. No documents: no rows."""
    rows, log, top, top_log = manifest(docs)
    found = roots(top_log).first()
    root = found and found.root.hex()
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    schema = pa.schema([(n, pa.int64() if n == "doc_id" else pa.bool_() if n == "verified" else pa.string()) for n in names])

    def run(batches):
        for part in walked(batches, ["doc_id", "leaf", "altered"]):
            out = []
            for segment, path, (doc, leaf, altered) in part:
                got = fold((leaf if altered is None else altered).hex().encode(), path).decode()
                proof = hashlib.sha256(b"".join([side for step in path for side in step])).hexdigest()
                out.append((doc, leaf.hex(), segment.root, root, proof, got, got == root))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    above = settled(subtree_paths(top, top_log))
    return paths(rows, log, ["doc_id", "leaf", "altered"], run,
                 "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", above)
