"""The Merkle manifest against plain code: positions, roots, proofs and tampering."""
import hashlib
import zlib
from itertools import groupby

import pytest

from opsloom.llm import merkle

DOC = "doc_id long, source string, lang string, n_chars long, text string, tree string, index long, size int"


def h(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, index):
    out = []
    for level in tree[:-1]:
        lo = index // 16 * 16
        run = level[lo:lo + 16]
        out.append((run[:index - lo], run[index - lo + 1:]))
        index //= 16
    return out


def plain(rows):
    """Rows as the operator returns them."""
    def leaf(row, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))

    lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    by_source = lambda r: (r[1] is not None, (r[1] or "").encode())
    trees = [sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for _, g in groupby(sorted(rows, key=by_source), by_source)]
    built = [levels([leaf(r, r[4]) for r in t]) for t in trees]
    top = levels([b[-1][0] for b in built])
    out = []
    for k, (tree, made) in enumerate(zip(trees, built)):
        for i, r in enumerate(tree):
            path = siblings(made, i) + siblings(top, k)
            node = leaf(r, lower(r[4]) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4])
            for left, right in path:
                node = h("".join([*left, node, *right]))
            proof = h("".join(x for s in path for side in s for x in side))
            out.append((r[0], leaf(r, r[4]), made[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 31, 32, 33, 255, 256, 257, 272, 273, 300, 4096, 4097, 4113, 5000, 70000])
def test_positions_are_the_order_of_completion(size, spark):
    log, open_ = [], [[] for _ in range(merkle.height(size) + 1)]
    counts = [0] * len(open_)

    def add(level):
        log.append((level, counts[level]))
        counts[level] += 1
        open_[level].append(1)

    for _ in range(size):
        add(0)
        level = 0
        while level + 1 < len(open_) and len(open_[level]) == 16:
            open_[level] = []
            level += 1
            add(level)
    for level in range(len(open_) - 1):
        if open_[level]:
            add(level + 1)
    assert len(open_[-1]) == 1
    assert [merkle.position(*node, size) for node in log] == list(range(len(log)))
    some = log[:3] + log[-40:]
    frame = spark.createDataFrame([(l, i, size) for l, i in some], "l int, i long, n long")
    got = frame.selectExpr(f"{merkle.position_sql('l', 'i', 'n')} AS p", f"{merkle.height_sql('n')} AS h").collect()
    assert [r.p for r in got] == [merkle.position(*node, size) for node in some] and {r.h for r in got} == {merkle.height(size)}


@pytest.mark.parametrize("hot, others", [(0, 0), (1, 0), (16, 1), (700, 40), (4400, 3)])
def test_proofs(spark, hot, others):
    rows = [(i * 7 % 100003, "Hot", "en", i, f"Text {i} É") for i in range(hot)]
    rows += [(i, f"s{i}" if i % 3 else None, None, None, None if i % 5 == 0 else "Ab" * i) for i in range(others)]
    if others > 3:
        rows += [(None, "Hot", "de", 1, "X"), (5, "Hot", "", 0, ""), (5, "Hot", "", 0, ""), (5, "", "", 0, "Long " * 100000), (None, None, None, None, None)]
    frame = spark.createDataFrame([(*r, "t", 3, 4) for r in rows], DOC).repartition(7)
    got = sorted([tuple(r) for r in merkle.proofs(frame).collect()], key=str)
    assert got == plain(rows)
    if hot > 100:
        assert not all(r[6] for r in got) and any(r[6] for r in got)


def test_log_holds_every_node_once(spark):
    rows = [(i, "a" if i < 600 else "b", "en", 1, f"t{i}") for i in range(1300)]
    _, log, _, _ = merkle.manifest(spark.createDataFrame([(*r, "t", 3, 4) for r in rows], DOC))
    for tree, size in (("=a", 600), ("=b", 700)):
        places = sorted(p for r in log.where(f"tree = '{tree}'").collect() for p in range(r.first, r.first + len(r.digests) // 32))
        assert places == list(range(merkle.position(merkle.height(size), 0, size) + 1))
