"""Toxicity of deobfuscated texts.

A noisy channel turns words into look-alikes: letters become digits or signs, are repeated, or are set apart by spaces
or signs. A word that shows such marks becomes a lattice of characters (what each sign may stand for, with the cost of
that substitution; a run of one letter may be one or two of them; what stands between single letters may be nothing or a space), and a
Viterbi pass finds the path that a character trigram model of the corpus likes best. Plain words have one path, so they
are left as they are. The model's counts come from all documents. The restored words are then scored.

The classifier is logistic over the evidence of words and of their beginnings. A feature weighs its smoothed log-odds among
labelled documents, near copies of one toxic document counting once, so that words of a copied document get no weight.
A document counts its strongest words.
"""
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import settled, slices, text_of

SAMPLE = 10_000
TOGETHER = 200_000
LEAST = 5
THRESHOLD = 0.7
SLOTS = 64
COPY = 0.8
# An odd multiplier per slot.
ODD = np.array([xxhash.xxh64_intdigest(b"%d" % i, 1) | 1 for i in range(SLOTS)], np.uint64)
SYMBOLS = 64
# Signs and the letters they are drawn like.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h", "€": "e", "£": "l",
}
ALPHABET = " abcdefghijklmnopqrstuvwxyzßàáâäæçèéêëìíîïñòóôöœùúûüÿ"
SUBSTITUTE, DROP, DROP_DIGIT, SHRINK, KEEP_SIGN, KEEP_SPACE, KEEP_END, HALVE, HALVE_ALL = -1.0, -5.0, -9.0, -0.5, -9.0, -2.5, -4.0, -6.0, -1.0
BELIEF = 3.0
LETTER = "a-zß-öø-ÿœ"
SIGN = re.escape("".join(LOOKALIKES))
WORD = re.compile(r"[^\W_]+")  # of any script
BETWEEN = f"(?:[^\\w{SIGN}]|_)"
# Single letters or signs set apart by anything else, or a word with a look-alike sign or the same letter twice. Both have letters.
MARKED = re.compile(
    f"(?<![{LETTER}{SIGN}])(?:[{LETTER}{SIGN}](?:{BETWEEN}+[{LETTER}{SIGN}]){{2,}}(?![{LETTER}{SIGN}])"
    f"|(?=[{SIGN}]*[{LETTER}])(?=[{LETTER}]*[{SIGN}]|[{LETTER}]*([{LETTER}])\\1)[{LETTER}{SIGN}]{{3,}})")
RUN = re.compile(r"(.)\1*", re.S)
HAS_LETTER = re.compile(f"[{LETTER}]")
# Signs that also end plain words.
ENDS = "!|+(*#"
# Longer words are not remembered.
SHORT = 64


def code_of():
    """Symbol number by code point below 512; other characters count as a space."""
    table = np.zeros(512, np.uint8)
    for i, c in enumerate(ALPHABET):
        if ord(c) < 512:
            table[ord(c)] = i
    return table


TABLE = code_of()


def trigram_counts(text: str) -> np.ndarray:
    """Counts of symbol triples of a lower-cased text."""
    code = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), "<u2")
    symbol = np.concatenate([[0, 0], TABLE[np.where(code < 512, code, 0)].astype(np.int32), [0]])
    return np.bincount((symbol[:-2] << 12) | (symbol[1:-1] << 6) | symbol[2:], minlength=SYMBOLS ** 3)


class CharModel:
    """Smoothed log-probabilities of a character after two others."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        pair = c.sum(2)
        single = c.sum((0, 1))
        p1 = (single + 1) / (single.sum() + SYMBOLS)
        p2 = (c.sum(0) + 5 * p1) / (c.sum(0).sum(1, keepdims=True) + 5)
        self.log = np.log((c + 5 * p2[None]) / (pair[..., None] + 5)).tolist()
        self.number = {ch: i for i, ch in enumerate(ALPHABET)}
        self.restore = lru_cache(maxsize=100_000)(self._restore)

    def __getstate__(self):
        return self.log

    def __setstate__(self, log):
        self.log, self.number = log, {ch: i for i, ch in enumerate(ALPHABET)}
        self.restore = lru_cache(maxsize=100_000)(self._restore)

    def lattice(self, word: str):
        """Per position the choices (letters, cost); letters may be empty or two."""
        runs = [len(m[0]) for m in RUN.finditer(word)]
        halve = HALVE_ALL if 2 * sum(n > 1 for n in runs) > len(runs) else HALVE
        out, i = [], 0
        while i < len(word):
            c, n = word[i], 1
            while i + n < len(word) and word[i + n] == c:
                n += 1
            i += n
            if c not in LOOKALIKES and c not in self.number or c == " ":
                while i < len(word) and (word[i] == " " or word[i] not in LOOKALIKES and word[i] not in self.number):
                    i += 1
                out.append([("", 0.0), (" ", KEEP_SPACE)])
            elif c in LOOKALIKES:
                once = [(x, SUBSTITUTE + SHRINK * 3 * (n > 1)) for x in LOOKALIKES[c]]
                twice = [(x + x, 2 * SUBSTITUTE) for x in LOOKALIKES[c]] if n > 1 else []
                ends = i == len(word) and c in ENDS
                out.append([*once, *twice, ("", DROP_DIGIT if c.isdigit() else DROP), (" ", KEEP_END if ends else KEEP_SIGN)])
            elif n == 1:
                out.append([(c, 0.0)])
            elif n == 2:
                out.append([(c + c, 0.0), (c, halve)])
            else:
                out.append([(c, SHRINK), (c + c, SHRINK)])
        return out

    def _restore(self, word: str) -> str:
        """The most likely plain word behind a marked one."""
        paths = {(0, 0): (0.0, None)}
        for choices in self.lattice(word):
            after = {}
            for (a, b), (score, behind) in paths.items():
                for letters, cost in choices:
                    x, y, s = a, b, score + cost
                    for ch in letters:
                        z = self.number[ch]
                        s += self.log[x][y][z]
                        x, y = y, z
                    if (x, y) not in after or s > after[x, y][0]:
                        after[x, y] = (s, (behind, letters))
            paths = after
        behind, out = max((s + self.log[a][b][0], n, b_) for n, ((a, b), (s, b_)) in enumerate(paths.items()))[2], []
        while behind:
            behind, letters = behind
            out.append(letters)
        return "".join(reversed(out))

    def words(self, text: str):
        """Different words of the restored text."""
        return set(WORD.findall(self.deobfuscated(text)))

    def deobfuscated(self, text: str) -> str:
        """Lower-cased text with marked words restored."""
        def plain(m):
            word = m[0]
            return word if not HAS_LETTER.search(word) else self.restore(word) if len(word) <= SHORT else self._restore(word)

        return MARKED.sub(plain, text.lower())


def features_of(word: str):
    """A word's beginnings, from the shortest, and the word."""
    return [word[:n] + "^" for n in range(4, min(len(word), 10))] + [word]


def features(words):
    return {f for w in words for f in features_of(w)}


def sketch(text: str):
    """SLOTS min-hashes of word pairs, for telling near copies in the sample."""
    words = text.split()
    hashes = np.array(list({xxhash.xxh64_intdigest(f"{a} {b}") for a, b in zip(words, words[1:])} or {xxhash.xxh64_intdigest(text)}), np.uint64)
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[start:start + 4096, None] * ODD).min(0))
    return least.view(np.int64).tolist()


def copies(sketches) -> list:
    """Group number of each sketch. A group is one sketch and those that agree with it, not merely with one another, in at
    least COPY of their slots, which is the share of common word pairs that they estimate."""
    own = np.array(sketches, np.int64).reshape(len(sketches), SLOTS)
    group, heads = np.zeros(len(own), np.int64), np.zeros_like(own)
    n = 0
    for i in sorted(range(len(own)), key=lambda i: sketches[i]):
        same = (heads[:n] == own[i]).sum(1)
        best = int(same.argmax()) if n else 0
        if n and same[best] >= COPY * SLOTS:
            group[i] = best
        else:
            heads[n], group[i] = own[i], n
            n += 1
    return group.tolist()


def fitted(x: np.ndarray, y: np.ndarray):
    """Coefficients of a logistic curve (the last is the intercept), by Newton steps with a light prior."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    w[-1] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, x.T @ (y - p) - 0.1 * w), -2, 2)
    return w.tolist()


def odds_by_prefix(toxic: dict, clean: dict, n_toxic: int, n_clean: int):
    """Log-odds of features; each is drawn, by BELIEF observations, to what its longest shorter beginning says."""
    base = n_toxic / (n_toxic + n_clean)
    share = {}
    for f in sorted(toxic, key=lambda f: len(f) if f.endswith("^") else len(f) + 100):
        stem = f.rstrip("^")
        parent = next((share[p] for n in range(len(stem) - (f.endswith("^")), 3, -1) if (p := stem[:n] + "^") in share and p != f), base)
        t, c = toxic[f] + BELIEF * parent, clean[f] + BELIEF * (1 - parent)
        share[f] = t / (t + c)
    return {f: math.log(s / (1 - s)) - math.log(base / (1 - base)) for f, s in share.items()}


def held_out(doc_id):
    """True where crc32 of the id as text leaves 1 when divided by 3; such labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of all documents. A task gives one row per triple it has seen (at most 64**3), the sum is as small."""
    def count(batches):
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in slices(batches, 512):
            total += trigram_counts("\n".join(batch.column("text").to_pylist()))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["triple", "n"])

    rows = docs.select(text_of().alias("text")).mapInArrow(count, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    out = np.zeros(SYMBOLS ** 3, np.int64)
    for r in rows.toLocalIterator():
        out[r.triple] = r.n
    return out


def learn(docs: DataFrame, labels: DataFrame, model, sample: int = SAMPLE):
    """(weights, curve): from at most `sample` labelled documents, the ones whose id hashes lowest.

    Labels of held-out documents are not read. An id with several labels counts as toxic if any says so; of rows that repeat an id the text
    with the least hash is learnt from, so the sample has one row per id.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id")).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = settled(rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).drop("doc_id"))

    def seen(batches):
        found = {}
        for batch in slices(batches, 64):
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                for f in [*features(model.value.words(text)), ""]:
                    found[f, toxic] = found.get((f, toxic), 0) + 1
            if len(found) > TOGETHER:
                yield put(found)
                found = {}
        yield put(found)

    def put(found):
        return pa.RecordBatch.from_arrays([
            pa.array([f for f, _ in found], pa.string()), pa.array([n if t == 1 else 0 for (_, t), n in found.items()], pa.int64()),
            pa.array([0 if t == 1 else n for (_, t), n in found.items()], pa.int64())], names=["feature", "t", "c"])

    by_feature = settled(rows.mapInArrow(seen, "feature string, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    total = by_feature.where("feature = ''").first()
    n_t, n_c = (total.t, total.c) if total else (0, 0)
    if not n_t or not n_c:
        return {}, [0.0, 0.0, -3.0]
    top = by_feature.where((F.col("feature") != "") & (F.col("t") >= LEAST) & ((F.col("t") + 0.5) / (n_t + 1) > 5 * (F.col("c") + 0.5) / (n_c + 1)))
    clean = {r.feature: r.c for r in top.collect()}  # at most the words of the sample

    def held(batches):
        for batch in slices(batches, 64):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([[f for f in features(model.value.words(t)) if f in clean] for t in texts], pa.list_(pa.string())),
                pa.array([sketch(t) for t in texts], pa.list_(pa.int64()))], names=["found", "sketch"])

    toxic = rows.where("toxic = 1").select("text").mapInArrow(held, "found array<string>, sketch array<long>").collect()
    group, by_group = copies([r.sketch for r in toxic]), {}
    for g, r in zip(group, toxic):
        for f in r.found:
            by_group.setdefault(f, set()).add(g)
    n_g = len(set(group))
    usual = {f: len(g) for f, g in by_group.items() if len(g) >= max(LEAST, 0.004 * n_g)}
    weights = {f: w for f, w in odds_by_prefix(usual, clean, n_g, n_c).items() if w > 1.5}

    def measured(batches):
        kept = {}
        for batch in slices(batches, 64):
            made = [evidence(t, model.value, weights, kept) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int64()), pa.array([e for e, _ in made]), pa.array([n for _, n in made])], names=["toxic", "x", "size"])

    known = rows.mapInArrow(measured, "toxic long, x double, size double").toPandas()
    return weights, fitted(known[["x", "size"]].to_numpy(), (known.toxic == 1).to_numpy().astype(float))


def evidence(text: str, model: CharModel, weights: dict, kept: dict):
    """(the three strongest pieces of evidence of different words, in log-odds, the second and third at a discount;
    logarithm of the number of different words)."""
    best, words = [], model.words(text)
    for w in words:
        s = kept.get(w)
        if s is None:
            if len(kept) > 400_000:
                kept.clear()
            s = kept[w] = next((weights[f] for f in reversed(features_of(w)) if f in weights), 0.0)
        if s:
            best.append(s)
    return float(sum(x / 2 ** i for i, x in enumerate(sorted(best, reverse=True)[:3]))), math.log1p(len(words))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text_hash, held_out, score, predicted) of every document.

    Null texts are empty; empty texts have the lowest score. Without labels of both kinds nothing is predicted toxic.
    Repeated rows give repeated rows; labels of absent documents are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(CharModel(char_counts(docs)))
    weights, curve = learn(docs, labels, model)

    def score(batches):
        kept = {}
        for batch in slices(batches, 256):
            made = np.array([(*evidence(t, model.value, weights, kept), 1.0) for t in batch.column("text").to_pylist()])
            odds = np.clip(made @ np.array(curve), -30, 30)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(1 / (1 + np.exp(-odds)))],
                                             names=["doc_id", "text_hash", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    scored = rows.mapInArrow(score, "doc_id long, text_hash long, score double")
    return scored.select("doc_id", "text_hash", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
