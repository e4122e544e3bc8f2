"""SentencePiece encoding (BPE models) that keeps offsets, and decoding.

Normalisation goes through the model's compiled character map, a double array of byte strings: at each place the longest key there is
replaced, else one character stays as it is. Every normalised byte records the source byte at which it came about, so the ends of a
piece, counted in normalised bytes, project to a span of the original text.

Merging takes the best scored pair of neighbours, the leftmost of equals, until no pair is a piece. No piece of the vocabulary has white
space behind other characters, so no merge crosses the start of a word; words are merged on their own and kept in a bounded
table, which only saves time. A vocabulary that has such pieces is merged text by text.
"""
import hashlib
import heapq
import re
import struct
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import Kept, slices, text_of

# Numbers of the fields and kinds of the model file, and the mark that stands for a space.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
SPACE = "▁"
SHORT = 64
NONE = float("inf")


def messages(data: bytes):
    """(field, value) of a serialized message: whole numbers, or bytes."""
    at = 0

    def number():
        nonlocal at
        shift = out = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, data[at:at + size]
            at += size


class CharMap:
    """A compiled character map: the length of its double array, the array, and the replacements, each ended by a zero."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.replaced = blob[4 + size:]
        firsts = [b for b in range(1, 256) if self.units and self.step(self.start(), b)]
        self.first = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in firsts) + b"]") if firsts else None

    def start(self):
        return self.offset(self.units[0])

    @staticmethod
    def offset(unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    def step(self, place, byte):
        """(place behind a byte, whether a key ends there), or nothing."""
        unit = self.units[place ^ byte]
        if unit & 0x800000FF == byte:
            return place ^ byte ^ self.offset(unit), unit & 256

    def longest(self, text: bytes, at: int):
        """(length, replacement) of the longest key at a place, or nothing."""
        place, found, n = self.start(), None, at
        while n < len(text) and (step := self.step(place, text[n])):
            place, ends = step
            n += 1
            if ends:
                found = n - at, self.units[place] & 0x7FFFFFFF
        if found:
            return found[0], self.replaced[found[1]:self.replaced.index(b"\0", found[1])]

    def mapped(self, text: bytes):
        """(mapped bytes, the source byte of each)."""
        if self.first is None:
            return text, np.arange(len(text))
        out, origin, at = [], [], 0
        while hit := self.first.search(text, at):
            start = hit.start()
            found = self.longest(text, start)
            if not found:
                stop = start + 1
                while stop < len(text) and text[stop] & 0xC0 == 0x80:
                    stop += 1
                out.append(text[at:stop])
                origin.append(np.arange(at, stop))
                at = stop
                continue
            out += [text[at:start], found[1]]
            origin += [np.arange(at, start), np.full(len(found[1]), start)]
            at = start + found[0]
        return b"".join([*out, text[at:]]), np.concatenate([*origin, np.arange(at, len(text))])


class Pieces:
    """Encoder and decoder of a model file. Models with user-defined or unused pieces, of other kinds, or with white space as a
    suffix are refused."""

    def __init__(self, model: bytes):
        parts = list(messages(model))
        self.pieces, self.kinds, self.scores = [], [], []
        for own in (dict(messages(value)) for field, value in parts if field == 1):
            self.pieces.append(own.get(1, b"").decode())
            self.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            self.kinds.append(own.get(3, NORMAL))
        trainer, norm = (dict(messages(dict(parts).get(k, b""))) for k in (2, 3))
        if trainer.get(3, 1) != BPE or trainer.get(24) or not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a BPE model of plain pieces")
        self.unknown, self.unknown_says = self.kinds.index(UNKNOWN), trainer.get(44, " ⁇ ".encode())
        self.map = CharMap(norm.get(2, b""))
        self.prefix, self.tidy, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.id = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.reserved = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k != NORMAL}
        self.sizes, self.says = [len(p.encode()) for p in self.pieces], [p.replace(SPACE, " ") for p in self.pieces]
        self.decimal = [str(i) for i in range(len(self.pieces))]
        self.rank = {p: -self.scores[i] for p, i in self.id.items()}
        bytes_ = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte = [bytes_[f"<0x{b:02X}>"] for b in range(256)] if trainer.get(35) else None
        self.byte_of = {i: int(p[3:5], 16) for p, i in bytes_.items()}
        crossing = SPACE not in self.id or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id)
        self.split = re.compile(".+" if crossing else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)
        self.kept = Kept(self.word, 300_000)

    def normalise(self, text: bytes):
        """(normalised text, the source byte of each of its bytes and, last, of its end)."""
        data, origin = self.map.mapped(text)
        end, lead = len(text), 0
        if self.tidy:
            blank = np.frombuffer(data, np.uint8) == 32
            stay = np.flatnonzero(~blank)
            if not len(stay):
                return "", np.zeros(1, np.int64)
            lead = int(origin[stay[0]])
            if stay[-1] + 1 < len(data):
                end = int(origin[stay[-1] + 1])
            keep = ~blank | np.append(False, ~blank[:-1])
            keep[stay[-1] + 1:] = False
            data, origin = np.frombuffer(data, np.uint8)[keep].tobytes(), origin[keep]
        if not data:
            return "", np.zeros(1, np.int64)
        if self.escape:
            origin = np.repeat(origin, np.where(np.frombuffer(data, np.uint8) == 32, 3, 1))
        mark = (SPACE if self.escape else " ") * self.prefix
        said = data.decode().replace(" ", SPACE) if self.escape else data.decode()
        return mark + said, np.concatenate([np.full(len(mark.encode()), lead), origin, [end]])

    def merged(self, text: str):
        """The symbols of a text after all merges."""
        parts = list(text)
        if len(parts) > SHORT:
            return self.merged_long(parts)
        rank = self.rank.get
        ranks = [rank(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NONE:
            at = ranks.index(least)
            made = parts[at] + parts.pop(at + 1)
            parts[at] = made
            ranks.pop(at)
            if at:
                ranks[at - 1] = rank(parts[at - 1] + made, NONE)
            if at < len(ranks):
                ranks[at] = rank(made + parts[at + 1], NONE)
        return parts

    def merged_long(self, parts):
        """The same merges in the same order, found by a heap."""
        n = len(parts)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i):
            j = after[i]
            if j < n and (found := self.rank.get(parts[i] + parts[j])) is not None:
                heap.append((found, i, j, len(parts[i]) + len(parts[j])))
                return True

        for i in range(n - 1):
            offer(i)
        heapq.heapify(heap)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if parts[i] is None or after[i] != j or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and offer(k):
                    heapq.heappush(heap, heap.pop())
        return [p for p in parts if p is not None]

    def word(self, text: str):
        """Of a normalised word: ids and lengths in its bytes (both packed, 4 bytes each), ids as decimal text, and what the ids decode
        to. A character without piece becomes its bytes, of which the last carries the length."""
        parts = self.merged(text)
        ids = list(map(self.id.get, parts))
        if None not in ids:
            sizes, says = [self.sizes[i] for i in ids], "".join([self.says[i] for i in ids]).encode()
        else:
            ids, sizes = [], []
            for part in parts:
                found, size = self.id.get(part), len(part.encode())
                if found is None:
                    found = self.reserved.get(part, self.unknown)
                if found == self.unknown and self.byte:
                    ids += [self.byte[b] for b in part.encode()]
                    sizes += [0] * (size - 1)
                else:
                    ids.append(found)
                sizes.append(size)
            says = self.surface(ids)
        return array("I", ids).tobytes(), array("I", sizes).tobytes(), ",".join([self.decimal[i] for i in ids]), says

    def encode(self, text: str):
        """(ids, begins, ends, decimal ids joined by commas, decoded text as bytes): spans are bytes of the original text."""
        said, origin = self.normalise(text.encode())
        none = np.zeros(0, np.int64)
        if not said:
            return none, none, none, "", b""
        ids, sizes, decimal, says = zip(*map(self.kept.__getitem__, self.split.findall(said)))
        end = origin[np.cumsum(np.frombuffer(b"".join(sizes), "<u4"))]
        ids = np.frombuffer(b"".join(ids), "<u4")
        return ids, np.append(origin[0], end[:-1]), end, ",".join(decimal), self.from_start(ids, b"".join(says))

    def surface(self, ids) -> bytes:
        """The bytes that ids say inside a text; sequences of byte pieces that are no characters give one U+FFFD a byte."""
        out, held = [], bytearray()

        def characters():
            at = 0
            while at < len(held):
                size = next((n for n in range(1, 5) if is_character(held[at:at + n])), 0)
                out.append(bytes(held[at:at + size]) if size else b"\xef\xbf\xbd")
                at += size or 1
            held.clear()

        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                held.append(self.byte_of[i])
                continue
            characters()
            if kind == UNKNOWN:
                out.append(self.unknown_says)
            elif kind != CONTROL:
                out.append(self.says[i].encode())
        characters()
        return b"".join(out)

    def from_start(self, ids, says: bytes) -> bytes:
        """`surface` of a whole text: without the mark of its start."""
        first = next((self.pieces[i] for i in ids[:64] if self.kinds[i] != CONTROL), "")
        if not (self.prefix or self.tidy) or not first.startswith(SPACE):
            return says
        return says.lstrip(b" ") if self.tidy else says[1:]

    def decode(self, ids) -> str:
        return self.from_start(ids, self.surface(ids)).decode()


def is_character(data) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """One encoder per worker process, whatever the number of tasks."""
    with open(path, "rb") as f:
        return Pieces(f.read())


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, begins, ends, decoded: one row per row of docs, with the span of original UTF-8 bytes of every piece.

    Null and empty texts have no pieces; repeated rows give repeated rows."""
    def run(batches):
        own = pieces(path)
        for batch in slices(batches, 64):
            made = [own.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.int64())),
                pa.array([m[2] for m in made], pa.list_(pa.int64())), pa.array([m[4].decode() for m in made], pa.string())],
                names=["doc_id", "ids", "begins", "ends", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, begins array<long>, ends array<long>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256 (of begin and end of every piece, 8 bytes each, little-endian), as `encoded`."""
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")
    schema = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in names])

    def run(batches):
        own = pieces(path)
        hexed = lambda data: hashlib.sha256(data).hexdigest()
        for batch in slices(batches, 256):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids, begin, end, decimal, said = own.encode(text)
                rows.append((doc, len(ids), hexed(decimal.encode()), hexed(said), hexed(np.stack([begin, end], 1).astype("<i8").tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
