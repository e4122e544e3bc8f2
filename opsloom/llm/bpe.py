"""Byte-pair encoding with a contiguous rank array, and byte-level token ids.

A word is held as two short arrays: its parts and the rank of each pair of neighbours. The smallest rank is found by a
scan, the boundary there is deleted, and the ranks on both sides are looked up anew. Words of more than SHORT parts
use a heap of the same (rank, place) order instead, so one very long word costs n log n. Words repeat, so the ids of a
word are kept in a bounded table; the table only saves time.
"""
import hashlib
import heapq
import json
import re
import struct
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from opsloom.llm.common import Kept, slices, text_of

SHORT = 256
NO_RANK = 1 << 60
# Code points of Latin-1 letters, numbers and white space, for texts that hold no others.
LATIN_L, LATIN_N, LATIN_S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\\x09-\\x0d \\x85\\xa0"
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"


def byte_symbols():
    """The printable symbol that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder of a tokenizer file whose model is BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.suffix] for s in symbols]
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.latin = re.compile(WORDS.format(L=LATIN_L, N=LATIN_N, S=LATIN_S))
        self.normalizer = Tokenizer.from_file(path).normalizer
        split = next(s for s in spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]]) if s["type"] == "Split")
        self.any = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=split["invert"])
        self.kept = Kept(self.word)

    def merge(self, word: bytes):
        """Ids of one word."""
        parts = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        if len(parts) > SHORT:
            return self.merge_long(parts)
        none = (NO_RANK, 0)
        look = self.merges.get
        pairs = [look(p, none) for p in zip(parts, parts[1:])]
        ranks = [r for r, _ in pairs]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            parts[at] = self.merges[parts[at], parts[at + 1]][1]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = look((parts[at - 1], parts[at]), none)[0]
            if at < len(ranks):
                ranks[at] = look((parts[at], parts[at + 1]), none)[0]
        return parts

    def merge_long(self, parts):
        """The same merges in the same order, found by a heap."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = after[i]
            if j < n and (found := self.merges.get((parts[i], parts[j]))):
                heapq.heappush(heap, (found[0], i, parts[i], parts[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = made, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def word(self, word: str):
        """(ids as little-endian unsigned 32-bit integers, decoded tokens) of one word."""
        ids = self.merge(word.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed, self.decode(packed)

    def words(self, text: str):
        """Lower-cased, composed text cut into words; control strings of the vocabulary stay whole. What is not Latin-1 is composed, lower-cased
        and split as the library does, whatever Unicode version it follows."""
        try:
            text.encode("latin-1")
            return self.latin.findall(text.lower())
        except UnicodeEncodeError:
            return [piece for piece, _ in self.any.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def encode_decode(self, text: str):
        """Ids (packed, 4 bytes each) and the text that they decode to."""
        if "<|" in text and self.split_special.search(text):
            packed, said = [], []
            for piece in self.split_special.split(text):
                if piece in self.special:
                    packed.append(self.special[piece].to_bytes(4, "little"))
                    said.append(piece)
                elif piece:
                    ids, decoded = self.encode_decode(piece)
                    if ids:
                        packed.append(ids)
                        said.append(decoded)
            return b"".join(packed), " ".join(said)
        found = list(map(self.kept.__getitem__, self.words(text)))
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found])

    def decode(self, packed: bytes):
        """Tokens joined by spaces, as a tokenizer file without decoder says."""
        return " ".join(self.tokens[i] for i in memoryview(packed).cast("I"))


@lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    """One encoder per worker process, whatever the number of tasks."""
    return WordBpe(path)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode whole texts: doc_id, n_tokens, ids_sha256, decoded_sha256, one row per row of docs.

    Null texts are empty and have no tokens; repeated rows give repeated rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        bpe = word_bpe(path)
        for batch in slices(batches, 256):
            rows = [bpe.encode_decode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(ids) // 4 for ids, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in rows]),
                pa.array([hashlib.sha256(said.encode()).hexdigest() for _, said in rows])], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
