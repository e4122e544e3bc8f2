"""Alignment of two tokenizations against plain code over the libraries themselves."""
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opsloom.llm import alignment
from opsloom.llm.bpe import byte_symbols

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EDGES = [None, "", " ", "  ", "x", "▁", "a▁b", "<|endoftext|> a <|endoftext|>", "<s> </s><0x41>", "🦄🦄 é\n\n\tx", "\0", " leading", "漢字かな", "a" * 500, " " * 300 + "y", "one two", "one two"]


def plain(rows):
    """Rows as the operator returns them, from the libraries' own ids."""
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    t, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    made, counts = [], Counter()
    for doc, text in rows:
        a = b = []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            said_a = [bytes(byte_of[c] for c in t.id_to_token(i)) for i in a]
            said_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [sp.id_to_piece(i)]]
            if not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
                a = b = []
        if not a:
            made.append((doc, 0, 0, [], [], 0))
            continue
        ends = [np.cumsum([len(x) for x in said]).tolist() for said in (said_a, said_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links = [], []
        for lo, hi in zip([0, *cuts], cuts):
            own = [[i for i, e in zip(ids, end) if lo < e <= hi] for ids, end in zip((a, b), ends)]
            groups.append("|".join(",".join(map(str, x)) for x in own))
            links.append((own[0][-1], own[1][-1]))
        counts.update(links)
        made.append((doc, len(a), len(b), groups, links, sum(len(g.replace("|", ",").split(",")) - 1 for g in groups)))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(doc, x, y, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", over) for doc, x, y, groups, links, over in made]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(7)
    words = ["the", "Zug", "überall", "naïve", "x9", "...", "漢", "123456", "\n", "'s", "�", "tokenization"]
    out = [(i, t) for i, t in enumerate(EDGES)]
    out += [(100 + i, " ".join(r.choice(words) + r.choice(["", "", "s", "é"]) for _ in range(r.randint(1, 60)))) for i in range(120)]
    return out + [(None, "null id"), (None, None), (100, out[20][1]), (999, "a very long text, in which ids repeat. " * 200)]


@pytest.mark.parametrize("run, block", [(1 << 18, 1 << 22), (7, 50), (300, 2000)])
def test_counts(spark, rows, monkeypatch, run, block):
    frame = spark.createDataFrame([(i, t, 5, "g") for i, t in rows], "doc_id long, text string, block int, pair string").repartition(5).persist()
    real = alignment.Block

    class Small(real):
        def __init__(self, own):
            super().__init__(own)
            alignment.RUN, alignment.BLOCK = run, block
            alignment.runs.__defaults__ = (run,)

    monkeypatch.setattr(alignment, "Block", Small)
    monkeypatch.setattr(alignment, "BLOCK", block)
    got = sorted([tuple(r) for r in alignment.alignment_counts(frame, A, B).collect()], key=str)
    assert got == sorted(plain(rows), key=str)
    assert any(r[1] for r in got) and len(got) == len(rows)


def test_no_documents(spark):
    assert alignment.alignment_counts(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_groups_cover_the_bytes(spark, rows):
    frame = spark.createDataFrame(rows[:60], "doc_id long, text string")
    want = {r[0]: r for r in plain(rows[:60])}
    for r in alignment.aligned(frame, A, B).collect():
        said = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups)
        assert (hashlib.sha256(said.encode()).hexdigest() if said else "") == want[r.doc_id][7]
        assert all(x.end == y.begin for x, y in zip(r.groups, r.groups[1:]))
        if r.groups:
            assert r.groups[0].begin == 0 and r.groups[-1].end == len((" " + dict(rows[:60])[r.doc_id]).encode())


def test_long_white_space_goes_to_the_tokenizer():
    own = alignment.Sides(A, B)
    assert own.ids_a(" " * 1_000_000 + "x").tolist()[-1] == own.ids_a(" x").tolist()[-1]
