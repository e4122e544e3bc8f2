"""Piece encoding against the library: ids, spans, decoding, with the given model and with other normalisations."""
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from opsloom.llm.pieces import Pieces, encode_digests, encoded, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
EDGES = ["", " ", "  ", "▁", "▁▁ a", "\n", "🦄 x", " 🦄", "<s> </s><0x41><unk>", "\0a", "a  b ", " Ａ①ﬁ   x　y  ", "é é   ½ ㍿", "ab" * 3000, "x" * 20000, " " * 5000 + "x",
         "�", "한국어 각", "​‍ a\tb\r\n", "…", "Ǆ ª"]


def models():
    """The given model as it is, and with the compiled map of a normaliser (a later message of a model file overrides an earlier one)."""
    with open(PATH, "rb") as f:
        plain = f.read()
    out = {"plain": plain}
    for rule in ("nmt_nfkc", "nmt_nfkc_cf"):
        for tidy in (False, True):
            for prefix in (False, True):
                out[f"{rule}-{tidy}-{prefix}"] = plain + sentencepiece.SentencePieceNormalizer(
                    rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=tidy).serialized_model_proto()
    return out


MODELS = models()


def texts():
    r = random.Random(3)
    chars = "abcé ß漢ﬁＡ①́ 　\t▁🦄½"
    return EDGES + ["".join(r.choice(chars) for _ in range(r.randint(1, 40))) for _ in range(400)]


def spans(sp, text):
    """The library's spans, in bytes."""
    return [(p.begin, p.end) for p in sp.encode(text, out_type="proto").pieces]


@pytest.mark.parametrize("name", list(MODELS))
def test_encoding_equals_the_library(name):
    own, sp = Pieces(MODELS[name]), sentencepiece.SentencePieceProcessor(model_proto=MODELS[name])
    for text in texts():
        ids, begin, end, decimal, said = own.encode(text)
        want = sp.encode(text)
        assert ids.tolist() == want, repr(text)
        assert decimal == ",".join(map(str, want))
        assert said.decode() == sp.decode(want) == own.decode(want), repr(text)
        assert list(zip(begin.tolist(), end.tolist())) == spans(sp, text), repr(text)


def test_every_code_point():
    own, sp = pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for low in range(0, 0x110000, 512):
        text = "".join(f"ab{chr(c)}cd {chr(c)} {chr(c)}9" for c in range(low, low + 512) if not 0xD800 <= c < 0xE000)
        ids, _, end, _, said = own.encode(text)
        assert ids.tolist() == sp.encode(text) and said.decode() == text.replace("▁", " ")
        assert not text or end[-1] == len(text.encode())


def test_decoding_of_any_ids():
    own, sp, r = pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(5)
    for _ in range(2000):
        ids = [r.randrange(r.choice([0, 3]), r.choice([259, 32000])) for _ in range(r.randint(0, 8))]
        assert own.decode(ids) == sp.decode(ids)


def test_queries_of_frames(spark):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(None, None), (3, None), (3, EDGES[10]), (3, EDGES[10]), (99, "long text " * 100000)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, n_tokens int").repartition(5)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len(ids := sp.encode(t or "")), hexed(",".join(map(str, ids))), hexed(sp.decode(ids))) for i, t in rows]
    assert sorted([tuple(r)[:4] for r in encode_digests(frame, PATH).collect()], key=str) == sorted(want, key=str)
    got = {r.doc_id: r for r in encoded(frame.where("doc_id IN (10, 99)"), PATH).collect()}
    assert got[10].ids == sp.encode(EDGES[10]) and got[10].decoded == EDGES[10]
    source = EDGES[10].encode()
    assert b"".join(source[b:e] for b, e in zip(got[10].begins, got[10].ends)) == source
    assert encode_digests(frame.where(F.lit(False)), PATH).count() == 0
