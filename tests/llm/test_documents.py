"""Operators on whole documents against plain code, and their behaviour at the edges."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opsloom.llm import bpe, components, exact_dedup, near_copies, packing, repeats, simhash

DOC = "doc_id long, text string, source string, n_chars long, run int, gram string, item long"


def documents(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, len(t or ""), 7, "g", 1) for i, t in rows], DOC)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(200)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [text(70) for _ in range(4)]
    out = []
    for i in range(80):
        t = text(r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            p = r.choice(passages)
            t += " " + p[r.randint(0, 40):len(p) - r.randint(0, 40)] + " " + text(r.randint(0, 40))
        out.append((i, t))
    long = " ".join(text(60) for _ in range(60))
    out += [(100, None), (101, ""), (102, " \n\t"), (103, "ab" * 400), (104, "x" * 3000), (105, out[3][1]), (105, out[3][1]), (106, out[3][1].replace(" ", "\r\n ")),
            (None, out[5][1]), (None, "one of a kind"), (107, long), (108, long.replace("a", "á", 3)), (109, long), (2, out[3][1])]
    return out


def test_exact_groups(spark, rows):
    got = sorted([tuple(r)[:5] for r in exact_dedup.exact_groups(documents(spark, rows).repartition(11), fan=2).collect()], key=str)
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert [(i, k, n, s) for i, k, n, _, s in got] == sorted(
        [(i, least[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm], key=str)
    kept = [r for r in got if r[3]]
    assert len(kept) == len(groups) and all(r[0] == r[1] for r in kept)


def test_exact_groups_of_partitions_of_several_batches(spark):
    texts = [f"text  {i % 7}" for i in range(60)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        df = documents(spark, list(enumerate(texts))).repartition(3)
        got = sorted(tuple(r)[:4] for r in exact_dedup.exact_groups(df, fan=2).collect())
        stay = sorted(r.doc_id for r in exact_dedup.exact_dedup(df).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == [(i, i % 7, texts.count(t), i < 7) for i, t in enumerate(texts)]
    assert stay == list(range(7))


def test_the_pipelines_exact_dedup_takes_partitions_of_several_batches(spark):
    import corpus_pipeline

    name, stage = corpus_pipeline.STAGES[1]
    df = spark.range(0, 25_000, numPartitions=2).select(F.col("id").alias("doc_id"), F.format_string("text of  %d", F.col("id") % 11_000).alias("text"), F.lit("x").alias("source"))
    assert name == "exact dedup"
    out = stage(spark, df, None)
    assert out.columns == df.columns
    assert out.agg(F.count("*"), F.countDistinct("text"), F.max("doc_id")).first()[:] == (11_000, 11_000, 10_999)


def test_exact_dedup_keeps_columns_and_one_row_of_each(spark, rows):
    df = documents(spark, rows)
    out = exact_dedup.exact_dedup(df)
    assert out.columns == df.columns
    texts = [re.sub("[\x20\x09-\x0d]+", " ", r.text or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows})


def test_golay_keys_meet_within_three_bits():
    errors = simhash.error_patterns()
    assert (np.sort(np.bitwise_count(errors[:, 0])).tolist().count(3), errors.shape) == (1771, (2048, 6))
    r = np.random.default_rng(3)
    a = r.integers(-2**63, 2**63 - 1, 3000, dtype=np.int64)
    b = a.copy()
    for _ in range(3):
        b ^= np.where(r.random(3000) < 0.8, np.int64(1) << r.integers(0, 63, 3000), 0)

    def keys(fp):
        out = {}
        for k, f in zip(*(x.tolist() for x in simhash.keys_of(fp, errors))):
            out.setdefault(f, set()).add(k)
        return out

    ka, kb = keys(a), keys(b)
    assert all(ka[x] & kb[y] for x, y in zip(a.tolist(), b.tolist()))


def chained(fps):
    """Smallest index reachable over links of at most three bits."""
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_near_duplicates_equal_brute_force(spark, rows):
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(documents(spark, rows)).collect()), key=str)
    fps = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    label = chained(fps)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    assert got == sorted(((i, signed(f), least.get(c)) for (i, _), f, c in zip(rows, fps, label)), key=str)
    kept = simhash.near_dedup(documents(spark, rows))
    assert kept.count() == len(set(label))


def shingle_set(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def test_the_stage_drops_all_near_copies_of_five_words(spark, rows):
    import corpus_pipeline
    r = random.Random(2)
    more = []
    for k in range(40):
        words = ["".join(r.choice("klmnop") for _ in range(4)) for _ in range(300)]
        more.append((1000 + 2 * k, " ".join(words)))
        for at in r.sample(range(10, 290), 1 + k % 7):
            words[at] = "other"
        more.append((1001 + 2 * k, " ".join(words)))
    base = [f"w{i}" for i in range(200)]
    more += [(2000 + k, " ".join([*base[:k], "x" * k, *base[k + 1:]])) for k in range(5, 60)]
    every = [*rows, *more]
    texts = sorted({t or "" for _, t in every})
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    of = dict(zip(texts, label))
    least = {}
    for i, t in every:
        g = of[t or ""]
        least[g] = min(least.get(g, (True, 0, "")), (i is None, i or 0, t or ""))
    out = corpus_pipeline.without_near_copies(spark, documents(spark, every), None)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == sorted(x[:2] for x in least.values())
    assert len(least) < len(every) - 80 and near_copies.without_near_copies(documents(spark, [])).count() == 0


def test_the_stage_links_by_fingerprint_what_shares_no_min_hash_key(spark):
    """The fingerprints of op7 bring together a pair at 0.8 that none of the bands does."""
    r = random.Random(21950)
    tail = ["%05x" % r.getrandbits(20) for _ in range(6)]
    a, b = (" ".join(["q", "r", "s"] * 200 + t) for t in (tail, [*tail[:-1], "other"]))
    x, y = (near_copies.shingles(t.encode()) for t in (a, b))
    assert near_copies.similar(x, y) and not (near_copies.band_keys(near_copies.minima(x)) == near_copies.band_keys(near_copies.minima(y))).any()
    out = near_copies.without_near_copies(documents(spark, [(1, a), (2, b), (3, "another text of some more words than five")]))
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_the_stage_links_all_that_share_a_key_of_a_crowded_bucket(spark, monkeypatch):
    """Texts about as alike as the limit: the most alike neighbour is often too far, the partner another one."""
    monkeypatch.setattr(near_copies, "BLOCK", 40, raising=False)
    r = random.Random(3)
    base = ["%04x" % r.getrandbits(16) for _ in range(400)]
    texts = []
    for _ in range(150):
        own = base[:]
        for at in r.sample(range(400), 6):
            own[at] = "%04x" % r.getrandbits(16)
        texts.append(" ".join(own))
    sets = [near_copies.shingles(t.encode()) for t in texts]
    keys = np.array([near_copies.band_keys(near_copies.minima(s)) for s in sets])
    prints = [simhash.fingerprint(t.encode()) for t in texts]
    part = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if part[i] != part[j] and ((keys[i] == keys[j]).any() or (prints[i] ^ prints[j]).bit_count() <= 3) and near_copies.similar(sets[i], sets[j]):
                part = [min(part[i], part[j]) if p in (part[i], part[j]) else p for p in part]
    out = near_copies.without_near_copies(documents(spark, list(enumerate(texts))))
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(part))


def test_fingerprint_by_definition():
    import xxhash
    text = "Be  be\x0bBE x É"
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode()) == want and simhash.fingerprint(b" \n") == 0


def test_a_large_bucket_is_cut_and_joined_up():
    r = np.random.default_rng(5)
    centre = r.integers(0, 2**62, 6, dtype=np.int64)
    fps = np.unique(np.concatenate([c ^ (np.int64(1) << r.integers(0, 62, 900)) ^ (np.int64(1) << r.integers(0, 62, 900)) for c in centre]))
    whole, cut = np.arange(len(fps)), np.arange(len(fps))
    simhash.linked(fps, whole, np.arange(len(fps)))
    old, simhash.PART = simhash.PART, 50
    try:
        simhash.linked(fps, cut, np.arange(len(fps)))
    finally:
        simhash.PART = old
    assert len(set(whole)) < len(fps) and (whole == cut).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 201: 200}


def without(rows, width):
    seen, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        for j in range(len(b) - width + 1):
            seen[b[j:j + width]] = seen.get(b[j:j + width], 0) + 1
    for i, b in texts:
        hit = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - width + 1):
            if seen[b[j:j + width]] > 1:
                hit[j:j + width] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~hit[:-1]])
        out.append((i, len(b), len(b) - len(kept), int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_brute_force(spark, rows):
    got = [tuple(r) for r in repeats.repeats(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(without(rows, 200), key=str)


def test_repeats_in_chunks(monkeypatch):
    text = bytes(random.Random(1).choice(b"abc") for _ in range(9000))
    whole = repeats.pivots(text)
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    cut = repeats.pivots(text)
    per_window = lambda p: {w: a for a, lo, hi, _ in p.T.tolist() for w in range(lo, hi + 1)}
    assert per_window(whole) == per_window(cut) and len(per_window(cut)) == 9000 - 199


def test_without_repeats_keeps_columns(spark, rows):
    df = documents(spark, rows)
    out = repeats.without_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    by_size = sorted((n - m) for _, n, m, _, _ in without(rows, 200))
    assert sorted(len((r.text or "").encode()) for r in out.collect()) == pytest.approx(by_size, abs=6)
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


ODD = ["", "ΑΣ ΟΔΟΣ it's WE'LL 12½ x²y  \x1c á İstanbul ﬁ", "<|endoftext|>hello<|startoftext|>x <|endoftext|>", "日本語 テスト 😀😀 don't'S", " \n ", "a" * 700 + " " + "thehe" * 300,
       "\x85\xa0 x\xa0\xa0y  z\r\n", "\x00 �"]


def test_bpe_equals_the_library(spark, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = [*ODD, *(t for _, t in rows)]
    got = {r.doc_id: r for r in bpe.encode_digests(documents(spark, list(enumerate(texts))), path).collect()}
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want, t


def test_long_words_merge_alike():
    own = bpe.word_bpe(public_tokenizers.path("word_bpe_49k.json"))
    word = b"thehenation" * 20 + b"a"
    assert own.merge_long([own.inner[c] for c in word[:-1]] + [own.last[word[-1]]]) == own.merge(word)


def test_packing(spark, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = [*ODD, *(t for _, t in rows), "word " * 5000]
    got = packing.packed(documents(spark, list(enumerate(texts))), path).toPandas().sort_values(["sequence_id", "offset"])
    total = 0
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        own = got[got.doc_id == i].sort_values("piece")
        assert own.length.sum() == len(ids) and list(own.piece) == list(range(len(own))) and (own.length.iloc[1:] == 2048).all()
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    ends = got.groupby("sequence_id").length.cumsum()
    assert (ends - got.length == got.offset).all() and ends.max() <= 2048
    assert got.sequence_id.nunique() <= -(-total // 2048) + 1


def test_long_white_space_is_encoded():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, tok = packing.ByteBpe(path), Tokenizer.from_file(path)
    for text in (" " * 1_000_000 + "x", "a" + "\n" * 1_200_000 + "b", "\u2003" * 12_000 + "é", "x" + " \t" * 9_000):
        assert own.ids(text).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_packing_of_equal_and_small_items(spark):
    items = spark.range(3000).select(F.col("id").alias("item"), F.when(F.col("id") < 1000, 1025).when(F.col("id") < 2000, 1).otherwise(300).cast("long").alias("length"))
    got = packing.pack(items).join(items, "item").toPandas()
    assert len(got) == 3000 and got.groupby("sequence_id").length.sum().max() <= 2048
    # 1,025 + 3 * 300 leaves 123, so 334 sequences take the 300s and the ones fill up.
    assert got.sequence_id.nunique() == 1000


def test_sweep_prefers_the_smallest_gap_and_ranks_conflicts():
    plan = packing.sweep({60: 3}, {100: 1, 70: 1}, 128)
    assert plan[0] == (60, 0, 1, 0, 70, 0, 0) and plan[1] == (60, 1, 1, 0, 100, 0, 0)
    assert plan[2] == (60, 2, 1, 1, 60, 2, 0)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert exact_dedup.exact_groups(none).count() == exact_dedup.exact_dedup(none).count() == 0
    assert simhash.near_duplicates(none).count() == repeats.repeats(none).count() == 0
    assert packing.packed(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert bpe.encode_digests(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_word_encoding_of_every_code_point():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = bpe.word_bpe(path), Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    wrong = []
    for low in range(0, 0x110000, 256):
        some = [chr(c) for c in range(low, low + 256) if not 0xD800 <= c < 0xE000]
        text = "\n".join(f"b{c}d {c}9" for c in some)
        if np.frombuffer(own.encode_decode(text)[0], "<u4").tolist() != library.encode(text, add_special_tokens=False).ids:
            wrong.append(low)
    assert wrong == []
