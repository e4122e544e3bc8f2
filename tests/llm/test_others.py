"""Conversations, vectors, pages, captures, toxicity and the pipeline."""
import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opsloom.llm import chat, html_crf, queries_text, topk, toxicity, warc
from opsloom.llm.common import Kept

TURNS = "conv_id long, part int, turn long, role string, text string"


# ---------------------------------------------------------------- conversations

@pytest.mark.parametrize("text", ["", "plain", chat.END + chat.START + "assistant\nok", "<|", "<\\|im_end|>", "<\\\\|x<<|", "a<", "\\n\n\\"])
def test_escapes_are_reversible_and_hide_control_strings(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)
    assert chat.parse(chat.format_turn("user", text) + chat.format_turn(text, "x")) == [("user", text), (text, "x")]


LAYOUTS = {
    '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}': [("user", "a"), ("assistant", "b")],
    '{"system": "s", "messages": [{"content": "a", "role": "user"}]}': [("system", "s"), ("user", "a")],
    '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": null}]}': [("user", "a"), ("assistant", "")],
    '{"prompt": "a", "completion": "b"}': [("user", "a"), ("assistant", "b")],
    '{"response": "b", "prompt": "a"}': [("user", "a"), ("assistant", "b")],
    '{"instruction": "a", "output": "b"}': [("user", "a"), ("assistant", "b")],
    '{"instruction": "a", "input": "x", "output": "b"}': [("user", "a\n\nx"), ("assistant", "b")],
    '{"instruction": "a", "input": "", "output": "b"}': [("user", "a"), ("assistant", "b")],
    '{"question": "a", "answer": 5}': [("user", "a"), ("assistant", "5")],
    '{"turn": 3, "role": "user", "text": "a"}': [("user", "a")],
    '{"messages": []}': [("unknown", '{"messages": []}')],
    '{"what": 1}': [("unknown", '{"what": 1}')],
    "no json": [("unknown", "no json")],
}


def test_turns_with_nulls_keep_role_and_text(spark):
    rows = [(1, None, "assistant", "said"), (1, 1, None, None), (1, 0, "user", None), (2, None, None, "x"), (None, None, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = [(r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_turns(queries_text.turn_records(df)).collect()]
    want = [(c, turn, role or "", text or "") for c, turn, role, text in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    digests = {r.conv_id: r for r in chat.digests(chat.formatted(chat.canonical_turns(queries_text.turn_records(df)))).collect()}
    assert (digests[1].n_turns, digests[1].loss_chars, digests[None].loss_chars) == (3, 4, 1)
    # As in the query's SQL, null turns come last.
    assert digests[1].turns_sha256 == hashlib.sha256(b"user\n\n\n\nassistant\nsaid\n").hexdigest()


def test_layouts_become_turns(spark):
    df = spark.createDataFrame([(i, r, "x") for i, r in enumerate([*LAYOUTS, None])], "conv_id long, record string, text string")
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv_id", "turn", "part").collect():
        got.setdefault(r.conv_id, []).append((r.part, r.turn, r.role, r.text))
    for i, want in enumerate([*LAYOUTS.values(), [("unknown", "")]]):
        assert [t[2:] for t in sorted(got[i])] == want


def test_fingerprint_takes_names_and_nesting_only(spark):
    rows = [('{"a": 1, "b": [{"c": "x"}]}',), ('{"b": [{"c": null}, {"c": 2.5}], "a": true}',), ('{"a": 1, "b": {"c": "x"}}',)]
    df = spark.createDataFrame(rows, "r string").select(chat.fingerprint(F.try_parse_json("r")).alias("f"))
    f = [r.f for r in df.collect()]
    assert f[0] == f[1] != f[2]


def test_digests_of_long_and_odd_conversations(spark):
    r = random.Random(2)
    turns = [(c, 0, t, r.choice(["user", "assistant", "system", None]), r.choice(["", None, "é" * 50, chat.END, "x" * 3000])) for c in (1, 2, None) for t in range(30)]
    turns += turns[:2]
    got = {g.conv_id: g for g in chat.digests(chat.formatted(spark.createDataFrame(turns, TURNS), chunk_chars=4000)).collect()}
    for c in (1, 2, None):
        own = sorted((t[2], t[3] or "", t[4] or "") for t in turns if t[0] == c)
        said = "".join(x for _, role, x in own if role == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[c].formatted_chars == sum(len(chat.format_turn(role, x)) for _, role, x in own)
    assert chat.digests(chat.formatted(spark.createDataFrame([], TURNS))).count() == 0


# ---------------------------------------------------------------- vectors

def test_rows_keep_their_roles_and_long_texts(spark):
    """Roles of rows are as they stand; other layouts have theirs unified. A text beyond the size of a variant is a turn like others."""
    long = "y" * 140_000_000
    rows = spark.createDataFrame([(1, 0, "gpt", "said"), (1, 1, "Human", "x"), (2, 0, "assistant", "short")], "conv_id long, turn int, role string, text string")
    rows = rows.withColumn("text", F.when(F.col("conv_id") == 2, F.expr("repeat('y', 140000000)")).otherwise(F.col("text")))
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.canonical_turns(queries_text.turn_records(rows)))).collect()}
    assert got[1].loss_chars == 0 and got[1].turns_sha256 == hashlib.sha256(b"gpt\nsaid\nHuman\nx\n").hexdigest()
    assert got[2].loss_chars == len(long) and got[2].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    share = spark.createDataFrame([(3, '{"conversations": [{"from": "gpt", "value": "v"}]}')], "conv_id long, record string")
    assert [(r.role, r.text) for r in chat.canonical_turns(share).collect()] == [("assistant", "v")]
    pairs = spark.createDataFrame([(4, "p", "c")], "conv_id long, prompt string, completion string").select("conv_id", F.struct("prompt", "completion").alias("record"))
    assert [(r.role, r.text) for r in chat.canonical_turns(pairs).orderBy("part").collect()] == [("user", "p"), ("assistant", "c")]


def test_top_k_of_repeated_ids(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.5, 0.0]), (7, [1.0, 1.0]), (7, [0.25, 0.0]), (3, [2.0, 0.0])]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors, vectors.where("vec_id = 50"), 3).collect())
    want = []
    for own in (0, 1):
        scores = sorted((-sum(int(256 * a) * int(256 * b) for a, b in zip(rows[own][1], v)), i) for n, (i, v) in enumerate(rows) if n != own)
        want += [(50, k + 1, i, -s) for k, (s, i) in enumerate(scores[:3])]
    assert got == sorted(want)


def test_top_k_joins_and_broadcasts_nothing(spark):
    """Queries stand in many cells; a plan that judges them by their size before may send all copies through the driver."""
    rows = [(i, [float(i * 37 % 101), float(i * 11 % 89) - 40]) for i in range(600)]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asked = vectors.where("vec_id % 5 = 0")
    got = topk.top_k(vectors, asked, 2, block=50, query_block=16, group=30)
    best = {}
    for r in sorted(got.collect(), key=lambda r: r["rank"]):
        best.setdefault(r.query_id, []).append((r.vec_id, r.score))
    q = np.floor(256 * np.array([v for _, v in rows])).astype(int)
    assert best == {i: [(j, -s) for s, j in sorted((-int(q[i] @ q[j]), j) for j in range(600) if j != i)[:2]] for i in range(0, 600, 5)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "BroadcastExchange" not in plan


def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(5, 12))
    x = base[r.integers(0, 5, 300)] + r.normal(size=(300, 12)) * 0.2
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)] + [(300 + i, x[3].tolist(), "c") for i in range(40)]
    rows += [(400, None, "c"), (401, [1.0, None], "c"), (402, [float("nan")] * 12, "c"), (403, [float("inf")] * 12, "c"), (None, x[0].tolist(), "c"),
             (404, [], "c"), (405, [0.0] * 12, "c"), (7, x[7].tolist(), "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, q string")
    vectors = topk.quantised(df)
    got = {}
    for g in topk.top_k(vectors, vectors.where("vec_id % 3 = 0"), 5, block=64, query_block=16).collect():
        got.setdefault(g.query_id, []).append((g.rank, g.vec_id, g.score))
    good = {i: np.floor(256 * np.array(v if v else [0.0] * 12)).astype(int) for i, v, _ in rows if i is not None and i not in (400, 401, 402, 403)}
    for q in (i for i in good if i % 3 == 0):
        best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)], q
    few = topk.top_k(vectors.where("vec_id < 3"), vectors.where("vec_id < 2"), 5)
    assert few.count() == 4 and topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_lists_are_read_in_order_until_no_outsider_qualifies():
    r = np.random.default_rng(2)
    x = r.integers(-50, 50, (400, 6))
    x[:5] += 1000
    x[5:9] -= 1000
    q = np.array([[3, 2, 1, 5, 4, 2], [-3, -2, -1, -5, -4, -2], [1, -1, 2, -2, 0, 0], [0] * 6])
    block = topk.Block(np.arange(400), np.arange(400), x.astype(np.int64))
    asked, read = [], block.read
    block.read = lambda done, depth: asked.append((done, depth)) or read(done, depth)
    found = {j: (set(left.tolist()), depth) for j, left, depth in block.qualified(np.array([-1, 7, 3, 0]), q, 3, 20)}
    assert asked == [(d, d + 20) for d in range(0, asked[-1][1], 20)]
    for j, own in enumerate((-1, 7, 3, 0)):
        score = x @ q[j]
        kth = sorted((int(s) for i, s in enumerate(score) if i != own), reverse=True)[2]
        assert {i for i, s in enumerate(score) if s > kth and i != own} <= found[j][0] and own not in found[j][0]
    assert found[0][1] < 400 and found[1][1] < 400 and len(found[0][0]) == 3 and found[3] == (set(range(1, 400)), 400)
    for step in (1, 7, 400, 1000):
        for j, got in enumerate(block.top([-1, 7, 3, 0], q, 3, step)):
            want = sorted((-int(s), i) for i, s in enumerate(x @ q[j]) if i != (-1, 7, 3, 0)[j])[:3]
            assert got == [(-s, i) for s, i in want]


# ---------------------------------------------------------------- pages

@pytest.fixture(scope="module")
def field():
    return html_crf.train(html_crf.Labelled(7).examples(html_crf.PAGES))


def test_field_on_layouts_it_has_not_seen(field):
    right = total = 0
    for page in html_crf.Labelled(4711).examples(150):
        found = field.decode([b for b, _ in page])
        right, total = right + sum(a == b for a, b in zip(found, (int(y) for _, y in page))), total + len(page)
    assert right / total > 0.98


@pytest.mark.parametrize("piece", ["<div>x", "<div><b>x</i>", "<p>x<li>y<td>"])
def test_pages_of_unclosed_elements_take_linear_time(field, piece):
    import time
    start = time.perf_counter()
    html_crf.main_text(piece * (1_000_000 // len(piece)), field)
    assert time.perf_counter() - start < 10


def test_ancestor_features_equal_those_of_the_open_elements():
    import random
    r = random.Random(3)
    for _ in range(200):
        above, open_ = html_crf.Ancestors(), []
        for _ in range(60):
            tag, kinds = r.choice(["div", "b", "main", "ul", "li", "x-y"]), r.choice([(), ("menu",), ("menu", "ad"), ("main",)])
            if r.random() < 0.6:
                above.push(tag, kinds)
                open_.append((tag, kinds))
            else:
                above.close(tag)
                at = max((i for i, (t, _) in enumerate(open_) if t == tag), default=len(open_))
                del open_[at:]
            plain = [t for t, _ in open_ if t not in html_crf.INLINE]
            want = {"own:" + t for t in plain[-1:]} | {"in:" + t for t in plain if t in html_crf.SHOWN} | {"mark:" + k for _, ks in open_ for k in ks}
            assert set(above.features()) == want and len(above.features()) == len(want)


def test_viterbi_equals_enumeration(field):
    import itertools
    page = [b for b, _ in html_crf.Labelled(5).examples(1)[0]][:8]
    emit = [sum(field.weights.get(f, 0.0) for f in html_crf.features(b)) for b in page]

    def score(path):
        return field.start[path[0]] + sum(e for e, y in zip(emit, path) if y) + sum(field.pairs[a][b] for a, b in zip(path, path[1:]))

    assert tuple(field.decode(page)) == max(itertools.product((0, 1), repeat=len(page)), key=score)


@pytest.mark.parametrize("page, want", [
    ("", ""), ("<html>", ""), ("<article><h1>A &amp; B</h1><p>One<b>two</b>\n three.<p>Four &lt;five&gt; &eacute;&#233;.</article><footer>&copy; x</footer>",
                               "A & B Onetwo three. Four <five> éé."),
    ("<nav><ul><li><a href=/>Home</a></ul></nav><article><p>It is a long sentence, is it not?</p><script>var x = '<p>no</p>'</script></article>",
     "It is a long sentence, is it not?"),
    ("<article><p>It ends in the middle of a sent<b", "It ends in the middle of a sent"),
    ("<article><p>Kept text of the page.</p><!-- <p>no</p> --><div class='ad'>Buy now</div></article>", "Kept text of the page."),
    ("<article><p>Body of the article.</p></article><section class=comments><h3>Two</h3><div class=comment><p>I disagree with this.</p></div></section>",
     "Body of the article."),
])
def test_main_text(field, page, want):
    assert html_crf.main_text(page, field) == want


def test_extract_edges(spark):
    df = spark.createDataFrame([(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<article><p>Some words here.</p></article>", "t")],
                               "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in html_crf.extract(df).collect()), key=str)
    assert got == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "Some words here.", 16)]
    assert html_crf.extract(df.limit(0)).count() == 0


# ---------------------------------------------------------------- captures

def test_canonical_urls(spark):
    urls = ["HTTP://www.Ex.org:80/A/?b=2&utm_source=x&a=1#f", "https://ex.org/A?a=1&b=2", "ex.org", "http://ex.org/", None, ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.canonical_url(F.col("u")).alias("c"))
    assert [r.c for r in df.collect()] == ["ex.org/A?a=1&b=2", "ex.org/A?a=1&b=2", "ex.org", "ex.org", None, ""]


def test_revisits(spark):
    def rec(i, kind, url, time, digest=None, **headers):
        return (i, kind, url, time, {k.replace("_", "-"): v for k, v in headers.items()} or None, digest, "x")

    rows = [
        rec(1, "response", "http://a.org/x", 10, "d1", etag='"1"', server="s", date="10"), rec(2, "revisit", "https://a.org/x#y", 11, None, etag='W/"1"', date="11", server="no"),
        rec(3, "response", "http://a.org/x", 20, "d2", etag='"2"'), rec(4, "revisit", "http://a.org/x", 21, None, etag='"1"'), rec(5, "revisit", "http://a.org/x", 5),
        rec(6, "revisit", "http://a.org/x", 20, "d2"), rec(7, "revisit", "http://a.org/x", 30), rec(8, "revisit", None, 30), rec(9, "revisit", "http://a.org/x", None),
        rec(10, "revisit", "http://b.org", 40), rec(11, "response", None, 1, "d"),
    ]
    df = spark.createDataFrame(rows, "record_id long, type string, url string, time long, headers map<string,string>, digest string, source string")
    got = {r.record_id: (r.status, r.refers_to, r.digest, r.headers) for r in warc.resolve_revisits(df).collect()}
    assert got[2] == ("resolved", 1, "d1", {"etag": 'W/"1"', "server": "s", "date": "11"})
    assert got[4][:2] == ("mismatch", None) and got[5][0] == "missing" and got[6][:3] == ("resolved", 3, "d2") and got[7][:2] == ("unverified", 3)
    assert got[8][0] == got[9][0] == got[10][0] == "missing" and len(got) == 8
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def test_hot_url_spreads(spark):
    df = spark.range(2000).select(F.col("id").alias("record_id"), F.when(F.col("id") % 100 == 0, "response").otherwise("revisit").alias("type"), F.lit("http://a.org/").alias("url"),
                                  F.col("id").alias("time"), F.lit(None).cast("map<string,string>").alias("headers"), F.lit("d").alias("digest"))
    got = warc.resolve_revisits(df.repartition(5)).collect()
    assert len(got) == 1980 and all(r.refers_to == r.record_id // 100 * 100 for r in got)


# ---------------------------------------------------------------- toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return toxicity.toxicity(docs, labels).join(labels, "doc_id").toPandas()


def test_held_out_accuracy(scored):
    out = scored[scored.held_out]
    assert ((out.toxic == 1) == (out.predicted == 1)).mean() > 0.93
    assert out[out.toxic == 0].predicted.mean() < 0.03 and out.score.between(0, 1).all()


def test_restored_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.CharModel(toxicity.char_counts(docs))
    for marked, plain in {"l0s3r": "loser", "m0r0n": "moron", "5cum": "scum", "l o s e r": "loser", "looooser": "loser", "M-O-R-O-N": "moron", "tr@sh": "trash"}.items():
        assert model.deobfuscated(marked) == plain
    assert model.deobfuscated("The end of it, 1999!") == "the end of it, 1999!"


FORMS = {
    "1 d 1 0 t": "idiot", "$ c u m": "scum", "$.c.u.m": "scum", "s,c,u,m": "scum", "s/c/u/m": "scum", "s\tc\tu\tm": "scum", "s / c / u / m": "scum",
    "s   c   u   m": "scum", "s u m": "sum", "iidiioott": "idiot", "ssccuumm": "scum", "mmoorroonn": "moron", "lloosseerr": "loser", "1d10+": "idiot",
    "tras#": "trash", "mor0n!": "moron", "5c" + "u" * 45 + "m": "scum", "moron!": "moron", "@ s s": "ass",
}


def test_every_marked_form_reaches_the_decoder(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.CharModel(toxicity.char_counts(docs))
    assert {marked: model.deobfuscated(marked).strip() for marked in FORMS} == FORMS
    for plain in ("the end, of it 1999", "1 2 3 4", "a b"):
        assert model.deobfuscated(plain) == plain
    long = "a1b2" * 50_000
    assert len(model.deobfuscated(long)) > 50_000 and model.deobfuscated("x" * 200_000 + " m0r0n").endswith("moron")


def test_only_copies_vote_once():
    r = random.Random(4)
    # Unrelated long texts that share a few frequent word pairs, and copies with a changed word.
    texts = [" ".join(r.choice(["of the", "in a", "to be"]) if r.random() < 0.05 else str(r.randint(0, 10**6)) for _ in range(800)) for _ in range(60)]
    copied = [texts[0].replace(texts[0].split()[k], "other") for k in range(10, 20)]
    group = toxicity.copies([toxicity.sketch(t) for t in [*texts, *copied, "", ""]])
    assert len(set(group[:60])) == 60 and set(group[60:70]) == {group[0]} and group[70] == group[71] and len(set(group)) == 61
    assert toxicity.copies([]) == []


def test_edges_of_scores(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (1, None, 1.0), (2, "", 1.0), (None, "x1x " * 9, 1.0), (3, "\ud7ff😀 " * 3, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 1), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_kept_results_are_bounded_and_right():
    kept = Kept(lambda k: k * 2, size=10)
    assert [kept[i % 37] for i in range(500)] == [i % 37 * 2 for i in range(500)] and len(kept) <= 10 and len(kept.older) <= 10


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) > 0.7 * len(ids), name
        ids = now
    assert json.dumps(sorted(docs.columns)) == json.dumps(sorted(["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]))
