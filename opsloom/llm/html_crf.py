"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text and inline elements between block boundaries. A block's features are its tag,
the tags and the class and id words of its ancestors, and properties of its text. The field has two labels, main text
and the rest; it is trained on labelled pages by gradient ascent on the conditional likelihood, and a page is
decoded by Viterbi. The labelled pages are layouts of made-up words, built from a seed, with the label of every block known.
"""
import html
import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import slices

PAGES, STEPS = 240, 150
SPACE = re.compile(r"\s+")
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<(?=/?[a-zA-Z!?])[^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Kinds of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg textarea select object".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
             "time tt u var".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
CLOSE_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SHOWN = set("article main section header footer nav aside form head title ul ol table blockquote pre figure p h1 h2 h3 h4 li td div button".split())
# Beginnings of class and id words, by what they tend to mark.
MARKS = {
    "menu": "nav menu breadcrumb pager pagination skip toolbar", "head": "head masthead logo topbar brand", "foot": "foot copyright legal colophon",
    "side": "side widget related recommend share social tags popular author-box toc", "ad": "ad ads advert banner sponsor promo adsbygoogle",
    "notice": "cookie notice alert popup modal consent gdpr paywall", "form": "form search newsletter subscribe signup login",
    "comment": "comment reply respond disqus discussion", "main": "content article post entry main story body text",
}
MARK_OF = [(re.compile("(?:^|[-_ ])(?:" + "|".join(words.split()) + ")", re.I) if kind != "ad" else
            re.compile("(?:^|[-_ ])(?:ads?(?=$|[-_ 0-9])|" + "|".join(words.split()[2:]) + ")", re.I), kind) for kind, words in MARKS.items()]


def marks(attributes: str):
    values = " ".join(a or b or c for a, b, c in ATTRIBUTE.findall(attributes))
    return tuple(kind for pattern, kind in MARK_OF if pattern.search(values)) if values else ()


@lru_cache(4096)
def above_names(tag, kinds):
    """Features that an open element gives to the blocks inside."""
    return (*(("in:" + tag,) if tag in SHOWN and tag not in INLINE else ()), *("mark:" + k for k in kinds))


class Ancestors:
    """Open elements, with counts of the tags and of the features that they give, so a step costs the same at any depth."""

    def __init__(self):
        self.stack, self.own, self.tags, self.counts = [], [], Counter(), Counter()

    def push(self, tag, kinds):
        self.stack.append((tag, kinds))
        self.tags[tag] += 1
        for name in above_names(tag, kinds):
            self.counts[name] += 1
        if tag not in INLINE:
            self.own.append(tag)

    def pop(self):
        tag, kinds = self.stack.pop()
        self.tags[tag] -= 1
        for name in above_names(tag, kinds):
            self.counts[name] -= 1
        if tag not in INLINE:
            self.own.pop()

    def close(self, tag):
        """Close the innermost element of this tag and what is open inside; nothing if there is none."""
        if self.tags[tag]:
            while self.stack[-1][0] != tag:
                self.pop()
            self.pop()

    def features(self):
        return (*("own:" + t for t in self.own[-1:]), *sorted(name for name, n in self.counts.items() if n))


def blocks(page: str):
    """Leaf blocks in page order: (text, share of it in links, features of the ancestors). Time and space are linear in the page."""
    out, above, text, linked, link = [], Ancestors(), [], 0, 0
    stack = above.stack

    def end():
        nonlocal linked
        said = SPACE.sub(" ", html.unescape("".join(text))).strip()
        if said:
            out.append((said, min(1.0, linked / len(said)), above.features()))
        text.clear()
        linked = 0

    def say(piece):
        nonlocal linked
        if piece:
            text.append(piece)
            if link:
                linked += len(piece.strip())

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW and not closing:
            over = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(page, at)
            at = over.end() if over else size
            continue
        if tag == "br" or tag == "hr" or (tag not in INLINE and tag not in VOID):
            end()
        if tag in VOID:
            continue
        if closing:
            above.close(tag)
        else:
            shut = CLOSES.get(tag, set()) | ({"p"} if tag in CLOSE_P else set())
            while shut and stack and (stack[-1][0] in shut or stack[-1][0] in INLINE and any(t in shut for t, _ in stack[-3:])):
                above.pop()
            above.push(tag, marks(m[3]) if m[3] else ())
        link = any(t == "a" for t, _ in stack[-4:])
    end()
    return out


def features(block):
    """Names of a block's features."""
    text, linked, above = block
    out = ["bias", *above]
    words = text.count(" ") + 1
    out.append("words:" + ("1" if words == 1 else "2" if words < 5 else "5" if words < 15 else "15" if words < 40 else "40"))
    out.append("links:" + ("none" if linked == 0 else "some" if linked < 0.5 else "most"))
    out.append("end:" + ("stop" if text[-1] in ".!?…\"”»:" else "open"))
    if text[:1] == "©" or " reserved" in text[-40:].lower():
        out.append("copyright")
    return out


class Labelled:
    """Labelled pages of many layouts, built from a seed. The markup marks main blocks by a code point that no page holds."""

    MARK = "\ue000"

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low, high):
        r = self.random
        return " ".join("".join(r.choice("aeiou") + r.choice("bdlmnrst") for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def sentence(self, low=6, high=30):
        return self.words(low, high).capitalize() + self.random.choice("....!?")

    def links(self, tag="ul", low=3, high=8):
        items = "".join(f'<li><a href="/x">{self.words(1, 3)}</a>{self.random.choice(["</li>", ""])}' for _ in range(self.random.randint(low, high)))
        return f"<{tag}>{items}</{tag}>"

    def wrap(self, choices, inside):
        tag, attributes = self.random.choice(choices)
        return f"<{tag}{attributes}>{inside}</{tag}>"

    def main(self):
        r, m, out = self.random, self.MARK, []
        if r.random() < 0.8:
            out.append(f"<h1>{m}{self.words(3, 10)}</h1>")
        for _ in range(r.randint(0, 9)):
            kind = r.random()
            if kind < 0.7:
                body = " ".join(self.sentence() for _ in range(r.randint(1, 6)))
                if r.random() < 0.15:
                    body = self.words(1, 6) + r.choice([".", "", ":"])
                if r.random() < 0.2:
                    body = f"<b>{m}{body}" if r.random() < 0.3 else f'{m}{self.words(1, 5)} <a href="/y">{self.words(1, 3)}</a> {body}'
                else:
                    body = m + body
                out.append(f"<p>{body}{r.choice(['</p>', '</p>', ''])}")
            elif kind < 0.78:
                out.append(f"<h2>{m}{self.words(2, 6)}</h2>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{m}{self.sentence(2, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{m}{self.sentence()}</blockquote>")
            elif kind < 0.96:
                out.append(f"<pre>{m}{self.words(3, 20)}</pre>")
            else:
                out.append(self.wrap([("div", ' class="ad"'), ("aside", ""), ("div", ' class="related"')], self.sentence(3, 12)))
        return self.wrap([("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="content"'), ("div", ' id="main-content"'),
                          ("section", ' class="entry"'), ("div", ' class="post-body"'), ("div", "")], "".join(out))

    def page(self) -> str:
        r = self.random
        head = f"<head><meta charset=utf-8><title>{self.words(3, 9)}</title><style>p{{}}</style></head>"
        out = []
        if r.random() < 0.5:
            out.append(self.wrap([("header", ""), ("div", ' class="header"'), ("div", ' id="masthead"')], self.words(1, 4) + r.choice(["", self.links("div", 2, 4)])))
        if r.random() < 0.85:
            out.append(self.wrap([("nav", ""), ("nav", ""), ("div", ' class="menu"'), ("div", ' id="nav"'), ("div", ' class="breadcrumbs"')], self.links()))
        extras = [
            ("ad", [("div", ' class="ad"'), ("div", ' class="ad-box"'), ("div", ' class="advert"'), ("div", ' class="sponsored"'), ("aside", ' class="promo"')]),
            ("notice", [("div", ' class="cookie-notice"'), ("div", ' class="alert"'), ("div", ' id="consent"')]),
            ("side", [("aside", ""), ("div", ' class="sidebar"'), ("div", ' class="related"'), ("div", ' id="widget-2"')]),
            ("form", [("form", ""), ("div", ' class="newsletter"'), ("form", ' class="search"')]),
        ]
        before, after = [], []
        for kind, shapes in extras:
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                inside = {"side": lambda: f"<h3>{self.words(1, 3)}</h3>" + r.choice([self.links(), f"<p>{self.sentence()}</p>"]),
                          "form": lambda: f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"}.get(
                    kind, lambda: r.choice([self.sentence(2, 8), self.sentence(10, 40), f"<p>{self.sentence()}</p>"]))()
                r.choice([before, after]).append(self.wrap(shapes, inside))
        if r.random() < 0.4:
            after.insert(0, self.wrap([("section", ' class="comments"'), ("div", ' id="comments"'), ("ol", ' class="comment-list"')],
                                      f"<h3>{self.words(1, 3)}</h3>" + "".join(f"<div class=comment><p>{self.sentence(4, 40)}</p></div>" for _ in range(r.randint(1, 5)))))
        foot = self.wrap([("footer", ""), ("footer", ""), ("div", ' class="footer"'), ("div", ' id="site-footer"')],
                         r.choice(["&copy; ", "&copy; ", ""]) + self.words(1, 4) + " &middot; " + self.sentence(2, 25) + r.choice(["", self.links()]))
        body = [*out, *before, self.main(), *after]
        if r.random() < 0.9:
            body.append(foot)
        page = f'<!DOCTYPE html><html>{head}<body>{"".join(body)}</body></html>'
        return page if r.random() < 0.85 else page[:r.randint(len(page) // 3, len(page))]

    def examples(self, pages: int):
        """Lists of (block, label)."""
        out = []
        for _ in range(pages):
            out.append([((text.replace(self.MARK, ""), linked, path), self.MARK in text) for text, linked, path in blocks(self.page())
                        if text.replace(self.MARK, "")])
        return [page for page in out if page]


class Field:
    """Weights of the features for label 1 and of the label pairs, with Viterbi decoding."""

    def __init__(self, weights: dict, pairs, start):
        self.weights, self.pairs, self.start = weights, pairs, start

    def decode(self, blocks_):
        """Label of each block on the best path."""
        get, (p00, p01), (p10, p11) = self.weights.get, *self.pairs
        back, best0, best1 = [], None, None
        for block in blocks_:
            s = sum(get(f, 0.0) for f in features(block))
            if best0 is None:
                best0, best1 = self.start[0], self.start[1] + s
                back.append((0, 0))
                continue
            a, b = best0 + p00, best1 + p10
            c, d = best0 + p01, best1 + p11
            back.append((a < b, c < d))
            best0, best1 = max(a, b), max(c, d) + s
        label, out = int(best1 is not None and best1 > best0), []
        for choice in reversed(back):
            out.append(label)
            label = int(choice[label])
        return out[::-1]


def train(examples, steps: int = STEPS, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Maximise the conditional log-likelihood by Adam; pages are padded so that forward and backward passes run over all at once."""
    names = {f: i for i, f in enumerate(sorted({f for page in examples for b, _ in page for f in features(b)}))}
    n, longest, width = len(examples), max(map(len, examples)), len(names)
    x, y = np.zeros((n, longest, width)), np.zeros((n, longest), int)
    size = np.array([len(p) for p in examples])
    for i, page in enumerate(examples):
        for t, (block, label) in enumerate(page):
            x[i, t, [names[f] for f in features(block)]] = 1
            y[i, t] = label
    real = np.arange(longest)[None] < size[:, None]
    theta = np.zeros(width + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    lse = np.logaddexp
    for step in range(1, steps + 1):
        w, pairs, start = theta[:width], theta[width:width + 4].reshape(2, 2), theta[width + 4:]
        emit = np.stack([np.zeros((n, longest)), x @ w], 2)
        fore, back = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        fore[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            at = lse(fore[:, t - 1, 0, None] + pairs[0], fore[:, t - 1, 1, None] + pairs[1]) + emit[:, t]
            fore[:, t] = np.where(real[:, t, None], at, fore[:, t - 1])
        total = lse(fore[:, -1, 0], fore[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            follow = emit[:, t + 1] + back[:, t + 1]
            at = lse(pairs[None, :, 0] + follow[:, 0, None], pairs[None, :, 1] + follow[:, 1, None])
            back[:, t] = np.where(real[:, t + 1, None], at, 0.0)
        p = np.exp(fore + back - total[:, None, None]) * real[..., None]
        grad = np.zeros_like(theta)
        grad[:width] = np.einsum("nt,ntf->f", (y - p[..., 1]) * real, x)
        for a in (0, 1):
            for b in (0, 1):
                pair = np.exp(fore[:, :-1, a] + pairs[a, b] + emit[:, 1:, b] + back[:, 1:, b] - total[:, None]) * real[:, 1:]
                seen = (y[:, :-1] == a) & (y[:, 1:] == b) & real[:, 1:]
                grad[width + 2 * a + b] = seen.sum() - pair.sum()
            grad[width + 4 + a] = (y[:, 0] == a).sum() - p[:, 0, a].sum()
        grad = grad / n - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in names.items()}
    return Field(weights, theta[width:width + 4].reshape(2, 2).tolist(), theta[width + 4:].tolist())


def main_text(page: str, field: Field) -> str:
    """Main blocks in page order, joined by one space."""
    found = blocks(page)
    return " ".join(b[0] for b, label in zip(found, field.decode(found)) if label)


def extract(pages: DataFrame, labelled: int = PAGES, seed: int = 7) -> DataFrame:
    """(page_id, url, text, n_chars) of whole pages. Null html is empty; a page without main text gives an empty text.

    Repeated rows give repeated rows; null ids and urls stay null. n_chars counts code points.
    """
    field = train(Labelled(seed).examples(labelled))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches):
        for batch in slices(batches, 256):
            texts = [main_text(p, field) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
