"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Every node (block element or run of text) gets a probability of holding main text. Of all choices in which what is kept hangs
together (a kept node's ancestors are kept, a dropped one's descendants dropped), the most probable is taken. The
trees are fitted on a bounded sample of the pages themselves: their article or main elements are the main text, and to
learn more than that one layout, their blocks are also set into made-up layouts of other tags and class names.
"""

from __future__ import annotations

import html
import random
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.boosting import Forest, grow
from inkfold.llm.common import bounded_sample, map_batches
from inkfold.llm.dom import Node, parse

#: Pages that the trees are fitted on, chosen by hash of the id, and their characters at most; longer ones are left to the
#: model. A bounded sample.
SAMPLE, SAMPLE_CHARS = 240, 40_000
#: Made-up layouts for each of these pages.
LAYOUTS = 4
#: Elements and names that do not hold main text even within an article, and elements that do. Fixed values.
ASIDE_TAGS = frozenset("nav footer aside form header menu".split())
MAIN_TAGS = frozenset({"article", "main"})
_MARK = ""


def feature_rows(nodes: list[Node], scores: dict[str, float]) -> np.ndarray:
    """The features of each node. scores: how much a tag ('<p') or a name in class, id or role speaks for main text."""
    n = len(nodes)
    chars, words, link, links, controls, elements = (np.zeros(n) for _ in range(6))
    runs, longest, heads, marks = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    tag_own, low, high = np.zeros(n), np.zeros(n), np.zeros(n)
    start, order, seen = np.zeros(n), np.zeros(n), 0
    children: list[list[int]] = [[] for _ in range(n)]
    for i, node in enumerate(nodes):
        start[i] = seen
        if i:
            order[i] = len(children[node.parent])
            children[node.parent].append(i)
        links[i], controls[i], elements[i] = node.links, node.controls, node.elements
        if node.tag:
            tag_own[i] = scores.get("<" + node.tag, 0.0)
            elements[i] += 1
            own = [scores[t] for t in node.tokens if t in scores]
            low[i], high[i] = (min(own), max(own)) if own else (0.0, 0.0)
        else:
            text = node.text
            chars[i] = longest[i] = len(text)
            words[i] = text.count(" ") + 1
            link[i], runs[i] = node.link, 1
            marks[i] = text.count(".") + text.count(",")
            tag_own[i] = tag_own[node.parent]
            heads[i] = nodes[node.parent].tag in ("h1", "h2", "h3")
            seen += len(text)
    low_up, high_up, tag_low, tag_high = low.copy(), high.copy(), tag_own.copy(), tag_own.copy()
    for i in range(1, n):
        p = nodes[i].parent
        low_up[i], high_up[i] = min(low[i], low_up[p]), max(high[i], high_up[p])
        tag_low[i], tag_high[i] = min(tag_own[i], tag_low[p]), max(tag_own[i], tag_high[p])
    own_chars = chars.copy()
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        for part in (chars, words, link, links, controls, elements, runs, heads, marks):
            part[p] += part[i]
        longest[p] = max(longest[p], longest[i])
    up = np.array([max(node.parent, 0) for node in nodes])
    siblings, alike, before, after = np.ones(n), np.ones(n), np.zeros(n), np.zeros(n)
    for own in children:
        tags: dict[str, int] = defaultdict(int)
        for c in own:
            tags[nodes[c].tag] += 1
        for k, c in enumerate(own):
            siblings[c], alike[c] = len(own), tags[nodes[c].tag]
            before[c] = chars[own[k - 1]] if k else 0
            after[c] = chars[own[k + 1]] if k + 1 < len(own) else 0
    mean = (chars[up] - chars) / np.maximum(siblings - 1, 1)
    total = max(chars[0], 1.0)
    depth = np.array([node.depth for node in nodes])
    return np.column_stack([
        depth, order / siblings, siblings, alike, own_chars > 0, tag_own, tag_low, tag_high, low, high, low_up, high_up,
        np.log1p(chars), np.log1p(words), link / np.maximum(chars, 1), elements, chars / (elements + 1), chars / total, start / total,
        runs, chars / np.maximum(runs, 1), longest, marks / np.maximum(words, 1), links, controls, np.log1p(mean), np.log1p(before),
        np.log1p(after), chars / np.maximum(chars[up], 1), link[up] / np.maximum(chars[up], 1), heads, tag_own[up], low[up], high[up], runs[up],
        longest[up], marks[up] / np.maximum(words[up], 1), controls[up],
    ])


def decode(nodes: list[Node], margins: Sequence[float]) -> np.ndarray:
    """The most probable choice that keeps no node without its parent. A node's part in it: its log-odds."""
    n = len(nodes)
    gain = np.array(margins, float)
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[nodes[i].parent] += gain[i]
    kept = np.zeros(n, bool)
    kept[0] = gain[0] > 0
    for i in range(1, n):
        kept[i] = kept[nodes[i].parent] and gain[i] > 0
    return kept


@dataclass
class Extractor:
    scores: dict[str, float]
    forest: Forest

    def texts(self, pages: list[str]) -> list[str]:
        """The main text of each page: its blocks in page order, one line each."""
        parsed = [parse(page) for page in pages]
        margins = self.forest.margins(np.concatenate([feature_rows(nodes, self.scores) for nodes in parsed])) if parsed else []
        out, at = [], 0
        for nodes in parsed:
            kept = decode(nodes, margins[at : at + len(nodes)])
            out.append("\n".join(node.text for node, keep in zip(nodes, kept, strict=True) if keep and node.text))
            at += len(nodes)
        return out


def _labels(nodes: list[Node]) -> np.ndarray | None:
    """1 for the nodes with main text, by the article or main element; None for a page without one."""
    inside = np.zeros(len(nodes), bool)
    for i, node in enumerate(nodes[1:], 1):
        inside[i] = (inside[node.parent] or node.tag in MAIN_TAGS) and node.tag not in ASIDE_TAGS
    return _upwards(nodes, [bool(node.text) and bool(inside[i]) for i, node in enumerate(nodes)]) if inside.any() else None


def _upwards(nodes: list[Node], main: list[bool]) -> np.ndarray:
    label = np.array(main, float)
    for i in range(len(nodes) - 1, 0, -1):
        label[nodes[i].parent] = max(label[nodes[i].parent], label[i])
    return label


# Names that pages use for their parts. Fixed values.
_NAMES = {
    "main": "article post content entry entry-content story article-body post-body main-content text body-text news single".split(),
    "header": "header site-header masthead topbar banner-top branding page-header top".split(),
    "nav": "nav menu navbar navigation main-menu links breadcrumbs breadcrumb toc pagination pager".split(),
    "side": "sidebar side aside widget widgets related related-posts recent-posts rail right-column secondary tags".split(),
    "notice": "notice cookie cookie-banner gdpr alert consent popup modal message warning privacy-notice".split(),
    "ad": "ad ads advert advertisement sponsored promo promotion banner ad-slot sponsor".split(),
    "form": "form search newsletter subscribe signup login contact-form search-form".split(),
    "comments": "comments comment comment-list discussion responses replies respond reader-comments disqus".split(),
    "footer": "footer site-footer copyright bottom credits legal colophon".split(),
    "neutral": "wrapper container row col inner page site section block box layout wrap clearfix grid".split(),
}
_TAGS = {
    "main": ["article", "main", "div", "div", "section"], "header": ["header", "div"], "nav": ["nav", "div", "ul"], "side": ["aside", "div", "section"],
    "notice": ["div", "section", "p"], "ad": ["div", "aside", "section"], "form": ["form"], "comments": ["section", "div", "ol"], "footer": ["footer", "div"],
    "neutral": ["div", "section"],
}


class _Layout:
    """Made-up pages from blocks of text."""

    def __init__(self, blocks: list[str], other: list[str], seed: int):
        self.random = random.Random(seed)
        self.blocks, self.other = blocks, other

    def element(self, kind: str, inner: str, bare: float = 0.25, tag: str = "") -> str:
        r = self.random
        tag = tag or r.choice(_TAGS[kind])
        names = "" if r.random() < bare and tag not in ("div", "section", "p") else f' {r.choice(["class", "class", "id"])}="{" ".join([r.choice(_NAMES[kind]), *([r.choice(_NAMES["neutral"])] * (r.random() < 0.3))])}"'
        return f"<{tag}{names}>{inner}</{tag}>"

    def words(self, low: int, high: int) -> str:
        r = self.random
        got = r.choice(self.other).split()
        at = r.randrange(len(got)) if got else 0
        return html.escape(" ".join(got[at : at + r.randint(low, high)]) or "more", quote=False)

    def anchors(self, n: int, wrap: str = "li") -> str:
        made = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(n)]
        return "".join(f"<{wrap}>{a}</{wrap}>" for a in made) if wrap else " | ".join(made)

    def prose(self, low: int, high: int) -> str:
        return "".join(f"<p>{self.words(5, 80)}</p>" for _ in range(self.random.randint(low, high)))

    def part(self, kind: str) -> str:
        r = self.random
        if kind == "nav":
            return self.element("nav", r.choice([f"<ul>{self.anchors(r.randint(2, 9))}</ul>", self.anchors(r.randint(2, 6), ""), self.anchors(r.randint(2, 6), "span")]))
        if kind == "header":
            return self.element("header", r.choice([f"<h1>{self.words(1, 4)}</h1>", f"<div>{self.words(1, 5)}</div>"]) + r.choice(["", f"<p>{self.words(3, 12)}</p>", self.part("nav")]))
        if kind == "side":
            return self.element("side", f"<h3>{self.words(1, 4)}</h3>" + r.choice([f"<ul>{self.anchors(r.randint(2, 7))}</ul>", self.prose(1, 3), f"<p>{self.words(4, 60)}</p>"]))
        if kind == "form":
            return self.element("form", f"<label>{self.words(1, 4)}</label><input name=q>" + r.choice(["", f"<p>{self.words(3, 20)}</p>", "<textarea>text</textarea>"]) + f"<button>{self.words(1, 2)}</button>")
        if kind == "comments":
            item = lambda: self.element("comments", r.choice([f"<b>{self.words(1, 2)}</b>", f"<div>{self.words(1, 3)}</div>", ""]) + self.prose(1, 2), 0.1, r.choice(["div", "li", "div"]))
            return self.element("comments", f"<h2>{self.words(1, 3)}</h2>" * (r.random() < 0.6) + "".join(item() for _ in range(r.randint(1, 5))))
        if kind == "footer":
            return self.element("footer", r.choice([f"&copy; {self.words(1, 3)} &middot; {self.words(4, 40)}", f"<p>{self.words(4, 50)}</p>", self.anchors(r.randint(2, 5), "")]))
        return self.element(kind, r.choice([self.words(3, 50), f"<p>{self.words(4, 60)}</p>", f"<p>{self.words(3, 30)}</p><button>{self.words(1, 2)}</button>"]))

    def main(self) -> str:
        r, inner = self.random, []
        for k, block in enumerate(self.blocks):
            text = html.escape(block, quote=False)
            if r.random() < 0.2 and len(text) > 80:
                cut = text.find(" ", 20)
                text = f'{text[:cut]} <a href="/x">{text[cut + 1 : cut + 12]}</a>{text[cut + 12 :]}' if "&" not in text[:cut + 12] else text
            text = _MARK + text
            tag = r.choice(["h1", "h1", "h2"]) if not k else r.choice(["p"] * 9 + ["blockquote", "h2", "pre", "div"])
            inner.append(f"<ul><li>{text}</li></ul>" if k and r.random() < 0.06 else f"<{tag}>{text}" + f"</{tag}>" * (r.random() < 0.93))
            if k and r.random() < 0.08:
                inner.append(self.part(r.choice(["ad", "side", "form", "notice"])))
        body = "".join(inner)
        if r.random() < 0.3:
            body = self.element("neutral", body)
        if r.random() < 0.25:
            body += self.part(r.choice(["comments", "side", "nav", "form"]))
        return self.element("main", body, 0.4)

    def page(self) -> str:
        r = self.random
        around = lambda kinds, most: "".join(self.part(k) for k in r.sample(kinds, r.randint(0, most)))
        body = around(["nav", "header", "notice", "ad", "side", "form"], 4) + self.main() + around(["comments", "side", "ad", "form", "footer", "nav", "notice"], 5)
        for _ in range(r.randint(0, 2)):
            body = self.element("neutral", body)
        return f"<html><head><title>{self.words(2, 8)}</title></head><body>{body}</body></html>"


def train(pages: list[str], seed: int = 3) -> Extractor:
    """An extractor from pages, whichever of them have an article or main element; without any, from made-up text."""
    examples: list[tuple[list[Node], np.ndarray]] = []
    texts: list[list[str]] = []
    for page in pages:
        nodes = parse(page)
        labels = _labels(nodes)
        if labels is not None:
            examples.append((nodes, labels))
            blocks = [node.text for node, y in zip(nodes, labels, strict=True) if y and node.text]
            texts += [blocks] * bool(blocks)
    texts = texts or [[f"Line {i} of a page, with some words, that go on for a while." * (1 + i % 3) for i in range(j)] for j in range(2, 30)]
    other = [b for blocks in texts for b in blocks[:4]]
    chooser = random.Random(seed)
    for k in range(LAYOUTS * len(texts)):
        blocks = chooser.choice(texts)
        nodes = parse(_Layout(blocks[: chooser.randint(1, 14)], other, seed * 100_003 + k).page())
        main = [_MARK in node.text for node in nodes]
        for node in nodes:
            node.text = node.text.replace(_MARK, "")
        examples.append((nodes, _upwards(nodes, main)))
    counts: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for nodes, labels in examples:
        for node, y in zip(nodes, labels, strict=True):
            for name in {*node.tokens, "<" + node.tag} if node.tag else ():
                counts[name][int(y)] += 1
    scores = {name: float(np.log((yes + 1) / (no + 1))) for name, (no, yes) in counts.items() if yes + no >= 3}
    x = np.concatenate([feature_rows(nodes, scores) for nodes, _ in examples])
    return Extractor(scores, grow(x, np.concatenate([labels for _, labels in examples])))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row (id, url, text, n_chars) per row of pages. n_chars counts code points.

    Null or empty html, and pages without main text, have an empty text. Repeated rows stay repeated; other columns are not
    read. The trees are fitted on the driver on about SAMPLE pages of at most SAMPLE_CHARS characters.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    sample = bounded_sample(rows.where(F.length("html").between(1, SAMPLE_CHARS)), ["id"], SAMPLE).select("html").collect()
    shared = pages.sparkSession.sparkContext.broadcast(train(sorted(r[0] for r in sample)))

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts: list[str] = []
        for at in range(0, rows.num_rows, 200):
            texts += shared.value.texts(rows.column(2)[at : at + 200].to_pylist())
        return pa.record_batch([rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, batch, f"id {kind}, url {rows.schema['url'].dataType.simpleString()}, text string, n_chars long")
