"""Main text of web pages: boosted trees over page elements, decoded along the tree.

Every element has features of itself, of its subtree and of its place among its siblings
and ancestors. Gradient-boosted trees give the odds that it belongs to the main text. An
element can only be kept if its parent is; among all such choices the one with the
highest total odds is taken, so no kept element stands below a dropped one.

The trees are trained on pages whose parts are known: pages of the table whose main text
stands in an article or main element, and layouts composed from their paragraphs with
menus, notices, comments and the like around and inside of the text.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.llm.dom import NO_TEXT, Page
from leadgrade.plans.sizing import written

#: The learner's bounds: so many pages of at most so many characters.
TRAIN_PAGES, TRAIN_CHARS, LAYOUTS = 240, 40_000, 2
TREES, DEPTH = 16, 5

# Words in class, id and role by the part of a page they speak of.
MARKS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs toc pager pagination toolbar tabs skip",
    "edge": "header footer masthead topbar copyright legal colophon bottom contentinfo banner logo",
    "side": "sidebar side aside rail widget widgets complementary",
    "ad": "ad ads adv advert advertisement sponsor sponsored promo promotion promoted adsense",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay dialog disclaimer message",
    "form": "form login signin signup register search subscribe newsletter subscription contact input",
    "comment": "comment comments reply replies respond disqus discussion thread feedback reviews response responses",
    "other": "related recommended recommendations share sharing social more trending popular tags teaser links",
    "main": "article content main post entry story text body page hentry articlebody prose",
}
_OF = {word: i for i, words in enumerate(MARKS.values()) for word in words.split()}
_MAIN = len(MARKS) - 1
TAGS = (
    "nav menu",
    "header footer",
    "aside dialog",
    "form fieldset select button textarea input label",
    "article main",
    "section div body html #root",
    "p blockquote pre",
    "h1 h2 h3 h4 h5 h6",
    "ul ol li dl dt dd",
    "table thead tbody tfoot tr td th caption",
    "a",
    "figure figcaption img",
    "head title meta link script style noscript iframe template",
)
_GROUP = {tag: i for i, tags in enumerate(TAGS) for tag in tags.split()}
_LINK = TAGS.index("a")
N_FEATURES = 2 * len(MARKS) + len(TAGS) + 5 + 19
_WORD = re.compile(r"[a-z]+")


def features(page: Page) -> np.ndarray:
    """A row for each element of the page."""
    n = len(page.tag)
    parent = page.parent
    group = [_GROUP.get(t, len(TAGS)) for t in page.tag]
    own, words, stops = [0] * n, [0] * n, [0] * n
    linked, under, first = [0] * n, [1] * n, [0] * n
    in_link = [False] * n
    paragraphs, links = [0] * n, [0] * n
    children: list[int] = [0] * n
    index = [0] * n
    marks = np.zeros((n, len(MARKS)))
    for i in range(n):
        p = parent[i]
        if p >= 0:
            index[i] = children[p]
            children[p] += 1
            in_link[i] = in_link[p]
        if group[i] == _LINK:
            in_link[i] = True
            links[i] = 1
        if page.tag[i] == "p":
            paragraphs[i] = 1
        if page.attrs[i]:
            for word in _WORD.findall(page.attrs[i]):
                k = _OF.get(word)
                if k is not None:
                    marks[i, k] += 1
    at, seen = 0, [False] * n
    for node, piece in page.text:
        size = len(piece) - piece.count(" ") if piece else 0
        if not seen[node]:
            seen[node], first[node] = True, at
        if not size:
            continue
        own[node] += size
        words[node] += piece.count(" ") + 1
        stops[node] += piece.count(".") + piece.count(",")
        if in_link[node]:
            linked[node] += size
        at += size
    total = max(at, 1)
    size = own[:]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        size[p] += size[i]
        words[p] += words[i]
        stops[p] += stops[i]
        linked[p] += linked[i]
        under[p] += under[i]
        paragraphs[p] += paragraphs[i]
        links[p] += links[i]
    parents = np.maximum(np.array(parent), 0)
    s, w, u = np.array(size, float), np.array(words, float), np.array(under, float)
    above = np.zeros_like(marks)
    tags_above = np.zeros((n, 5))
    for i in range(1, n):
        p = parent[i]
        above[i] = above[p] + marks[p]
        tags_above[i] = tags_above[p]
        if group[p] < 5:
            tags_above[i, group[p]] = 1
    kinds = np.zeros((n, len(TAGS) + 1))
    kinds[np.arange(n), group] = 1
    o, k = np.array(own, float), np.array(children, float)
    siblings = k[parents]
    place = np.array(index, float)
    start = np.array(first, float) / total
    whole = np.maximum(s, 1)
    rest = (s[parents] - s) / np.maximum(siblings - 1, 1)
    columns = [
        np.log1p(s), np.log1p(o), np.log1p(w), s / np.maximum(u, 1), np.array(linked) / whole,
        np.array(stops) / whole, w / whole, np.log1p(np.array(paragraphs)), np.log1p(np.array(links)),
        s / total, s / np.maximum(s[parents], 1), np.log1p(rest), place, siblings - 1 - place,
        np.array(page.depth, float), start, (np.array(linked)[parents]) / np.maximum(s[parents], 1),
        np.log1p(s[parents]), k,
    ]
    return np.concatenate(
        [marks, np.minimum(above, 3), kinds[:, : len(TAGS)], tags_above, np.stack(columns, axis=1)], axis=1
    )


@dataclass(frozen=True)
class TreeModel:
    """Trees as arrays (tree, node); a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, t, a, b, v in zip(self.feature, self.threshold, self.left, self.right, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = np.where(x[rows, f[node]] <= t[node], a[node], b[node])
            total += v[node]
        return 2 * total


def kept_elements(page: Page, odds: np.ndarray) -> list[bool]:
    """The choice with the highest total odds in which a kept element's parent is kept."""
    n = len(page.tag)
    best = odds.tolist()
    for i in range(n - 1, 0, -1):
        if page.tag[i] in NO_TEXT:
            best[i] = -1.0
        elif best[i] > 0:
            best[page.parent[i]] += best[i]
    keep = [True] * n
    for i in range(1, n):
        keep[i] = keep[page.parent[i]] and best[i] > 0
    return keep


def main_text(source: str, model: TreeModel) -> str:
    page = Page(source)
    return page.blocks(kept_elements(page, model.odds(features(page))))


class _Layout:
    """Writes a page and remembers which of its elements hold main text."""

    def __init__(self):
        self.out, self.label = [], [1.0]

    def start(self, tag: str, label: float, **attrs: str) -> None:
        marks = "".join(f' {k.rstrip("_")}="{escape(v)}"' for k, v in attrs.items() if v)
        self.out.append(f"<{tag}{marks}>")
        self.label.append(label)

    def end(self, tag: str) -> None:
        self.out.append(f"</{tag}>")

    def block(self, tag: str, label: float, text: str, **attrs: str) -> None:
        self.start(tag, label, **attrs)
        self.out.append(escape(text))
        self.end(tag)


def _part(page: _Layout, kind: str, draw: random.Random, lines: list[str]) -> None:
    """A part of a page that is no main text."""
    word = draw.choice(MARKS[kind].split())
    tag = {"nav": "nav", "edge": draw.choice(("header", "footer")), "side": "aside", "form": "form"}.get(kind, "div")
    if draw.random() < 0.5:
        tag = draw.choice(("div", "section"))
    named = tag in ("nav", "header", "footer", "aside", "form") and draw.random() < 0.5
    mark = "" if named else draw.choice((word, f"{word}-{draw.choice(('box', 'list', 'wrap', 'area', 'block'))}", f"site-{word}"))
    page.start(tag, 0.0, **{draw.choice(("class_", "id")): mark})
    if kind == "comment":
        for _ in range(draw.randint(1, 4)):
            page.start("div", 0.0, class_=draw.choice(("comment", "comment-body", "reply", "")))
            page.block("p", 0.0, draw.choice(lines))
            page.end("div")
    elif kind == "nav" or draw.random() < 0.4:
        page.start("ul", 0.0)
        for _ in range(draw.randint(2, 7)):
            page.start("li", 0.0)
            page.block("a", 0.0, " ".join(draw.choice(lines).split()[: draw.randint(1, 6)]), href="/x")
            page.end("li")
        page.end("ul")
    elif draw.random() < 0.5:
        page.block("p", 0.0, " ".join(draw.choice(lines).split()[: draw.randint(3, 40)]))
    else:
        if draw.random() < 0.4:
            page.block("h3", 0.0, " ".join(draw.choice(lines).split()[:4]))
        page.out.append(escape(" ".join(draw.choice(lines).split()[: draw.randint(3, 30)])))
    page.end(tag)


def layout(title: str, body: list[str], lines: list[str], draw: random.Random) -> tuple[str, list[float]]:
    """A page with the title and body as main text, and the label of each element."""
    page = _Layout()
    parts = [k for k in MARKS if k != "main"]
    page.start("html", 1.0)
    page.start("body", 1.0)
    for kind in draw.sample(parts, draw.randint(1, 4)):
        _part(page, kind, draw, lines)
    wrapped = draw.random() < 0.5
    if wrapped:
        page.start("div", 1.0, **{draw.choice(("class_", "id")): draw.choice(("page", "wrapper", "container", ""))})
    tag = draw.choice(("article", "main", "div", "div", "section"))
    mark = draw.choice(MARKS["main"].split()) if tag in ("div", "section") or draw.random() < 0.3 else ""
    page.start(tag, 1.0, **{draw.choice(("class_", "id")): mark})
    page.block("h1", 1.0, title)
    for i, text in enumerate(body):
        if draw.random() < 0.12 and i:
            _part(page, draw.choice(parts), draw, lines)
        kind = draw.random()
        if kind < 0.08:
            page.start("ul", 1.0)
            for piece in text.split(". ")[:6]:
                page.block("li", 1.0, piece)
            page.end("ul")
        elif kind < 0.14:
            page.start("blockquote", 1.0)
            page.block("p", 1.0, text)
            page.end("blockquote")
        elif kind < 0.22:
            page.block("h2", 1.0, " ".join(text.split()[:5]))
        elif kind < 0.32:
            words = text.split()
            page.start("p", 1.0)
            page.out.append(escape(" ".join(words[: len(words) // 2])))
            page.block(draw.choice(("b", "em", "span")), 1.0, " ".join(words[len(words) // 2 : -1]))
            page.block("a", 1.0, words[-1] if words else "", href="/y")
            page.end("p")
        else:
            page.block(draw.choice(("p", "p", "p", "p", "div")), 1.0, text)
    if draw.random() < 0.3:
        _part(page, "comment", draw, lines)
    page.end(tag)
    if wrapped:
        page.end("div")
    for kind in draw.sample(parts, draw.randint(1, 4)):
        _part(page, kind, draw, lines)
    page.end("body")
    page.end("html")
    return "".join(page.out), page.label


def _known(page: Page) -> list[float] | None:
    """Labels of a page whose main text stands in an article or main element."""
    n = len(page.tag)
    label = [0.0] * n
    for i in range(1, n):
        label[i] = 1.0 if page.tag[i] in ("article", "main") else label[page.parent[i]]
        marks = {_OF.get(w) for w in _WORD.findall(page.attrs[i])} - {None, _MAIN}
        if page.tag[i] in NO_TEXT or marks or _GROUP.get(page.tag[i], 99) in (0, 2, 3):
            label[i] = 0.0
    if 1.0 not in label:
        return None
    for i in range(n - 1, 0, -1):
        if label[i]:
            label[page.parent[i]] = 1.0
    return label


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages (key, html) to (label, features) of the elements of known layouts."""
    for batch in batches:
        labels, rows = [], []
        pages = [Page(x) for x in batch["html"].to_pylist()]
        lines = [
            x
            for p in pages
            for x in p.blocks([t not in NO_TEXT for t in p.tag]).split("\n")
            if len(x.split()) > 2
        ] or ["no text here"]
        for key, page in zip(batch["key"].to_pylist(), pages, strict=True):
            known = _known(page)
            if known is None:
                continue
            draw = random.Random(key)
            labels += known
            rows.append(features(page))
            body = page.blocks([bool(x) for x in known]).split("\n")
            for _ in range(LAYOUTS):
                source, label = layout(body[0], body[1:] or body, lines, draw)
                made = Page(source)
                if len(label) == len(made.tag):
                    labels += label
                    rows.append(features(made))
        if rows:
            x = np.concatenate(rows).astype(np.float64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([pa.array(labels), lists], ["label", "features"])


def learn(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> TreeModel:
    """Trees fitted on the ``train_pages`` pages with the smallest hash of their html, of at most
    ``TRAIN_CHARS`` characters each. Without a page whose main text is known there is no
    tree, and every element counts as main text."""
    key = F.xxhash64("html", F.lit(5))
    sample = (
        pages.where(F.length("html") <= TRAIN_CHARS)
        .select(key.alias("key"), "html")
        .orderBy("key", "html")
        .limit(train_pages)
    )
    rows = written(sample.repartition(2, "key").sortWithinPartitions("key").mapInArrow(
        _examples, "label double, features array<double>"
    ), "examples")
    if rows.select("label").distinct().count() < 2:
        one = np.zeros((1, 1), np.int64)
        return TreeModel(one, np.zeros((1, 1)), one, one, np.ones((1, 1)))
    data = rows.select("label", array_to_vector("features").alias("features")).coalesce(2)
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32).fit(data)
    return _arrays(fitted)


def _arrays(fitted) -> TreeModel:
    trees = []
    for tree, weight in zip(fitted.trees, fitted.treeWeights, strict=True):
        rows: list[list[float]] = []

        def walk(node, rows=rows, weight=weight) -> int:
            at = len(rows)
            rows.append([0, 0.0, at, at, weight * node.prediction()])
            if node.subtreeDepth():
                rows[at][0], rows[at][1] = node.split().featureIndex(), node.split().threshold()
                rows[at][2] = walk(node.leftChild())
                rows[at][3] = walk(node.rightChild())
            return at

        walk(tree._java_obj.rootNode())
        trees.append(rows)
    most = max(map(len, trees))
    table = np.zeros((len(trees), most, 5))
    for i, rows in enumerate(trees):
        table[i, : len(rows)] = rows
    whole = table[:, :, [0, 2, 3]].astype(np.int64)
    return TreeModel(whole[:, :, 0], table[:, :, 1], whole[:, :, 1], whole[:, :, 2], table[:, :, 4])


def _extracted(model: TreeModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                pages = [Page(x or "") for x in batch["_html"].to_pylist()]
                tables = [features(p) for p in pages]
                odds = model.odds(np.concatenate(tables))
                edges = np.cumsum([len(t) for t in tables])[:-1]
                text = [
                    p.blocks(kept_elements(p, o)) for p, o in zip(pages, np.split(odds, edges), strict=True)
                ]
                size = [len(x) for x in text]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(text, pa.string()), pa.array(size, pa.int64())],
                    [*batch.schema.names[:-1], "text", "n_chars"],
                )

    return run


def extract(pages: DataFrame, model: TreeModel) -> DataFrame:
    """``pages`` with text and n_chars; same-named columns go, and so does html.

    The whole html is read; null html, or html without main text, gives an empty text.
    Character references are decoded, white space inside a block (line breaks too) becomes
    one space, blocks are trimmed and joined by one line feed in page order. n_chars counts code
    points. Repeated rows are all returned; an empty table stays empty.
    """
    kept = pages.drop("text", "n_chars")
    others = [c for c in kept.columns if c != "html"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "html"]
    return kept.select(*others, F.col("html").alias("_html")).mapInArrow(
        _extracted(model), ", ".join([*fields, "text string", "n_chars long"])
    )
