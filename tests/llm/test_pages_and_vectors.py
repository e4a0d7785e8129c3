import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade.llm import extract, top_k
from leadgrade.llm.dom import Page

KEPT = {
    "<p>a<b>x<br>y<p>c</p></article>d": "ax y\nc\nd",
    '<div>foo<script>var t="</p>";</script>bar<p></p>baz</div>': "foobar\nbaz",
    'a < b &amp; c <p title="x>y">q &lt;&#233;&gt;</p>': "a < b & c\nq <é>",
    "<ul><li>a<li>b</ul>t": "a\nb\nt",
    '<p title="abc>x</p>y<!-- z': "x\ny",
    "<a href=x>l</a": "l",
    "": "",
    "<td> 1 \n\t 2 <td>3": "1 2\n3",
    "<html><head><title>t</title><meta x><body><p>a": "a",
    "<head><link href=x><p>a</p><p>b": "a\nb",
    "<html><head><style>s</style> <div>a</div>b</html>": "a\nb",
    "<head><title>t</title>plain <b>text</b>": "plain text",
    "<html><body><p>a<p>b</html>": "a\nb",
    "<table><tr><td>a<table><tr><td>b<td>c</table>d<td>e</table>f": "a\nb\nc\nd\ne\nf",
    "<p>a<select><option>x</p><p>b</p>": "ax\nb",
    "<p>a<select><option>x</select>c</p><p>b</p>": "ac\nb",
}


@pytest.mark.parametrize("source", KEPT)
def test_blocks(source):
    page = Page(source)
    assert page.blocks([True] * len(page.tag)) == KEPT[source]


def test_the_best_choice_keeps_no_element_below_a_dropped_one():
    rng = np.random.default_rng(1)
    page = Page("<div><p>a</p><div><p>b</p><p>c</p></div></div><div><p>d</p></div>")
    n = len(page.tag)
    for _ in range(40):
        odds = rng.normal(size=n)
        best, choice = -np.inf, None
        for code in range(1 << (n - 1)):
            keep = [True, *[bool(code >> i & 1) for i in range(n - 1)]]
            if all(keep[page.parent[i]] or not keep[i] for i in range(1, n)):
                total = sum(o for o, k in zip(odds[1:], keep[1:], strict=True) if k)
                if total > best:
                    best, choice = total, keep
        assert extract.kept_elements(page, odds) == choice


@pytest.fixture(scope="module")
def tree_model(spark, sf_dir):
    return extract.learn(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_articles_of_the_table(spark, sf_dir, tree_model):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in extract.extract(pages, tree_model).join(pages.select("page_id", "html"), "page_id").collect():
        page = Page(r["html"])
        inside = [False] * len(page.tag)
        for i in range(1, len(page.tag)):
            inside[i] = page.tag[i] == "article" or inside[page.parent[i]]
        assert r["text"] == page.blocks(inside) and r["n_chars"] == len(r["text"])


def test_a_page_without_the_end_of_its_head(spark, tree_model):
    body = "".join(f"<p>Here is sentence {i} of a report that goes on for quite a while.</p>" for i in range(8))
    whole = f"<html><head><title>T</title><meta charset=u></head><body><article><h1>R</h1>{body}</article></body></html>"
    cut = whole.replace("</head>", "").replace("</body></html>", "")
    bare = cut.replace("<body>", "")
    table = spark.createDataFrame([(i, "u", s) for i, s in enumerate((whole, cut, bare))], "page_id long, url string, html string")
    texts = {r["text"] for r in extract.extract(table, tree_model).collect()}
    assert len(texts) == 1 and "sentence 7" in texts.pop()


def test_other_layouts(spark, tree_model):
    body = "".join(f"<p>This is paragraph {i} of the story, and it goes on for a while.</p>" for i in range(6))
    source = (
        '<html><head><title>T</title></head><body><header><a href="/">Home</a> <a href="/x">News</a></header>'
        '<div class="cookie-notice">We use cookies. Accept them all.</div>'
        f'<div id="content"><h1>Story</h1>{body}</div>'
        '<aside class="sidebar"><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></aside>'
        '<div id="comments"><div class="comment"><p>I like this story, it is a fine one to read.</p></div></div>'
        '<form class="newsletter"><p>Subscribe now</p><input name="m"></form>'
        "<footer>All rights reserved</footer></body></html>"
    )
    rows = [(1, "u", source, "mine"), (2, None, None, "x"), (3, "u", "", "x"), (3, "u", "", "x"), (None, "u", "<p", "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract.extract(table, tree_model).collect()
    text = [r["text"] for r in got if r["page_id"] == 1][0]
    assert text.startswith("Story\nThis is paragraph 0") and "paragraph 5" in text
    assert not any(w in text for w in ("cookies", "Home", "One", "I like", "Subscribe", "reserved"))
    assert len(got) == 5 and all(r["text"] == "" and r["n_chars"] == 0 for r in got if r["page_id"] != 1)
    assert extract.extract(table.limit(0), tree_model).collect() == []
    assert extract.learn(table.limit(0)).value.shape == (1, 1)


def brute(rows, queries, k):
    out = []
    for qid, q in queries:
        scored = [(-int(np.dot(v, q)), i) for i, v in rows if i != qid and len(v) == len(q)]
        out += [(qid, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 50])
def test_top_k_against_all_products(spark, monkeypatch, block):
    monkeypatch.setattr(top_k, "BLOCK", block)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    vectors = [(int(i), (centres[i % 6] + 0.1 * rng.normal(size=12)).tolist()) for i in range(400)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(60)] + [(2000, [1.0, 2.0]), (2020, [0.5, -1.0]), (2040, [0.0] * 12)]
    odd = [(3000, None), (3020, [float("nan")] * 12), (3040, [None] * 12), (3060, [float("inf")] * 12), (None, [1.0] * 12), (3080, [])]
    table = spark.createDataFrame([*vectors, *odd], "vec_id long, embedding array<double>")
    table = table.withColumn("rank", F.lit("clash"))
    got = top_k.top_k(table, table.where("vec_id % 20 = 0"))
    whole = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors]
    want = brute(whole, [x for x in whole if x[0] % 20 == 0], 20)
    assert sorted(map(tuple, got.collect())) == want
    assert top_k.top_k(table.limit(0), table.limit(0)).collect() == []


def test_products_beyond_double_are_exact():
    q = np.array([[1 << 40, 3]], np.int64)
    c = np.array([[1 << 20, 1], [1 << 40, 0]], np.int64)
    assert top_k._products(q, c).tolist() == [[(1 << 60) + 3, (1 << 63) - 1]]


def test_the_bound_leaves_blocks_that_cannot_help():
    best = top_k._Best(1, 2)
    q, own = np.array([[3, -1]]), np.array([7])
    far = np.column_stack([np.arange(100, 200), np.zeros(100, int)])
    top_k._search(q, own, far, np.arange(100), best)
    assert best.scores[0].tolist() == [597, 594]
    seen = []
    real = top_k._products
    top_k._products = lambda a, b: seen.append(len(b)) or real(a, b)
    try:
        top_k._search(q, own, np.column_stack([np.arange(100), np.zeros(100, int)]), np.arange(100), best)
    finally:
        top_k._products = real
    assert seen == [] and best.ids[0].tolist() == [99, 98]
