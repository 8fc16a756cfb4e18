import html as entities
import random
import re

import pytest
from llm_samples import words  # noqa: F401

from wellnote.llm import extraction as ex


@pytest.fixture(scope="module")
def model(spark):
    return ex.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def expected(html):
    """Text of the given tables' articles, by their markup."""
    m = re.search(r"<article>(.*?)(</article>|$)", html, re.S)
    blocks = [" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split())
              for b in re.split(r"</?(?:p|h1)>", m[1] if m else "")]
    return " ".join(b for b in blocks if b)


def test_given_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    given = {r.page_id: r.html for r in pages.collect()}
    got = ex.main_texts(pages, model).collect()
    assert len(got) == len(given)
    assert all(r.text == expected(given[r.page_id]) and r.n_chars == len(r.text) for r in got)


def test_held_out_layouts(model):
    """Variants with another seed: nearly all text runs get their mark."""
    rng = random.Random(77)
    words = ["some words of a sentence that stands here, and more.", "another one follows at once", "short", "Two words."]
    paragraphs = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(80)]
    right = total = 0
    for _ in range(150):
        tree = ex.parse(ex.variant(paragraphs, rng))
        marks = tree.marks()
        found, _ = model.marginals(tree)
        for text, mark, p in zip(tree.text, marks, found):
            if text is not None:
                total += 1
                right += (p > 0.5) == bool(mark)
    assert right / total > 0.95


def test_messages_give_exact_marginals():
    """Against the sum over all labellings of a small tree."""
    import itertools
    import math
    tree = ex.parse("<div class=a><p>one</p><ul><li>two</li></ul></div>")
    m = ex.TreeModel()
    rng = random.Random(3)
    for fs in tree.features:
        for f in fs:
            m.weights[f] = rng.uniform(-1, 1)
    m.edges = [[[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)] for _ in range(2)]
    n = len(tree.parent)
    total, ones = 0.0, [0.0] * n
    for y in itertools.product((0, 1), repeat=n):
        s = sum(y[i] * sum(m.weights[f] for f in tree.features[i]) for i in range(n))
        s += sum(m.edges[tree.text[i] is not None][y[tree.parent[i]]][y[i]] for i in range(n) if tree.parent[i] >= 0)
        total += math.exp(s)
        for i in range(n):
            ones[i] += y[i] * math.exp(s)
    found, _ = m.marginals(tree)
    assert all(abs(a - b / total) < 1e-9 for a, b in zip(found, ones))


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""),
    ("<article><p>a<p>b</article>", "a b"), ("<article><p>one &amp;amp; &lt;b&gt; &nbsp;two<br>three", "one &amp; <b> two three"),
    ("<body><script>var t='</p>';</script><article><p>x<b>y</b>z</p><!-- no --></article>", "xyz"),
    ("<nav><a href=/>home</a></nav><article><h1>T</h1><p>body <i>text</i></p></article><footer>f</footer>", "T body text"),
    ("<article><p>cut off <a href=", "cut off"), ("</div></p><article>stray</b> ends</article>", "stray ends"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be given.</p></article>", "Let x=2 be given."),
    ("<article><div>before <button>press</div><p>after the button</p></article>", "before after the button"),
    ("<article><p>one</p><div><select><option>a<option>b</div><p>two</p></article>", "one two"),
    ("<article><div><object data=x>fallback</div><p>rest</p></article>", "rest"),
    ("<article><template><p>never</p></template><p>shown</p></article>", "shown"),
])
def test_markup(model, html, text):
    assert model.extract(html) == text


def test_pages_without_names_give_their_text(model):
    paragraphs = ["A first paragraph that says something about its subject at some length.",
                  "A second one goes on where the first one ended, with a few more words.", "And a last, short one."]
    plain = "".join(f"<p>{p}</p>" for p in paragraphs)
    for page in (f"<html><body><div>{plain}</div></body></html>", f"<div><div>{plain}</div></div>", f"<html><body>{plain}</body></html>",
                 f"<body><div><h1>A title</h1>{plain}</div></body>"):
        assert model.extract(page).replace("A title ", "") == " ".join(paragraphs)


def test_usual_furniture(model):
    page = """<html><head><title>t</title></head><body><header><h1>Site name</h1></header>
    <div class="cookie-notice"><p>We use cookies on this site to serve you.</p></div>
    <div class="post-content"><h1>Title</h1><p>First paragraph of the text, which is long enough to matter.</p>
    <form class="newsletter"><p>Sign up now</p></form><p>Second.</p></div>
    <div id="comments"><h3>Comments</h3><div class="comment"><p>I liked this very much, thank you.</p></div></div>
    <aside class="sidebar"><ul><li><a href="#">Other page</a></li></ul></aside><footer>Copyright</footer></body></html>"""
    assert model.extract(page) == "Title First paragraph of the text, which is long enough to matter. Second."


def test_odd_and_empty_tables(spark, model):
    pages = spark.createDataFrame([(1, None, None, "t", 3), (None, "u", "<article><p>x</p></article>", "t", 3),
                                   (2, "u", "<article>" + "<div>" * 3000 + "deep" + "<p>y</p>" * 20_000, "t", 3),
                                   (2, "u", "<article>" + "<div>" * 3000 + "deep" + "<p>y</p>" * 20_000, "t", 3)],
                                  "page_id long, url string, html string, text string, n_chars int")
    got = sorted(ex.main_texts(pages, model).collect(), key=repr)
    assert [(r.page_id, r.url, r.text[:8], r.n_chars) for r in got] == [
        (1, None, "", 0), (2, "u", "deep y y", 40_004), (2, "u", "deep y y", 40_004), (None, "u", "x", 1)]
    assert ex.main_texts(pages.limit(0)).count() == 0
