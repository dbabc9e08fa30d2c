"""Page text: markup of every kind, the field's arithmetic, and the table's own articles."""

import html
import itertools
import re
import time

import numpy as np
import pytest

from recordmill.llm import main_text as M


def test_blocks():
    page = (
        "<head><title>T &amp; t</title><style>p{}</style></head><body><p>One <b>two</b>\n three<br>four<p>five &lt;6"
        "<script>var a='</p>';</script> seven<!-- no > --> < 8<div>nine<a href='x>y'>ten</a></div>last &nbsp; one"
    )
    assert [b[0] for b in M.blocks(page)] == ["One two three", "four", "five <6", "seven < 8", "nineten", "last one"]
    assert M.blocks("") == [] and M.blocks("<a") == [] and M.blocks("   ") == []
    assert [b[0] for b in M.blocks("a<p title='b>c'>d")] == ["a", "d"]


@pytest.mark.parametrize("page", [
    "<a" * 500_000, "<a " * 300_000, '<a "' * 250_000, "<!--" * 250_000, "<p>" * 200_000, "<script>" * 100_000,
    "&" * 1_000_000, '<a b="' * 200_000, "<a b='c" * 100_000 + ">"])
def test_hostile_pages_take_linear_time(page):
    start = time.process_time()
    M.main_text(page, M.prior())
    assert time.process_time() - start < 8


def test_viterbi_and_forward_backward_against_all_labellings():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        score, step = rng.normal(size=n), rng.normal(size=(2, 2))
        value = {
            y: sum(s for s, k in zip(score, y) if k) + sum(step[a, b] for a, b in zip(y, y[1:]))
            for y in itertools.product((0, 1), repeat=n)
        }
        assert tuple(M.viterbi(score.tolist(), step)) == max(value, key=value.get)
        weight = {y: np.exp(v) for y, v in value.items()}
        total = sum(weight.values())
        p, pairs = M.forward_backward(score, step)
        assert p == pytest.approx([sum(w for y, w in weight.items() if y[i]) / total for i in range(n)])
        want = np.zeros((2, 2))
        for y, w in weight.items():
            for a, b in zip(y, y[1:]):
                want[a, b] += w / total
        assert pairs == pytest.approx(want)


def article(page):
    inside = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside))).split())


def test_articles_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in M.extract(pages, M.train(pages)).collect()}
    want = {r.page_id: article(r.html) for r in pages.collect()}
    assert got == want


PAGE = """<html><head><title>T</title></head><body><header><a href=/>Home</a></header><nav><a>One</a><a>Two</a></nav>
<div class="cookie-notice">We use cookies. OK</div><aside>Side text here about things. And more.</aside>{0}
<h1>Title of it</h1><p>First paragraph of the &eacute;tude text, long enough to be a real one, with commas and such.</p>
<div class="ad-box">Buy now, it is cheap today!</div><p>Second&nbsp;one is here   too, and says <i>many</i> things.</p>
<form><label>Email</label><input><button>Go</button></form>
<section class="comments"><h3>Comments</h3><p>Great article, I liked it a lot. Thanks.</p></section>{1}<footer>(c) 2020</footer>"""
TEXT = "Title of it First paragraph of the étude text, long enough to be a real one, with commas and such. Second one is here too, and says many things."


def test_page_parts_that_no_training_page_has(spark, sf_dir):
    w = M.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    for tags in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>")):
        assert M.main_text(PAGE.format(*tags), w) == TEXT


def test_cases(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<nav>a</nav>", "x"), (2, "u", PAGE.format("<main>", "</main>"), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for pages in (df, df.limit(0)):
        got = M.extract(df, M.train(pages)).collect()
        assert sorted((r.page_id or 0, r.text == "") for r in got) == [(0, True), (1, True), (2, False), (2, True)]
    assert M.extract(df.limit(0), M.prior()).count() == 0


def test_comments_are_known_at_any_depth_and_place_of_their_name():
    many = " ".join(f"x{chr(97 + i)}" for i in range(20))
    deep = "<div class=comments>" + "<div class=y><section>" * 40 + "<p>A reader says this.</p>" + "</section></div>" * 40 + "</div>"
    late = f"<div class='{many} comments'><p>A reader says this.</p></div>"
    for shape in (deep, late):
        page = f"<html><body><article><h1>Title of it</h1><p>One plain sentence of the article.</p>{shape}<p>The last sentence of it.</p></article></body></html>"
        found = M.blocks(page)
        assert [("c:comments" in names) for text, names, *_ in found] == [text.startswith("A reader") for text, *_ in found]
        assert "reader" not in M.main_text(page, M.prior())
