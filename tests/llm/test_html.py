"""Main text of pages."""

from __future__ import annotations

import pytest

from tests.llm import brute
from wardline.llm import html_blocks, queries

TREE = html_blocks.train()


def test_every_page_equals_its_article(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = queries.op12_flat_blocks(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == brute.article_text(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def texts(page):
    return [b.text for b in html_blocks.blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain  text\n", ["plain text"]),
        ("<p>a<p>b</p></p>c", ["a", "b", "c"]),
        ("<p>1 &lt; 2 &amp&eacute;&#233;&#x1D11E; &nbsp; x</p>", ["1 < 2 &éé𝄞 x"]),
        ("<p>a<b>b</b>c<br>d<!-- e <p> --> f</p>", ["abc d f"]),
        ("<script>var t='</p>';</script><p>a</p><style>p{}</style><script>never closed <p>b", ["a"]),
        ('<p title="a > b">c</p><p class=\'x>y\'>d', ["c", "d"]),
        ("<p>a < b <3 </p", ["a < b <3"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e", ["a", "b", "c", "d", "e"]),
        ("<p>a<a href=x>b", ["ab"]),
        ("<P CLASS=x>A</P><SCRIPT>b</script >c", ["A", "c"]),
        ("<p>cut <a href=", ["cut"]),
        ("</div></p><p>a", ["a"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_marks_of_elements():
    found = html_blocks.blocks("<body class=has-sidebar><article><p>a</p><aside><p>b</p></aside><p>c</p></article><div class='footerNav'>d</div><div>e <span class=ad>f</span> g</div>")
    assert [(b.text, b.main, b.other) for b in found] == [
        ("a", True, False), ("b", True, True), ("c", True, False), ("d", False, True), ("e", False, False), ("f", False, True), ("g", False, False)
    ]


def test_links_are_counted_in_words():
    (block,) = html_blocks.blocks("<p>one <a href=x>two <b>three</b></a> four</p>")
    assert (block.words, block.link_words) == (4, 2)


FILLER = " ".join(["words"] * 30)


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<nav>a</nav><article><h1>T</h1><p>{FILLER}.</p><p>x.</p><div class='comment-list'><p>{FILLER}</p></div></article>", f"T\n{FILLER}.\nx."),
        (f"<div id=cookie-consent><p>{FILLER}.</p></div><main><p>{FILLER}.</p><form><label>n</label></form></main><footer>{FILLER}</footer>", f"{FILLER}."),
        (f"<div><a href=x>home</a></div><p>{FILLER}.</p><p>{FILLER}.</p><div>&copy; me</div>", f"{FILLER}.\n{FILLER}."),
        (f"<article><p>{FILLER}.</p><ul class=menu><li><a href=x>{FILLER}</a></li></ul></article>", f"{FILLER}."),
        ("<nav><a href=x>only</a></nav>", ""),
    ],
)
def test_unseen_pages(page, want):
    assert html_blocks.main_text(page, TREE) == want


def test_odd_rows(spark):
    page = f"<article><p>{FILLER}</p></article>"
    rows = [(1, None, "u", 0), (2, "", None, 0), (3, page, "u", 1), (3, page, "u", 1), (None, "<p>" * 50_000 + "<div class=ad>" * 2_000 + "x", "u", 2)]
    got = html_blocks.extract(spark.createDataFrame(rows, "page_id long, html string, text string, n_chars long"), TREE).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == [(0, "", 0), (1, "", 0), (2, "", 0), (3, FILLER, 149 + 30), (3, FILLER, 149 + 30)]
    empty = spark.createDataFrame([], "page_id long, html string")
    assert html_blocks.extract(empty, TREE).collect() == []


def test_long_page_is_read_whole(spark):
    page = "<article>" + "".join(f"<p>{FILLER} {i}.</p>" for i in range(20_000)) + "</article>"
    (row,) = html_blocks.extract(spark.createDataFrame([(1, page)], "page_id long, html string"), TREE).collect()
    assert row["text"] == brute.article_text(page)


def test_tree_splits_what_a_line_cannot():
    import numpy as np

    x = np.array([[a, b] for a in range(4) for b in range(4)], dtype=float)
    y = ((x[:, 0] < 2) ^ (x[:, 1] < 1)).astype(float)
    tree = html_blocks.fit(x, y)
    assert (tree.predict(x) == (y == 1)).all() and len(tree.predict(x[:0])) == 0
    with pytest.raises(ValueError):
        html_blocks.train((("<p>a</p>", "01"),))
