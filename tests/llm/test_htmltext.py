import html as H
import re

import numpy as np
import pytest

from ballotbox.llm import htmltext
from llm.conftest import SF

PARAGRAPH = "A paragraph with quite a few plain words in it, so that its length speaks for it. "

CASES = [
    (None, ""),
    ("", ""),
    ("<<<>", ""),
    ("<article><h1>T</h1><p>A &amp; B&nbsp;&#99;  <b>d</b>\n e</p></article>", "T\n\nA & B c d e"),
    ("<article><p>one<p>two<br>lines<p><b>three</article>", "one\n\ntwo lines\n\nthree"),
    ("<nav><a href=x>Home</a></nav><article><p>x<script>var t='</p>'</script>y</p></article><footer>" + PARAGRAPH + "</footer>", "xy"),
    ("<article><p>text</p><div class='ad'>" + PARAGRAPH * 5 + "</div><aside>" + PARAGRAPH + "</aside></article>", "text"),
    ("<main><p>text</p></main><div id='cookie-banner'>" + PARAGRAPH * 9 + "</div>", "text"),
    ("<article><p>text</p><section class='comments'><p>" + PARAGRAPH * 6 + "</p></section></article>", "text"),
    ("<article><form><p>" + PARAGRAPH * 3 + "</p></form><p>text</p></article>", "text"),
    ("<p>" + PARAGRAPH * 4 + "</p><p>" + PARAGRAPH * 3 + "</p>", (PARAGRAPH * 4).strip() + "\n\n" + (PARAGRAPH * 3).strip()),
    ("<ul>" + "<li><a href=x>one link</a></li>" * 9 + "</ul>", ""),
    ("<article><p>cut in the mid", "cut in the mid"),
    ("<article><!-- <p>no</p> --><p>yes</p></article>", "yes"),
    ("<article><style>p{}</style><select><option>a</select><p>x</p></article></div></p>", "x"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert htmltext.main_text(page) == text


def test_tree_fits_the_labelled_table():
    x, y = htmltext.labelled_blocks()
    assert len(y) > 100 and 0 < y.mean() < 1
    assert (htmltext.classify(htmltext.default_tree(), x) == y).mean() > 0.97
    # held out: grown on every second row, judged on the others
    tree = htmltext.grow(x[::2], y[::2])
    assert (htmltext.classify(tree, x[1::2]) == y[1::2]).mean() > 0.9


def test_features_are_of_neighbours():
    f = htmltext.features(htmltext.blocks("<p>a b <a href=x>c</a></p><p>d</p><h2>e f</h2>"))
    assert np.allclose(f[:, :6], [[3, 1 / 3, 0, 0, 1, 0], [1, 0, 3, 1 / 3, 2, 0], [2, 0, 1, 0, 0, 0]])
    assert f[:, htmltext.FEATURES.index("heading")].tolist() == [0, 0, 1] and f.shape[1] == len(htmltext.FEATURES)


def test_article_of_every_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r for r in htmltext.extract(pages).collect()}
    assert len(out) == pages.count()
    for r in pages.collect():
        article = r.html[r.html.index("<article>"):r.html.index("</article>")].replace("<br>", " ")
        parts = [" ".join(H.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1|article)>", article)]
        assert out[r.page_id].text == "\n\n".join(p for p in parts if p)
        assert out[r.page_id].n_chars == len(out[r.page_id].text)


def test_edges(spark):
    rows = [(1, "u", None, "a"), (None, None, "<article><p>x</p></article>", "b"), (1, "u", None, "a"),
            (2, "u", "<article><p>" + "long " * 300_000 + "</p></article>", "c"), (3, "u", "", "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = htmltext.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 1), (1, 0), (1, 0), (2, 1_499_999), (3, 0)]
    assert htmltext.extract(pages.limit(0)).count() == 0


TITLED = f"<h1>Title of it</h1><p>{PARAGRAPH * 4}</p><p>{PARAGRAPH * 3}</p>"
MAIN = "\n\n".join(["Title of it", (PARAGRAPH * 4).strip(), (PARAGRAPH * 3).strip()])


@pytest.mark.parametrize("start", [
    "<html><head><title>T</title><meta name=x><script>var a</script><body>", "<head><title>T</title>", "<head><link rel=x><body><div>",
    "<head><noscript><p>Turn scripts on</p></noscript><title>T</title><body>", "<select><option>a<option>b<div>"])
def test_silent_elements_without_an_end_tag(start):
    assert htmltext.main_text(start + TITLED) == MAIN


def test_text_ends_an_open_head():
    assert htmltext.main_text("<head><title>T</title>" + PARAGRAPH * 5) == (PARAGRAPH * 5).strip()


@pytest.mark.parametrize("wrapper", ["class='content has-sidebar'", "class='page with-header'", "class='sidebar-layout'",
                                     "class='sidebar-right' id=page", "class='sidebar'"])
def test_names_of_wrappers(wrapper):
    side = f"<div class='sidebar'><p>{PARAGRAPH}</p></div><div class='comment-list'><p>{PARAGRAPH * 20}</p></div>"
    assert htmltext.main_text(f"<div {wrapper}>{TITLED}{side}</div>") == MAIN
    assert htmltext.main_text(f"<div {wrapper}>{TITLED}</div>{side}") == MAIN


def test_parts_that_hold_most_words_stay_outside():
    for name in ("comments", "comment-list", "cookie-notice"):
        assert htmltext.main_text(f"{TITLED}<div class='{name}'><p>{PARAGRAPH * 30}</p></div>") == MAIN


HEADING, LONG_A, LONG_B = "Title of it", (PARAGRAPH * 4).strip(), (PARAGRAPH * 3).strip()
BOX = "<div class='elementor-widget elementor-widget-{}'>{}</div>"
LAYOUTS = {
    "page builder": BOX.format("heading", f"<h1>{HEADING}</h1>") + BOX.format("text-editor", f"<p>{LONG_A}</p>")
    + BOX.format("text-editor", f"<p>{LONG_B}</p>"),
    "page builder with parts": f"<div class='nav-menu'><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div>"
    + BOX.format("heading", f"<h1>{HEADING}</h1>") + BOX.format("text-editor", f"<p>{LONG_A}</p><p>{LONG_B}</p>")
    + f"<div class='comments-area'><p>{PARAGRAPH * 2}</p></div>",
    "social content": f"<div class='social content'><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p></div>",
    "widget content": f"<div class='widget content'><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p></div>",
    "form around": f"<form id=aspnetForm><article><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p></article></form>",
    "form around divs": f"<form id=aspnetForm><div><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p></div>"
    f"<div class=footer><p>{PARAGRAPH}</p></div></form>",
    "entry-header": f"<div class=post><div class='entry-header'><h1>{HEADING}</h1></div><div class='entry-content'><p>{LONG_A}</p>"
    f"<p>{LONG_B}</p></div></div>",
    "commentlist": f"<article><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p><ol class='commentlist'>"
    + f"<li><p>{PARAGRAPH}</p></li>" * 9 + "</ol></article>",
    "usercomments": f"<article><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p><section id='usercomments'>"
    + f"<p>{PARAGRAPH * 2}</p>" * 5 + "</section></article>",
    "short footer": f"<h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p><div>Published by the Example Company, Berlin</div>",
    "footer with rights": f"<h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p><div>© 2024 Example. " + "All rights reserved by us and others. " * 5 + "</div>",
    "parts by name": f"<div id=header>Example site</div><div id=nav><a href=a>One</a> <a href=b>Two</a></div><div id=main><h1>{HEADING}</h1>"
    f"<p>{LONG_A}</p><p>{LONG_B}</p></div><div id=sidebar><p>{PARAGRAPH * 6}</p></div><div id=footer><p>{PARAGRAPH * 2}</p></div>",
    "roles": f"<div role=banner>Example</div><div role=main><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p></div>"
    f"<div role=complementary><p>{PARAGRAPH * 5}</p></div><div role=contentinfo>{PARAGRAPH}</div>",
    "sections": f"<header><p>Example</p></header><section><h1>{HEADING}</h1><p>{LONG_A}</p><p>{LONG_B}</p></section><footer>{PARAGRAPH}</footer>",
}


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_other_layouts(layout):
    """Pages unlike the templates of the labelled table."""
    assert htmltext.main_text(LAYOUTS[layout]) == "\n\n".join([HEADING, LONG_A, LONG_B])


def test_kinds_held_out_of_the_table():
    """The tree grown without a kind of page is right on most blocks of that kind."""
    shares = []
    for kind in range(htmltext.KINDS):
        x, y = htmltext.labelled_blocks(range(kind, kind + 1))
        rest = [htmltext.labelled_blocks(range(k, k + 1)) for k in range(htmltext.KINDS) if k != kind]
        tree = htmltext.grow(np.vstack([a for a, _ in rest]), np.concatenate([b for _, b in rest]))
        shares.append((htmltext.classify(tree, x) == y).mean())
    assert np.mean(shares) > 0.85 and min(shares) > 0.5


def test_neighbours_carry_the_decision_where_nothing_is_named():
    """With the names and tags of page parts taken away, the tree of counts alone is mostly right."""
    x, y = htmltext.labelled_blocks()
    plain = x[:, :htmltext.FEATURES.index("article")]
    odd = np.arange(len(y)) % 2 == 1
    assert (htmltext.classify(htmltext.grow(plain[~odd], y[~odd]), plain[odd]) == y[odd]).mean() > 0.8
