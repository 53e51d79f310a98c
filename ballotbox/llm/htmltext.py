"""Main text of HTML pages from flat text blocks and a decision tree.

A page becomes a flat list of text blocks, ended by every block-level tag. A block's
features are its number of words and link density, those of the blocks before and
after it, whether it is a heading or a paragraph, its place in the page, whether it
speaks of rights and privacy, and what the elements around it say: the innermost
article, and the element named or tagged like another page part that speaks loudest
against it (whether it holds the h1, and if not, how plainly; whether it lies within
the article, whether its names also say content, its share of the page's words, and
how much of the page lies outside all such elements). So a name is evidence and not a rule:
``has-sidebar`` around a page, a page builder's ``widget`` around every block or a form
around everything say little, a ``commentlist`` beside the article much.

A decision tree over these features, grown on the small labelled table
``labelled_blocks`` makes from page templates, says which blocks are main text. Only
scripts, styles and other elements without text are left out by rule.

Defined cases. NULL or empty html: empty text. No main text: empty text. Broken
markup (unclosed or stray tags, cut pages): read as far as it goes. Very long
pages are read whole. Repeated rows each get a row; an empty table gives an
empty result. Columns beside page_id, url and html are not read.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ballotbox.llm.common import pieces

# HTML element names by role, and the names that sites give page parts.
SILENT = set("script style noscript template svg math iframe object canvas audio video map head title "
             "button select option textarea datalist".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span "
             "strike strong sub sup time tt u var wbr br img ruby rt rp".split())
OUTSIDE_TAGS = set("nav footer aside form dialog menu".split())
INSIDE_TAGS = {"article", "main"}
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
OUTSIDE_NAMES = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu "
                    "breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share sharing "
                    "social cookie cookies consent notice gdpr popup modal overlay newsletter subscribe signup login "
                    "comment comments disqus reply replies respond pagination pager toolbar copyright".split())
# Stems of such names that stand out in a longer word (commentlist, usercomments).
STEMS = ("comment", "advert", "sponsor", "newsletter", "breadcrumb", "sidebar", "navbar", "footer", "cookie", "disqus", "paginat",
         "subscri", "masthead", "siteheader", "sitenav", "mainmenu", "topmenu")
INSIDE_NAMES = set("article post entry story".split())
CONTENT_NAMES = INSIDE_NAMES | set("content main body text headline title page wrapper container".split())
MENTIONS = set("has have with without no not hide show".split())        # has-sidebar, sidebar-layout: one is somewhere in it
LAYOUTS = set("layout page template".split())
HEAD_TAGS = set("html head base link meta title noscript script style template".split())
TEXT_ONLY = set("title select option textarea datalist".split())        # silent elements that hold no block
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"},
          "dd": {"dt", "dd"}}
PARAGRAPHS = HEADINGS | set("p li dd dt blockquote pre td figcaption".split())
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "paragraph", "from_start", "from_end", "legal",
            "article", "against", "within", "content_too", "share", "holds_h1", "rest")
MENTIONED, PART, WHOLE, TAG = 1, 2, 3, 4        # how plainly an element is named like another page part

_space = re.compile(r"\s+")
_names = re.compile(r"[a-z0-9]+")
_legal = re.compile(r"©|\(c\) ?\d{4}|copyright|all rights reserved|privacy|terms of|imprint|impressum|cookie", re.IGNORECASE)


class _Part(NamedTuple):
    """An element named or tagged like another page part."""
    key: str            # the name; with a number of its own if that is plain
    plain: int
    within: bool        # it lies in the article
    content: bool       # its names say content, too


@lru_cache(maxsize=50_000)
def _named(names: str) -> tuple[str, int, bool, bool]:
    """What classes and ids say: name of another page part, how plainly, whether they say
    content, whether they say article."""
    whole = names.lower().split()
    parts = [_names.findall(w) for w in whole]
    every = {n for p in parts for n in p}
    plain, key = 0, ""
    for w, p in zip(whole, parts):
        if not p:
            continue
        found = next((n for n in p if n in OUTSIDE_NAMES), None) or next((t for t in STEMS for n in p if t in n), None)
        if found:
            level = MENTIONED if p[0] in MENTIONS or p[-1] in LAYOUTS else WHOLE if w in OUTSIDE_NAMES or w.startswith(STEMS) else PART
            if level > plain:
                plain, key = level, found
    return key, plain, bool(every & CONTENT_NAMES), bool(every & INSIDE_NAMES)


class _Blocks(HTMLParser):
    """Text blocks of a page: [text, words, linked words, heading, paragraph, in an article, parts]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.open: list[tuple[str, bool, tuple[_Part, ...]]] = []     # (tag, in an article, parts around)
        self.silent = 0
        self.links = 0
        self.text: list[str] = []
        self.linked: list[str] = []
        self.titles: set[str] = set()               # keys of the parts that hold an h1
        self.numbers = 0

    def end_block(self) -> None:
        if self.text:
            text = _space.sub(" ", "".join(self.text)).strip()
            if text:
                words = len(text.split(" "))
                linked = len("".join(self.linked).split())
                _, article, parts = self.open[-1] if self.open else ("", False, ())
                tags = [t for t, *_ in self.open if t not in INLINE]
                if "h1" in tags:
                    self.titles.update(p.key for p in parts)
                self.blocks.append([text, words, min(words, linked), not HEADINGS.isdisjoint(tags), bool(tags) and tags[-1] in PARAGRAPHS,
                                    article, parts])
            self.text, self.linked = [], []

    def place(self, tag: str, attrs: list) -> tuple[bool, tuple[_Part, ...]]:
        """Whether an element is in an article, and the parts around its text."""
        _, article, parts = self.open[-1] if self.open else ("", False, ())
        values = {k: v or "" for k, v in attrs if k in ("class", "id", "role")}
        role = values.get("role", "").strip().lower()
        key, plain, content, story = _named(f"{values.get('class', '')} {values.get('id', '')}") if values else ("", 0, False, False)
        if tag in INSIDE_TAGS or role in ("main", "article"):
            return (article or not any(p.plain == TAG and p.key.startswith(("nav#", "footer#", "aside#")) for p in parts)), parts
        if tag in OUTSIDE_TAGS or role in OUTSIDE_ROLES or tag == "header" and not article:
            key, plain = tag if tag in OUTSIDE_TAGS or tag == "header" else role, TAG
        elif tag in ("html", "body", *HEADINGS) or article and key == "header":
            plain = 0
        if plain:
            self.numbers += 1
            return article, (*parts, _Part(f"{key}#{self.numbers}" if plain >= WHOLE else key, plain, article, content))
        return article or story and not plain and not parts, parts

    def cut(self, at: int) -> None:
        """Closes the open elements from ``at`` on."""
        for t, *_ in self.open[at:]:
            if t in SILENT:
                self.silent -= 1
            if t == "a":
                self.links -= 1
        del self.open[at:]

    def end_silent(self, tag: str) -> None:
        """Closes silent elements that end without an end tag where ``tag`` starts."""
        silent = [i for i, (t, *_) in enumerate(self.open) if t in SILENT]
        if tag == "body":
            self.cut(silent[0])
            return
        block = tag not in INLINE and tag not in SILENT and tag not in VOID
        while silent and (tag not in HEAD_TAGS and self.open[silent[-1]][0] == "head"
                          or block and self.open[silent[-1]][0] in TEXT_ONLY):
            self.cut(silent.pop())

    def handle_starttag(self, tag, attrs):
        if self.silent > 0:
            self.end_silent(tag)
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag not in INLINE:
                self.end_block()
            return
        if tag in SILENT:
            self.silent += 1
        if tag not in INLINE and tag not in SILENT:
            self.end_block()
            ends = CLOSES.get(tag, ())
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in ends:
                    del self.open[i:]
                    break
                if self.open[i][0] not in INLINE and self.open[i][0] not in ends:
                    break
        if tag == "a":
            self.links += 1
        self.open.append((tag, *self.place(tag, attrs)))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:                                       # <p/> opens a paragraph in HTML
            self.handle_starttag(tag, attrs)
            if tag in SILENT:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if tag not in INLINE and tag not in SILENT:
            self.end_block()
        if at is None:
            return
        if tag in INLINE and any(t not in INLINE for t, *_ in self.open[at:]):
            return                                  # does not reach over a block
        self.cut(at)

    def handle_data(self, data):
        if self.silent > 0 and self.open[-1][0] == "head" and not data.isspace():
            self.cut(len(self.open) - 1)            # text ends the head, too
        if self.silent <= 0:
            self.text.append(data)
            if self.links > 0:
                self.linked.append(data)


def blocks(html: str) -> tuple[list[list], set[str]]:
    """Blocks of a page, and the keys of the parts that hold its h1."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.end_block()
    return parser.blocks, parser.titles


def features(page: tuple[list[list], set[str]]) -> np.ndarray:
    """One row per block, in the order of ``FEATURES``."""
    found, titles = page
    n = len(found)
    own = np.array([(b[1], b[2] / b[1]) for b in found], dtype=float).reshape(-1, 2)
    pad = np.vstack([np.zeros((1, 2)), own, np.zeros((1, 2))])
    total = max(1.0, own[:, 0].sum())
    held: Counter = Counter()           # words in the element, or in all of a name that is part of theirs
    for b in found:
        for key in {p.key for p in b[6]}:
            held[key] += b[1]
    rest = sum(b[1] for b in found if not any(p.plain > MENTIONED for p in b[6])) / total
    said = []
    for b in found:
        if not b[6]:
            said.append((b[5], 0, 0, 0, 0, 0, rest))
            continue
        # the loudest: without the h1 before those with it, plainer names first, then the smaller share
        p = min(b[6], key=lambda p: (p.key in titles, p.plain == MENTIONED, b[5] and not p.within, held[p.key], -p.plain))
        title = p.key in titles
        said.append((b[5], 0 if title else p.plain, p.within, p.content, held[p.key] / total, title, rest))
    at = np.arange(n)[:, None]
    more = np.array([(b[3], b[4], 0, 0, bool(_legal.search(b[0][:400])) if b[1] <= 60 else False) for b in found], dtype=float).reshape(-1, 5)
    more[:, 2:3], more[:, 3:4] = np.minimum(at, 20), np.minimum(n - 1 - at, 20)
    return np.hstack([own, pad[:n], pad[2:], more, np.array(said, dtype=float).reshape(-1, 7)])


def _template(kind: int, size: int) -> list[tuple[str, int]]:
    """A labelled page of a kind: (html piece, 1 if its text is main text). ``size`` varies the
    lengths of its parts, what it has, and the names."""
    rnd = random.Random(1000 * kind + size)

    def some(low: int, high: int) -> int:
        return int(math.exp(rnd.uniform(math.log(low), math.log(high + 0.99))))

    def words(low: int, high: int) -> str:
        return " ".join(["word"] * some(low, high))

    def links(n: int) -> str:
        return "".join(f"<li><a href='#'>{words(1, 4)}</a></li>" for _ in range(n))

    def block(start: str, stop: str, low: int, high: int) -> tuple[str, int]:
        body = "".join(rnd.choice((f"<p>{words(low, high)}</p>", f"<p>{words(low, high)}</p>", f"<ul>{links(2)}</ul>", f"<h3>{words(1, 4)}</h3>"))
                       for _ in range(rnd.randint(1, 4))) + f"<p>{words(low, high)}</p>"
        return f"{start}{body}{stop}", 0

    def named(*names: str) -> tuple[str, int]:
        name = rnd.choice(names)
        return block(f"<{rnd.choice(('div', 'section'))} {rnd.choice(('class', 'id'))}='{name}'>", "</div></section>", 2, 120)

    def text(low: int = 2, tag: str = "p") -> list[tuple[str, int]]:
        out = [(f"<{tag}>{words(low, 160)}</{tag}>", 1) for _ in range(rnd.randint(1, 6))]
        extra = [(f"<p>{words(3, 40)} <a href='#'>{words(1, 5)}</a> {words(2, 30)}</p>", 1), (f"<h2>{words(1, 6)}</h2>", 1),
                 (f"<blockquote>{words(2, 30)}</blockquote>", 1), (f"<ul><li>{words(1, 8)}</li><li>{words(1, 20)}</li></ul>", 1)]
        for piece in rnd.sample(extra, rnd.randint(0, 3)):
            out.insert(rnd.randint(1, len(out)), piece)
        return out

    def maybe(share: float, *pieces: tuple[str, int]) -> list[tuple[str, int]]:
        return list(pieces) if rnd.random() < share else []

    title = [(f"<h1>{words(1, 14)}</h1>", 1)]
    menu = rnd.choice(((f"<nav><ul>{links(some(2, 12))}</ul></nav>", 0), (f"<div class='menu'><ul>{links(some(2, 12))}</ul></div>", 0),
                       (f"<ul>{links(some(4, 12))}</ul>", 0)))
    top = (f"<header><a href='#'>{words(1, 4)}</a>{rnd.choice(('', '<p>' + words(2, 8) + '</p>'))}</header>", 0)
    bottom = block("<footer>", "</footer>", 2, 160)
    aside = block("<aside>", "</aside>", 3, 200)
    ad = named("ad", "advert", "ad-box", "sponsored", "promo", "advertisement")
    talk = named("comments", "commentlist", "comment-list", "usercomments", "user-comments", "disqus_thread", "comment-respond", "respond")
    thread = (f"<ol class='{rnd.choice(('commentlist', 'comments', 'comment-list'))}'>" + "".join(
        f"<li><p>{words(3, 60)}</p></li>" for _ in range(some(1, 20))) + "</ol>", 0)
    asks = block("<form>", "</form>", 2, 120)
    notice = named("cookie-notice", "cookie-banner", "gdpr", "newsletter", "subscribe-box", "popup")
    side = named("sidebar", "widget", "related", "right-sidebar", "share", "social")
    foot = named("footer", "page-footer", "site-footer", "sitefooter", "footer-area")
    legal = (f"<div>{rnd.choice(('© 2024', 'Copyright', 'All rights reserved', '(c) 2021'))} {words(1, 60)}</div>", 0)
    line = (f"<div>{words(2, 14)}</div>", 0)
    rights = (f"<p>{words(1, 20)} {rnd.choice(('All rights reserved.', 'Copyright 2020.', 'Our privacy policy.'))}</p>", 1)
    if kind == 0:       # an article element with its like; notices, adverts and comments around and in it
        tag = rnd.choice(("article", "main", "div role='main'"))
        inner = [*maybe(0.8, *title), *text(1), *maybe(0.3, rights), *maybe(0.3, ad), *maybe(0.3, asks), *maybe(0.2, aside), *text(1)[:2], *maybe(0.3, rights),
                 *maybe(0.5, rnd.choice((talk, thread)))]
        return [*maybe(0.6, top), *maybe(0.7, menu), *maybe(0.4, aside), *maybe(0.4, ad), (f"<{tag}>", 0), *inner, (f"</{tag.split()[0]}>", 0),
                *maybe(0.4, asks), *maybe(0.5, notice), *maybe(0.3, talk), *maybe(0.7, bottom)]
    if kind == 1:       # no landmark: length, links, neighbours and what is said tell
        return [*maybe(0.5, (f"<div><ul>{links(some(4, 9))}</ul></div>", 0)), *maybe(0.7, *title), *text(12),
                *maybe(0.4, (f"<div><ul>{links(3)}</ul></div>", 0)), *maybe(0.6, line), *maybe(0.4, (f"<div><ul>{links(some(2, 8))}</ul></div>", 0)),
                *maybe(0.6, legal)]
    if kind == 2:       # a link list page, or next to nothing
        if size % 6 == 0:
            return [(words(1, 3), 0)]
        return [*maybe(0.5, menu), (f"<div>{links(some(6, 20))}</div>", 0), (f"<div><a href='#'>{words(4, 12)}</a></div>", 0), *maybe(0.6, bottom)]
    if kind == 3:       # a main element with short text only
        return [top, menu, ("<main>", 0), *title, (f"<p>{words(1, 8)}</p>", 1), *maybe(0.5, (f"<p><a href='#'>{words(2, 8)}</a></p>", 1)),
                ("</main>", 0), aside, ad, bottom]
    if kind == 4:       # a wrapper whose names mention other page parts, or say one
        name = rnd.choice(("content has-sidebar", "page with-header", "sidebar-layout", "sidebar", "social content", "sidebar-right", "no-comments"))
        inner = [*title, *text(8), *maybe(0.5, side), *maybe(0.4, talk)]
        return [(f"<div class='{name}'>", 0), *inner, ("</div>", 0), *maybe(0.4, side), *maybe(0.4, thread), *maybe(0.6, bottom)]
    if kind == 5:       # a head without its end tag
        return [(f"<head><title>{words(3, 3)}</title>", 0), (rnd.choice(("<body>", "<div>")), 0), *title, *text(8), *maybe(0.6, aside),
                *maybe(0.6, ad), *maybe(0.4, line), *maybe(0.4, legal), *maybe(0.5, bottom)]
    if kind == 6:       # a page builder: every block in elements of one name, the menu and the footer too
        builder = rnd.choice(("box", "elementor", "block", "vc"))

        def boxed(piece: str, what: str) -> str:
            return f"<div class='{builder}-widget {builder}-widget-{what}'>{piece}</div>"

        return [*maybe(0.6, (boxed(f"<ul>{links(some(3, 9))}</ul>", "nav-menu"), 0)), *maybe(0.8, *[(boxed(h, "heading"), 1) for h, _ in title]),
                *[(boxed(h, "text-editor"), 1) for h, _ in text(8)], *[(boxed(h, "text-editor"), 1) for h, _ in text(8)],
                *maybe(0.4, (boxed(f"<ul>{links(some(3, 6))}</ul>", "social-icons"), 0)), *maybe(0.4, thread), *maybe(0.6, foot)]
    if kind == 7:       # one form around the whole page
        inner = [("<article>", 0), *title, *text(2), *maybe(0.4, rights), ("</article>", 0)] if rnd.random() < 0.5 else [*title, *text(10)]
        return [("<form id='aspnetForm'>", 0), *maybe(0.6, menu), *inner, *maybe(0.4, side), *maybe(0.7, foot), ("</form>", 0)]
    if kind == 8:       # names of the article's own parts
        where = rnd.choice(("entry", "post", "article"))
        return [*maybe(0.7, (f"<div class='site-header'><a href='#'>{words(1, 4)}</a></div>", 0)),
                *maybe(0.7, (f"<div class='main-menu'><ul>{links(some(3, 9))}</ul></div>", 0)), *maybe(0.5, (f"<div class='{where}'>", 0)),
                (f"<div class='{where}-header'>", 0), *title, ("</div>", 0), (f"<div class='{where}-content'>", 0), *text(3), ("</div>", 0),
                *maybe(0.5, (f"<div class='{where}-footer'><a href='#'>{words(1, 4)}</a> <a href='#'>{words(1, 3)}</a></div>", 0)),
                *maybe(0.5, rnd.choice((talk, thread))), *maybe(0.5, legal)]
    if kind == 9:       # comments in the article, often longer than it
        return [*maybe(0.5, top), ("<article>", 0), *title, *text(2), *maybe(0.4, rights), rnd.choice((talk, thread)), ("</article>", 0), *maybe(0.5, bottom)]
    if kind == 10:      # a single element with a misleading name, and nothing else
        name = rnd.choice(("widget content", "social content", "content widget", "promo text", "banner-content", "notice-body"))
        return [(f"<div class='{name}'>", 0), *maybe(0.6, *title), *text(10), ("</div>", 0)]
    if kind == 11:      # tables and plain divs
        return [*maybe(0.6, (f"<table><tr><td>{links(5)}</td></tr></table>", 0)), ("<table><tr><td>", 0), *title, *text(20, "div"),
                ("</td></tr></table>", 0), *maybe(0.6, line), *maybe(0.7, legal)]
    # parts known by their names only
    return [*maybe(0.7, (f"<div class='header'><a href='#'>{words(1, 4)}</a> {words(1, 6)}</div>", 0)),
            *maybe(0.7, (f"<div id='{rnd.choice(('menu', 'nav', 'navbar'))}'><ul>{links(some(3, 9))}</ul></div>", 0)),
            (f"<div id='{rnd.choice(('content', 'main', 'page'))}'>", 0), *title, *text(3), ("</div>", 0), *maybe(0.6, side), *maybe(0.5, talk),
            *maybe(0.7, foot)]


KINDS, SIZES = 13, 80


def labelled_blocks(kinds: range = range(KINDS)) -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: features and labels of the blocks of template pages, ``SIZES`` of each kind."""
    x, y = [], []
    for kind in kinds:
        for size in range(SIZES):
            parts = _template(kind, size)
            labels, state = [], _Blocks()
            for h, label in parts:
                state.feed(h)
                state.end_block()
                labels += [label] * (len(state.blocks) - len(labels))
            x.append(features(blocks("".join(h for h, _ in parts))))
            y += labels
    return np.vstack(x), np.array(y)


LEAF = 8            # blocks in a leaf at least


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12) -> tuple | float:
    """A decision tree by Gini impurity: (feature, threshold, low, high), or the share of label 1."""
    share, n = float(y.mean()), len(y)
    if depth == 0 or share in (0.0, 1.0) or n < 2 * LEAF:
        return share
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        value, ones = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(value[1:] > value[:-1]) + 1            # so many in the low half
        cut = cut[(cut >= LEAF) & (cut <= n - LEAF)]
        if not len(cut):
            continue
        low, high = ones[cut - 1], ones[-1] - ones[cut - 1]
        impurity = low * (cut - low) / cut + high * (n - cut - high) / (n - cut)
        k = int(impurity.argmin())
        if best is None or impurity[k] < best[0] - 1e-9:
            best = (float(impurity[k]), f, float((value[cut[k] - 1] + value[cut[k]]) / 2))
    if best is None:
        return share
    _, f, threshold = best
    low = x[:, f] <= threshold
    return f, threshold, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def classify(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    """Whether each row is main text."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree >= 0.5)
    f, threshold, low, high = tree
    at = x[:, f] <= threshold
    out = np.empty(len(x), dtype=bool)
    out[at], out[~at] = classify(low, x[at]), classify(high, x[~at])
    return out


@lru_cache(maxsize=1)
def default_tree() -> tuple | float:
    return grow(*labelled_blocks())


def main_text(html: str | None, tree: tuple | float | None = None) -> str:
    page = blocks(html) if html else ([], set())
    if not page[0]:
        return ""
    main = classify(default_tree() if tree is None else tree, features(page))
    return "\n\n".join(b[0] for b, keep in zip(page[0], main) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    tree = default_tree()

    def rows(batches):
        for batch in pieces(batches, column="html"):
            texts = [main_text(h, tree) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select("page_id", "url", "html")
    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(rows, f"page_id {kind}, url string, text string, n_chars long")
