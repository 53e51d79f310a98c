"""Reversed search against scoring every document for every item."""

import math
import re
from collections import Counter

import pytest

from ballotbox.llm import lexical, terms
from llm.conftest import LONG

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORDS.findall(text or "")]


def brute(items, docs, top=20):
    held = [(d, cut(t)) for d, t in docs]
    held = [(d, Counter(w), len(w)) for d, w in held if w]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, counts, n in held:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m)) for t in cut(text) if t in counts)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("postings,cells", [(1 << 20, 1 << 21), (60, 300)])
def test_equals_brute_force(spark, documents, monkeypatch, postings, cells):
    """Whatever the blocks of items and the slices of documents."""
    monkeypatch.setattr(lexical, "POSTINGS", postings)
    monkeypatch.setattr(lexical, "CELLS", cells)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    if postings < 1000:
        items = items.orderBy("item_id").limit(9)
    got = [tuple(r) for r in lexical.search(items, documents).collect()]
    want = brute([(r.item_id, r.text) for r in items.collect()], [(r.doc_id, r.text) for r in documents.collect()])
    assert sorted(got, key=key) == sorted(want, key=key) and len(want) > 100


def test_heaps_take_part_in_every_task(spark):
    """One item whose best documents lie in all tasks, ties and repeated rows among them."""
    rows = [(i % 97, "alpha " * (1 + i % 5) + "beta " * (i % 7) + f"w{i}") for i in range(600)] + [(None, "alpha"), (None, "alpha")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    items = [(1, "alpha beta beta"), (2, "alpha"), (3, "w5 w17"), (4, "nowhere"), (5, None), (5, ""), (None, "beta")]
    got = [tuple(r) for r in lexical.search(spark.createDataFrame(items, "item_id long, text string"), docs).collect()]
    assert sorted(got, key=key) == sorted(brute(items, rows), key=key)


def test_edges(spark, edges, nothing):
    items = [(1, "two three seven"), (2, "éα 漢字 MAIL"), (3, "alpha"), (4, "word row")]
    frame = spark.createDataFrame([(*i, "x", 7) for i in items], "item_id long, text string, rank string, score int")
    got = [tuple(r) for r in lexical.search(frame, edges).collect()]
    want = brute(items, [(r.doc_id, r.text) for r in edges.collect()])
    assert sorted(got, key=key) == sorted(want, key=key) and got
    assert lexical.search(frame, nothing).count() == 0
    assert lexical.search(frame.limit(0), edges).count() == 0
    assert lexical.search(frame, nothing).columns == ["item_id", "rank", "doc_id", "score"]


def test_texts_are_cut_in_parts_between_words(monkeypatch):
    text = LONG + " Éa漢b\x00ZZ9_x"
    monkeypatch.setattr(terms, "CHUNK", 1000)
    got = [w.decode() for part in terms.words(terms.blanked(text)) for w in part]
    assert got == cut(text) and got[-3:] == ["Éa漢b", "zz9", "x"]
