"""The license scan against a plain re-computation, and the expression parser against Python's own."""

import itertools
import re

import pytest

from ballotbox.llm import licenses
from llm.conftest import EDGES, LONG

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    """Base places by trying every phrase at every word."""
    words = WORDS.findall(lower(text))
    hits = [(i, label) for i in range(len(words)) for p, label in BASE.items() if tuple(words[i:i + len(p)]) == p]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_base_equals_brute_force_on_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert len(rows) == docs.count()
    found = 0
    for d in docs.collect():
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(d.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) == (r.terms != "none")
        found += bool(r.labels)
        if not re.search(r"(?i)licen[sc]e|\bcc by", d.text or ""):
            assert not r.labels
    assert found > 5


@pytest.mark.parametrize("text", [
    "MIT license MIT License mit-license MIT\nLICENSE", "mit mit license license", "MITLicense", "mit é license",
    "general public license general general public license", "É mit\x00license 漢 apache license", "mit license", "İ mit license",
])
def test_base_phrases(text):
    assert licenses.scan_text(text)[:5] == brute(text)


@pytest.mark.parametrize("text,labels,terms", [
    ("Released under the MIT License.", "mit", "permissive"),
    ("Licensed under the Apache License, Version 2.0.", "apache", "permissive"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", "copyleft"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc", "restricted"),
    ("GNU Lesser General Public License", "gpl,lgpl", "copyleft"),
    ("Redistribution and use in source and binary forms, with or without", "bsd", "permissive"),
    ("// SPDX-License-Identifier: MIT\ncode", "mit", "permissive"),
    ("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */", "gpl", "weak copyleft"),
    ("SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND AGPL-3.0-only", "agpl,gpl,mit", "network copyleft"),
    ("SPDX-License-Identifier: MIT OR GPL-3.0-only AND AGPL-3.0-only", "agpl,gpl,mit", "permissive"),
    ('{"license": "Apache-2.0"}', "apache", "permissive"),
    ("License: MIT and more to come", "mit", "permissive"),
    ("License: see below. Licence = none. license: all", "", "none"),
    ("A license to drive, cc by mail, the apache tribe, MIT lectures", "", "none"),
])
def test_notices_and_tags(text, labels, terms):
    got = licenses.scan_text(text)
    assert (got[5], got[7]) == (labels, terms)


@pytest.mark.parametrize("text", ["SPDX-License-Identifier: (MIT OR", "SPDX-License-Identifier: MIT WITH Apache-2.0",
                                  "SPDX-License-Identifier: (MIT OR ISC) WITH Classpath-exception-2.0"])
def test_malformed_expressions_count_and_label_nothing(text):
    got = licenses.scan_text(text)
    assert got[5:7] == ("", 0.0) and got[9] == 1


def test_parser_equals_pythons_own_on_all_small_expressions():
    names = {"MIT": licenses.FREE, "GPL-3.0-only": licenses.COPYLEFT, "CC0-1.0": licenses.PUBLIC, "AGPL-3.0-only": licenses.NETWORK}
    n = 0
    for ids in itertools.product(names, repeat=3):
        for a, b in itertools.product(("AND", "OR"), repeat=2):
            for form in ("{0} {3} {1} {4} {2}", "({0} {3} {1}) {4} {2}", "{0} {3} ({1} {4} {2})", "(({0} {3} {1} {4} {2}))"):
                text = form.format(*ids, a, b)
                # max and min as Python's * and + on a class, with the same precedence
                python = re.sub(r"[A-Z][\w.-]+", lambda m: {"AND": "*", "OR": "+"}.get(m[0], f"V({names.get(m[0])})"), text)
                want = eval(python, {"V": V}).value
                labels, terms, known, shown = licenses.evaluate(licenses.tokens(text))
                assert terms == want and known and labels == {licenses.identifier(i)[0] for i in ids}
                again = licenses.evaluate(licenses.tokens(shown))
                assert again[3] == shown and again[1] == want
                n += 1
    assert n == 4 ** 3 * 4 * 4


class V:
    def __init__(self, value):
        self.value = value

    def __mul__(self, other):
        return V(max(self.value, other.value))

    def __add__(self, other):
        return V(min(self.value, other.value))


def test_edges(spark, edges, nothing):
    rows = licenses.scan(edges).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        if r.doc_id in (2, 3, 4):
            assert (r.n_words, r.n_base, r.first_word, r.base_labels, r.labels, r.score) == (0, 0, None, "", "", 0.0)
    assert {r.n_words for r in rows if r.doc_id == 5} == {len(LONG.split())}
    assert licenses.scan(nothing).count() == 0
    long = spark.createDataFrame([(1, LONG * 70 + " MIT License")], "doc_id long, text string")     # several parts of a text
    r = licenses.scan(long).first()
    assert (r.n_words, r.n_base, r.first_word) == brute(LONG * 70 + " MIT License")[:3]
