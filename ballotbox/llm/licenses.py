"""License scan: identifier tags, notice phrases and licence expressions.

One Aho-Corasick automaton holds every phrase (as words between single spaces)
and runs once over a text's words. Phrases are of three kinds:

* the base phrases, whose places are counted;
* notices, longer statements that name a licence of their own;
* tags, after which a licence expression may stand in the text as written:
  ``SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH
  Classpath-exception-2.0``, or a field ``license: MIT``.

A shunting-yard parser reads the expression (WITH binds closest, then AND, then
OR) and evaluates it to the strictest terms that hold: all sides of an AND
apply, of an OR the reader may choose the mildest, and a WITH exception turns
copyleft into weak copyleft. A tag of the first kind takes any identifier; a
field only known ones, since "license: see below" is prose.

``score`` is the strength of the best evidence (0 none, 1 an expression of known
identifiers); ``terms`` the strictest of all findings; ``expressions`` the
expressions in a fixed spelling.

Defined cases. NULL or empty text: no words, no places (NULL first and last
word), empty labels, score 0. NULL doc_id: kept. Repeated rows: each has its
row. Very long texts are read whole. An expression that does not parse counts
in ``n_malformed`` only. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox.llm.common import pieces
from ballotbox.llm.terms import blanked, words

TERMS = ("none", "public domain", "permissive", "weak copyleft", "copyleft", "network copyleft", "restricted")
PUBLIC, FREE, WEAK, COPYLEFT, NETWORK, CLOSED = range(1, 7)
LONGEST = 2_000             # characters of a line read as an expression

# Phrases and labels of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices, the licence each names and how sure it is.
NOTICES = {
    "released under the mit license": ("mit", 0.9),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "licensed under the apache license": ("apache", 0.9),
    "licensed under the gnu general public license": ("gpl", 0.9),
    "under the terms of the gnu general public license": ("gpl", 0.9),
    "gnu general public license": ("gpl", 0.8),
    "lesser general public license": ("lgpl", 0.8),
    "library general public license": ("lgpl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "bsd license": ("bsd", 0.6),
    "bsd 2 clause": ("bsd", 0.7),
    "bsd 3 clause": ("bsd", 0.7),
    "permission to use copy modify and or distribute this software": ("isc", 0.9),
    "isc license": ("isc", 0.6),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "european union public licence": ("eupl", 0.8),
    "boost software license": ("bsl", 0.8),
    "free and unencumbered software released into the public domain": ("unlicense", 0.9),
    "cc0 1 0 universal": ("cc0", 0.9),
}
TAGS = ("spdx license identifier", "license", "licence", "license expression")

# Identifiers in lower case -> licence, terms; the first that fits holds.
KNOWN = [(re.compile(pattern).fullmatch, label, terms) for pattern, label, terms in (
    (r"agpl-[123]\.0(-only|-or-later)?", "agpl", NETWORK),
    (r"lgpl-[123]\.[01](-only|-or-later)?", "lgpl", WEAK),
    (r"gpl-[123]\.0(-only|-or-later)?", "gpl", COPYLEFT),
    (r"mit(-0)?", "mit", FREE),
    (r"apache-(1\.[01]|2\.0)", "apache", FREE),
    (r"0bsd|bsd-[1234]-clause(-[a-z]+)*", "bsd", FREE),
    (r"isc", "isc", FREE),
    (r"zlib", "zlib", FREE),
    (r"bsl-1\.0", "bsl", FREE),
    (r"ncsa|postgresql|x11|python-2\.0|openssl|wtfpl|artistic-[12]\.0|afl-[123]\.[01]", "other-permissive", FREE),
    (r"mpl-[12]\.[01]", "mpl", WEAK),
    (r"epl-[12]\.0", "epl", WEAK),
    (r"cddl-1\.[01]", "cddl", WEAK),
    (r"eupl-1\.[012]", "eupl", COPYLEFT),
    (r"osl-[123]\.0", "osl", COPYLEFT),
    (r"unlicense", "unlicense", PUBLIC),
    (r"cc0-1\.0", "cc0", PUBLIC),
    (r"cc-by-[1234]\.[05]", "cc-by", FREE),
    (r"cc-by-sa-[1234]\.[05]", "cc-by-sa", COPYLEFT),
    (r"cc-by-nc-[1234]\.[05]", "cc-by-nc", CLOSED),
    (r"cc-by-nd-[1234]\.[05]", "cc-by-nd", CLOSED),
    (r"cc-by-nc-sa-[1234]\.[05]", "cc-by-nc-sa", CLOSED),
    (r"cc-by-(nc-nd|nd-nc)-[1234]\.[05]", "cc-by-nc-nd", CLOSED),
)]
OF_LABEL = {label: terms for _, label, terms in reversed(KNOWN)}

_exception = re.compile(r"[a-z0-9.-]*(exception|note|linking)[a-z0-9.-]*").fullmatch
_token = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.:-]*\+?))")
_after_tag = re.compile(r"""["']?[ \t]*[:=][ \t]*["']?""")
BINDS = {"or": 1, "and": 2, "with": 3}


def _phrases() -> dict[str, tuple]:
    """Phrase -> (base label, label, strength, tag)."""
    out: dict[str, list] = {p: [label, label, 0.6, None] for p, label in BASE.items()}
    notices = dict(NOTICES)
    for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            notices[f"cc {kind} {version}"] = (f"cc-{kind.replace(' ', '-')}", 0.8)
    long_names = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
    for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        name = " ".join(long_names[k] for k in kind.split())
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            notices[f"creative commons {name} {version}"] = (f"cc-{kind.replace(' ', '-')}", 0.8)
    for phrase, (label, strength) in notices.items():
        out.setdefault(phrase, [None, label, strength, None])
    for tag in TAGS:
        out.setdefault(tag, [None, None, 0.0, None])[3] = tag
    return {p: tuple(v) for p, v in out.items()}


@lru_cache(maxsize=1)
def automaton():
    """One per process."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, what in _phrases().items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, len(phrase.split()), *what))
    found.make_automaton()
    return found


def identifier(name: str) -> tuple[str, int, bool]:
    """Licence, terms and whether the identifier is known (a ``+`` or ``-or-later`` included)."""
    for fits, label, terms in KNOWN:
        if fits(name.lower().removesuffix("+")):
            return label, terms, True
    return "other", CLOSED, False


def tokens(line: str) -> list[str]:
    """Tokens of the expression that ``line`` starts with: up to the first word that
    cannot go on with it (an operand after an operand, an operator after none)."""
    out, at, open_, operand = [], 0, 0, False     # operand: the last token ends one
    while m := _token.match(line, at):
        mark, word = m.groups()
        if mark == "(" and not operand:
            open_ += 1
        elif mark == ")" and operand and open_:
            open_ -= 1
        elif word and operand and word.lower() in BINDS:
            operand = False
        elif word and not operand and word.lower() not in BINDS:
            if not word.endswith("+"):
                word = word.rstrip(".:-")       # the end of a sentence
            if out and out[-1] in BINDS and not (identifier(word)[2] or _exception(word.lower())):
                break                           # "MIT and more": operators in lower case join known names only
            operand = True
        else:
            break
        out.append(mark or word)
        at = m.end()
    while out and out[-1].lower() in BINDS:     # "MIT and" goes on in prose
        out.pop()
    return out


def evaluate(parts: list[str]) -> tuple[frozenset, int, bool, str] | None:
    """Labels, terms, whether all identifiers are known, and the expression in a fixed
    spelling; None where it does not parse."""
    values: list[tuple] = []
    held: list[str] = []

    def reduce() -> bool:
        op = held.pop()
        if op not in BINDS or len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        if op == "with":
            if left[4] or not _exception(right[3].lower()):     # only an identifier takes an exception
                return False
            values.append((left[0], min(left[1], WEAK) if left[1] == COPYLEFT else left[1], left[2], f"{left[3]} WITH {right[3]}", 3))
        else:
            pick = max if op == "and" else min
            shown = [f"({v[3]})" if v[4] and v[4] < BINDS[op] else v[3] for v in (left, right)]
            values.append((left[0] | right[0], pick(left[1], right[1]), left[2] and right[2],
                           f" {op.upper()} ".join(shown), BINDS[op]))
        return True

    for part in parts:
        low = part.lower()
        if part == "(":
            held.append(part)
        elif part == ")":
            while held and held[-1] != "(":
                if not reduce():
                    return None
            if not held:
                return None
            held.pop()
        elif low in BINDS:
            while held and held[-1] != "(" and BINDS[held[-1]] >= BINDS[low]:
                if not reduce():
                    return None
            held.append(low)
        else:
            label, terms, known = identifier(part)
            values.append((frozenset([label]), terms, known, part, 0))
    while held:
        if held[-1] == "(" or not reduce():
            return None
    return values[0][:4] if len(values) == 1 else None


def _expressions(text: str, ends: list[tuple[str, int]], flat: bytes):
    """(evaluated or None, tag) of each tag that an expression may follow. ``ends``:
    tag and the number of its last word; ``flat``: the text's ``blanked`` bytes."""
    data = text.encode("utf-8", "surrogatepass")
    letters = np.frombuffer(flat, np.uint8) != 32
    stops = np.flatnonzero(letters & ~np.append(letters[1:], False)) + 1
    for tag, last in ends:
        stop = int(stops[last])
        line = data[stop:stop + 4 * LONGEST].decode("utf-8", "ignore").split("\n", 1)[0][:LONGEST]
        if not (mark := _after_tag.match(line)):
            continue
        parts = tokens(line[mark.end():])
        value = evaluate(parts)
        if tag == TAGS[0]:
            if parts:
                yield value, tag
        elif value is not None and value[2]:        # a field: known identifiers only
            yield value, tag


def scan_text(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, terms,
    expressions, n_malformed of one text."""
    flat = blanked(text)
    n, rows = 0, []
    for part in words(flat):
        n += len(part)
        rows.append(b" ".join(part))
    line = b" %b " % b" ".join(filter(None, rows))
    base, labels, places, tags = set(), set(), [], []
    score, terms, at, number = 0.0, 0, 0, 0
    for end, (size, n_of, base_label, label, strength, tag) in sorted(
            automaton().iter(line.decode("latin-1")), key=lambda hit: (hit[0] - hit[1][0], hit[0])):
        start = end - size + 1
        number += line.count(b" ", at, start)       # spaces before the phrase's own: its first word's number
        at = start
        if base_label:
            base.add(base_label)
            places.append(number)
        if label:
            labels.add(label)
            score, terms = max(score, strength), max(terms, OF_LABEL[label])
        if tag:
            tags.append((tag, number + n_of - 1))
    shown, malformed = set(), 0
    for value, _ in _expressions(text or "", tags, flat) if tags else ():
        if value is None:
            malformed += 1
            continue
        labels |= value[0]
        shown.add(value[3])
        score, terms = max(score, 1.0 if value[2] else 0.7), max(terms, value[1])
    return (n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score, TERMS[terms], "; ".join(sorted(shown)), malformed)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, terms string, expressions string, n_malformed long")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document. A narrow pass: no shuffle, one batch of texts in memory."""
    def rows(batches):
        for batch in pieces(batches):
            found = zip(*map(scan_text, batch.column("text").to_pylist()))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()] + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(found, kinds))], names=names)

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SCHEMA)
