import math
import re

import numpy as np
import pytest

from ballotbox.llm import quality
from llm.conftest import EDGES, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(covered))


@pytest.mark.parametrize("text", [None, "", "a", "a a a", "a a a a", "a b c a b c d", "x\n\nx\n x\nx", "a|b <c> #1 **", "é ü z\x1cq",
                                  "a b a b a b a b", "the end the end of the end of"])
def test_base_counts(text):
    assert quality.base(["x y z x y z", text, "x y z"])[1] == brute(text)


def test_base_counts_of_documents(documents):
    for r in quality.report(documents).join(documents.select("doc_id", "text"), "doc_id").filter("length(text) < 6000").collect():
        want = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def plain_references(rows):
    """(lang, text) -> lang: class counts, most frequent words, their counts and the rest."""
    langs = {}
    for lang, text in rows:
        n, _, symbols, _, again = brute(text)
        have = quality.class_counts(text or "")
        if n < 50 or 100 * again > 50 * n or symbols * 20 > n or have[1] * 4 > have[:3].sum():
            continue
        entry = langs.setdefault(lang, [0, np.zeros(len(quality.CLASSES)), {}])
        entry[0] += 1
        entry[1] += have
        for w in map(quality.plain, text.encode().split()):
            entry[2][w] = entry[2].get(w, 0) + 1
    total = sum(sum(words.values()) for _, _, words in langs.values())
    out = {}
    for lang, (n, classes, words) in langs.items():
        if n >= 10 and sum(words.values()) >= 2000 and sum(words.values()) * 200 >= total:
            best = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:64]
            out[lang] = (classes, [w for w, _ in best], [c for _, c in best] + [sum(words.values()) - sum(c for _, c in best)])
    return out


def divergence(p, q):
    """Jensen-Shannon distance, term by term."""
    p, q = ([x / sum(h) for x in h] for h in (p, q))
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += sum(x * math.log2(x / m) / 2 for x in (a, b) if x)
    return math.sqrt(max(0.0, total))


def plain_verdict(text, refs):
    n, _, _, _, again = brute(text)
    if n < 50 or 100 * again > 50 * n:
        return False
    by_class = min(divergence(quality.class_counts(text).tolist(), r[0].tolist()) for r in refs.values()) if refs and len(text) >= 300 else 0.0
    by_word = 0.0
    if refs:
        words = [quality.plain(w) for w in text.encode().split()]
        by_word = 1.0
        for _, common, counts in refs.values():
            have = [words.count(w) for w in common]
            by_word = min(by_word, divergence(have + [n - sum(have)], counts))
    return by_class <= 0.30 and by_class + by_word <= 0.54 + 7.0 / n


def test_references_and_verdict_equal_a_plain_computation(documents):
    rows = [(r.lang, r.text) for r in documents.collect()]
    refs, want = {r[0]: r for r in quality.references(documents)}, plain_references(rows)
    assert set(refs) == set(want) and len(refs) >= 2
    for lang, (classes, words, counts) in want.items():
        assert (refs[lang][1] == classes).all() and refs[lang][2] == words and refs[lang][3].tolist() == counts
    kept = {r.doc_id: r.kept for r in quality.report(documents).collect()}
    assert kept == {r.doc_id: plain_verdict(r.text, want) for r in documents.collect()}


def test_a_label_of_few_rows_does_not_speak_for_itself(spark, documents):
    rng = np.random.default_rng(6)

    def junk():
        return " ".join("".join(rng.choice(list("QXZJ0123456789")) for _ in range(7)) + " qzx" for _ in range(120))

    rows = [(r.doc_id, r.lang, r.text) for r in documents.collect()]
    odd = [(9000 + i, lang, junk()) for i, lang in enumerate(["en", "en", "en", "zz", None, "zz"])]
    frame = spark.createDataFrame(rows + odd, "doc_id long, lang string, text string")
    assert {r[0] for r in quality.references(frame)} == {r[0] for r in quality.references(documents)}
    kept = {r.doc_id: r.kept for r in quality.report(frame).collect()}
    assert not any(kept[r[0]] for r in odd)
    before = {r.doc_id: r.kept for r in quality.report(documents).collect()}
    assert all(kept[d] == k for d, k in before.items())


def test_distance():
    p, q = np.array([1.0, 0.0]), np.array([0.0, 3.0])
    assert quality.distance(p, p) == 0 and quality.distance(p, q) == pytest.approx(1)
    assert quality.distance(np.array([1.0, 1.0]), np.array([1.0, 3.0])) == pytest.approx(0.2209, abs=1e-3)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = SF.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [r for r in quality.report(spark.read.parquet(f"{sf}/documents.parquet")).collect() if not r.base_failed]
    good = [r.kept for r in out if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in out if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.3


def test_edges(edges, nothing):
    out = quality.report(edges).collect()
    assert len(out) == len(EDGES)
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in out if r.doc_id in (2, 3, 4))
    assert all(r.base_failed for r in out if r.doc_id == 9)
    assert quality.apply(edges).columns == edges.columns
    assert quality.report(nothing).count() == 0 and quality.apply(nothing).count() == 0
