"""The near-duplicate stage of the pipeline against a brute-force join of five-word shingles."""

import random

import corpus_pipeline
from llm.conftest import SF


def shingles(text):
    words = text.lower().split()
    return set(zip(*(words[i:] for i in range(5))))


def kept(rows):
    """The least id of every group of texts linked at 0.8 or more."""
    sets, label = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {d: low if v == high else v for d, v in label.items()}
    return set(label.values())


def words(rnd, n):
    return [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]


def test_copies_just_above_the_threshold_go(spark):
    rnd, rows = random.Random(8), []
    for share in (0.18, 0.21, 0.245, 0.26, 0.4):        # appended, cut off
        base = words(rnd, 600)
        rows += [base, base + words(rnd, int(share * 600))]
        base = words(rnd, 600)
        rows += [base, base[:int(600 / (1 + share))]]
    for edits in (20, 21, 22, 24):                      # spread over 1000 words
        base = words(rnd, 1000)
        rows += [base, [f"e{i}" if i % (1000 // edits) == 9 and i < edits * (1000 // edits) else w for i, w in enumerate(base)]]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    want = kept(rows)
    assert 10 < len(want) < 20
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want)


def test_unrelated_texts_under_one_id_stay(spark):
    rnd = random.Random(3)
    base, *alone = (" ".join(words(rnd, 120)) for _ in range(6))
    rows = [(1, text) for text in alone] + [(1, alone[0]), (2, base), (1, base + " end"), (3, alone[1]), (4, ""), (4, None), (5, ""),
                                            (None, base), (None, base)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, at int")
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    want = [(1, text) for text in alone] + [(1, base + " end"), (4, ""), (4, None), (5, ""), (None, base), (None, base)]
    key = lambda r: (str(r[0]), str(r[1]))      # noqa: E731
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=key) == sorted(want, key=key)
