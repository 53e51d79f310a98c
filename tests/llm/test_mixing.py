import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ballotbox.llm import mixing
from llm.conftest import EDGES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """Targets by giving the excess out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in stopped)
        open_ = [s for s in names if s not in stopped]
        out = {s: epochs * sizes[s] if s in stopped else left * w[s] / sum(w[o] for o in open_) for s in names}
        over = {s for s in open_ if out[s] >= epochs * sizes[s]}
        if not over:
            return out
        stopped |= over


def brute(rows):
    """The mix by one global order of all copies."""
    size = [len(WORDS.findall(t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, s), n in zip(rows, size):
        sizes[s] = sizes.get(s, 0) + n
    target = filled(sizes)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    digest = [hashlib.md5(str(d).encode()).hexdigest() for d, _, _ in rows]
    upto, copies = dict.fromkeys(sizes, 0), []
    for k in sorted(range(len(rows)), key=lambda k: digest[k]):
        s = rows[k][2]
        upto[s] += size[k]
        for e in range(2):
            copies.append(((upto[s] + e * sizes[s]) / target[s] if target[s] else float("inf"), names.index(s), e, digest[k], k))
    budget, held, taken = sum(sizes.values()) * 3 // 2, 0, [0] * len(rows)
    for *_, k in sorted(copies):
        held += size[k]
        if held > budget:
            break
        taken[k] += size[k]
    return {rows[k][0]: (size[k], sizes[rows[k][2]], pytest.approx(target[rows[k][2]]), taken[k]) for k in range(len(rows))}


def test_equals_one_global_order(documents):
    got = {r[0]: tuple(r[1:]) for r in mixing.report(documents).collect()}
    assert got == brute([tuple(r) for r in documents.select("doc_id", "text", "source").collect()])


def test_buckets_do_not_change_the_mix(documents, monkeypatch):
    want = sorted(map(tuple, mixing.report(documents).collect()))
    monkeypatch.setattr(mixing, "LEAST_BUCKETS", 1)
    monkeypatch.setattr(mixing, "BINS", 3)
    assert sorted(map(tuple, mixing.report(documents).collect())) == want


def test_targets_are_met_and_no_row_passes_two_copies(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', int(id % 37)) AS text",
                                        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 11) END AS source")
    out = mixing.report(docs)
    per = out.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 37 for r in per)
    assert out.filter("taken > 2 * size").count() == 0


@pytest.mark.parametrize("many", [10_000, 7])
def test_a_hot_row_does_not_shift_its_source(spark, monkeypatch, many):
    """40 of 100 rows equal: each is a place of its own in the queue."""
    monkeypatch.setattr(mixing, "MANY", many)
    rows = [(5, "w " * 50, "a") for _ in range(40)] + [(100 + i, "v " * (30 + i % 7), "b" if i % 2 else "c") for i in range(60)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, source string, at int")
    out = mixing.report(docs).collect()
    assert len(out) == 100
    taken, want = {}, filled({"a": 2000, **{s: sum(len(r[1].split()) for r in rows if r[2] == s) for s in "bc"}})
    for r in out:
        taken[r.source_size, round(r.target, 6)] = taken.get((r.source_size, round(r.target, 6)), 0) + r.taken
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert sorted(taken) == sorted((n, round(want[s], 6)) for s, n in (("a", 2000), *((s, sum(len(r[1].split()) for r in rows if r[2] == s)) for s in "bc")))
    assert all(abs(n - target) <= 50 for (_, target), n in taken.items())
    total = sum(len(r[1].split()) for r in rows) * 3 // 2
    assert total - 50 <= sum(r.taken for r in out) <= total
    mixed = mixing.apply(docs).collect()
    assert sum(len(r.text.split()) for r in mixed) == sum(r.taken for r in out)
    times = {}
    for r in mixed:
        times[r["at"]] = times.get(r["at"], 0) + 1
    hot = [r.taken // 50 for r in out if r.doc_id == 5]
    assert max(times.values()) <= 2 and sorted(times.get(i, 0) for i in range(40)) == sorted(hot)


def test_edges(edges, nothing):
    out = mixing.report(edges).collect()
    assert len(out) == len(EDGES)
    assert all(r["size"] == r.taken == 0 for r in out if r.doc_id in (2, 3, 4))
    same = [r for r in out if r.doc_id == 7 and r["size"] == 2]
    assert len(same) == 2 and same[0].target == same[1].target
    mixed = mixing.apply(edges)
    assert mixed.columns == edges.columns
    taken = sum(r.taken for r in out)
    assert sum(len(WORDS.findall(r.text or "")) for r in mixed.collect()) == taken
    assert mixing.report(nothing).count() == 0 and mixing.apply(nothing).count() == 0
