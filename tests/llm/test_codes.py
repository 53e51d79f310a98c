"""Codes by Orchard search against comparing every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest

from ballotbox.llm import codes


def brute(rows):
    """rows: (vec_id, vector, label) -> sorted result rows."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(max(len(v) for _, v, _ in kept), 1) // 8) * 8
    per = width // 8
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[r[1][p * per:(p + 1) * per] for r in order[:16]] for p in range(8)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            groups = {}
            for _, v, _ in kept:
                part = v[p * per:(p + 1) * per]
                groups.setdefault(nearest(part, books[p])[1], []).append(part)
            for k, parts in groups.items():
                books[p][k] = [sum(c) // len(parts) for c in zip(*parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, lab in kept:
        found = [nearest(v[p * per:(p + 1) * per], books[p]) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
    total = {}
    for *_, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, c, e, total[lab], sha) for i, c, e, lab in out), key=str)


def test_equals_brute_force(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = sorted(map(tuple, codes.compress(vectors).collect()), key=str)
    assert got == brute([(r.vec_id, r.embedding, r.label) for r in vectors.collect()]) and len(got) == vectors.count()


@pytest.mark.parametrize("k", [1, 2, 16, 40])
def test_orchard_finds_the_nearest_and_passes_entries_over(k, monkeypatch):
    rng = np.random.default_rng(k)
    book = rng.integers(-20, 20, (k, 3))
    book[k // 2:] = book[:k - k // 2]           # equal entries
    points = np.concatenate([rng.integers(-25, 25, (500, 3)), book])
    d = ((points[:, None] - book[None]) ** 2).sum(-1)
    looked = []
    real = codes.distances
    monkeypatch.setattr(codes, "distances", lambda a, b: looked.append(len(a)) or real(a, b))
    entry, dist = codes.orchard(points, book)
    assert entry.tolist() == d.argmin(1).tolist() and dist.tolist() == d.min(1).tolist()
    if k == 40:
        assert sum(looked[2:]) < 0.8 * len(points) * k      # walks end early


def test_blocks_do_not_change_the_codes(spark, monkeypatch):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = sorted(map(tuple, codes.compress(vectors).collect()))
    monkeypatch.setattr(codes, "CELLS", 500)
    assert sorted(map(tuple, codes.compress(vectors.repartition(7)).collect())) == want


def test_edges(spark):
    rnd = random.Random(5)

    def vector(n=16):
        return [rnd.uniform(-1, 1) for _ in range(n)]

    rows = [(i, vector(), rnd.choice([1, 2, None])) for i in range(40)]
    rows += [(100, None, 1), (101, [1.0, None] * 8, 1), (102, [float("nan")] * 16, 2), (103, [float("inf")] * 16, None),
             (3, vector(), 1), (3, rows[3][1], 2), (None, vector(), None), (None, vector(), 1), (105, [0.0] * 16, 1),
             (106, vector(11), 1), (107, [], 2), (108, [1.0], 1)]
    schema = "vec_id long, embedding array<double>, label int, error string, code int"
    got = sorted(map(tuple, codes.compress(spark.createDataFrame([(*r, "x", 1) for r in rows], schema)).collect()), key=str)
    assert got == brute(rows)
    few = [(7, vector(), 1), (2, vector(), 1)]
    got = sorted(map(tuple, codes.compress(spark.createDataFrame([(*r, "x", 1) for r in few], schema)).collect()), key=str)
    assert got == brute(few)
    assert codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, None, 1, "x", 1)], schema)).count() == 0
    huge = codes.compress(spark.createDataFrame([(1, [1e30, -1e300] * 8, 1, "x", 1), (2, [0.0] * 16, 1, "x", 1)], schema))
    assert [r.error for r in huge.collect()] == [0, 0]
