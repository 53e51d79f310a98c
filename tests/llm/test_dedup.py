"""Sentence spans, suffix levels, Jaccard groups and embeddings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ballotbox.llm import jaccard, rabitq, sentences, suffixes
from ballotbox.llm.components import components
from llm.conftest import EDGES, LONG, SF


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)]
    links += [(2000, 2001 + i) for i in range(100)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# sentence spans

def brute_sentences(rows):
    """First places by one pass over the documents in order."""
    first, out = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        parts = sentences.split(text or "")
        words = [sentences.n_words(p.split()) for p in parts]
        gone = set()
        for i, j in sorted(sentences.runs(words)):
            span = " ".join(" ".join(parts[i:j]).split())
            if first.setdefault(span, (doc_id, i, j)) != (doc_id, i, j):
                gone.update(range(i, j))
        out[doc_id] = "".join(p for k, p in enumerate(parts) if k not in gone)
    return out


def test_sentence_spans(documents):
    got = {r.doc_id: r.text for r in sentences.dedup(documents).collect()}
    want = brute_sentences([(r.doc_id, r.text) for r in documents.collect()])
    assert got == want and want != {r.doc_id: r.text for r in documents.collect()}


def test_passages_go_and_the_rest_stays(spark):
    rnd = random.Random(4)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) + (". " if k % 9 == 8 else "") for k in range(n)) + ". "

    passage = prose(60)
    rows = [(i, prose(80) + (passage if i % 3 == 0 else "") + prose(50)) for i in range(30)]
    out = {r.doc_id: r for r in sentences.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert out[i].text == (text if i % 3 or i == 0 else text.replace(passage, ""))


def test_sentences_of_other_scripts(spark):
    rnd = random.Random(12)

    def prose(letters, stop, n):
        return "".join("".join(rnd.choice(letters) for _ in range(24)) + stop for _ in range(n))

    han = "".join(map(chr, range(0x4E00, 0x4E80)))
    hindi = "".join(map(chr, range(0x0915, 0x0939))) + "   "
    rows = []
    for letters, stop in ((han, "。"), (han, "！"), (hindi, "। "), (hindi, "? ")):
        passage = prose(letters, stop, 14)
        first = len(rows)
        rows += [(first, prose(letters, stop, 4) + passage), (first + 1, prose(letters, stop, 5) + passage + prose(letters, stop, 4)),
                 (first + 2, prose(letters, stop, 9))]
        rows[-2] = (*rows[-2], passage)
    out = {r.doc_id: r.text for r in sentences.dedup(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for doc_id, text, *passage in rows:
        assert out[doc_id] == (text.replace(passage[0], "") if passage else text)


@pytest.mark.parametrize("text", ["", "a", "これは。それは！「はい。」 と", "क। ख॥ ग", "A. B? C!\nd\n\n e.f. g", "x\n", "\n\n", "No end", "Dots... more!! "])
def test_split_joins_back(text):
    assert "".join(sentences.split(text)) == text


def test_sentence_edges(edges, nothing):
    out = sentences.dedup(edges).collect()
    assert len(out) == len(EDGES)
    by_id = {r.doc_id: r for r in out}
    assert by_id[2].text is None and by_id[3].text == "" and by_id[6].n_removed >= by_id[5].n_removed > 0
    assert sentences.dedup(nothing).count() == 0


# suffix levels

def brute_bytes(rows):
    counts = Counter()
    for _, t in rows:
        b = (t or "").encode()
        counts.update(b[i:i + 200] for i in range(len(b) - 199))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if counts[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("contexts,part,batches", [(4000, 1 << 20, 4), (3, 512, 3), (4000, 1 << 20, 1)])
def test_suffix_levels_on_planted_copies(spark, monkeypatch, contexts, part, batches):
    monkeypatch.setattr(suffixes, "CONTEXTS", contexts)
    monkeypatch.setattr(suffixes, "PART", part)
    rnd = random.Random(5)

    def noise(n):
        return "".join(rnd.choice("abcdefg é") for _ in range(n))

    base = noise(3000)
    rows = [(1, base), (2, base[:500] + "X" + base[501:]), (3, noise(300) + base[100:300] + noise(100)),
            (4, noise(300) + base[100:270] + noise(100)), (5, "ab " * 400), (6, "x" * 199), (7, "x" * 200), (8, None), (9, ""),
            (None, noise(50) + base[700:1000]), (1, base), (10, base[2000:2450] + noise(30) + base[2000:2450]),
            (11, noise(500)), (11, noise(400))]
    rows += [(100 + i, noise(rnd.randint(0, 400)) + base[rnd.randint(0, 1000):][:rnd.randint(150, 600)] + noise(rnd.randint(0, 300)))
             for i in range(60)]
    got = suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string"), batches).collect()
    assert in_order(got) == in_order(brute_bytes(rows))


def test_suffix_levels_on_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert in_order(suffixes.dedup(documents).collect()) == in_order(brute_bytes(rows))


def test_levels_grow_geometrically(spark):
    family = suffixes.Levels()
    sizes, found = [], []
    for i in range(6):
        batch = spark.createDataFrame([(10 * i, 1), (7, 1)], "anchor long, n long")
        found.append(sorted(r.anchor for r in family.add(batch).collect()))
        sizes.append(sorted(family.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2], [1, 2]]
    assert found == [[], [7], [7], [7], [7], [7]]
    assert sorted(family.levels[2].collect()) == sorted([(0, 1), (10, 1), (20, 1), (30, 1), (7, 4)])


def test_suffix_edges(edges, nothing):
    rows = [(r[0], r[1]) for r in EDGES if r[0] not in (5, 6)]
    small = edges.filter("coalesce(doc_id, 0) NOT IN (5, 6)")
    assert in_order(suffixes.dedup(small).collect()) == in_order(brute_bytes(rows))
    both = {r.doc_id: r for r in suffixes.dedup(edges).collect()}
    assert both[5].n_removed == both[6].n_removed > 0
    assert suffixes.dedup(nothing).count() == 0


# Jaccard groups

def token_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return set(zip(*(words[i:] for i in range(4)))) if len(words) > 3 else {tuple(words)} if words else set()


def brute_groups(rows):
    sets = {d: token_set(t) for d, t in rows}
    label = {d: d for d in sets}
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= 85 * (len(x) + len(y) - shared):
                    low, high = sorted((label[a], label[b]))
                    label = {d: low if v == high else v for d, v in label.items()}
    return {d: (len(sets[d]), label[d]) for d in sets}


def family(rnd, n, size, edits):
    base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(size)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rnd.randint(0, edits)):
            copy[rnd.randrange(size)] = f"e{rnd.randrange(10 ** 6)}"
        yield " ".join(copy)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    texts = [LONG, None, "a b", "", "one two three four five", " x" * 500, "y" * 300]
    want = jaccard.shingle_sets(texts)
    monkeypatch.setattr(jaccard, "PART", 64)
    assert all((a == b).all() for a, b in zip(jaccard.shingle_sets(texts), want, strict=True))
    assert [len(s) for s in want] == [len(token_set(t)) for t in texts]


@pytest.mark.parametrize("group,firsts", [(5, 0), (3, 8), (4096, 8)])
def test_jaccard_groups_with_families_and_a_common_passage(spark, monkeypatch, group, firsts):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "FIRSTS", firsts)
    monkeypatch.setattr(jaccard, "HOT_SHARE", 20)
    rnd = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [t for size, edits in ((100, 4), (200, 7), (60, 3), (300, 12)) for t in family(rnd, 40, size, edits)]
    texts += [next(family(rnd, 1, rnd.randint(5, 80), 0)) + " " + passage for _ in range(60)]
    texts += ["Three short words", "three SHORT words", "three short", "É é", "é É", "a b c d", "a b c d e"]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r[0]: tuple(r[1:]) for r in jaccard.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows)


@pytest.mark.parametrize("hot,run", [(100, 1 << 16), (1, 3)])
def test_jaccard_groups_of_documents(documents, monkeypatch, hot, run):
    monkeypatch.setattr(jaccard, "HOT_SHARE", hot)
    monkeypatch.setattr(jaccard, "RUN", run)
    got = {r[0]: tuple(r[1:]) for r in jaccard.report(documents).collect()}
    assert got == brute_groups([(r.doc_id, r.text) for r in documents.collect()])


def test_one_id_with_many_texts_links_them(spark):
    rnd = random.Random(21)

    def prose(n):
        return " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(n))

    base = [prose(60) for _ in range(40)]
    rows = [(7, t) for t in base[:30]] + [(100 + i, t + " end") for i, t in enumerate(base)] + [(7, ""), (3, None), (3, base[35]), (200, prose(9))]
    got = {}
    for r in jaccard.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
    assert all(len(v) == 1 for v in got.values())
    want = {7: 7, 3: 3, 200: 200, **{100 + i: 7 if i < 30 else 3 if i == 35 else 100 + i for i in range(40)}}
    assert {d: v.pop() for d, v in got.items()} == want


def test_kept_tokens_of_partners_reach_the_bound():
    """Whatever the frequencies: what two partners both keep is at least the bound."""
    rng = np.random.default_rng(4)
    for percent in (80, 85):
        for _ in range(400):
            a = int(rng.integers(1, 160))
            b = int(rng.integers(a, 100 * a // percent + 1))
            lo = -(-percent * (a + b) // (100 + percent))       # overlap at the threshold
            if lo > a:
                continue
            every = rng.permutation(100_000)[:a + b - lo].astype(np.int64)
            often = {int(t): (int(rng.integers(1, 6)), int(t)) for t in every}
            kept = []
            for tokens in (every[:a], every[a - lo:]):
                first = jaccard.prefix(np.sort(tokens), percent)
                order = sorted(map(int, first), key=often.get, reverse=True)
                kept.append(set(order[jaccard.dropped(len(tokens), percent):]))
            assert len(kept[0] & kept[1]) >= min(jaccard.BOUND, jaccard.least_shared(a, percent))


def test_recurring_word_sequences_open_few_groups(spark):
    """Unrelated texts over few words share many tokens; what is compared grows in proportion."""
    opened = {}
    for n in (300, 1200, 4800):
        rnd = random.Random(n)
        rows = [(i, " ".join(f"v{rnd.randrange(12)}" for _ in range(120))) for i in range(n)]
        rows += [(n + i, rows[i][1] + " tail") for i in range(n // 100)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ref", F.col("doc_id"))
        classes = jaccard._classes(docs, 4, 85).withColumn("node", F.col("ref")).persist()
        sets = jaccard._grouped(jaccard._tokens(classes, 85), 85).persist()
        opened[n] = jaccard._openings(sets, 85).count()
        if n == 1200:
            links = jaccard.report(docs.select("doc_id", "text")).filter("doc_id <> component_id").collect()
            assert sorted((r.doc_id, r.component_id) for r in links) == [(n + i, i) for i in range(n // 100)]
    assert all(opened[n] <= n // 100 for n in opened), opened      # few by chance; copies share a group


def test_jaccard_edges(edges, nothing):
    out = jaccard.report(edges).collect()
    assert len(out) == len(EDGES)
    by_id = {r.doc_id: r for r in out}
    assert (by_id[2].n_shingles, by_id[2].component_id) == (0, 2) and by_id[4].component_id == 4
    assert by_id[5].component_id == by_id[6].component_id == 5
    assert by_id[None].component_id is None and by_id[None].n_shingles > 0
    stay = jaccard.apply(edges)
    assert stay.columns == edges.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in stay.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (False, 7), (False, 8), (False, 9), (True, 0)]
    assert jaccard.report(nothing).count() == 0 and jaccard.apply(nothing).count() == 0


# embeddings

def brute_vectors(rows):
    n = len(rows)
    count, pairs = np.zeros(n, int), []
    for a in range(n):
        for b in range(a + 1, n):
            if rows[a][2] is not None and rows[a][2] == rows[b][2]:
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    count[[a, b]] += 1
                    pairs.append((a, b))
    ids = np.array([r[0] for r in rows])
    i, j = (np.array([p[k] for p in pairs], int) for k in range(2))
    return {r[0]: (int(count[k]), int(rabitq.roots(n, i, j, ids)[k])) for k, r in enumerate(rows)}


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(rabitq, "BLOCK", block)
    monkeypatch.setattr(rabitq, "BUCKET", 16)
    rng = np.random.default_rng(1)
    rows = []
    for c in range(12):
        center = rng.normal(size=24)
        for _ in range(int(rng.integers(1, 60))):
            rows.append((len(rows), (center + rng.normal(scale=rng.choice([0.02, 0.2, 1.0]), size=24)).astype(np.float32).tolist(), c % 3))
    rows += [(len(rows), rows[0][1], 0), (len(rows) + 1, rows[0][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in rabitq.dedup(df).collect()}
    want = brute_vectors(rows)
    links = sum(v[0] for v in want.values())
    assert all(got[k][0] <= want[k][0] for k in want) and links > 1000      # none below the threshold
    assert sum(v[0] for v in got.values()) >= 0.97 * links
    assert np.mean([got[k][1] == want[k][1] for k in want]) > 0.97


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(400, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    turned, codes, factors = rabitq.coded(v, 3)
    estimate, error = rabitq.estimated(turned, codes, factors)
    off = ~np.eye(400, dtype=bool)
    gap = (estimate - v @ v.T)[off]
    assert abs(gap.mean()) < 0.005
    assert (np.abs(gap) <= np.broadcast_to(error, estimate.shape)[off]).mean() > 0.999


def test_rounded_queries_leave_true_links_open():
    """The bound on codes and four-bit queries opens every link, and not everything."""
    rng = np.random.default_rng(2)
    for dim in (7, 64):
        base = rng.normal(size=(150, dim))
        v = np.concatenate([base, base + rng.normal(scale=0.05, size=base.shape), rng.normal(size=(300, dim))])
        unit = v / np.linalg.norm(v, axis=1)[:, None]
        turned, codes, factors = rabitq.coded(unit, 5)
        q, low, step = rabitq.packed(turned)
        back = rabitq.unpacked(q, low, step, dim)
        assert np.abs(back - turned).max() <= step.max() / 2 + 1e-6
        cosine = unit @ unit.T - 2 * np.eye(len(v))
        linked = (cosine >= 0.98).any(axis=1)
        got = rabitq.has_open_pair(back, step, codes, factors, 0, 0.98)
        assert got[linked].all() and linked.sum() >= 250
        if dim == 64:
            assert got[300:].mean() < 0.9
        two = rabitq.has_open_pair(back, step, codes, factors, 150, 0.98)
        across = (cosine[:150, 150:] >= 0.98)
        assert two[:150][across.any(axis=1)].all() and two[150:][across.any(axis=0)].all()


def test_recall_on_the_given_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want, got = brute_vectors(rows), {r.vec_id: r.n_links for r in rabitq.dedup(df).collect()}
    assert len(got) == len(rows)
    assert sum(got.values()) >= 0.9 * sum(v[0] for v in want.values()) and all(got[k] <= want[k][0] for k in got)


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (3, [1.0, 0.0], None, "x"), (4, None, 1, "x"), (5, [0.0, 0.0], 1, "x"),
            (6, [nan, 1.0], 1, "x"), (7, [inf, 1.0], 1, "x"), (8, [None, 1.0], 1, "x"), (9, [], 1, "x"), (10, [1.0, 0.0, 0.0], 1, "x"),
            (None, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (11, [1.0, 0.0], 2, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string")
    out = rabitq.dedup(df).collect()
    assert len(out) == len(rows)
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in out}
    assert found == {(1, 2, 1, True), (2, 2, 1, False), (None, 0, None, False)} | {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)}
    assert rabitq.dedup(df.limit(0)).count() == 0
