import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ballotbox.llm import packing, records
from ballotbox.llm.tokens import Encoder
from llm.conftest import EDGES, VOCABULARIES

ODD = ["don't stop", "a\x1cb", "  lead  two", "trail \n\n x", "é Á", "it's 'tis we'll", "ÉCOLE. À!! ß", "x y z",
       "Iİi Σας", "<|endoftext|> a", "a <|endoftext|> b", "x<|startoftext|>y <|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|end oftext|>",
       "long " * 50 + "<|endoftext|>\n tail  ", "tab\t\tx\r\ny", "", "   ", "\n", "日本語 text, ok", "a.b,c", "foo!?bar",
       "naïve, café.; ÿ", "ﬁ ligature", "…", "'s", "a 's b", "1234 12a34", "a" * 300 + " " + "." * 100,
       "word .", "word,.", "áb á.", "x's. y'all! 'll", "­ soft­hy", "a\u00a0b\u2003c\u0085d\u3000e\u2028f\x1cg\x1f h", "\u200bzero\ufeff w"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_those_of_whole_texts(documents, name):
    texts = ODD + [r.text for r in documents.collect()]
    whole = Tokenizer.from_file(f"{VOCABULARIES}/{name}")
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    enc = Encoder(f"{VOCABULARIES}/{name}")
    for _ in range(2):      # the second time from the cache
        assert [np.frombuffer(enc.ids(b), "<u4").tolist() for b in enc.encode(texts)] == want
    assert enc.encode([None]) == [b""]


def test_frames_round_trip_and_damage_is_found():
    data = [b"", b"a", b"\x00" * 5000]
    blob = b"".join(map(records.frame, data))
    assert [d for _, d in records.unframe(blob)] == data
    for at in (0, 9, 14, len(blob) - 1):
        bad = bytearray(blob)
        bad[at] ^= 1
        with pytest.raises(Exception):
            list(records.unframe(bytes(bad)))


def expected(rows, end=2):
    whole = Tokenizer.from_file(f"{VOCABULARIES}/word_bpe_49k.json")
    out, at = [], 0
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_digest_and_files(documents, scratch, spark):
    folder = scratch("records")
    got = sorted(map(tuple, records.digest(documents, folder, f"{VOCABULARIES}/word_bpe_49k.json").collect()))
    assert got == expected(sorted((r.doc_id, r.text) for r in documents.collect()))
    # the offset index leads to every record
    shards = spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(folder).collect()
    bodies = {r.path.rpartition("/")[2][:-4]: bytes(r.content) for r in
              spark.read.format("binaryFile").option("pathGlobFilter", "*.rec").load(folder).collect()}
    n = 0
    for s in shards:
        body = bodies[s.path.rpartition("/")[2][:-4]]
        for (offset,) in struct.iter_unpack("<Q", bytes(s.content)):
            size = struct.unpack("<Q", body[offset:offset + 8])[0]
            assert next(records.unframe(body[offset:offset + 16 + size]))[0] == 0
            n += 1
    assert n == documents.count()


def test_shards_have_a_size_and_are_read_by_their_index(spark, documents, scratch, monkeypatch):
    monkeypatch.setattr(records, "SHARD_BYTES", 6_000)
    monkeypatch.setattr(records, "RANGE_BYTES", 1_500)
    folder = scratch("records")
    got = sorted(map(tuple, records.digest(documents, folder, f"{VOCABULARIES}/word_bpe_49k.json").collect()))
    assert got == expected(sorted((r.doc_id, r.text) for r in documents.collect()))
    cuts = records.ranges(spark, folder).collect()
    shards = {(r.part, r.number) for r in cuts}
    assert len(shards) > 20 and len(cuts) > len(shards)
    back = records.read(spark, folder)
    largest = back.groupBy("part", "number").agg({"n_tokens": "sum", "record": "count"}).collect()
    assert all(2 * r["sum(n_tokens)"] + 26 * r["count(record)"] <= 6_000 or r["count(record)"] == 1 for r in largest)
    rows = sorted((r.part, r.number, r.record, r.doc_id) for r in back.collect())
    assert [r[3] for r in rows] == sorted(r[3] for r in rows) and len(rows) == documents.count()


def test_half_of_all_rows_equal_are_dealt_out(spark, scratch):
    docs = spark.range(8000).selectExpr("CASE WHEN id % 2 = 0 THEN 5L ELSE id END AS doc_id",
                                        "CASE WHEN id % 2 = 0 THEN 'the same words' ELSE concat('w', id) END AS text")
    folder = scratch("records")
    shards = records.write(docs, folder, f"{VOCABULARIES}/word_bpe_49k.json").collect()
    assert sum(r.n_records for r in shards) == 8000 and max(r.n_records for r in shards) < 2500
    rows = sorted((r.part, r.number, r.record, r.doc_id) for r in records.read(spark, folder).collect())
    assert [r[3] for r in rows] == sorted(r[3] for r in rows) and len(rows) == 8000


def test_edges(edges, nothing, scratch):
    got = records.digest(edges, scratch("records"), f"{VOCABULARIES}/word_bpe_49k.json").collect()
    assert len(got) == len(EDGES) and got
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert {r.doc_id: r.n_tokens for r in got}[2] == 1
    assert records.digest(nothing, scratch("records"), f"{VOCABULARIES}/word_bpe_49k.json").count() == 0


def check_packed(rows, docs, capacity):
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0) and r.length >= 1
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in at.values())
    return len(at)


def test_packing(documents):
    rows = packing.pack(documents, f"{VOCABULARIES}/byte_bpe_50k.json", keep_ids=True).collect()
    n = check_packed(rows, documents, 1024)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 1024) + 2
    whole = Tokenizer.from_file(f"{VOCABULARIES}/byte_bpe_50k.json")
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.piece):
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.start == len(by_doc.get(r.doc_id, b"")) // 4
        assert r.piece == 0 or r.length == 1024
        by_doc[r.doc_id] = by_doc.get(r.doc_id, b"") + bytes(r.ids)
    for d in documents.collect():
        assert np.frombuffer(by_doc[d.doc_id], "<u4").tolist() == whole.encode(d.text, add_special_tokens=False).ids + [2]


def test_packing_edges(edges, nothing):
    rows = packing.pack(edges, f"{VOCABULARIES}/byte_bpe_50k.json", capacity=64).collect()
    check_packed(rows, edges, 64)
    assert sum(r.piece == 0 for r in rows) == len(EDGES)
    assert [(r.piece, r.length) for r in rows if r.doc_id == 2] == [(0, 1)]
    assert packing.pack(nothing, f"{VOCABULARIES}/byte_bpe_50k.json").count() == 0


def test_swaps_find_what_best_fit_misses():
    kinds = {(6, 3): 1, (6, 2): 1, (4, 3, 2): 1, (4,): 1}       # 30 tokens in four bins of 10
    out = packing.improve(kinds, 10)
    lengths = sorted(x for k, n in out.items() for _ in range(n) for x in k)
    assert lengths == [2, 2, 3, 3, 4, 4, 6, 6] and sum(out.values()) == 3
    assert all(sum(k) <= 10 for k in out)


def test_best_fit_places_every_length():
    rng = np.random.default_rng(3)
    for _ in range(20):
        counts = {int(x): int(n) for x, n in zip(rng.integers(1, 101, 30), rng.integers(1, 9, 30))}
        for kinds in (packing.best_fit(counts, 100), packing.improve(packing.best_fit(counts, 100), 100)):
            back = {}
            for k, n in kinds.items():
                assert sum(k) <= 100
                for x in k:
                    back[x] = back.get(x, 0) + n
            assert back == counts


def optimum(lengths, capacity):
    """Least number of bins, by placing the longest first into every bin it fits."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        place(i + 1, bins + [lengths[i]])

    place(0, [])
    return best


def raising_exchange(kinds, capacity):
    """Any exchange of up to three documents between two bins that raises the sum of squares."""
    from itertools import combinations

    bins = [k for k, n in kinds.items() for _ in range(n)]
    for low, high in combinations(sorted(bins, key=sum), 2):
        for g in range(3):
            for b in range(min(3, 4 - g)):
                for give in combinations(low, g):
                    for back in combinations(high, b):
                        gain = sum(give) - sum(back)
                        if g + b <= 3 and 0 < gain <= capacity - sum(high):
                            return low, high, give, back
    return None


def test_search_ends_where_nothing_improves_and_near_the_optimum():
    rng = np.random.default_rng(11)
    over = 0
    for _ in range(120):
        lengths = rng.integers(3, 28, rng.integers(4, 12)).tolist()
        kinds = packing.improve(packing.best_fit({x: lengths.count(x) for x in set(lengths)}, 40), 40)
        n, best = sum(kinds.values()), optimum(lengths, 40)
        assert sorted(x for k, m in kinds.items() for _ in range(m) for x in k) == sorted(lengths)
        assert best <= n <= best + 1
        assert n == -(-sum(lengths) // 40) or raising_exchange(kinds, 40) is None
        over += n - best
    assert over <= 6


def test_search_over_many_lengths_reaches_the_bound_in_time():
    import time

    rng = np.random.default_rng(5)
    lengths = np.minimum(1024, np.maximum(1, rng.lognormal(5.5, 1.0, 5000))).astype(int)
    counts = {int(x): int(n) for x, n in zip(*np.unique(lengths, return_counts=True))}
    began = time.time()
    kinds = packing.improve(packing.best_fit(counts, 1024), 1024)
    assert sum(kinds.values()) <= -(-int(lengths.sum()) // 1024) + 1 and time.time() - began < 60


def test_equal_rows_are_dealt_out(spark):
    from pyspark.sql import functions as F

    rows = spark.range(4000).selectExpr("7L AS doc_id", "0 AS piece", "5L AS ids_crc32", "CAST(id % 3 AS long) AS length", "id % 1000 AS deal")
    out = packing.numbered(rows, "length", ["doc_id", "piece", "ids_crc32", "deal"])
    assert {r.length: (r.a, r.z, r.n) for r in out.groupBy("length").agg(
        F.min("rank").alias("a"), F.max("rank").alias("z"), F.count_distinct("rank").alias("n")).collect()} == {
            0: (0, 1333, 1334), 1: (0, 1332, 1333), 2: (0, 1332, 1333)}
