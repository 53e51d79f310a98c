import pytest

import corpus_pipeline
import __spark_entry__ as entry
from ballotbox.llm import jaccard, quality, surrogates
from ballotbox.llm.common import materialize
from llm.conftest import EDGES, LONG, SF


def test_stages(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), "test-stage")
        if name != "packing":
            assert docs.columns == documents.columns
        old, new = before.collect(), docs.collect()
        if name == "quality rules":
            kept = {r.doc_id for r in quality.report(before).filter("kept").collect()}
            assert {r.doc_id for r in new} == kept and len(new) == len(kept) < len(old)
        elif name == "near duplicates":
            groups = {r.component_id for r in jaccard.report(before).collect()}
            assert {r.doc_id for r in new} == groups and len(new) == len(groups) < len(old)
        elif name == "private data":
            text = {r.doc_id: r.text for r in surrogates.report(before).collect()}
            assert {r.doc_id: r.text for r in new} == text and all(r.n_chars == len(r.text) for r in new)
        elif name == "source mix":
            assert {tuple(r) for r in new} <= {tuple(r) for r in old}
            words = [sum(len(r.text.split()) for r in rows) for rows in (old, new)]
            assert 1.4 * words[0] < words[1] <= 1.5 * words[0]
        else:
            at = {}
            for r in sorted(new, key=lambda r: (r.sequence_id, r.offset)):
                assert r.offset == at.get(r.sequence_id, 0)
                at[r.sequence_id] = r.offset + r.length
            assert max(at.values()) <= 1024 and sum(r.piece == 0 for r in new) == len(old)


def test_queries_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_run_gives_sequences(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


PIPELINE = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_odd_documents(spark, edges, nothing, name, stage):
    """NULLs in any column, empty and very long texts, repeated rows, ids with several texts, clashing names."""
    out = stage(spark, edges, SF)
    rows = out.collect()
    if name == "packing":
        assert out.columns == PIPELINE
        assert sum(r.piece == 0 for r in rows) == len(EDGES)        # every row is packed, those without text as their end id
    else:
        assert out.columns == edges.columns and {f.name: f.dataType for f in out.schema} == {f.name: f.dataType for f in edges.schema}
    texts = sorted((r.doc_id or 0, r.text or "") for r in rows) if name != "packing" else []
    if name == "quality rules":
        assert all(len(t.split()) >= 50 for _, t in texts)          # NULL, empty and short texts fail the base rules
    elif name == "near duplicates":
        # one of the two long texts, one of the equal rows; rows without an id or words stay
        assert [d for d, _ in texts] == [0, 1, 2, 3, 4, 5, 7, 7, 8, 9] and sum(t == LONG for _, t in texts) == 1
    elif name == "private data":
        assert len(texts) == len(EDGES)
        assert [t for d, t in texts if d not in (8,)] == [t or "" for d, t, *_ in sorted(EDGES, key=lambda r: (r[0] or 0, r[1] or "")) if d != 8]
        assert "ann@site.example.org" not in next(t for d, t in texts if d == 8)
    elif name == "source mix":
        assert all(t in {r[1] or "" for r in EDGES} for _, t in texts)
        assert all(n <= 2 * sum((r[0] or 0, r[1] or "") == k for r in EDGES) for k, n in {k: texts.count(k) for k in texts}.items())
    empty = stage(spark, nothing, SF)
    assert empty.count() == 0 and (name == "packing" or empty.columns == nothing.columns)


def test_all_stages_of_an_empty_table(spark, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-empty")
    assert docs.columns == PIPELINE and docs.count() == 0


def test_near_duplicates_equal_brute_force_on_documents(spark, documents):
    """The stage against a join of all five-word shingle sets."""
    rows = documents.select("doc_id", "text").collect()
    sets = {}
    for r in rows:
        words = (r.text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets[r.doc_id] = set(zip(*(words[i:] for i in range(5)))) or ({tuple(words)} if words else set())
    label, ids = {d: d for d in sets}, sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {d: low if v == high else v for d, v in label.items()}
    stay = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents, SF).collect()}
    assert stay == set(label.values())
