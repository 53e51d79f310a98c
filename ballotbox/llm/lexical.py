"""Ranked lexical search, reversed: documents stream through an index of the queries.

The items (queries) are the small side. Their terms make an inverted index, term
-> items with the term's count, which is broadcast; every document's term counts
go through it once, and each task keeps a bounded heap of its best documents per
item. The heaps of all tasks are merged, first within slices of the tasks.

1. ``_counts``: one pass over the texts keeps each document's length and its
   counts of terms that some item has, and writes them.
2. The number of documents holding each term, the number of documents and of all
   terms are sums over that table.
3. ``_heaps``: the counts meet the postings; all scores are whole numbers.

The index has a proven bound: items are dealt into blocks of about ``POSTINGS``
postings (one item's own distinct terms at least), each with its own pass.

Defined cases. NULL or empty text, or no term: not a document of the search, an
item without results. Repeated rows are documents of their own; equal scores go
by doc_id, NULL last. Items that share an id are ranked each for itself. Very
long texts are cut into words in parts. Empty documents or items: empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize, pieces
from ballotbox.llm.terms import blanked, words

TOP = 20
POSTINGS = 1 << 20          # of a block of items, about
CELLS = 1 << 21             # scores and postings worked on at a time
SLICES = 64                 # heaps are merged within so many slices of the tasks first


def _items(items: DataFrame) -> DataFrame:
    """item, item_id, terms, counts of every item that has a term."""
    def rows(batches):
        for batch in pieces(batches):
            found = []
            for text in batch.column("text").to_pylist():
                held: Counter = Counter()
                for part in words(blanked(text)):
                    held.update(part)
                found.append(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), pa.array([list(c) for c in found], pa.list_(pa.binary())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], names=["item", "item_id", "terms", "counts"])

    rows_of = items.select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn("item", F.monotonically_increasing_id())
    schema = "item long, item_id long, terms array<binary>, counts array<bigint>"
    return materialize(rows_of.select("item", "item_id", "text").mapInArrow(rows, schema).filter("size(terms) > 0"), "lexical-items")


class _Index:
    """Postings of a block of items: for each term the items (by place) and their counts."""

    def __init__(self, rows: list):
        self.items = np.array([r["item"] for r in rows], np.int64)
        self.terms: dict[bytes, int] = {}
        of, at, n = [], [], []
        for place, r in enumerate(rows):
            for term, count in zip(r["terms"], r["counts"]):
                of.append(self.terms.setdefault(bytes(term), len(self.terms)))
                at.append(place)
                n.append(count)
        order = np.argsort(np.array(of, np.int64), kind="stable")
        self.start = np.searchsorted(np.array(of, np.int64)[order], np.arange(len(self.terms) + 1))
        self.at, self.n = np.array(at, np.int64)[order], np.array(n, np.int64)[order]


def _counts(docs: DataFrame, terms) -> DataFrame:
    """doc_id, n, terms, tfs: each document's length and its counts of the index's terms."""
    def rows(batches):
        place = terms.value.get
        for batch in pieces(batches, 4 << 20):
            keep, sizes, held, tfs, lengths = [], [], [], [], [0]
            for i, text in enumerate(batch.column("text").to_pylist()):
                n, found = 0, []
                for part in words(blanked(text)):
                    n += len(part)
                    ids = np.fromiter(map(place, part, repeat(-1)), np.int64, len(part))
                    found.append(ids[ids >= 0])
                if n:
                    ids, tf = np.unique(np.concatenate(found), return_counts=True)
                    keep.append(i)
                    sizes.append(n)
                    held.append(ids)
                    tfs.append(tf)
                    lengths.append(lengths[-1] + len(ids))
            if keep:
                at = pa.array(lengths, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(keep)), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(at, pa.array(np.concatenate(held).astype(np.int32))),
                     pa.ListArray.from_arrays(at, pa.array(np.concatenate(tfs).astype(np.int32)))], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, "doc_id long, n long, terms array<int>, tfs array<int>")


def _frequencies(counts: DataFrame, n_terms: int) -> np.ndarray:
    """Number of documents that hold each term; as long as the index."""
    def rows(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in counts.select("terms").mapInArrow(rows, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


class _Heaps:
    """The best ``top`` documents of each item: by score, then doc_id, NULL last."""

    def __init__(self, n_items: int, top: int):
        self.n, self.top = n_items, top
        self.least = np.zeros(n_items, np.int64)        # the score to reach: that of the last one, if there are ``top``
        self.item = np.empty(0, np.int64)
        self.score, self.doc, self.null = self.item, self.item, np.empty(0, bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """``scores``: documents x items."""
        least = np.maximum(self.least, 1)
        if len(scores) > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=0)[-self.top])
        row, item = np.nonzero(scores >= least)
        if not len(row):
            return
        item, score = np.append(self.item, item), np.append(self.score, scores[row, item])
        doc, null = np.append(self.doc, doc[row]), np.append(self.null, null[row])
        order = np.lexsort((doc, null, -score, item))
        at = item[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        keep = order[rank < self.top]
        self.item, self.score, self.doc, self.null = item[keep], score[keep], doc[keep], null[keep]
        last = order[rank == self.top - 1]
        self.least[item[last]] = score[last]


def _heaps(counts: DataFrame, shared, top: int) -> DataFrame:
    """item, doc_id, score: the heaps of every task."""
    def rows(batches):
        index, weights, n_docs, n_terms = shared.value
        best = _Heaps(len(index.items), top)
        fan = np.diff(index.start)
        for batch in batches:
            lists = batch.column("terms")
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = batch.column("tfs").flatten().to_numpy().astype(np.int64)
            size = batch.column("n").to_numpy().astype(np.int64)
            m = 75 + (25 * size * n_docs) // n_terms
            ends = np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))
            of = np.repeat(np.arange(len(size)), np.diff(ends, prepend=0))
            part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[of]))
            work = np.append(0, np.cumsum(fan[term]))[ends]      # postings up to the end of each document
            doc = batch.column("doc_id")
            null = doc.is_null().to_numpy(zero_copy_only=False)
            doc = doc.fill_null(0).to_numpy()
            most = max(1, CELLS // len(index.items))
            a = 0
            while a < len(size):
                reached = work[a - 1] if a else 0
                z = min(a + most, len(size), max(a + 1, int(np.searchsorted(work, reached + CELLS, "right"))))
                some = slice(ends[a - 1] if a else 0, ends[z - 1])
                many = fan[term[some]]
                first = np.repeat(index.start[term[some]] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
                cell = np.repeat(of[some] - a, many) * len(index.items) + index.at[first]
                value = np.repeat(part[some], many) * index.n[first]
                # sums of the halves stay exact as doubles
                scores = sum((np.bincount(cell, half.astype(np.float64), (z - a) * len(index.items)).astype(np.int64) << shift)
                             for half, shift in ((value >> 24, 24), (value & 0xFFFFFF, 0)))
                best.add(scores.reshape(z - a, len(index.items)), doc[a:z], null[a:z])
                a = z
        yield pa.RecordBatch.from_arrays(
            [pa.array(index.items[best.item]), pa.array(best.doc, pa.int64(), mask=best.null), pa.array(best.score)],
            names=["item", "doc_id", "score"])

    return counts.mapInArrow(rows, "item long, doc_id long, score long")


def _merged(heaps: DataFrame, top: int) -> DataFrame:
    """The best of all heaps, with ranks. Slices of the tasks are merged first, so no
    task reads one item's heaps of all tasks."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    rank = F.row_number()
    sliced = (heaps.withColumn("slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
              .withColumn("rank", rank.over(Window.partitionBy("item", "slice").orderBy(*order))).filter(F.col("rank") <= top))
    return (sliced.drop("rank", "slice").withColumn("rank", rank.over(Window.partitionBy("item").orderBy(*order)))
            .filter(F.col("rank") <= top))


def search(items: DataFrame, docs: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each item."""
    spark = docs.sparkSession
    context = spark.sparkContext
    known = _items(items)
    n_postings = known.agg(F.sum(F.size("terms"))).first()[0]
    found = []
    for block in range(-(-(n_postings or 0) // POSTINGS)):
        dealt = known.filter(F.pmod(F.xxhash64("item"), F.lit(-(-n_postings // POSTINGS))) == block)
        index = _Index(dealt.select("item", "terms", "counts").collect())
        if not len(index.items):
            continue
        counts = materialize(_counts(docs, context.broadcast(index.terms)), "lexical-counts", 3)
        n_docs, n_terms = counts.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        df = _frequencies(counts, len(index.terms))
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        found.append(_heaps(counts, context.broadcast((index, weights, n_docs, n_terms)), top))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = materialize(_merged(reduce(DataFrame.unionAll, found), top), "lexical-best", 8)
    return best.join(known.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
