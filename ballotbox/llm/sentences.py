"""Substring deduplication over sliding spans of sentences.

A text is cut into sentences (after ``.``, ``!`` or ``?`` and white space, after the
full stops of other scripts, and at line ends). A word is a run without white space;
scripts that write none count two characters as a word. From every sentence, and back from every sentence, goes the shortest
run of at least ``SENTENCES`` sentences and ``WORDS`` words, or of
``LONG_WORDS`` words if that comes first; a passage that is repeated as a whole
is then covered from its first sentence to its last. Runs are hashed (with white
space made even) and joined globally. The first place of a run is the one with
the least (doc_id, text key, sentence); a sentence under any other place of a
repeated run is removed, with the white space after it.

Repeats inside one document are settled where it is read, so each document sends
a run once. Counts are pre-aggregated per task; the join back has one row per
repeated run on one side, so Spark may split its other side at a hot run. Only
sentence numbers travel to the texts.

Defined cases. NULL or empty text: unchanged (no sentences). NULL doc_id: least.
Rows equal in doc_id and text are one document (all keep what one keeps); rows
that share a doc_id with other texts are different documents. Empty table: empty
result. Very long texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize, pieces, text_key

SENTENCES = 3
WORDS = 15
LONG_WORDS = 40

# Full stops of Chinese and Japanese, Devanagari, Arabic, Urdu, Armenian,
# Ethiopic, Burmese and Khmer; letters written without spaces between words.
STOPS = "。！？｡।॥؟۔։።፧၊။។៕"
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"

_ends = re.compile(rf"[.!?]+\s+|[{STOPS}]+[」』”’）)]?\s*|\n\s*")
_unspaced = re.compile(f"[{UNSPACED}]")


def split(text: str) -> list[str]:
    """Sentences with the white space after them; joined they are the text."""
    cuts = [0, *(m.end() for m in _ends.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def runs(words: list[int]) -> set[tuple[int, int]]:
    """Runs [i, j) of sentences with these numbers of words."""
    n, total, upto = len(words), 0, [0]
    for w in words:
        total += w
        upto.append(total)

    def enough(i: int, j: int) -> bool:
        held = upto[j] - upto[i]
        return held >= LONG_WORDS or j - i >= SENTENCES and held >= WORDS

    out, j = set(), 0
    for i in range(n):
        j = max(j, i + 1)
        while j < n and not enough(i, j):
            j += 1
        if not enough(i, j):
            break
        out.add((i, j))
    i = 0
    for j in range(1, n + 1):
        if not enough(0, j):
            continue
        while i + 1 < j and enough(i + 1, j):
            i += 1
        if enough(i, j):
            out.add((i, j))
    return out


def n_words(parts: list[str]) -> int:
    """Words of a sentence cut at white space."""
    dense = sum(len(_unspaced.findall(p)) for p in parts if not p.isascii())
    return max(len(parts), dense // 2)


def hashed(text: str) -> tuple[dict[tuple[int, int], tuple[int, int]], list[tuple[int, int]], int]:
    """(hash, length) -> first run with it; the later runs in this text; number of sentences."""
    parts = [s.split() for s in split(text)]
    even = [" ".join(p) for p in parts]
    first: dict[tuple[int, int], tuple[int, int]] = {}
    again = []
    for i, j in sorted(runs([n_words(p) for p in parts])):
        span = " ".join(even[i:j]).strip()
        key = (xxhash.xxh3_64_intdigest(span.encode("utf-8", "surrogatepass")) - (1 << 63), len(span))
        if first.setdefault(key, (i, j)) != (i, j):
            again.append((i, j))
    return first, again, len(parts)


def _spans(docs: DataFrame) -> DataFrame:
    names = ["hash", "size", "doc_id", "txt_key", "i", "j"]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())

    def rows(batches):
        for batch in pieces(batches):
            out = []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "txt_key", "text"))):
                if text:
                    out += [(*h, doc_id, key, *run) for h, run in hashed(text)[0].items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return docs.mapInArrow(rows, "hash long, size int, doc_id long, txt_key long, i int, j int")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, text (what is left), n_sentences, n_removed (sentences) per row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("txt_key", text_key(F.col("text")))
    spans = materialize(_spans(keyed), "sentence-spans")
    repeated = (spans.groupBy("hash", "size")
                .agg(F.count("*").alias("places"), F.min(F.struct("doc_id", "txt_key")).alias("first"),
                     F.max(F.struct("doc_id", "txt_key")).alias("last"))
                .filter("places > 1 AND first <> last").select("hash", "size", "first"))
    later = (spans.join(repeated, ["hash", "size"]).filter(F.struct("doc_id", "txt_key") != F.col("first"))
             .groupBy("doc_id", "txt_key").agg(F.collect_set(F.struct("i", "j")).alias("runs"))
             .select(F.col("doc_id").alias("later_id"), F.col("txt_key").alias("later_key"), "runs"))
    joined = keyed.join(later, keyed["doc_id"].eqNullSafe(later["later_id"]) & (keyed["txt_key"] == later["later_key"]),
                        "left").select("doc_id", "text", "runs")

    def left(batches):
        for batch in pieces(batches):
            texts, counts, removed = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                if not text:
                    texts.append(text)
                    counts.append(0)
                    removed.append(0)
                    continue
                _, again, n = hashed(text)
                gone = {s for i, j in again for s in range(i, j)}
                for r in found or ():
                    gone.update(range(r["i"], r["j"]))
                texts.append("".join(s for k, s in enumerate(split(text)) if k not in gone) if gone else text)
                counts.append(n)
                removed.append(len(gone))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int32()),
                                              pa.array(removed, pa.int32())], names=["doc_id", "text", "n_sentences", "n_removed"])

    return joined.mapInArrow(left, "doc_id long, text string, n_sentences int, n_removed int")
