"""Quality rules with a divergence test against language references.

Base rules judge length and repetition. The method's verdict compares two
histograms of a document with those of each language of the corpus, by the
Jensen-Shannon distance (base 2, so within [0, 1]): character classes, and the
language's ``COMMON`` most frequent words with all other words as one more bin.
A document is held against the reference nearest to it, since ``lang`` labels
can be wrong, and fails if the distance of classes exceeds ``CLASS_LIMIT`` or
both together exceed ``SUM_LIMIT`` and an allowance for sampling noise,
``NOISE`` divided by the number of words. Guards: texts of fewer than ``LEAST_CHARS`` characters or ``LEAST_WORDS`` words are too short for
the respective histogram, which then does not count against them.

The references come from all documents that pass the base rules, have at most
one symbol in 20 words and at most a quarter of their letters in upper case (so
that the junk to be found does not shape them). A ``lang`` value is a reference only
with ``LEAST_DOCUMENTS`` such documents, ``LEAST_SUPPORT`` words of theirs and one word
in ``RARE`` of all languages' (so there are at most ``RARE`` references): a few rows with
a label of their own cannot speak for themselves. They are judged by the others.
Counts are summed per task, then per (language, word); the most frequent words of a
language are picked in every task, then among those picked.

Defined cases. NULL or empty text: no words, base_failed. NULL lang: a label
like any other. Repeated rows each get a row. Empty table, or no
document passing the base rules: empty references, which reject nothing. Very
long texts are read whole. Other columns are not read (``apply`` keeps them).
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize, pieces
from ballotbox.llm.jaccard import word_hashes

COMMON = 64
CLASS_LIMIT = 0.30
SUM_LIMIT = 0.54
NOISE = 7.0
LEAST_CHARS = 300
LEAST_WORDS = 50
LEAST_DOCUMENTS, LEAST_SUPPORT, RARE = 10, 2_000, 200       # of a reference
# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
CLASSES = ("lower", "upper", "letter", "digit", "space", "line", "sentence", "mark", "other")

UPPER, LETTERS = 1, slice(0, 3)

_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_edges = ".,;:!?\"'()[]{}<>|*#$%&-–—…«»¿¡"


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class number of every code point, by its general category."""
    t = np.full(0x110000, CLASSES.index("other"), dtype=np.uint8)
    kinds = {"Ll": "lower", "Lu": "upper", "Lt": "upper", "N": "digit", "L": "letter", "Z": "space", "P": "mark", "S": "mark"}
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        t[c] = CLASSES.index(kinds.get(kind) or kinds.get(kind[0]) or "other")
    for c in "\t\v\f\r ":
        t[ord(c)] = CLASSES.index("space")
    t[ord("\n")] = CLASSES.index("line")
    for c in ".,;:?-'":
        t[ord(c)] = CLASSES.index("sentence")
    return t


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.bincount(_class_table()[codes], minlength=len(CLASSES))


def base(texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    hashes, first, last = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    # three words as one number; a window that reaches into the next text is cut off below
    triple = (hashes[:-2] * np.uint64(_MIX[0]) + hashes[1:-1]) * np.uint64(_MIX[1]) + hashes[2:] if len(hashes) > 2 else hashes[:0]
    out = []
    for text, a, z in zip(texts, first.tolist(), last.tolist()):
        if not text:
            out.append((0, 0, 0, 0, 0))
            continue
        lines = [line for line in text.split("\n") if line.strip(SPACES)]
        again = 0
        if z - a > 3:
            windows = triple[a:z - 2]
            order = np.argsort(windows, kind="stable")
            ranked = windows[order]
            equal = ranked[1:] == ranked[:-1]
            if equal.any():
                twice = order[np.concatenate([equal, [False]]) | np.concatenate([[False], equal])]
                covered = np.zeros(z - a, dtype=bool)
                for k in range(3):
                    covered[twice + k] = True
                again = int(covered.sum())
        out.append((z - a, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), again))
    return out


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def plain(word: bytes) -> str:
    """A word in lower case without punctuation around it."""
    return word.decode("utf-8", "surrogatepass").lower().strip(_edges)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


def references(docs: DataFrame, common: int = COMMON) -> list[tuple]:
    """(lang, class histogram, common words, their histogram with the rest last)
    per language with enough support: at most ``RARE`` rows."""
    def count(batches):
        held: dict[str | None, tuple[np.ndarray, Counter, list[int]]] = {}
        size = 0

        def rows():
            out = []
            for lang, (classes, words, docs_of) in held.items():
                out.append((lang, "documents", "", docs_of[0]))
                out += [(lang, "class", name, int(n)) for name, n in zip(CLASSES, classes)]
                even: Counter = Counter()
                for w, n in words.items():
                    even[plain(w)] += n
                out += [(lang, "word", w, n) for w, n in even.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.string(), pa.string(), pa.string(), pa.int64()))], names=["lang", "kind", "key", "n"])

        for batch in pieces(batches, 2 << 20):
            texts = batch.column("text").to_pylist()
            for lang, text, (n, _, symbols, _, again) in zip(batch.column("lang").to_pylist(), texts, base(texts)):
                if base_failed(n, again) or symbols * 20 > n:
                    continue
                have = class_counts(text)
                if have[UPPER] * 4 > have[LETTERS].sum():
                    continue
                classes, words, docs_of = held.setdefault(lang, (np.zeros(len(CLASSES), np.int64), Counter(), [0]))
                classes += have
                docs_of[0] += 1
                before = len(words)
                words.update(text.encode("utf-8", "surrogatepass").split())     # at the same six bytes
                size += len(words) - before
            if size > 400_000:
                yield rows()
                held, size = {}, 0
        if held:
            yield rows()

    counted = (docs.select("lang", "text").mapInArrow(count, "lang string, kind string, key string, n long")
               .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    sums = materialize(counted, "quality-counts", 3)
    support = sums.groupBy("lang").agg(F.sum(F.when(F.col("kind") == "word", F.col("n"))).alias("n_words"),
                                       F.sum(F.when(F.col("kind") == "documents", F.col("n"))).alias("n_docs"))
    total = support.agg(F.sum("n_words")).first()[0] or 0
    enough = ((F.col("n_docs") >= LEAST_DOCUMENTS) & (F.col("n_words") >= LEAST_SUPPORT) & (F.col("n_words") * RARE >= total))
    words_of = {r["lang"]: r["n_words"] for r in support.filter(enough).collect()}
    if not words_of:
        return []

    def best(batches):
        """The most frequent words of each language in a task."""
        held: dict[str | None, list[tuple[int, str]]] = {}
        for batch in batches:
            for lang, key, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "n"))):
                if lang in words_of:
                    some = held.setdefault(lang, [])
                    some.append((-n, key))
                    if len(some) > 64 * common:
                        some.sort()
                        del some[common:]
        rows = [(lang, key, -n) for lang, some in held.items() for n, key in sorted(some)[:common]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                                             names=["lang", "key", "n"])

    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("key"))
    top = (sums.filter("kind = 'word'").select("lang", "key", "n").mapInArrow(best, "lang string, key string, n long")
           .withColumn("at", F.row_number().over(order)).filter(F.col("at") <= common))
    frequent: dict[str | None, list[tuple[str, int]]] = {lang: [] for lang in words_of}
    for r in top.orderBy("at").collect():               # references x common
        frequent[r["lang"]].append((r["key"], r["n"]))
    classes: dict[str | None, dict[str, int]] = {lang: {} for lang in words_of}
    known = F.col("lang").isin([x for x in words_of if x is not None]) | F.lit(None in words_of) & F.col("lang").isNull()
    for r in sums.filter("kind = 'class'").filter(known).collect():      # references x classes
        classes[r["lang"]][r["key"]] = r["n"]
    out = []
    for lang in sorted(words_of, key=lambda x: (x is None, x or "")):
        shares = [n for _, n in frequent[lang]]
        out.append((lang, np.array([classes[lang].get(c, 0) for c in CLASSES], float), [w for w, _ in frequent[lang]],
                    np.array(shares + [words_of[lang] - sum(shares)], float)))
    return out


class _Places(dict):
    """Word as written -> its place among the common words of all languages, or 0."""

    def __init__(self, places: dict[str, int]):
        super().__init__()
        self.places = places

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        at = self[word] = self.places.get(plain(word), 0)
        return at


class Judge:
    """Distances of a document to the nearest reference."""

    def __init__(self, refs: list[tuple]):
        self.refs = refs
        every = sorted({w for _, _, words, _ in refs for w in words})
        number = {w: i + 1 for i, w in enumerate(every)}
        self.places = _Places(number)
        self.most = len(every) + 1
        self.columns = [np.array([number[w] for w in words], dtype=np.int64) for _, _, words, _ in refs]

    def distances(self, text: str, n_words: int) -> tuple[float, float]:
        by_class = by_word = 0.0
        if self.refs and len(text) >= LEAST_CHARS:
            have = class_counts(text).astype(float)
            by_class = min(distance(have, ref[1]) for ref in self.refs)
        if self.refs and n_words >= LEAST_WORDS:
            at = np.fromiter(map(self.places.__getitem__, text.encode("utf-8", "surrogatepass").split()), np.int64, n_words)
            counts = np.bincount(at, minlength=self.most)
            by_word = 1.0
            for columns, ref in zip(self.columns, self.refs):
                have = np.append(counts[columns], 0.0)
                have[-1] = n_words - have.sum()
                by_word = min(by_word, distance(have, ref[3]))
        return by_class, by_word


def accepted(n_words: int, by_class: float, by_word: float) -> bool:
    return by_class <= CLASS_LIMIT and by_class + by_word <= SUM_LIMIT + NOISE / max(1, n_words)


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "class_distance double, word_distance double, base_failed boolean, kept boolean")


def judge(docs: DataFrame, refs: list[tuple] | None = None) -> DataFrame:
    """The columns of ``docs`` and those of ``SCHEMA`` (replacing columns of these
    names). ``refs``: from ``references`` (default: of these documents)."""
    refs = references(docs) if refs is None else refs
    added = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
    kept = [c for c in docs.columns if c not in added]

    def rows(batches):
        by = Judge(refs)
        for batch in pieces(batches, 2 << 20):
            out, texts = [], batch.column("text").to_pylist()
            for text, numbers in zip(texts, base(texts)):
                failed = base_failed(numbers[0], numbers[4])
                d = by.distances(text, numbers[0]) if text and not failed else (0.0, 0.0)
                out.append((*numbers, *d, failed, not failed and accepted(numbers[0], *d)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, t) for c, t in zip(zip(*out), types))],
                names=[*kept, *added])

    source = docs.select(*kept)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema] + [SCHEMA])
    return source.mapInArrow(rows, schema)


def apply(docs: DataFrame) -> DataFrame:
    """The documents kept, with their columns."""
    own = {c: f"_own_{c}" for c in docs.columns if c in {x.split()[0] for x in SCHEMA.split(", ")}}
    kept = judge(docs.withColumnsRenamed(own)).filter("kept")
    return kept.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    return (judge(docs.select("doc_id", "lang", "text"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "class_distance", "word_distance"))
