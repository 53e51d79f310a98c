"""Exact removal of repeated long strings, with a logarithmic index family.

A string of ``LENGTH`` bytes (a window) that starts in two places has in both
the same least hash among its substrings of ``GRAM`` bytes, at the same offset.
That substring is the window's anchor. So only suffixes that start at anchors
are indexed, one in about 85 bytes, and windows need comparing only where they
share an anchor. The sampled suffixes are ordered by the hash of their first
``GRAM`` bytes (any order serves: only equal beginnings are looked for).

1. New batches of documents get a sorted suffix array and are merge-scanned
   against the levels that exist; anchors met before, or twice in the batch,
   are matches. Levels of equal size merge with the batch in the same pass, so
   there are at most log2(batches) levels and an entry is rewritten as often.
2. The windows of one anchor at one place are a run; the run's whole text, its
   context, has a hash. A context met twice settles all its windows. Where an
   anchor has several contexts and one of them is met once, one example of each
   goes to the anchor's group, and the windows of the contexts are compared
   there. Groups of more than ``CONTEXTS`` contexts are compared as rows of
   window hashes instead, which no single task gathers.
3. Documents that have no open context are finished where their text is first
   met with its matches; the texts of the others travel once more.

All comparisons are on 64-bit polynomial hashes. A row is known by the hash of
its doc_id and text.

Defined cases. NULL text: as empty. Texts shorter than a window: nothing
removed. NULL doc_id: kept as NULL. Equal rows are different documents, so their
windows are repeated. Empty table: empty result. Very long texts are read whole,
in overlapping parts. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox.llm.common import keep, materialize, pieces

LENGTH, GRAM = 200, 40
BATCHES = 4
CONTEXTS = 4_000
SHARE = 3                   # what is written is a small part of the bytes it stands for
PART = 1 << 20              # bytes of a long text worked on at a time

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, 1 << 16)
            inverse = pow(_MULTIPLIER, -1, 1 << 64)
            for name, base in (("up", _MULTIPLIER), ("down", inverse)):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_powers = _Powers()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sums(b: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any substring follows."""
    _powers.to(len(b) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _powers.up[:len(b)], dtype=np.uint64)])


def hashes(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return _mix((prefix[stop] - prefix[start]) * _powers.down[start])


def windows(b: np.ndarray) -> np.ndarray:
    """Hash of every window."""
    if len(b) < LENGTH:
        return np.empty(0, np.uint64)
    upto = sums(b)
    return _mix((upto[LENGTH:] - upto[:-LENGTH]) * _powers.down[:len(b) - LENGTH + 1])


def _leftmost_least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in every window of ``width`` values."""
    value, place, size = h, np.arange(len(h), dtype=np.int64), 1
    n = len(h) - width + 1

    def join(va, pa_, vb, pb):
        right = vb < va
        return np.where(right, vb, va), np.where(right, pb, pa_)

    while size * 2 <= width:
        value, place = join(value[:-size], place[:-size], value[size:], place[size:])
        size *= 2
    rest = width - size
    return join(value[:n], place[:n], value[rest:rest + n], place[rest:rest + n])[1]


def runs(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, context hash, first and last window start of every run."""
    out = []
    for at in range(0, max(0, len(b) - LENGTH + 1), PART):
        part = b[at:at + PART + LENGTH - 1]
        if len(part) < LENGTH:
            break
        upto = sums(part)
        grams = _mix((upto[GRAM:] - upto[:-GRAM]) * _powers.down[:len(part) - GRAM + 1])
        place = _leftmost_least(grams, LENGTH - GRAM + 1)
        cut = np.flatnonzero(place[1:] != place[:-1]) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]]) - 1
        out.append((grams[place[first]], hashes(upto, first, last + LENGTH), first + at, last + at))
    if not out:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    return tuple(np.concatenate(c) for c in zip(*out))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class Levels:
    """The index family: sorted suffix arrays whose sizes double."""

    def __init__(self):
        self.levels: dict[int, DataFrame] = {}      # log2 of the batches in it -> (anchor, n)

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds the anchors (anchor, n) of a batch; returns those of the batch that
        are repeated in it or met in a level."""
        rank, merged = 0, []
        while rank in self.levels:
            merged.append(self.levels.pop(rank))
            rank += 1
        rows = batch.select("anchor", F.col("n").alias("fresh"), F.lit(0).cast("long").alias("old"), F.lit(0).cast("long").alias("kept"))
        for level in merged:
            rows = rows.union(level.select("anchor", F.lit(0).cast("long"), "n", "n"))
        for level in self.levels.values():
            rows = rows.union(level.select("anchor", F.lit(0).cast("long"), "n", F.lit(0).cast("long")))
        scanned = (rows.groupBy("anchor").agg(F.sum("fresh").alias("fresh"), F.sum("old").alias("old"), F.sum("kept").alias("kept"))
                   .filter("fresh > 0 OR kept > 0")
                   .select("anchor", (F.col("fresh") + F.col("kept")).alias("n"),
                           ((F.col("fresh") > 0) & (F.col("fresh") + F.col("old") > 1)).alias("match"))
                   .sortWithinPartitions("anchor"))
        level = materialize(scanned, f"suffix-level-{rank}", SHARE)
        self.levels[rank] = level.select("anchor", "n")
        return level.filter("match").select("anchor")


def _anchors(docs: DataFrame) -> DataFrame:
    names = ["anchor", "context", "row", "n"]

    def rows(batches):
        for batch in pieces(batches, 2 << 20):
            out = []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                anchor, context, _, _ = runs(np.frombuffer(_bytes(text), np.uint8))
                if len(anchor):
                    both, n = np.unique(np.stack([anchor, context], 1), axis=0, return_counts=True) if len(np.unique(anchor)) < len(anchor) \
                        else (np.stack([anchor, context], 1), np.ones(len(anchor), np.int64))
                    out.append((both, np.full(len(both), row, np.int64), n))
            if out:
                both, row, n = (np.concatenate(c) for c in zip(*out))
                both = both.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(row),
                                                  pa.array(n.astype(np.int64))], names=names)

    return docs.mapInArrow(rows, "anchor long, context long, row long, n long")


def _kept(b: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Bytes removed, maximal removed runs, digest of what is left."""
    out, removed, n, at = hashlib.sha256(), 0, 0, 0
    for start, stop in spans:
        out.update(b[at:start])
        removed, n, at = removed + stop - start, n + 1, stop
    out.update(b[at:])
    return removed, n, out.hexdigest()


def _union(spans) -> list[tuple[int, int]]:
    """Maximal runs of bytes under any span."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


DONE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_STAGE = DONE + (", row long, text string, settled array<struct<a:bigint,b:bigint>>, "
                 "contexts array<struct<anchor:bigint,context:bigint,open:boolean,at:bigint,bytes:binary>>")


def _settle(docs: DataFrame) -> DataFrame:
    """Finishes documents without open contexts; the others keep their text."""
    span = pa.struct([("a", pa.int64()), ("b", pa.int64())])
    context = pa.struct([("anchor", pa.int64()), ("context", pa.int64()), ("open", pa.bool_()), ("at", pa.int64()), ("bytes", pa.binary())])
    types = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.string(), pa.list_(span), pa.list_(context)]
    names = [c.split()[0] for c in DONE.split(", ")] + ["row", "text", "settled", "contexts"]

    def rows(batches):
        for batch in pieces(batches, 1 << 20):
            out = []
            for doc_id, row, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text", "found"))):
                b = _bytes(text)
                if not found:
                    out.append((doc_id, len(b), *_kept(b, []), row, None, None, None))
                    continue
                state = {(f["anchor"], f["context"]): f for f in found}
                spans, sent, is_open = [], {}, False
                anchor, whole, first, last = runs(np.frombuffer(b, np.uint8))
                for key, s, e in zip(zip(anchor.view(np.int64).tolist(), whole.view(np.int64).tolist()), first.tolist(), last.tolist()):
                    f = state.get(key)
                    if f is None:
                        continue
                    if f["settled"]:
                        spans.append((s, e + LENGTH))
                    is_open |= not f["settled"]
                    if f["example"] and key not in sent:
                        sent[key] = {"anchor": key[0], "context": key[1], "open": not f["settled"], "at": s, "bytes": b[s:e + LENGTH]}
                spans = _union(spans)
                if is_open:
                    out.append((doc_id, len(b), 0, 0, None, row, text, [{"a": x, "b": y} for x, y in spans], list(sent.values())))
                else:
                    out.append((doc_id, len(b), *_kept(b, spans), row, None, None, list(sent.values())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return docs.mapInArrow(rows, _STAGE)


def _compared(contexts: DataFrame) -> DataFrame:
    """row, a, b: spans of open contexts that are repeated in their anchor's group."""
    def whole(rows_: list[tuple]) -> list[tuple]:
        hashes = [windows(np.frombuffer(r[-1], np.uint8)) for r in rows_]
        _, which, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        again, out, start = times[which] > 1, [], 0
        for (row, is_open, at, _), h in zip(rows_, hashes):
            if is_open:
                hit = np.flatnonzero(again[start:start + len(h)])
                if len(hit):
                    gap = np.flatnonzero(np.diff(hit) > 1) + 1
                    out += [(row, at + int(x[0]), at + int(x[-1]) + LENGTH) for x in np.split(hit, gap)]
            start += len(h)
        return out

    def compare(batches):
        name, held = None, []
        for batch in batches:
            out = []
            for anchor, *rest in zip(*(batch.column(c).to_pylist() for c in ("anchor", "row", "open", "at", "bytes"))):
                if anchor != name:
                    if len(held) > 1:
                        out += whole(held)
                    name, held = anchor, []
                held.append(rest)
            if out:
                yield spans(out)
        if len(held) > 1 and (out := whole(held)):
            yield spans(out)

    def spans(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["row", "a", "b"])

    def exploded(batches):
        for batch in batches:
            for row, is_open, at, b in zip(*(batch.column(c).to_pylist() for c in ("row", "open", "at", "bytes"))):
                h = windows(np.frombuffer(b, np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), row)), pa.array([is_open] * len(h)),
                                                  pa.array(at + np.arange(len(h)))], names=["h", "row", "open", "at"])

    sizes = contexts.groupBy("anchor").agg(F.count("*").alias("held")).filter("held > 1")
    sized = contexts.join(sizes, "anchor")
    columns = ("anchor", "row", "open", "at", "bytes")
    near = (sized.filter(F.col("held") <= CONTEXTS).select(*columns).repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(compare, "row long, a long, b long"))
    hot = sized.filter(F.col("held") > CONTEXTS).select(*columns[1:]).mapInArrow(exploded, "h long, row long, open boolean, at long")
    hot = keep(hot)
    again = hot.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    far = hot.filter("open").join(again, "h").select("row", F.col("at").alias("a"), (F.col("at") + LENGTH).alias("b"))
    return near.union(far)


def dedup(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("row", F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), "text"))
    anchors = materialize(_anchors(docs.select("row", "text")), "suffix-anchors")

    family, repeated = Levels(), None
    for i in range(batches):
        found = family.add(anchors.filter(F.pmod("row", F.lit(batches)) == i).select("anchor", "n"))
        repeated = found if repeated is None else repeated.union(found)
    matched = materialize(anchors.join(repeated.distinct(), "anchor"), "suffix-matches", SHARE)

    by_context = matched.groupBy("anchor", "context").agg(F.sum("n").alias("places"), F.min("row").alias("example"))
    mixed = (by_context.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("places").alias("least"))
             .select("anchor", ((F.col("kinds") > 1) & (F.col("least") == 1)).alias("mixed")))
    state = (by_context.join(mixed, "anchor").select("anchor", "context", (F.col("places") > 1).alias("settled"), "example", "mixed")
             .filter("settled OR mixed"))
    lists = (matched.join(state, ["anchor", "context"])
             .groupBy("row").agg(F.collect_set(F.struct("anchor", "context", "settled", (F.col("mixed") & (F.col("row") == F.col("example")))
                                                        .alias("example"))).alias("found")))
    stage = materialize(_settle(docs.join(lists, "row", "left")), "suffix-stage", SHARE)

    contexts = stage.select("row", F.explode("contexts").alias("c")).select("row", "c.*").dropDuplicates(["anchor", "context"])
    later = _compared(contexts).groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("more"))
    waiting = (stage.filter("text IS NOT NULL").select("doc_id", "row", "text", "settled").join(later, "row", "left"))

    def finish(batches_):
        names = [c.split()[0] for c in DONE.split(", ")]
        types = [pa.int64()] * 4 + [pa.string()]
        for batch in pieces(batches_):
            out = []
            for doc_id, text, settled, more in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "settled", "more"))):
                b = _bytes(text)
                out.append((doc_id, len(b), *_kept(b, _union([(x["a"], x["b"]) for x in (settled or []) + (more or [])]))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    done = [c.split()[0] for c in DONE.split(", ")]
    return stage.filter("text IS NULL").select(*done).union(waiting.mapInArrow(finish, DONE))
