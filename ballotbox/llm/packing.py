"""Best-fit packing of documents into sequences, improved by swaps.

A document's ids (with the end id) are cut into pieces of ``capacity`` from the
end, so only the first piece may be shorter. Which pieces share a sequence
depends on their lengths alone, so the packing works on the histogram of
lengths: ``capacity`` counts at most, however many documents there are. A bin
kind is a multiset of lengths with the number of bins of that kind.

1. ``best_fit``: lengths from long to short go to the fullest kind of bin they
   fit, a whole count at a time.
2. ``improve``: local search between underfull kinds. A document moves, one is
   exchanged for one, or two for one, whenever that raises the sum of squared
   fills; the emptiest kind is worked on first, until it is empty. The search
   ends at the lower bound or when nothing improves.

Pieces then take the places: they are numbered within their length by a running
count over hash buckets (a length that a third of all rows share is split, and so
are rows that are equal in all), and
the number says which bin of which kind.

Defined cases. NULL or empty text: the end id alone, one piece of length 1.
NULL doc_id: kept as NULL. Repeated rows: each is packed. Empty table: empty
result. Other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize, pieces as batch_pieces
from ballotbox.llm.tokens import encoder

ROWS_PER_BUCKET = 200_000

Kinds = dict[tuple[int, ...], int]      # lengths of a bin, long to short -> number of such bins


def cut(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:len(names)]

    def rows(batches):
        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batch_pieces(batches, 2 << 20):
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text").to_pylist())):
                ids = enc.ids(ids) + end
                n = len(ids) // 4
                start, stop, i = 0, n % capacity or capacity, 0
                while start < n:
                    part = ids[4 * start:4 * stop]
                    out.append((doc_id, i, start, stop - start, zlib.crc32(part), part)[:len(names)])
                    start, stop, i = stop, stop + capacity, i + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, schema)


def best_fit(counts: dict[int, int], capacity: int) -> Kinds:
    """Best-fit decreasing on counts of lengths."""
    by_room: dict[int, Counter] = {}
    rooms: list[int] = []                           # sorted, those with bins

    def put(kind: tuple[int, ...], n: int) -> None:
        room = capacity - sum(kind)
        if not by_room.get(room):
            bisect.insort(rooms, room)
            by_room[room] = Counter()
        by_room[room][kind] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put((length,) * each, full)
                if rest:
                    put((length,) * rest, 1)
                break
            room = rooms[at]
            kind, n = next(iter(by_room[room].items()))
            take = min(n, left)
            by_room[room][kind] -= take
            if not by_room[room][kind]:
                del by_room[room][kind]
            if not by_room[room]:
                rooms.pop(at)
            put(kind + (length,), take)
            left -= take
    out: Kinds = Counter()
    for kinds in by_room.values():
        out.update(kinds)
    return out


def _parts(kind: tuple[int, ...]) -> list[tuple[int, tuple[int, ...]]]:
    """The distinct choices of up to two documents of a bin, with their sums."""
    seen = Counter(kind)
    out: list[tuple[int, ...]] = [(), *((x,) for x in seen)]
    out += [(x, y) for x in seen for y in seen if x > y or (x == y and seen[x] > 1)]
    return sorted((sum(p), p) for p in out)


def _swapped(kind: tuple[int, ...], out: tuple[int, ...], into: tuple[int, ...]) -> tuple[int, ...]:
    rest = Counter(kind)
    rest.subtract(out)
    rest.update(into)
    return tuple(sorted(rest.elements(), reverse=True))


class _Search:
    """Underfull kinds by room, and for each kind that found no exchange the time up to
    which it looked: only kinds that came (or became two) since can change that."""

    def __init__(self, kinds: Kinds, capacity: int):
        self.capacity, self.clock = capacity, 0
        self.kinds: Counter = Counter()
        self.open: list[tuple[int, tuple[int, ...]]] = []       # (fill, kind), sorted
        self.since: dict[tuple[int, ...], int] = {}
        self.looked: dict[tuple[int, ...], int] = {}
        self.parts: dict[tuple[int, ...], list] = {}
        for kind, n in kinds.items():
            self.add(kind, n)

    def add(self, kind: tuple[int, ...], n: int) -> None:
        if not kind or not n:
            return
        before = self.kinds[kind]
        self.kinds[kind] += n
        if sum(kind) == self.capacity:
            return
        if before + n < 1:
            del self.kinds[kind]
            self.open.pop(bisect.bisect_left(self.open, (sum(kind), kind)))
            for table in (self.since, self.looked, self.parts):
                table.pop(kind, None)
        elif n > 0 and before < 2:
            if not before:
                bisect.insort(self.open, (sum(kind), kind))
                self.parts[kind] = _parts(kind)
            self.clock += 1
            self.since[kind] = self.clock
            if before:
                self.looked.pop(kind, None)         # a second one of its own kind

    def exchange(self, low: tuple[int, ...]) -> tuple | None:
        """(gain, fuller kind, what goes to it, what comes back) of the exchange that
        moves most from ``low``; of equal ones that with the fullest kind."""
        done, best = self.looked.get(low, 0), None
        gives = [[(s, p) for s, p in self.parts[low] if len(p) <= most] for most in (1, 2)]
        sums = [[s for s, _ in g] for g in gives]
        for fill, high in self.open[bisect.bisect_left(self.open, (sum(low), ())):]:
            room = self.capacity - fill
            if best is not None and room < best[0]:
                break                               # no fuller kind can take as much
            if self.since[high] <= done or high == low and self.kinds[low] < 2:
                continue
            for back, part in self.parts[high]:
                which = 0 if len(part) == 2 else 1              # three documents at most change places
                at = bisect.bisect_right(sums[which], back + room) - 1
                gain = sums[which][at] - back if at >= 0 else 0
                if gain > 0 and (best is None or gain >= best[0]):
                    best = (gain, high, gives[which][at][1], part)
        if best is None:
            self.looked[low] = self.clock
        return best


def improve(kinds: Kinds, capacity: int) -> Kinds:
    """Swap-based local search; never more bins than before. Ends at the least number
    of bins that could hold all, or where no exchange raises the sum of squares (every
    exchange does, so there is an end)."""
    total = sum(sum(k) * n for k, n in kinds.items())
    least = -(-total // capacity)
    search = _Search(Counter({tuple(sorted(k, reverse=True)): n for k, n in kinds.items()}), capacity)
    bins = sum(search.kinds.values())
    while bins > least:
        found = None
        for _, low in search.open:
            if search.looked.get(low) == search.clock:
                continue
            found = search.exchange(low)
            if found is not None:
                break
        if found is None:
            break
        _, high, give, back = found
        n = search.kinds[low] // 2 if high == low else min(search.kinds[low], search.kinds[high])
        search.add(low, -n)
        search.add(high, -n)
        left = _swapped(low, give, back)
        search.add(left, n)
        search.add(_swapped(high, back, give), n)
        bins -= 0 if left else n
    return search.kinds


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``rank``: 0, 1, ... within ``group``, counted over hash buckets."""
    n = rows.count()
    buckets = max(32, -(-n // ROWS_PER_BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = rows.groupBy(group, "bucket").agg(F.count("*").alias("in_bucket"))
    upto = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "bucket", F.coalesce(F.sum("in_bucket").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy(group, "bucket").orderBy(*order)
    return (rows.withColumn("inside", F.row_number().over(inside)).join(starts, [group, "bucket"])
            .withColumn("rank", F.col("base") + F.col("inside") - 1).drop("bucket", "inside", "base"))


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids with ``keep_ids``)."""
    dealt = cut(docs, vocabulary, capacity, end_id, keep_ids).withColumn("deal", F.monotonically_increasing_id() % ROWS_PER_BUCKET)
    cuts = materialize(dealt, "packing-pieces")
    counts = {r["length"]: r["count"] for r in cuts.groupBy("length").count().collect()}    # capacity rows at most
    kinds = improve(best_fit(counts, capacity), capacity)

    # places: for each length, ranks from lo on fill `bins` bins from `first` at `offset`
    places, taken, first = [], Counter(), 0
    for kind, bins in sorted(kinds.items(), reverse=True):
        offset = 0
        for length in kind:
            places.append((length, taken[length], bins, first, offset))
            taken[length] += bins
            offset += length
        first += bins
    places.sort()
    table = np.array(places, dtype=np.int64).reshape(-1, 5)

    columns = [c for c in cuts.columns if c != "deal"]

    def placed(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            lo, hi = (np.searchsorted(table[:, 0], length, side) for side in ("left", "right"))
            while (mid := (lo + hi) // 2).size and (hi - lo > 1).any():     # last place whose lo <= rank
                up = (hi - lo > 1) & (table[mid, 1] <= rank)
                hi = np.where((hi - lo > 1) & ~up, mid, hi)
                lo = np.where(up, mid, lo)
            t = table[lo]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(t[:, 3] + rank - t[:, 1]), pa.array(t[:, 4])],
                names=[*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cuts.select(*columns).schema) + ", sequence_id long, offset long"
    return numbered(cuts, "length", ["doc_id", "piece", "ids_crc32", "deal"]).select(*columns, "rank").mapInArrow(placed, schema)
