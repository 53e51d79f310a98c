"""Vector code compression: codebooks per part, nearest entries by Orchard search.

Vectors become whole numbers (``SCALE`` steps to one), are cut into ``PARTS``
equal parts, and each part position has a codebook of ``ENTRIES`` entries,
improved in ``ROUNDS`` rounds of assigning and averaging. A vector's code is the
entry of each part.

Orchard search finds the nearest entry: for every entry the others are listed by
their distance from it. A part starts at one entry and walks that entry's list;
an entry that is nearer becomes the current one and its list is walked from the
start, entries met before are marked and passed over, and the walk ends at an
entry more than twice as far from the current one as the part is, which no
nearer entry can be. All parts of a batch walk at the same time.

Every round is one pass over the vectors; a task gives the sums and counts of its
entries, which are added up in the shuffle. What the driver holds is the codebook.

Defined cases. Vectors that are NULL or hold NULL or non-finite components are
dropped, with their rows. Vectors shorter than the longest one, and a length that
``PARTS`` does not divide, are filled with zeros. Components beyond +-2**25 steps
are held there (a long cannot hold their squares). Fewer rows than ``ENTRIES``:
fewer entries. Rows that share a vec_id are vectors of their own, the lesser
vector first, NULL ids last. NULL labels count as one label. Empty table: empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 25
CELLS = 1 << 20             # components worked on at a time

Books = np.ndarray          # parts x entries x components


def steps(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers, rounded down."""
    return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared, along the last axis."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def neighbours(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the others by distance (ties to the lower index), and the least
    squared distance of a part from it at which the walk goes past each of them."""
    far = distances(book[:, None], book[None])
    np.fill_diagonal(far, -1)                   # itself first, then cut off
    near = np.argsort(far, axis=1, kind="stable")[:, 1:]
    return near, -(-np.take_along_axis(far, near, 1) // 4)


def orchard(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point (ties to the lower index) and its squared distance."""
    n, k = len(points), len(book)
    near, reach = neighbours(book)
    best, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
    dist = distances(points, book[0])
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    live = np.arange(n) if k > 1 else np.empty(0, np.int64)
    while len(live):
        live = live[at[live] < k - 1]
        live = live[reach[best[live], at[live]] <= dist[live]]      # beyond twice the distance: done
        entry = near[best[live], at[live]]
        at[live] += 1
        new = ~seen[live, entry]
        who, entry = live[new], entry[new]
        seen[who, entry] = True
        d = distances(points[who], book[entry])
        nearer = (d < dist[who]) | ((d == dist[who]) & (entry < best[who]))
        who, entry = who[nearer], entry[nearer]
        best[who], dist[who], at[who] = entry, d[nearer], 0
    return best, dist


def _kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding of the rows that count."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").filter(whole)


def _blocks(batches, width: int):
    """Arrow batches in slices of a bounded size, with their parts (rows x parts x components)."""
    per = width // PARTS
    for batch in batches:
        for start in range(0, batch.num_rows, max(1, CELLS // max(1, width))):
            piece = batch.slice(start, max(1, CELLS // max(1, width)))
            lists = piece.column("embedding")
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            values = steps(lists.flatten().to_numpy())
            if len(values) == len(sizes) * width:
                whole = values.reshape(len(sizes), width)
            else:
                whole = np.zeros((len(sizes), width), np.int64)
                whole[np.arange(width)[None] < sizes[:, None]] = values
            yield piece, whole.reshape(len(sizes), PARTS, per)


def start_books(kept: DataFrame, width: int) -> Books:
    """The parts of the first vectors by id."""
    rows = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).select("embedding").collect()
    whole = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        whole[i, :len(r[0])] = steps(np.array(r[0], np.float64))
    return whole.reshape(len(rows), PARTS, width // PARTS).transpose(1, 0, 2).copy()


def improved(kept: DataFrame, books: Books) -> Books:
    """Each entry becomes the mean of its parts, rounded down; unused ones stay."""
    held = kept.sparkSession.sparkContext.broadcast(books)
    n_parts, k, per = books.shape

    def rows(batches):
        book = held.value
        total, count = np.zeros(book.shape, np.int64), np.zeros((n_parts, k), np.int64)
        for _, parts in _blocks(batches, n_parts * per):
            for p in range(n_parts):
                entry, _ = orchard(parts[:, p], book[p])
                np.add.at(total[p], entry, parts[:, p])
                count[p] += np.bincount(entry, minlength=k)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"])

    found = (kept.select("embedding").mapInArrow(rows, "part long, entry long, n long, total array<bigint>")
             .select("part", "entry", "n", F.posexplode("total").alias("pos", "total"))
             .groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out = books.copy()
    for r in found:
        out[r.part, r.entry, r.pos] = r.total // r.n
    return out


def encoded(kept: DataFrame, books: Books) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    held = kept.sparkSession.sparkContext.broadcast(books)
    label = kept.schema["label"].dataType.simpleString()
    n_parts, _, per = books.shape

    def rows(batches):
        book = held.value
        for piece, parts in _blocks(batches, n_parts * per):
            found = [orchard(parts[:, p], book[p]) for p in range(n_parts)]
            codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [piece.column("vec_id"), piece.column("label"), pa.array([bytes(c).hex() for c in codes], pa.string()),
                 pa.array(sum(d for _, d in found), pa.int64())], names=["vec_id", "label", "code", "error"])

    return kept.mapInArrow(rows, f"vec_id long, label {label}, code string, error long")


def digest(books: Books) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def train(kept: DataFrame, rounds: int = ROUNDS) -> Books:
    """Codebooks of the vectors; without any, no entries."""
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    books = start_books(kept, -(-max(longest, 1) // PARTS) * PARTS)
    for _ in range(rounds if books.shape[1] else 0):
        books = improved(kept, books)
    return books


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that counts."""
    kept = _kept(vectors)
    books = train(kept)
    if not books.shape[1]:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit(digest(books)).alias("codebooks_sha256"))
    codes = materialize(encoded(kept, books), "codes")
    errors = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (codes.join(errors, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
