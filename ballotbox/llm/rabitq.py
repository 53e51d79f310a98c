"""Near-duplicate embeddings by randomised-rotation binary codes.

Vectors of one label are compared by cosine. Candidates meet in buckets of
several hash tables (signs of random projections): the number of bits follows
the size of the largest label, the number of tables from the wanted recall at
the threshold. In a bucket each vector has a binary code, the signs of its
randomly rotated unit vector, and a stored correction factor, the inner product
of the vector with its code. Code times query, divided by that factor, is an
unbiased estimate of the cosine, and the factor gives a confidence bound of its
error (``SIGMAS`` wide). Only pairs whose upper bound reaches the threshold are
computed exactly, in double precision, and only those decide. A pair that meets
in several tables counts in the first.

What goes to the buckets of all tables is small: a bit a dimension for the code, its
factor, and the rotated vector in four bits a dimension, as it is needed where the
vector is the query. There the bound, with the rounding added to it, says which
vectors have an open pair at all, seen from either side. Only these vectors travel
to their bucket as a whole.

Equal vectors of a label are one class with a weight, known by 96 bits of hashes. A
large bucket is cut into blocks that meet pairwise, two blocks to a task at a time; a
block gives counts and a spanning forest, never its pairs.

Defined cases. NULL label, NULL or empty vector, a zero vector or one with NULL
or non-finite components: no links. Vectors of different lengths do not link.
NULL vec_id: no links, NULL component, not kept. Repeated rows count each other
as links. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize
from ballotbox.llm.components import components

THRESHOLD = 0.98
SIGMAS = 4.0
RECALL = 0.99       # at the threshold; higher above it
BUCKET = 64         # vectors a bucket of the largest label aims at
BLOCK = 1024


def shape(largest: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits and tables for a largest label of this many vectors."""
    bits = max(1, min(48, math.ceil(math.log2(max(2, largest / BUCKET)))))
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def coded(unit: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit vectors, their codes (+-1/sqrt(dim)) and correction factors."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, seed).T
    codes = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(dim)
    return turned, codes, np.einsum("ij,ij->i", turned, codes)


def estimated(turned: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the cosines (rows: queries, columns: codes) and their error bounds."""
    estimate = (turned.astype(np.float32) @ codes.T.astype(np.float32)) / factors
    spread = np.sqrt(np.maximum(0.0, 1 - factors ** 2)) / factors / math.sqrt(max(1, codes.shape[1] - 1))
    return estimate, SIGMAS * spread + 1e-5


LEVELS = 15         # a component of a rotated vector is one of so many steps, and 0


def packed(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors in four bits a component (two to a byte), with their least value and step."""
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / LEVELS, 1e-12)
    q = np.clip(np.rint((turned - low[:, None]) / step[:, None]), 0, LEVELS).astype(np.uint8)
    if q.shape[1] % 2:
        q = np.pad(q, ((0, 0), (0, 1)))
    return q[:, 0::2] << 4 | q[:, 1::2], low, step


def unpacked(q: np.ndarray, low: np.ndarray, step: np.ndarray, dim: int) -> np.ndarray:
    out = np.empty((len(q), 2 * q.shape[1]), np.float32)
    out[:, 0::2], out[:, 1::2] = q >> 4, q & 15
    return out[:, :dim] * step[:, None].astype(np.float32) + low[:, None].astype(np.float32)


def has_open_pair(turned: np.ndarray, step: np.ndarray, codes: np.ndarray, factors: np.ndarray, half: int, threshold: float) -> np.ndarray:
    """Which vectors of a block have a pair that either's bound leaves open."""
    n, dim = codes.shape
    # of the estimate, and of the rounded query
    spread = np.maximum(0.0, 1 - factors ** 2) / max(1, dim - 1)
    out, rows = np.zeros(n, bool), half or n
    for start in range(0, rows, 256):
        one, rest = slice(start, min(rows, start + 256)), slice(half or start, n)

        def upper(queries: slice, data: slice) -> np.ndarray:
            estimate = (turned[queries] @ codes[data].T) / factors[data]
            error = np.sqrt(spread[data] + (step[queries] ** 2 / 12)[:, None]) / factors[data]
            return estimate + SIGMAS * error + 1e-4

        open_ = (upper(one, rest) >= threshold) & (upper(rest, one).T >= threshold)
        i, j = np.nonzero(open_)
        i, j = i + one.start, j + rest.start
        out[i[i != j]] = out[j[i != j]] = True
    return out


def linked(vectors: np.ndarray, tables: np.ndarray, table: int, half: int, threshold: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j) of a block, i < j, that meet in ``table`` first; with
    ``half``, only pairs of the first ``half`` rows with the others."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    turned, codes, factors = coded(vectors / norms[:, None], seed)
    first, second = [], []
    rows = half or len(vectors)
    for start in range(0, rows, 256):
        stop = min(rows, start + 256)
        after = half or start
        estimate, error = estimated(turned[start:stop], codes[after:], factors[after:])
        i, j = np.nonzero(estimate + error >= threshold)
        i, j = i + start, j + after
        keep = i < j
        i, j = i[keep], j[keep]
        for t in range(table):
            keep = tables[i, t] != tables[j, t]
            i, j = i[keep], j[keep]
        for part in range(0, len(i), 1 << 16):
            a, b = i[part:part + (1 << 16)], j[part:part + (1 << 16)]
            exact = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b])
            first.append(a[exact >= threshold])
            second.append(b[exact >= threshold])
    return (np.concatenate(first), np.concatenate(second)) if first else (np.empty(0, int), np.empty(0, int))


def roots(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Least id of each row's component."""
    label = ids.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        if (label == before).all():
            return label


def dedup(rows: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 7) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
              & F.exists("embedding", lambda x: x != 0))
    same = ["label", "dim", "h1", "h2"]
    good = rows.filter(usable).select("vec_id", "label", F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("h1"),
                                      F.hash("embedding").alias("h2"), "embedding")
    classes = materialize(good.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"),
                                                  F.first("embedding").alias("embedding")), "rabitq-classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, n_tables = shape(largest, threshold, recall)

    def codes(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in map(int, np.unique(dims)):
                at = np.flatnonzero(dims == dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed + 1, dim]).normal(size=(dim, bits * n_tables))
                v = batch.column("embedding").take(pa.array(at)).flatten().to_numpy().astype(np.float64).reshape(len(at), dim)
                signs = (v @ planes[dim] >= 0).reshape(len(at), n_tables, bits)
                turned, _, factors = coded(v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None], seed)
                q, low, step = packed(turned)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(at)) for c in ("label", "dim", "rep")]
                    + [pa.array(list(map(bytes, np.packbits(turned >= 0, axis=1))), pa.binary()), pa.array(factors, pa.float32()),
                       pa.array(list(map(bytes, q)), pa.binary()), pa.array(low, pa.float32()), pa.array(step, pa.float32()),
                       pa.array(list(signs @ (1 << np.arange(bits, dtype=np.int64))), pa.list_(pa.int64()))],
                    names=["label", "dim", "rep", "code", "factor", "q", "low", "step", "tables"])

    label_type = rows.schema["label"].dataType.simpleString()
    hashed = materialize(classes.select("label", "dim", "rep", "embedding").mapInArrow(
        codes, f"label {label_type}, dim int, rep long, code binary, factor float, q binary, low float, step float, "
               "tables array<bigint>"), "rabitq-codes")
    at = ["label", "dim", "t", "bucket"]
    places = hashed.select("label", "dim", "rep", "code", "factor", "q", "low", "step", F.posexplode("tables").alias("t", "bucket"))
    large = places.groupBy(*at).agg(F.count("*").alias("held")).filter(F.col("held") > BLOCK)
    blocks = (places.join(large, at, "left").withColumn("n", F.coalesce(F.ceil(F.col("held") / BLOCK), F.lit(1)).cast("int"))
              .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
              .select(*at, F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q_"), "own", "rep", "code", "factor",
                      "q", "low", "step"))
    group = [*at, "p", "q_"]

    def in_blocks(done):
        """``done`` of each block (or pair of blocks): a table ordered by ``own``, and how many
        rows are of the first of two blocks."""
        def run(batches):
            held, name = [], None

            def one(parts):
                table = pa.Table.from_batches(parts)
                own, p, q = (table.column(c).to_numpy() for c in ("own", "p", "q_"))
                half = int((own == p[0]).sum()) if p[0] != q[0] else 0
                if len(own) < 2 or half == len(own) or p[0] != q[0] and not half:
                    return None
                return done(table.take(pa.array(np.argsort(own, kind="stable"))), half)

            for batch in batches:
                keys = list(zip(*(batch.column(c).to_pylist() for c in group)))
                start = 0
                while start < len(keys):
                    stop = start
                    while stop < len(keys) and keys[stop] == keys[start]:
                        stop += 1
                    if held and name != keys[start]:
                        if (out := one(held)) is not None:
                            yield out
                        held = []
                    name = keys[start]
                    held.append(batch.slice(start, stop - start))
                    start = stop
            if held and (out := one(held)) is not None:
                yield out
        return run

    def bound(table, half):
        dim = table.column("dim")[0].as_py()

        def raw(name):
            return np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint8).reshape(table.num_rows, -1)

        low, step, factors = (table.column(c).to_numpy() for c in ("low", "step", "factor"))
        signs = (np.unpackbits(raw("code"), axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(math.sqrt(dim))
        some = np.flatnonzero(has_open_pair(unpacked(raw("q"), low, step, dim), step, signs, factors, half, threshold))
        return table.select([*group, "own", "rep"]).take(pa.array(some)).combine_chunks().to_batches()[0] if len(some) else None

    def exact(table, half):
        """Counts and forest of the links."""
        ids, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        vectors, tables = (np.array(table.column(c).to_pylist()) for c in ("embedding", "tables"))
        i, j = linked(vectors.astype(np.float64), tables, int(table.column("t")[0].as_py()), half, threshold, seed)
        if not len(i):
            return None
        n = len(ids)
        count = np.bincount(i, weight[j], n) + np.bincount(j, weight[i], n)
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(count[some].astype(np.int64)),
                                           pa.array(roots(n, i, j, ids)[some])], names=["rep", "n", "root"])

    open_ = materialize(blocks.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        in_blocks(bound), f"label {label_type}, dim int, t int, bucket long, p int, q_ int, own int, rep long"), "rabitq-open", 4)
    whole = open_.join(classes.select("rep", "weight", "embedding"), "rep").join(hashed.select("rep", "tables"), "rep")
    found = materialize(whole.repartition(*group).sortWithinPartitions(*group)
                        .mapInArrow(in_blocks(exact), "rep long, n long, root long"), "rabitq-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    tree = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    by_class = (classes.drop("embedding").join(counts, "rep", "left").join(tree, F.col("rep") == F.col("node"), "left")
                .select(*same, "rep", "weight", "n", "component"))
    joined = good.drop("embedding").join(by_class, same)
    links = F.coalesce("n", F.lit(0)) + F.col("weight") - 1
    component = F.coalesce("component", "rep")
    return (joined.select("vec_id", links.alias("n_links"), component.alias("component_id"),
                          (F.col("vec_id") == component).alias("kept"))
            .union(rows.filter(~F.coalesce(usable, F.lit(False))).select(
                "vec_id", F.lit(0).cast("long"), "vec_id", F.col("vec_id").isNotNull())))
