"""Ordered per-key logic that does not put a whole key into one task.

``lag`` or a running count over ``Window.partitionBy(key)`` sends every row of
a key to one task. A probe log has few keys (file type x cycle), and one key
may hold a third of all rows, so that plan serialises the job. Here the rows are
dealt into pieces by range of (key, order), which splits by number of rows: a
burst within a second, or equal times with different ids, is split like
anything else. Then

1. each task walks its sorted piece once, in Arrow batches, and adds the
   previous row's values, the running count or the row's number in the piece;
2. the rows are written below the shared scratch folder with their piece, so
   the one exchange of the log is not run again for what follows;
3. one row per piece (its last key, its last values, its counts) says what
   crosses to the pieces after it; a window over that table, which is as long
   as there are pieces, carries it on, and a broadcast of it (at most
   ``pieces`` rows) brings it to the rows concerned.

The result equals the plain per-key window. Keys may be NULL.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballotbox.session import scratch_path

_KEY, _PIECE, _HEAD, _AT = "_key", "_piece", "_head", "_at"


def _pieces(df: DataFrame, pieces: int | None) -> int:
    return pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _walked(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int, carried: Sequence[str] = (),
            hit: Column | None = None) -> DataFrame:
    """``df`` with _key, _piece, _head (same key as the piece's first row), _at (row
    number in the piece, from 0), _lag_<i> of ``carried``, _same (previous row has
    this key) and _cum (hits of the key in the piece so far), written once."""
    spark = df.sparkSession
    keyed = (df.withColumn(_KEY, F.to_json(F.struct(*keys)) if keys else F.lit(""))
             .withColumn("_hit", (F.lit(0) if hit is None else F.when(hit, 1).otherwise(0)).cast("long")))
    ordered = (keyed.repartitionByRange(pieces, _KEY, *order).sortWithinPartitions(_KEY, *order))
    names = [*keyed.columns, _PIECE, _HEAD, _AT, "_same", "_cum", *(f"_lag_{i}" for i in range(len(carried)))]
    schema = keyed.schema
    for name, kind in ((_PIECE, "integer"), (_HEAD, "boolean"), (_AT, "long"), ("_same", "boolean"), ("_cum", "long")):
        schema = schema.add(name, kind)
    for i, c in enumerate(carried):
        schema = schema.add(f"_lag_{i}", keyed.schema[c].dataType)
    carried = list(carried)

    def walk(batches):
        piece, at, first_key, last, count = TaskContext.get().partitionId(), 0, None, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(_KEY)
            before = key.slice(0, 1) if last is None else last[0]
            prev_key = pa.concat_arrays([before, key.slice(0, n - 1)])
            same = pc.equal(key, prev_key).to_numpy(zero_copy_only=False)
            if last is None:
                first_key = key[0].as_py()
                same[0] = False
            hits = batch.column("_hit").to_numpy()
            total, starts = np.cumsum(hits), np.flatnonzero(~same)
            base = np.zeros(n, np.int64)            # hits before the run of one key that a row is in
            base[starts] = (total - hits)[starts]
            cum = total - np.maximum.accumulate(base)
            upto = starts[0] if len(starts) else n
            cum[:upto] = total[:upto] + count       # a run that comes from the batch before
            lags = []
            for i, c in enumerate(carried):
                values = batch.column(c)
                head = pa.nulls(1, values.type) if last is None else last[1][i]
                lags.append(pa.concat_arrays([head, values.slice(0, n - 1)]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, piece, np.int32)), pc.equal(key, pa.scalar(first_key)),
                 pa.array(np.arange(at, at + n)), pa.array(same), pa.array(cum), *lags], names=names)
            at, count = at + n, int(cum[-1])
            last = (key.slice(n - 1, 1), [batch.column(c).slice(n - 1, 1) for c in carried])

    path = scratch_path(spark, "ordered")
    ordered.mapInArrow(walk, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def previous_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                    prefix: str = "prev_", flag: str = "has_prev", pieces: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` (value on the previous row of the key) and ``has_prev``.

    ``order`` must make the order total.
    """
    rows = _walked(df, keys, order, _pieces(df, pieces), cols)
    # Positional names: a carried column may also be an order column.
    tail = F.max(F.struct(_AT, F.col(_KEY).alias("k"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)]))
    tails = rows.groupBy(_PIECE).agg(tail.alias("tail"))
    edges = tails.select(F.col(_PIECE).alias("_p"), F.lag("tail").over(Window.orderBy(_PIECE)).alias("_edge"))
    first = F.col(_AT) == 0
    met = first & F.coalesce(F.col("_edge.k") == F.col(_KEY), F.lit(False))
    return (rows.join(F.broadcast(edges), rows[_PIECE] == edges["_p"], "left")
            .select(*[rows[c] for c in df.columns],
                    *[F.when(met, F.col(f"_edge.v{i}")).when(F.col("_same"), F.col(f"_lag_{i}")).alias(prefix + c)
                      for i, c in enumerate(cols)], (met | F.col("_same")).alias(flag)))


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], condition: Column,
                  name: str = "running_count", pieces: int | None = None) -> DataFrame:
    """Add ``name``: rows of the key up to and including this one where ``condition`` holds."""
    rows = _walked(df, keys, order, _pieces(df, pieces), hit=condition)
    tails = rows.groupBy(_PIECE).agg(F.min(_KEY).alias("head"), F.max(F.struct(_AT, F.col(_KEY).alias("k"), "_cum")).alias("tail"))
    # a piece's head key goes on from all pieces before that end on it
    before = (Window.partitionBy("k").orderBy("_p", F.col("asks").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    ends = tails.select(F.col(_PIECE).alias("_p"), F.col("tail.k").alias("k"), F.col("tail._cum").alias("n"), F.lit(None).cast("int").alias("asks"))
    asks = tails.select(F.col(_PIECE).alias("_p"), F.col("head").alias("k"), F.lit(0).cast("long").alias("n"), F.col(_PIECE).alias("asks"))
    offsets = (ends.unionByName(asks).withColumn("_off", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .where("asks IS NOT NULL").select("asks", "_off"))
    add = F.when(F.col(_HEAD), F.col("_off")).otherwise(0)
    return (rows.join(F.broadcast(offsets), rows[_PIECE] == offsets["asks"], "left")
            .select(*[rows[c] for c in df.columns], (F.col("_cum") + add).cast("bigint").alias(name)))


def dense_ids(df: DataFrame, order: Sequence[str], base: int | Column = 0, name: str = "id",
              pieces: int | None = None) -> DataFrame:
    """Consecutive ids ``base+1..base+n`` in the given order (NULL first), without one task."""
    rows = _walked(df, (), order, _pieces(df, pieces))
    counts = rows.groupBy(_PIECE).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(_PIECE).alias("_p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (rows.join(F.broadcast(offsets), rows[_PIECE] == offsets["_p"])
            .select(*[rows[c] for c in df.columns], (base_col + F.col("_off") + F.col(_AT) + 1).cast("bigint").alias(name)))
