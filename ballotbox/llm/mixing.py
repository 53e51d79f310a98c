"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a keyed shuffle (the digest of the
doc_id), played up to ``epochs`` times. A copy's virtual finish time is the
queue's words up to and with it, divided by the source's target. All copies
ordered by finish time make the mix, cut at the total budget: every queue is
then near virtual time 1, that is near its target, to within one document.

At scale no ordering meets in one task. A queue is split into buckets by range
of the digest; words per bucket are pre-aggregated and summed, and the running
sum inside a bucket starts from there. The place of the cut in the global order
comes from two rounds of word sums over ranges of finish time (``BINS`` each,
so a bounded table), then an exact order of the few copies in the last range.

Defined cases. NULL text or no words: size 0, in the mix without words. NULL
source: a source of its own, last. NULL doc_id: shuffled as an empty id. Rows
equal in doc_id, source and text are one entry of the queue with as many places, one
after the other; the cut may fall between them. Empty table: empty result. Other columns are not read by ``plan`` and
kept by ``apply``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize, n_words, text_key
from ballotbox.llm.packing import numbered

BINS = 4096
ROWS_PER_BUCKET = 50_000
LEAST_BUCKETS = 64
MANY = 10_000       # equal rows made in one go; more are dealt out first


def targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), numerator: int = 3,
            denominator: int = 2, epochs: int = 2) -> DataFrame:
    """``sources`` (src_null, src, source_size): adds src_rank and target.

    Targets share ``numerator/denominator`` of all words by weight; one that
    would exceed ``epochs`` times its source stops there and its excess goes to
    the others by weight. In order of cap per weight the stopped sources come
    first: a source is stopped if what is left for it and all after it would
    give it more than its cap, and the level of the first that is not holds for
    all after it. One row per source: the windows are over that short table.
    """
    names = Window.orderBy("src_null", "src")
    w = F.array(*[F.lit(float(x)) for x in weights])
    t = (sources.withColumn("src_rank", F.row_number().over(names))
         .withColumn("w", w[((F.col("src_rank") - 1) % len(weights)).cast("int")])
         .withColumn("cap", F.col("source_size") * epochs))
    order = Window.orderBy(F.col("cap") / F.col("w"), "src_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * float(numerator) / float(denominator)
    t = (t.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after))
         .withColumn("stopped", F.col("level") * F.col("w") >= F.col("cap"))
         .withColumn("final", F.min(F.when(~F.col("stopped"), F.struct((F.col("cap") / F.col("w")).alias("r"),
                                                                      "src_rank", "level"))).over(whole)["level"]))
    return t.select("src_null", "src", "src_rank", "source_size",
                    F.when(F.col("stopped"), F.col("cap").cast("double"))
                    .otherwise(F.col("final") * F.col("w")).alias("target"))


def _share(digest: Column) -> Column:
    """First 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def plan(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), numerator: int = 3, denominator: int = 2,
         epochs: int = 2, seed: str = "") -> DataFrame:
    """One row per entry: doc_id, txt_key, src_null, src, n_rows, size, source_size,
    target, taken (for each epoch, how many of its rows are in the mix)."""
    keys = ["src_null", "src"]
    entries = materialize(
        docs.select("doc_id", text_key(F.col("text")).alias("txt_key"), F.col("source").isNull().alias("src_null"),
                    F.coalesce("source", F.lit("")).alias("src"), n_words(F.col("text")).alias("size"))
        .groupBy("doc_id", "txt_key", *keys)
        .agg(F.first("size").alias("size"), F.count("*").alias("n_rows"))
        .withColumn("digest", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed))))
        .withColumn("words", F.col("size") * F.col("n_rows")), "mix-entries")

    per_source = entries.groupBy(*keys).agg(F.sum("words").alias("source_size"), F.count("*").alias("entries"))
    goal = targets(per_source, weights, numerator, denominator, epochs)
    split = per_source.select(*keys, F.greatest(F.lit(LEAST_BUCKETS), F.ceil(F.col("entries") / ROWS_PER_BUCKET))
                              .alias("n_buckets"))
    goal = materialize(goal.join(split, keys), "mix-sources")

    rows = entries.join(goal, keys).withColumn(
        "bucket", F.floor(_share(F.col("digest")) * F.col("n_buckets")))
    sums = rows.groupBy(*keys, "bucket").agg(F.sum("words").alias("in_bucket"))
    upto = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "bucket", F.coalesce(F.sum("in_bucket").over(upto), F.lit(0)).alias("base"))
    inside = (Window.partitionBy(*keys, "bucket").orderBy("digest", "doc_id", "txt_key")
              .rowsBetween(Window.unboundedPreceding, 0))
    queue = materialize(
        rows.join(starts, [*keys, "bucket"])
        .withColumn("upto", F.col("base") + F.sum("words").over(inside))
        .select("doc_id", "txt_key", *keys, "src_rank", "digest", "size", "n_rows", "words", "source_size", "target",
                "upto"), "mix-queue")
    cut = _cut(queue, numerator, denominator, epochs)
    taken = F.array(*[_rows_taken(e, cut) if cut is not None else F.lit(0).cast("long") for e in range(epochs)])
    return queue.select("doc_id", "txt_key", *keys, "n_rows", "size", "source_size", "target", taken.alias("taken"))


def _finish(epoch: int, row: Column) -> Column:
    """Virtual finish time of an entry's row (from 1); entries without a target come last."""
    words = F.col("upto") - F.col("words") + F.col("size") * row + F.col("source_size") * epoch
    return F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(float("inf")))


def _place(epoch: int, row: Column) -> Column:
    """The order of the mix; the last fields only break ties."""
    return F.struct(_finish(epoch, row).alias("finish"), F.col("src_rank").alias("src_rank"), F.lit(epoch).alias("epoch"),
                    F.col("digest").alias("digest"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"),
                    F.col("txt_key").alias("txt_key"), row.cast("long").alias("row"))


def _rows_taken(epoch: int, cut: Column) -> Column:
    """How many of an entry's rows come before the cut: about as many as the finish time
    says, and exactly by the places around that."""
    before = F.col("upto") - F.col("words") + F.col("source_size") * epoch
    about = F.when((F.col("size") > 0) & (F.col("target") > 0), F.floor((cut["finish"] * F.col("target") - before) / F.col("size")))
    about = F.greatest(F.lit(0), F.least(F.coalesce(about, F.col("n_rows")), F.col("n_rows"))).cast("long")
    near = F.sequence(F.greatest(about - 3, F.lit(0)), F.least(about + 3, F.col("n_rows")))
    found = F.array_max(F.filter(near, lambda row: (row == 0) | (_place(epoch, row) <= cut)))
    # rows without words, or without a target, finish together
    one = F.when(_place(epoch, F.lit(1).cast("long")) <= cut, F.col("n_rows")).otherwise(F.lit(0))
    return F.when((F.col("size") > 0) & (F.col("target") > 0), F.coalesce(found, F.lit(0))).otherwise(one).cast("long")


def _each_row(entries: DataFrame) -> DataFrame:
    """``entries`` with a ``row`` for each of their rows; those of an entry with very many
    are made in several tasks."""
    def rows(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(first, last)).alias("row")

    few = entries.filter(F.col("n_rows") <= MANY).select("*", rows(F.lit(1).cast("long"), F.col("n_rows")))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_rows") - 1) / MANY))).alias("_part")
    many = (entries.filter(F.col("n_rows") > MANY).select("*", part)
            .repartition(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), "txt_key", "_part"))
    last = F.least((F.col("_part") + 1) * MANY, F.col("n_rows"))
    return few.unionByName(many.select(*entries.columns, rows(F.col("_part") * MANY + 1, last)))


def _cut(queue: DataFrame, numerator: int, denominator: int, epochs: int) -> Column | None:
    """The place of the last copy within the budget (None: no copy is)."""
    rows = _each_row(queue.filter("size > 0"))          # the others change nothing
    copies = rows.select(F.col("size").alias("words"), F.explode(F.array(*[_place(e, F.col("row")) for e in range(epochs)])).alias("place"))
    finish = F.col("place.finish")
    # monotone in the finish time, below 1 for all
    share = F.when(finish == float("inf"), F.lit(1.0)).otherwise(finish / (finish + 1.0)) * float(BINS)
    copies = copies.withColumn("share", share).withColumn("bin", F.floor("share"))
    left = queue.agg(F.floor(F.sum("words") * numerator / denominator)).first()[0]
    if left is None:
        return None

    def first_over(sums: DataFrame, left: int) -> tuple[int | None, int]:
        for b, words in sorted(map(tuple, sums.collect())):      # BINS + 1 rows at most
            if words > left:
                return b, left
            left -= words
        return None, left

    top, left = first_over(copies.groupBy("bin").agg(F.sum("words")), left)
    inside = copies.filter(F.col("bin") == top) if top is not None else copies.limit(0)
    sub = F.floor((F.col("share") - F.col("bin")) * float(BINS))
    below = F.col("bin") < top if top is not None else F.lit(True)
    if top is not None:
        low, left = first_over(inside.groupBy(sub.alias("sub")).agg(F.sum("words")), left)
        below = below | ((F.col("bin") == top) & (sub < low))
        exact = inside.filter(sub == low).withColumn("upto", F.sum("words").over(
            Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
        place = exact.filter(F.col("upto") <= left).agg(F.max("place")).first()[0]
    else:
        place = None
    if place is None:
        place = copies.filter(below).agg(F.max("place")).first()[0]
    if place is None:
        return None
    return F.struct(F.lit(place.finish).alias("finish"), F.lit(place.src_rank).alias("src_rank"),
                    F.lit(place.epoch).alias("epoch"), F.lit(place.digest).alias("digest"),
                    F.lit(place.doc_id).cast("long").alias("doc_id"), F.lit(place.txt_key).cast("long").alias("txt_key"),
                    F.lit(place.row).cast("long").alias("row"))


def _copies(row: Column, taken: Column) -> Column:
    """How often a row (from 1) of its entry is in the mix."""
    return F.aggregate(taken, F.lit(0), lambda n, most: n + F.when(row <= most, 1).otherwise(0))


def apply(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    p = (plan(docs, **options).filter(F.exists("taken", lambda n: n > 0))
         .select(F.col("doc_id").alias("_mix_id"), F.col("txt_key").alias("_mix_key"), F.col("src_null").alias("_mix_null"),
                 F.col("src").alias("_mix_src"), F.col("n_rows").alias("_mix_rows"), F.col("taken").alias("_mix_taken")))
    on = (docs["doc_id"].eqNullSafe(p["_mix_id"]) & (text_key(docs["text"]) == p["_mix_key"])
          & (docs["source"].isNull() == p["_mix_null"]) & (F.coalesce(docs["source"], F.lit("")) == p["_mix_src"]))
    part = F.exists("_mix_taken", lambda n: (n > 0) & (n < F.col("_mix_rows")))
    # all rows of an entry alike; where the cut falls between them they are numbered first
    alike = docs.join(p.filter(~part), on).withColumn("_mix_copies", _copies(F.col("_mix_rows"), F.col("_mix_taken")))
    cut = docs.join(p.filter(part), on).select(
        *[docs[c] for c in docs.columns], F.xxhash64("_mix_id", "_mix_key", "_mix_null", "_mix_src").alias("_mix_entry"), "_mix_taken",
        F.monotonically_increasing_id().alias("_mix_deal"))
    names = docs.columns
    cut = materialize(cut.toDF(*[f"_c{i}" for i in range(len(names))], "_mix_entry", "_mix_taken", "_mix_deal"), "mix-cut", 8)
    cut = numbered(cut, "_mix_entry", ["_mix_deal"]).withColumn("_mix_copies", _copies(F.col("rank") + 1, F.col("_mix_taken")))
    out = alike.select(*[docs[c] for c in names], "_mix_copies").toDF(*[f"_c{i}" for i in range(len(names))], "_mix_copies")
    out = out.unionAll(cut.select(*[f"_c{i}" for i in range(len(names))], "_mix_copies")).filter("_mix_copies > 0")
    return out.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken."""
    return (_each_row(plan(docs, **options))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * _copies(F.col("row"), F.col("taken"))).alias("taken")))
