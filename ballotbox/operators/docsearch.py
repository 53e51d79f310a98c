"""Document index and ranked search (D1-D5) over a table of documents.

A document row is ``(rel_path, content)`` plus any id. ``index`` adds the
section, title and summary; ``search`` scores every document against a
query, keeps matches and orders them. Every step is a per-row projection
over the whole text (no shuffle) except the final ordering, a range-
partitioned sort (or a distributed top-k when ``limit`` is given).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotbox.functions import text as X
from ballotbox.session import scratch_path


def index(docs: DataFrame, path: str = "rel_path", content: str = "content") -> DataFrame:
    ts = X.title_summary(content, X.path_stem(path))
    return (docs.select("*", X.section(path).alias("section"), ts.alias("_ts"))
            .select(*docs.columns, "section", "_ts.title", "_ts.summary"))


def listing(docs: DataFrame, keep: list[str], path: str = "rel_path", content: str = "content") -> DataFrame:
    """U4 over the index with the ``keep`` columns of the documents only."""
    return ordered(_once(index(docs, path, content).select(*keep, "section", "title", "summary")), path)


def _once(rows: DataFrame) -> DataFrame:
    """Written and read again: a global sort reads its input twice (to find the ranges
    first), and what it reads is to be the rows and not the texts."""
    held = scratch_path(rows.sparkSession, "doc-rows")
    rows.write.parquet(held)
    return rows.sparkSession.read.schema(rows.schema).parquet(held)


def ordered(indexed: DataFrame, path: str = "rel_path") -> DataFrame:
    """U4: the declared listing order (section, lower-case title, lower-case path)."""
    return indexed.orderBy("section", F.lower("title"), F.lower(path))


def _ranked(scored: DataFrame, path: str, limit: int | None) -> DataFrame:
    out = scored.orderBy(F.desc("score"), "section", F.lower("title"), F.lower(path))
    return out.limit(limit) if limit else out


def _hits(docs: DataFrame, title, summary, terms: list[str], content: str) -> DataFrame:
    """``docs`` with title, summary and score of those whose score is above 0. One row at
    most comes out of each array, so the text is worked on once, not once in a filter
    and again in the projection after it."""
    def scored(ts):
        hay = F.concat_ws("\n", ts["title"], ts["summary"], F.col(content))
        return F.struct(ts["title"].alias("title"), ts["summary"].alias("summary"), X.score(hay, terms).alias("score"))

    row = X.let(F.struct(title.alias("title"), summary.alias("summary")), scored)
    return docs.select("*", F.inline(F.filter(F.array(row), lambda r: r["score"] > 0)))


def search(docs: DataFrame, query: str, content: str = "content", path: str = "rel_path",
           limit: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """D4 + D5: documents with score > 0, best first; an empty query returns all with 0.
    Only texts that can score are read for title, summary and counts. ``keep``: the
    columns of the documents that the result has (default all)."""
    terms = X.search_terms(query)
    if not terms:
        out = index(docs, path, content).select("*", F.lit(0).cast("bigint").alias("score"),
                                                F.lit("").alias("snippet"))
        return out.orderBy("section", F.lower("title"), F.lower(path))
    stem = X.path_stem(path)
    able = docs.where(X.may_score(content, stem, terms)).withColumn("section", X.section(path))
    out = (_hits(able, X.title(content, stem), X.summary(content), terms, content)
           .withColumn("snippet", X.snippet(content, terms)))
    if keep is not None:
        out = out.select(*dict.fromkeys([*keep, path]), "section", "title", "summary", "score", "snippet")
        if limit is None:
            out = _once(out)
    return _ranked(out, path, limit)


# ---- the same search over a stored index

BLOCK_BYTES = 64 << 20      # of text in a block, about
MOST_SMALLER = 500          # blocks smaller than that; a larger tree has larger blocks
MOST_LISTED = 10_000        # blocks named in the scan's filter; more are met by a join
GRAM = 3


def _grams(word: str, n: int) -> set[str]:
    return {word[i:i + n] for i in range(len(word) - n + 1)}


def n_blocks(size: int, block_bytes: int) -> int:
    """Blocks of ``size`` bytes of text."""
    return max(1, min(-(-size // block_bytes), max(MOST_SMALLER, -(-size // BLOCK_BYTES))))


def build_index(docs: DataFrame, root: str, path: str = "rel_path", content: str = "content",
                block_bytes: int = BLOCK_BYTES) -> str:
    """Stores ``docs`` in blocks with title, summary and section, and for each block the
    runs of up to three characters that its titles, summaries and texts hold.

    Blocks have about ``block_bytes`` of text as long as there are few of them, and more, up
    to ``BLOCK_BYTES``, in a large tree: every block has its folder, its tasks and nearly
    the same runs as any other, so blocks of one small size make postings as large as the text.
    Blocks are ranges of paths, so what lies together in the tree lies together here;
    the postings are sorted, so that a lookup reads a few row groups of them.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(content))).first()[0] or 0
    n = n_blocks(size, block_bytes)
    dealt = docs.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(n, path, "_row")
    (index(dealt.drop("_row"), path, content).withColumn("block", F.spark_partition_id())
     .write.partitionBy("block").parquet(f"{root}/documents"))
    stored = spark.read.parquet(f"{root}/documents")

    def postings(batches):
        """A task's blocks one after the other: each block's runs once."""
        block, words, grams = None, set(), set()
        for batch in batches:
            for b, text in zip(batch.column("block").to_pylist(), batch.column("low").to_pylist()):
                if b != block:
                    if grams:
                        yield _posting(block, grams)
                    block, words, grams = b, set(), set()
                for word in set((text or "").split()) - words:
                    for k in range(1, GRAM + 1):
                        grams |= _grams(word, k)
                    if len(words) < 1_000_000:          # only spares work
                        words.add(word)
        if grams:
            yield _posting(block, grams)

    low = stored.select("block", F.lower(F.concat_ws("\n", "title", "summary", content)).alias("low"))
    (low.mapInArrow(postings, "gram string, block int").distinct().repartitionByRange("gram").sortWithinPartitions("gram")
     .write.parquet(f"{root}/postings"))
    return root


def _posting(block: int, grams: set[str]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(sorted(grams), pa.string()), pa.array([block] * len(grams), pa.int32())],
                                      names=["gram", "block"])


def blocks_with(spark: SparkSession, root: str, terms: list[str]) -> DataFrame:
    """block: those that hold all runs of some term (a term may be in no other)."""
    wanted = {t: sorted(_grams(t, min(GRAM, len(t)))) for t in terms}
    every = sorted(set().union(*wanted.values()))
    found = spark.read.parquet(f"{root}/postings").where(F.col("gram").isin(every))
    held = found.groupBy("block").agg(F.collect_set("gram").alias("held"))       # a query's runs at most
    has = [F.size(F.array_intersect("held", F.array(*map(F.lit, g)))) == len(g) for g in wanted.values()]
    return held.where(reduce(lambda a, b: a | b, has)).select("block")


def search_index(spark: SparkSession, root: str, query: str, content: str = "content", path: str = "rel_path",
                 limit: int | None = None) -> DataFrame:
    """``search`` over an index of ``build_index``: the same rows in the same order, read
    from the blocks that can hold them only."""
    docs, terms = spark.read.parquet(f"{root}/documents"), X.search_terms(query)
    if not terms:
        out = docs.drop("block").select("*", F.lit(0).cast("bigint").alias("score"), F.lit("").alias("snippet"))
        return out.orderBy("section", F.lower("title"), F.lower(path))
    blocks = blocks_with(spark, root, terms)
    listed = [r["block"] for r in blocks.limit(MOST_LISTED + 1).collect()]
    some = docs.where(F.col("block").isin(listed)) if len(listed) <= MOST_LISTED else docs.join(blocks, "block", "left_semi")
    out = (_hits(some.drop("block").withColumnsRenamed({"title": "_title", "summary": "_summary"}), F.col("_title"), F.col("_summary"),
                 terms, content).drop("_title", "_summary").withColumn("snippet", X.snippet(content, terms)))
    return _ranked(out, path, limit)
