"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.

Defined cases, for every stage. NULL or empty texts and those under 50 words fail the
quality rules; where they come in all the same, the other stages keep them. NULL ids
and ids that several texts share are kept: near duplicates are told apart by id and
text. Repeated rows: one stays after the near duplicates, else each counts. NULL
sources are a source of their own. Columns beside those named are carried along
(packing drops them), also ones named like a stage's own. An empty table stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ballotbox.llm import jaccard, mixing, packing, quality, surrogates
from ballotbox.llm.common import materialize, read
from ballotbox.llm.tokens import vocabulary

NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from every language reference go."""
    return quality.apply(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays. Near copies share 80 per cent
    or more of their five-word shingles; op9's own numbers bind the op9 query only."""
    return jaccard.apply(docs, NEAR_WORDS, NEAR_PERCENT, by_text=True)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become surrogates."""
    return surrogates.apply(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document may be there twice."""
    return mixing.apply(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: which piece of which document lies where."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("private data", private_data),
    ("source mix", source_mix),
    ("packing", packed),
]

# Tokenizing and packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
