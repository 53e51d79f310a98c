"""The registered queries of this subpackage and, where SQL can say them, their
DuckDB SQL. Each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ballotbox.llm import (
    codes, htmltext, jaccard, lexical, licenses, mixing, oracles, packing, quality, rabitq, records, sentences, suffixes,
    surrogates,
)
from ballotbox.llm.common import read
from ballotbox.llm.tokens import vocabulary
from ballotbox.session import scratch_path


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read(spark, sf_dir, "documents"))


def op3_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read(spark, sf_dir, "documents"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.report(read(spark, sf_dir, "documents"))


def op5_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(read(spark, sf_dir, "documents"))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.dedup(read(spark, sf_dir, "documents"))


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.digest(read(spark, sf_dir, "documents"), scratch_path(spark, "records"),
                          vocabulary("word_bpe_49k.json"))


def op9_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(read(spark, sf_dir, "documents"))


def op10_rabitq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.dedup(read(spark, sf_dir, "embeddings"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"))


def op13_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_main_text, op2_mix_sources, op3_quality_divergence, op4_pii_surrogates, op5_suffix_levels,
        op6_sentence_spans, op7_pack_sequences, op8_binary_records, op9_jaccard_groups, op10_rabitq_neardup,
        op11_license_scan, op12_reversed_search, op13_orchard_codes)
}

ORACLES: dict[str, str] = {
    "op2_mix_sources": oracles.MIX, "op9_jaccard_groups": oracles.JACCARD, "op12_reversed_search": oracles.SEARCH,
    "op13_orchard_codes": oracles.codes(),
}
