"""The operators of this package as queries over the whole ``documents`` table, with production
parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import (
    chosen_path,
    chunk_dedup,
    importance,
    line_quality,
    packing,
    piece_codec,
    piecewise_hash,
    ppm_language,
    secret_scan,
    suffix_automaton,
    suffix_dedup,
    token_store,
    variant_trie,
)
from .common import benchmark, documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return secret_scan.scan(docs, secret_scan.train(docs))


def op2_piece_codec(spark: SparkSession, d: str) -> DataFrame:
    return piece_codec.digests(documents(spark, d), PIECE_BPE)


def op3_chunk_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "text")
    return chunk_dedup.without_repeats(docs, with_figures=True)


def op4_line_quality(spark: SparkSession, d: str) -> DataFrame:
    return line_quality.assess(documents(spark, d))


def op5_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, d))


def op6_ppm_language(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return ppm_language.predict(docs, ppm_language.train(docs))


def op7_chosen_path(spark: SparkSession, d: str) -> DataFrame:
    return chosen_path.report(documents(spark, d))


def op8_token_store(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "store")
    token_store.write(documents(spark, d), path, BYTE_BPE, end_id=0)
    return token_store.read(spark, path)


def op9_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(documents(spark, d), BYTE_BPE, end_id=1)


def op10_piecewise_hash(spark: SparkSession, d: str) -> DataFrame:
    return piecewise_hash.compare(documents(spark, d))


def op11_suffix_automaton(spark: SparkSession, d: str) -> DataFrame:
    return suffix_automaton.report(documents(spark, d), benchmark(spark, d))


def op12_variant_trie(spark: SparkSession, d: str) -> DataFrame:
    return variant_trie.variants(documents(spark, d))


def op13_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    return importance.report(documents(spark, d), benchmark(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_secret_scan, op2_piece_codec, op3_chunk_dedup, op4_line_quality, op5_suffix_dedup, op6_ppm_language,
             op7_chosen_path, op8_token_store, op9_packing, op10_piecewise_hash,
             op11_suffix_automaton, op12_variant_trie, op13_importance_resampling]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_quality": line_quality.assess_sql(), "op11_suffix_automaton": suffix_automaton.report_sql()}
