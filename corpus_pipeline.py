"""Corpus pipeline: quality rules, near-duplicate removal, passage removal, secrets, packing.

Each stage takes the documents its predecessor kept and returns documents (the last one: packed
pieces). ``run`` writes every stage to shared storage and reads it back, so a stage starts from
files and a lost executor costs no earlier work. Null and empty texts fail the quality rules;
extra columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cumulus.llm import chosen_path, chunk_dedup, line_quality, packing, secret_scan
from cumulus.llm.common import documents, saved
from cumulus.llm.queries import BYTE_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines common to a host's documents leave the others."""
    return line_quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays."""
    return chosen_path.without_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a smaller document has too leave the text."""
    return chunk_dedup.without_repeats(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secret_scan.redact(docs, secret_scan.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of 2048-id training sequences. The workers keep the other stages' tables too, so
    they remember fewer words here."""
    return packing.pack(docs, BYTE_BPE, end_id=1, memo=300_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

#: Chosen-path joins, chunk boundaries and token ids are beyond SQL; the tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
