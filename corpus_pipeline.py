"""A training corpus from raw documents: toxic documents go, near duplicates go, benchmark passages go, sources are mixed to
their targets, and the rest becomes token files. Each stage is written and read again before the next one runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, mixing, simhash, token_files, toxicity
from tallyloom.llm.queries import END_ID, table, token_file_path
from tallyloom.session import cut_lineage, scratch_path

# Shingles of three words, and fingerprints that differ in at most three of 64 bits are linked.
SHINGLE, RADIUS = 3, 3


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked fingerprints the document with the smallest id stays."""
    return simhash.drop_linked(docs, RADIUS, SHINGLE)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark`` stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_sources(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the token files, read back from them."""
    target = scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    manifest = token_files.write_token_files(docs, target, token_file_path(), END_ID)
    token_files.save_manifest(manifest, target)
    rows = token_files.read_token_files(token_files.load_manifest(spark, target), target)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_free),
    ("source_mixing", mixed),
    ("token_files", tokens),
]

# Trained models and tokenizers are beyond SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
