"""Registered queries of the thirteen operators (production parameters, whole
tables) and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomis.session import scratch_path

from . import oracles
from .base import prepare, table
from .decontaminate import decontaminate, verdicts
from .fixity import audit_files
from .htmltext import extract_text
from .interaction import interaction_audit
from .lm import lm_scores
from .manifest import manifest
from .mixing import mix
from .quality import quality_rules
from .repeats import remove_repeats
from .secrets import find_secrets, secret_digests
from .simhash import simhash_groups
from .tokencount import token_counts
from .tokenfile import read_token_files, write_token_files


def op1_warc_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixity of every WARC file of the pages against an aged replica."""
    prepare(spark)
    return audit_files(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under the 32k sentencepiece model."""
    import public_tokenizers
    prepare(spark)
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write all documents' ids as block files and read them back."""
    import public_tokenizers
    out = scratch_path(spark, "llm", f"tokens-{uuid.uuid4().hex}")
    write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), out)
    return read_token_files(spark, out, with_ids=False)


def op3_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in the token files."""
    prepare(spark)
    return token_files(spark, table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    prepare(spark)
    return extract_text(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adaptive quality verdict for every document."""
    prepare(spark)
    return quality_rules(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    prepare(spark)
    return simhash_groups(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    prepare(spark)
    return verdicts(decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spans=True))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more removed where a smaller doc_id has them."""
    prepare(spark)
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op9_mixing_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the target mixture takes of every document."""
    prepare(spark)
    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (m["size"] * m["copies"]).alias("taken"),
                    "source", "rate", "copies")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and attention-model scores of every document."""
    import public_tokenizers
    prepare(spark)
    return lm_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters, step by step, for every part."""
    prepare(spark)
    return interaction_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, those under nested encodings included."""
    prepare(spark)
    return secret_digests(find_secrets(table(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and recomputed root of every document."""
    prepare(spark)
    return manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_warc_merkle_audit, op2_token_counts, op3_token_id_output, op4_html_extraction, op5_quality_rules, op6_simhash_near_dedup,
    op7_benchmark_decontamination, op8_suffix_array_dedup, op9_mixing_to_targets, op10_lm_scoring,
    op11_filter_interaction_audit, op12_secret_scan, op13_merkle_manifest)}
ORACLE: dict[str, str] = {"op5_quality_rules": oracles.quality_sql(),
                          "op11_filter_interaction_audit": oracles.interaction_sql(),
                          "op13_merkle_manifest": oracles.manifest_sql()}
