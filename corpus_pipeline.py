"""From raw documents to encoded training data: five stages, each written out and read again as the next one's input.

Counted as part of ``tickweave.llm``; nothing else imports it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickweave.llm import mixing, neardup, quality, secrets
from tickweave.llm.common import settled
from tickweave.llm.queries import MIX_WEIGHTS, encoded_digests, mix_levels

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of smallest id."""
    return neardup.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, encoded ones too, are replaced in the texts; the character counts follow."""
    out = secrets.redact_secrets(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of 60 per cent of the tokens that are left, by target weights; scarce sources repeat at most once."""
    return mixing.mix(docs, mix_levels(), MIX_WEIGHTS, share=0.6)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each row's token ids and of the bytes they decode to."""
    return encoded_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing", mixture),
    ("byte BPE", encode),
]

# The sketches, decoders and encoder can't be said in SQL; tests/llm/test_pipeline.py compares run() with five plain stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
