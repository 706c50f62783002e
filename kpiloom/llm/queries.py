"""The operators as registered queries over whole tables, and the pipeline's SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import fingerprints, licenses, lines, minhash, mixing, negatives, packing, pii, quality, scoring_lm, spelling, substrings, vectors
from kpiloom.llm.common import table

#: The tokenizer's file, a parameter of every operator that needs one.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def visible(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed, by
    naming its folder in their path; a cluster ships it as usual."""
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment
    if root not in path.get("PYTHONPATH", "").split(os.pathsep):
        path["PYTHONPATH"] = os.pathsep.join(filter(None, [root, path.get("PYTHONPATH", "")]))


def op1_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return scoring_lm.scores(table(spark, sf_dir, "documents"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return substrings.digest(substrings.without_repeats(table(spark, sf_dir, "documents")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.licences(table(spark, sf_dir, "documents")))


def op6_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mixed(table(spark, sf_dir, "documents"), ["doc_id"]))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return packing.digest(packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, ["doc_id"], ranks=RANKS))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.verdicts(table(spark, sf_dir, "documents"), ["doc_id"]))


def op9_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return lines.digest(lines.without_repeated_lines(table(spark, sf_dir, "documents"), ["doc_id"]))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(fingerprints.compared(table(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible(spark)
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_duplicates,
        op2_personal_data,
        op3_lm_scores,
        op4_repeated_passages,
        op5_license_scan,
        op6_mix_to_targets,
        op7_best_fit_packing,
        op8_quality_rules,
        op9_minhash_near_duplicates,
        op10_line_dedup,
        op11_hard_negatives,
        op12_document_fingerprints,
        op13_spelling_variants,
    )
}
