"""A training-data pipeline over the documents table.

Each stage takes all that the one before kept, as rows of the documents' columns,
and is written as Parquet before the next one reads it.

quality      documents that break a rule go (kpiloom.llm.quality)
lines        repeated lines go; documents of which nothing is left go
             (kpiloom.llm.lines)
near         one document of each group of near copies stays: the first by
             doc_id, one without an id only where none of the group has one
             (kpiloom.llm.minhash, with a similarity of 0.8 or more)
mix          documents are repeated or left out to meet their source's target
             (kpiloom.llm.mixing)
pack         pieces of at most 2048 tokens with their place in a sequence
             (kpiloom.llm.packing)

Null ids, texts and keys are handled as the operators say. Columns beside the
documents' own are passed on by all stages but the last. Rows that are repeated
in the input are twins up to the near stage, which keeps one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import lines, minhash, mixing, packing, quality
from kpiloom.llm.common import stored, table
from kpiloom.llm.queries import RANKS, TOKENIZER, visible

#: Near copies share this percentage of their five-word shingles or more.
SIMILAR = 80

#: The copies, the lines' order and the packing's plan are not for SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.verdicts(docs, docs.columns).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text keeps its remaining lines; n_chars follows it where there is one."""
    visible(spark)
    others = [c for c in docs.columns if c != "text"]
    rows = lines.without_repeated_lines(docs, others)
    changed = F.col("n_removed") > 0
    left = rows.where(~changed | F.exists(F.split("kept_text", "\n"), lambda s: F.trim(s, F.lit(quality.SPACES)) != ""))
    values = {c: F.col(f"payload.{c}") for c in others} | {"text": F.col("kept_text")}
    if "n_chars" in others:
        values["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(values["n_chars"])
    return left.select(*[values[c].alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by a key of their own, as ids may be null or repeat.
    It is written with them, so that every read gives a row the same key; it
    decides only between rows that are the same in all columns."""
    visible(spark)
    keyed = stored(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("key"), F.xxhash64(*docs.columns).alias("hash")), "keyed")
    found = minhash.near_duplicates(keyed, "key", "row.text", threshold=SIMILAR, bands=minhash.bands_for(SIMILAR))
    found = found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("component"))
    order = F.struct(F.col("row.doc_id").isNull().alias("unnamed"), "row.doc_id", "hash", "key").alias("order")
    members = stored(keyed.select("key", order).join(found, "key"), "near-members")
    groups = members.groupBy("component").agg(F.min("order.key").alias("least"), F.max("order.key").alias("most"), F.min("order").alias("first"))
    first = groups.where("least != most").select("component", F.col("first.key").alias("first"))
    gone = members.join(first, "component").where("key != first").select("key")
    return keyed.join(gone, "key", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(docs, docs.columns)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return rows.where("copies > 0").withColumn("copy", copies).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    visible(spark)
    return packing.digest(packing.packed(docs, TOKENIZER, ["doc_id"], ranks=RANKS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("lines", line_dedup),
    ("near", near_dedup),
    ("mix", mix_sources),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
