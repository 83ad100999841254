"""The corpus pipeline: documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and reads it back as the next one's ``docs``. All stages but the last
return the columns of ``documents``.

Null texts count as empty in every stage and null ids are kept; see the
operators' modules for the other edge cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import read_table, stage
from tidewater.llm.curriculum import curriculum_order
from tidewater.llm.decontaminate import drop_contaminated
from tidewater.llm.registry import WORD_TOKENIZER, on_workers, tokenizer_path
from tidewater.llm.superminhash import drop_near_duplicates
from tidewater.llm.token_blocks import token_index
from tidewater.llm.toxicity import drop_toxic

#: Similarity of near copies, in per cent of the union of five-word shingles.
NEAR_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier calls toxic."""
    on_workers(spark)
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    on_workers(spark)
    return drop_near_duplicates(docs, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    on_workers(spark)
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once per pass, in training order."""
    on_workers(spark)
    return curriculum_order(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token file, in the training order in which the mix comes, and
    return its index, read back from it."""
    on_workers(spark)
    return token_index(docs, tokenizer_path(WORD_TOKENIZER), keep_order=True)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing), ("token_ids", token_ids)]

#: SQL can't express the classifier, the signatures, the latent space or the
#: tokenizer; the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
