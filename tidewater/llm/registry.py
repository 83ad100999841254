"""The queries of the corpus operators over the test tables, and their SQL."""

from __future__ import annotations

import os
import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import read_table, stage
from tidewater.llm.license_rules import oracle_sql as license_sql
from tidewater.llm.source_audit import ORACLE_SQL as AUDIT_SQL
from tidewater.llm.vector_codes import oracle_sql as codes_sql
from tidewater.session import staging_path

#: Folder with the public tokenizer files; unset, that of the installed package.
TOKENIZERS = os.environ.get("TOKENIZER_DIR")
WORD_TOKENIZER = "word_bpe_49k.json"
RANK_TOKENIZER = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: Key of the pseudonyms. Unset, one is drawn that nobody knows and that ends
#: with this process: values are linked within its results only.
PII_KEY = os.environ.get("PII_KEY") or secrets.token_hex(16)


def tokenizer_path(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers
    return public_tokenizers.path(name)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def on_workers(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did. On a
    cluster where they can't, ship it with --py-files. Whole texts are long
    rows, so an unset batch size becomes a smaller one."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.secret_grammar import find_secrets
    return find_secrets(read_table(spark, sf_dir, "documents"))


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.token_blocks import token_index
    return token_index(read_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.toxicity import score_toxicity, train_toxicity
    docs = read_table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels")))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.lattice_lm import lattice_scores
    return lattice_scores(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.feistel_pii import KINDS, pseudonymise
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PII_KEY).select("doc_id", "text", *[f"pii_{k}" for k in KINDS])


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.digest_merge import exact_duplicates
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.decontaminate import contaminated_documents
    return contaminated_documents(read_table(spark, sf_dir, "documents"),
                                  read_table(spark, sf_dir, "benchmark"))


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 inserts all documents; batch 2 revises the non-English ones under
    the tokenizer for many languages; batch 3 deletes those labelled of low
    quality; batch 2 is then committed once more, to no effect."""
    import public_tokenizers

    from tidewater.llm.token_rollup import TokenLedger, changes, count_tokens
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    ledger = TokenLedger(spark, staging_path(spark, "ledger"))
    ledger.commit(1, changes(count_tokens(docs, tokenizer_path(WORD_TOKENIZER)), "insert",
                             "word_bpe_49k"))
    foreign = count_tokens(docs.where("lang != 'en'"), tokenizer_path(RANK_TOKENIZER),
                           public_tokenizers.PATTERN)
    revision = stage(changes(foreign, "revise", "byte_bpe_multi_50k"), "revision")
    ledger.commit(2, revision)
    low = labels.where("quality = 0").select("doc_id").distinct()
    ledger.commit(3, low.select(
        F.lit("delete").alias("op"), F.lit(0).cast("long").alias("seq"), "doc_id",
        *[F.lit(None).cast("string").alias(c) for c in ("source", "lang", "tokenizer")],
        F.lit(0).cast("long").alias("tokens")))
    ledger.commit(2, revision)
    return ledger.totals()


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.superminhash import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


def op10_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.curriculum import mix_plan
    plan = mix_plan(read_table(spark, sf_dir, "documents"))
    # training order: by the position of the first pass, what isn't taken last
    first = F.get("positions", F.lit(0)).alias("position")
    return (plan.select("doc_id", "size", "source_size", "target", "taken", first)
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.source_audit import divergence_audit
    return divergence_audit(read_table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.license_rules import scan_licenses
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("detections")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.vector_codes import vector_codes
    return vector_codes(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def _query(run: Callable) -> Callable:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return run(spark, sf_dir)
    query.__name__, query.__doc__ = run.__name__, run.__doc__
    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _query(f) for f in (
        op1_secret_scan, op2_token_blocks, op3_toxicity, op4_lattice_lm, op5_pii_pseudonyms,
        op6_exact_dedup, op7_decontamination, op8_token_rollup, op9_superminhash,
        op10_curriculum, op11_source_audit, op12_license_scan, op13_vector_codes, pipeline)}

OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256
                                   ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""

ORACLE: dict[str, str] = {"op6_exact_dedup": OP6_SQL, "op11_source_audit": AUDIT_SQL,
                          "op12_license_scan": license_sql(),
                          "op13_vector_codes": codes_sql()}
