"""Training-data pipeline over ``documents``.

Quality rules, one document of each near-duplicate group, no benchmark
passages, no secrets, packed into sequences. Each stage takes
(spark, docs, sf_dir), works on all rows its predecessor kept, and but for the
last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import decontaminate, ngram_join, packing, quality_rules, secret_scan
from salescope.llm.common import staged, table
from salescope.llm.tokens import tokenizer_path
from salescope.session import remove_scratch, scratch_path, scratch_paths


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the least id stays."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; found secrets are replaced in their texts."""
    ledger = secret_scan.Ledger(spark, scratch_path(spark, "secret-ledger"), create=True)
    clean = secret_scan.redact_secrets(docs, ledger)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every id of every document in one piece of one sequence."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets),
    ("packing", pack),
]

#: SQL cannot express suffix arrays, SimHash or subset sums; the tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. A stage's own tables, and the one that it
    read, go when its rows are written."""
    docs = table(spark, sf_dir, "documents")
    before = scratch_paths(spark)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        made = [p for p in scratch_paths(spark) if p not in before]
        remove_scratch(spark, made[:-1])            # the last one is the stage's rows
    return STAGES[-1][1](spark, docs, sf_dir)
