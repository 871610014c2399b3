"""The corpus pipeline: documents through four filters and a mix, each an operator of curvethin.llm.

``run`` writes each stage's rows as Parquet to the session's shared checkpoint folder and reads them
back as the next stage's input, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from curvethin.llm import op1_toxicity, op2_decontaminate, op3_exact, op5_mix, op7_ngram_join
from curvethin.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay."""
    model = op1_toxicity.fit_tables(spark, sf_dir)
    return op1_toxicity.score(docs, model).where("score < 0.5").select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest doc_id stays."""
    return op3_exact.dedup(docs).select(*COLUMNS)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word shingles at Jaccard 0.75 or more, the smallest doc_id stays."""
    return op7_ngram_join.dedup(docs).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return op2_decontaminate.clean(docs, op2_decontaminate.T.read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each remaining document with the words the mix takes of it; those it takes none of go."""
    return op5_mix.mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

ORACLE_SQL = None  # the trained first stage is not expressible in SQL; tests/llm compares the others with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
