"""A training corpus from documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adspark.llm import contamination, private, sentences, simhash, toxicity
from adspark.llm.common import owned, remove, scratch, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("simhash_near_dedup", simhash.stage),
    ("benchmark_decontamination", contamination.stage),
    ("pii", private.stage),
    ("sentencepiece", sentences.stage),
]
#: The trained scores of the first stage and the fingerprints of the second have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result written and read again.

    When a stage's result is written, what the stage kept and the result before it are deleted.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = scratch(spark)
        with owned(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
