"""A corpus from raw documents to a mix: toxic documents go, one of each near-duplicate group stays, contaminated
documents go, secrets are masked, and the sources are mixed to target weights.

Each stage is a function of ``(spark, docs, sf_dir)``; :func:`run` writes what it returns and reads it again as
the next one's documents, so that a lost executor costs no earlier stage.

Stages keep all columns, whatever they are named. A null or empty text is clean and has no near-duplicate, passage or
secret, so it stays up to the mix, where it has no words. Rows with a null id are kept like others. Of repeated rows
one stays, unless the text has no words; of documents that tie as keepers of a group, one. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontaminate import without_contaminated
from millrace.llm.mixing import mix_report
from millrace.llm.near import without_near_duplicates
from millrace.llm.secrets import redacted
from millrace.llm.toxicity import without_toxic
from millrace.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, learned from the labels beside them."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return without_near_duplicates(docs, size=5, part=80, whole=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found credentials masked."""
    return redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mix_report(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
]

#: The toxicity stage is a fitted model: SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the documents, labels and benchmark below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
