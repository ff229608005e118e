"""From raw documents to a training mix, in five stages.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps; its result is written and read
again as the next one's input. The last returns the rows of the mix with their copy number. An empty
table stays empty through all stages, and columns beyond those that a stage reads pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.llm import decontaminate, line_dedup, mixing, quality, simhash
from epiframe.llm.common import documents, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. A null text is scored as empty; repeated rows go or stay together."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that documents share stay in the first of them; n_chars, if there is one, follows the text. Null texts stay null."""
    cut = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return cut.select(docs.columns)
    n_chars = F.when(F.col(cut.columns[-1]) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest id. Rows with a null id all stay, null texts are empty ones."""
    return simhash.first_of_groups(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go. Null texts have none."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, numbered by a last column. Null sources are one source; documents without words are never taken."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing", mixing_stage),
]

#: Training and rounding by hashes have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
