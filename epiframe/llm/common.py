"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.sources.shared import bucketed, discard, new_path, shared_dir, staged  # noqa: F401

#: The white space that separates words in the contracts, as trim characters.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(df: DataFrame, name: str) -> str:
    """``name``, behind as many underscores as it takes to differ from all columns of ``df``, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(col: Column) -> Column:
    """64-bit hash that tells the rows of one id apart by their text."""
    return F.xxhash64(F.coalesce(col, F.lit("")))
