"""Pictures that lie in files, one each, as rows of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def picture_files(spark: SparkSession, folder: str, formats: tuple[str, ...] = ("jpeg", "jpg", "png")) -> DataFrame:
    """``ts, format, data, path`` of the files below ``folder``: the time is the number that the name ends with, the format its suffix.

    Empty files, other formats and names without a number are left out; ``jpg`` is given as jpeg.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where("length > 0")
    kind, number = F.lower(F.regexp_extract("path", r"\.(\w+)$", 1)), F.regexp_extract("path", r"(\d+)\.\w+$", 1)
    found = rows.where(kind.isin(*formats) & (number != ""))
    return found.select(number.cast("long").alias("ts"), F.when(kind == "jpg", "jpeg").otherwise(kind).alias("format"), F.col("content").alias("data"), "path")


def by_association(references: DataFrame) -> DataFrame:
    """``association, paths``: references ``association, path`` to local objects, grouped by what they belong to; repeats count once."""
    return references.groupBy("association").agg(F.array_sort(F.collect_set("path")).alias("paths"))
