"""Registered queries over the driver's tables, with the SQL that they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epiframe import queries_align, queries_decode, queries_episodes, queries_metrics, queries_more  # noqa: F401
from epiframe.registry import ORACLES, QUERIES


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries_align.asof_hold_summary(spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
