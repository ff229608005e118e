"""The driver's tables in the roles of sensor data: events as messages, line items and embeddings as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scope, topic, seq, ts, value, k``: an event is a message of its user's scope and its type's topic; ts in nanoseconds."""
    e = read(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select(
        F.col("user_id").alias("scope"),
        F.col("event_type").alias("topic"),
        F.col("event_id").alias("seq"),
        (micros * 1000).alias("ts"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def topic(msgs: DataFrame, name: str, start_ns: int | None = None, end_ns: int | None = None) -> DataFrame:
    """One topic's messages in a time window; the filters reach the scan."""
    found = msgs.where(F.col("topic") == name)
    if start_ns is not None:
        found = found.where(F.col("ts") >= start_ns)
    return found if end_ns is None else found.where(F.col("ts") <= end_ns)


def spans(msgs: DataFrame) -> DataFrame:
    """``scope, start_ns, end_ns``: the first and last message of a scope."""
    return msgs.groupBy("scope").agg(F.min("ts").alias("start_ns"), F.max("ts").alias("end_ns"))


def bounds(msgs: DataFrame) -> DataFrame:
    """``topic, first_ns, last_ns, n``: first and last time of each topic, and its messages."""
    return msgs.groupBy("topic").agg(F.min("ts").alias("first_ns"), F.max("ts").alias("last_ns"), F.count("*").alias("n"))


def chunks(msgs: DataFrame) -> DataFrame:
    """``scope, topic, chunk, start_ns, end_ns, message_count``: messages in chunks of a calendar month."""
    month = F.date_format(F.timestamp_seconds(F.expr("ts div 1000000000")), "yyyyMM")
    return msgs.groupBy("scope", "topic", month.alias("chunk")).agg(F.min("ts").alias("start_ns"), F.max("ts").alias("end_ns"), F.count("*").alias("message_count"))


def overlapping(pieces: DataFrame, start_ns: int, end_ns: int) -> DataFrame:
    """Chunks that may hold messages of the window; a missing bound excludes nothing."""
    return pieces.where((F.col("end_ns").isNull() | (F.col("end_ns") >= start_ns)) & (F.col("start_ns").isNull() | (F.col("start_ns") <= end_ns)))


def lineitem_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``episode, frame, role, dim, x``: a supplier is an episode, its line items by date are frames; state quantity and price, action discount and tax.

    Line items are not unique by key, so every column breaks ties. Values are doubles of single-precision numbers.
    """
    li = read(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    rows = li.select(F.col("l_suppkey").alias("episode"), (F.row_number().over(order) - 1).cast("long").alias("frame"), "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    cells = [("state", 0, "l_quantity"), ("state", 1, "l_extendedprice"), ("action", 0, "l_discount"), ("action", 1, "l_tax")]
    parts = [F.struct(F.lit(r).alias("role"), F.lit(d).alias("dim"), F.col(c).cast("float").cast("double").alias("x")) for r, d, c in cells]
    return rows.select("episode", "frame", F.explode(F.array(*parts)).alias("c")).select("episode", "frame", "c.*")


def embedding_frames(spark: SparkSession, sf_dir: str, dims: int = 32) -> DataFrame:
    """``episode, frame, state, action``: a label is an episode, its vectors are frames; the first half of a vector is state, the second action."""
    e = read(spark, sf_dir, "embeddings")
    order = Window.partitionBy("label").orderBy("vec_id")
    vector = F.col("embedding").cast("array<double>")
    return e.select(F.col("label").cast("long").alias("episode"), (F.row_number().over(order) - 1).cast("long").alias("frame"), F.slice(vector, 1, dims).alias("state"), F.slice(vector, dims + 1, dims).alias("action"))
