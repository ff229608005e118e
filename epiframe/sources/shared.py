"""Written tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session may lack it; it then gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = spark.sparkContext.getCheckpointDir()
    if made is None:
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="epiframe-"))
        made = spark.sparkContext.getCheckpointDir()
    return made.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts the lineage. The table goes with the driver at the latest."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    _at(df.sparkSession, path, lambda fs, p: fs.deleteOnExit(p))
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``staged``, but dealt by ``key`` as joins deal rows: a join on it reads this table where it lies and moves the other side alone."""
    spark = df.sparkSession
    path, n, table = new_path(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions")), f"epiframe_{uuid.uuid4().hex}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table, format="parquet")
    _at(spark, path, lambda fs, p: fs.deleteOnExit(p))
    out = spark.table(table)
    out._staged_at, out._staged_as = path, table
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``staged`` or ``bucketed`` wrote for tables that nothing reads any more."""
    for t in tables:
        if name := getattr(t, "_staged_as", None):
            t.sparkSession.sql(f"DROP TABLE {name}")
        _at(t.sparkSession, t._staged_at, lambda fs, p: fs.delete(p, True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, wherever the path is."""

    def put(fs, p) -> None:
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    _at(spark, path, put)


def _at(spark: SparkSession, path: str, act: Callable) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    act(p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p)
