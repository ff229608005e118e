"""The metadata of a dataset in either layout: episodes, tasks and per-episode statistics.

Layout 3 keeps them as parquet under ``meta/tasks``, ``meta/episodes`` and ``meta/stats``, layout 2.1 as JSON lines
under ``meta/tasks.jsonl``, ``meta/episodes.jsonl`` and ``meta/episodes_stats.jsonl``. Each is a folder that executors write in parts.

``episodes``: ``episode_index, length, tasks`` (array) and whatever else; ``tasks``: ``task_index, task``; ``stats``:
``episode_index, feature, min, max, mean, std, count`` with arrays of one number a dim (layout 3 may have quantiles; 2.1 drops them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.operators import dataset

#: What layout 2.1 keeps of the statistics, and where each layout has its tables.
KEPT_STATS = ("mean", "std", "min", "max", "count")
FILES = {"v3.0": {"tasks": "tasks", "episodes": "episodes", "stats": "stats"}, "v2.1": {"tasks": "tasks.jsonl", "episodes": "episodes.jsonl", "stats": "episodes_stats.jsonl"}}


def episode_stats(frames: DataFrame, features: list[str]) -> DataFrame:
    """``stats`` of number and vector columns, in one pass over the frames."""
    def cells(name: str):
        v = F.col(f"`{name}`")
        values = v.cast("array<double>") if frames.schema[name].dataType.typeName() == "array" else F.array(v.cast("double"))
        return F.transform(values, lambda x, i: F.struct(F.lit(name).alias("feature"), i.alias("dim"), x.alias("x")))

    long = frames.select("episode_index", F.explode(F.concat(*map(cells, features))).alias("c")).select("episode_index", "c.*")
    x = F.col("x")
    per = long.groupBy("episode_index", "feature", "dim").agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.count(x).alias("count"))
    dims = F.array_sort(F.collect_list(F.struct("dim", *KEPT_STATS)))  # a row a dim
    wide = per.groupBy("episode_index", "feature").agg(dims.alias("d"))
    return wide.select("episode_index", "feature", *[F.col("d")[k].alias(k) for k in ("min", "max", "mean", "std")], F.get("d", F.lit(0))["count"].alias("count"))


def episodes_of(frames: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """``episodes`` by counting frames; the tasks are those of the frames' ``task_index``, if there are any."""
    if tasks is None or "task_index" not in frames.columns:
        return frames.groupBy("episode_index").agg(F.count("*").alias("length")).withColumn("tasks", F.array().cast("array<string>"))
    per = frames.groupBy("episode_index", "task_index").agg(F.count("*").alias("n")).join(tasks, "task_index", "left")
    return per.groupBy("episode_index").agg(F.sum("n").alias("length"), F.array_sort(F.collect_set("task")).alias("tasks"))


def write_meta(root: str, version: str, episodes: DataFrame, tasks: DataFrame, stats: DataFrame) -> None:
    for name, t in (("tasks", tasks.orderBy("task_index")), ("episodes", episodes), ("stats", stats)):
        path = f"{root}/meta/{FILES[version][name]}"
        if version == "v3.0":
            t.write.parquet(path)
        else:
            if name == "stats":
                t = t.groupBy("episode_index").agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct(*KEPT_STATS)))).alias("stats"))
            t.write.json(path)


def read_meta(spark: SparkSession, root: str, version: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(episodes, tasks, stats), all in the form that this module's docstring gives."""
    at = {n: f"{root}/meta/{f}" for n, f in FILES[version].items()}
    if version == "v3.0":
        return tuple(spark.read.parquet(at[n]) for n in ("episodes", "tasks", "stats"))
    # fields are known, so nothing is read to infer them but the episodes' own columns
    tasks = spark.read.schema("task_index long, task string").json(at["tasks"])
    number = "array<double>"
    stats = spark.read.schema(f"episode_index long, stats map<string,struct<mean:{number},std:{number},min:{number},max:{number},count:long>>").json(at["stats"])
    stats = stats.select("episode_index", F.explode("stats").alias("feature", "s")).select("episode_index", "feature", *[F.col(f"s.{k}").alias(k) for k in ("min", "max", "mean", "std", "count")])
    return spark.read.json(at["episodes"]), tasks, stats


def write_dataset(frames: DataFrame, tasks: DataFrame, root: str, version: str, fps: float, features: dict, numbers: list[str]) -> None:
    """Data, info, episodes, tasks and statistics of the columns ``numbers`` in one layout."""
    {"v2.1": dataset.write_by_episode, "v3.0": dataset.write_packed}[version](frames, root, fps, features)
    write_meta(root, version, episodes_of(frames, tasks), tasks, episode_stats(frames, numbers))


def convert(spark: SparkSession, root: str, out: str, version: str) -> None:
    """A whole dataset in the other layout: data and info, then episodes, tasks and statistics. Quantiles are left out of layout 2.1."""
    had = dataset.read_info(spark, root)["codebase_version"]
    dataset.convert_layout(spark, root, out, version)
    episodes, tasks, stats = read_meta(spark, root, had)
    write_meta(out, version, episodes, tasks, stats)


def start_frame(from_seconds, fps: float):
    """Frame of a packed video at which an episode begins, as a column: the nearest one to its start."""
    return F.bround(from_seconds * F.lit(float(fps)), 0).cast("long")


def copied_files(spark: SparkSession, root: str, folder: str, suffixes: tuple[str, ...] = (".png", ".jpg", ".jpeg")) -> DataFrame:
    """``path, data`` of a dataset's own pictures below ``folder``; other kinds of files and paths that leave the dataset are refused.

    Write them with ``foreachPartition`` or as rows; nothing is copied by the driver.
    """
    if folder.startswith("/") or ".." in folder.split("/"):
        raise ValueError(f"{folder!r} leaves the dataset")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{folder}")
    known = F.lower("path").rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$")
    data = F.when(known, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("not a picture: "), "path")).cast("binary"))
    return rows.select("path", data.alias("data"))
