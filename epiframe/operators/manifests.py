"""One manifest out of those of a merge's shards.

``shards`` has a row a shard: ``shard`` (its place in the merge, from 0), ``manifest`` (JSON text or null) and
``total_episodes`` (of the shard's own summary). Lists within manifests stay distributed rows; only one row a
shard is ever ordered as a whole.

Defined results: a shard without manifest moves the numbers of the later ones by its ``total_episodes`` and adds
nothing else; a manifest that states ``total_episodes`` is believed over the summary; text that is not JSON counts as no manifest.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiframe.sources.shared import write_text


class ManifestError(ValueError):
    """Shards that cannot be one dataset."""


def value_at(path: str) -> Column:
    """Text of a nested entry of the manifest, null where there is none."""
    return F.get_json_object("manifest", f"$.{path}")


def _entries(shards: DataFrame, path: str, *more: str) -> DataFrame:
    """``shard``, ``more`` and ``entry``, a row an element of a list, as JSON text."""
    return shards.select("shard", *more, F.explode(F.from_json(value_at(path), "array<string>")).alias("entry"))


def offsets(shards: DataFrame) -> DataFrame:
    """``shards`` plus ``first``, the number that its first episode gets."""
    n = F.coalesce(value_at("total_episodes").cast("long"), F.col("total_episodes").cast("long"), F.lit(0).cast("long"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("first", F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long"))


def episode_events(shards: DataFrame, path: str = "episode_to_event") -> DataFrame:
    """``episode_index, source_shard, entry``: every episode's provenance under its new number; ``entry`` is as the shard had it."""
    rows = _entries(offsets(shards), path, "first")
    return rows.select((F.col("first") + F.get_json_object("entry", "$.episode_index").cast("long")).alias("episode_index"), F.col("shard").alias("source_shard"), "entry")


def listed(shards: DataFrame, path: str) -> DataFrame:
    """``shard, entry``: all shards' entries of one list, such as what was skipped or dropped as a duplicate."""
    return _entries(shards, path)


def counts(shards: DataFrame, path: str = "episodes_per_dataset") -> DataFrame:
    """``name, n``: sums of a mapping from names to numbers."""
    pairs = shards.select(F.explode(F.from_json(value_at(path), "map<string,long>")).alias("name", "n"))
    return pairs.groupBy("name").agg(F.sum("n").alias("n"))


def names(shards: DataFrame, path: str = "source_datasets") -> DataFrame:
    """``name``: the distinct entries of a list of names."""
    return _entries(shards, path).select(F.col("entry").alias("name")).distinct()


def distinct_values(shards: DataFrame, path: str) -> list[str]:
    """The distinct values of a nested entry, sorted; a value a shard at most."""
    return sorted(r.v for r in shards.select(value_at(path).alias("v")).where("v IS NOT NULL").distinct().collect())


def contract_of(shards: DataFrame, path: str = "contract") -> dict[str, str | None]:
    """Name, version, path and hash of the contract of the first shard that has one; shards of different contracts are refused."""
    hashes = distinct_values(shards, f"{path}.sha256")
    if len(hashes) > 1:
        raise ManifestError(f"shards were made by different contracts: {hashes}")
    fields = ("name", "version", "path", "sha256")
    has = value_at(path).startswith("{")
    first = shards.where(has).orderBy("shard").select(*[value_at(f"{path}.{f}").alias(f) for f in fields]).first()
    return dict(zip(fields, first)) if first else {}


def with_episodes(shards: DataFrame) -> DataFrame:
    """Shards that hold an episode; if none does, the refusal lists each shard's ``reason``, if there is such a column."""
    kept = shards.where(F.col("total_episodes") > 0)
    if kept.isEmpty():
        reason = F.coalesce(F.col("reason"), F.lit("no reason given")) if "reason" in shards.columns else F.lit("no reason given")
        why = shards.orderBy("shard").select("shard", reason.alias("reason")).collect()  # a row a shard
        raise ManifestError("no shard has an episode: " + "; ".join(f"{r.shard}: {r.reason}" for r in why))
    return kept


def contracts(shards: DataFrame, by: str, path: str = "contract") -> DataFrame:
    """``by, n_contracts, consistent`` of the shards of many merges: shards without a contract do not count."""
    n = F.count_distinct(value_at(f"{path}.sha256"))
    return shards.groupBy(by).agg(n.alias("n_contracts")).withColumn("consistent", F.col("n_contracts") <= 1)


def shard_summary(infos: DataFrame) -> DataFrame:
    """``shard, n_episodes, n_frames, fps, version`` from the info files ``shard, info`` (JSON text); a shard without one raises."""
    entry = lambda name: F.get_json_object("info", f"$.{name}")
    there = F.when(F.col("info").isNull(), F.raise_error(F.concat(F.lit("no info file in shard "), F.col("shard").cast("string"))).cast("long")).otherwise(entry("total_episodes").cast("long"))
    return infos.select("shard", there.alias("n_episodes"), entry("total_frames").cast("long").alias("n_frames"), entry("fps").cast("double").alias("fps"), entry("codebase_version").alias("version"))


def document(shards: DataFrame) -> dict:
    """The merged manifest but for lists that grow with the episodes: totals, contract, counts and names.

    What comes to the driver is a row a shard, a dataset or a name.
    """
    whole = offsets(shards)
    n = F.coalesce(value_at("total_episodes").cast("long"), F.col("total_episodes").cast("long"), F.lit(0).cast("long"))
    sums = whole.agg(F.count("*").alias("s"), F.sum(n).alias("e"), F.count("manifest").alias("m")).first()
    return {
        "total_shards": sums.s, "total_episodes": sums.e or 0, "shards_with_manifest": sums.m, "contract": contract_of(shards),
        "episodes_per_dataset": {r["name"]: r["n"] for r in counts(shards).orderBy("name").collect()},
        "source_datasets": sorted(r["name"] for r in names(shards).collect()),
    }


def write_document(shards: DataFrame, folder: str) -> dict:
    """``manifest.json`` in ``folder`` and beside it, written by executors, the provenance of all episodes and what was skipped, as JSON lines."""
    spark, found = shards.sparkSession, document(shards)
    episode_events(shards).write.json(f"{folder}/episode_to_event.jsonl")
    listed(shards, "skipped").write.json(f"{folder}/skipped.jsonl")
    write_text(spark, f"{folder}/manifest.json", json.dumps(found | {"episode_to_event": "episode_to_event.jsonl", "skipped": "skipped.jsonl"}, sort_keys=True, indent=2))
    return found
