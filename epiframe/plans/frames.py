"""From a contract and messages to episode frames."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiframe.contract import Contract, Stream, scan_window
from epiframe.functions.decoders import decode
from epiframe.operators import asof
from epiframe.operators.episodes import degenerate, keep_monotonic, within
from epiframe.operators.transforms import transform
from epiframe.sources.shared import staged


@dataclass
class Frames:
    """``frames``: episode, frame, timestamp and a vector a base key; ``skipped``: episode, stage, error_class, message."""

    frames: DataFrame
    skipped: DataFrame


def samples(messages: DataFrame, episodes: DataFrame, stream: Stream, contract: Contract) -> DataFrame:
    """``episode, ts, seq, values`` of one stream: an episode reads its scope's messages within its scan window."""
    before, after = (abs(x) for x in scan_window(contract, 0, 0))
    bounds = episodes.select("episode", "scope", (F.col("start_ns") - before).alias("_lo"), (F.col("end_ns") + after).alias("_hi"))
    values = decode(stream.type, messages.schema, stream.names)
    own = messages.where(F.col("topic") == stream.topic).select("scope", "ts", "seq", values.alias("values"))
    return within(own, bounds, "scope", "ts", "_lo", "_hi").select("episode", "ts", "seq", "values")


def build_frames(messages: DataFrame, episodes: DataFrame, contract: Contract, slice_ns: int | None = None) -> Frames:
    """Align all number streams of the contract onto each episode's grid.

    messages: ``scope, topic, ts, seq`` and payload columns; episodes: ``episode, scope, start_ns, end_ns``. Order
    of steps: monotonic filter of actions, guard, transforms before, lead of actions, alignment, transforms after,
    drop of frames with a missing stream, concatenation by base key. An episode that a step refuses is
    skipped whole.
    """
    grid = asof.timeline(episodes, "episode", contract.step_ns)
    skipped, columns = [], {}
    scans, used = {}, Counter((s.topic, s.type, s.names) for s in contract.observations + contract.actions)
    for s in contract.observations + contract.actions:
        key = (s.topic, s.type, s.names)
        if key not in scans:  # streams that take the same of one topic share its scan
            rows = samples(messages, episodes, s, contract)
            scans[key] = staged(rows, "scan") if used[key] > 1 else rows
    for s in contract.observations + contract.actions:
        action = s in contract.actions
        rows = scans[s.topic, s.type, s.names]
        if action:
            rows = keep_monotonic(rows, ["episode"])
        bad = degenerate(rows, "episode")
        skipped.append(bad.select("episode", F.lit("worker").alias("stage"), F.lit("ValueError").alias("error_class"), F.lit(f"{s.unique_key}: the median time step is not above 0").alias("message")))
        before = [t for t in s.transforms if t.stage == "pre"]
        if before:
            rows, errors = transform(rows, "episode", before)
            skipped.append(errors.select("episode", F.lit("worker").alias("stage"), F.lit("ValueError").alias("error_class"), F.concat(F.lit(f"{s.unique_key}: "), "error").alias("message")))
        if action and contract.action_lead_steps:
            rows = rows.withColumn("ts", F.col("ts") - contract.action_lead_steps * contract.step_ns)
        columns[s.unique_key] = (rows, s.align.method, s.align.tolerance_ms)
    frames = asof.align_all(grid, columns, "episode", slice_ns)
    for s in contract.observations + contract.actions:
        after = [t for t in s.transforms if t.stage == "post"]
        if after:
            own, errors = transform(frames.select("episode", "ts", F.col("frame").alias("seq"), F.col(f"`{s.unique_key}`").alias("values")), "episode", after, contract.fps)
            skipped.append(errors.select("episode", F.lit("worker").alias("stage"), F.lit("ValueError").alias("error_class"), F.concat(F.lit(f"{s.unique_key}: "), "error").alias("message")))
            own = own.select(F.col("episode").alias("_e"), F.col("ts").alias("_t"), F.col("values").alias("_v"))
            same = F.col("episode").eqNullSafe(F.col("_e")) & (F.col("ts") == F.col("_t"))
            frames = frames.drop(s.unique_key).join(own, same, "left").withColumnRenamed("_v", s.unique_key).drop("_e", "_t")
    errors = reduce(DataFrame.union, skipped)
    refused = errors.select("episode").distinct()
    whole = reduce(lambda c, k: c & F.col(f"`{k}`").isNotNull(), columns, F.lit(True))
    frames = frames.join(refused, "episode", "left_anti").where(whole)
    renumbered = (F.row_number().over(Window.partitionBy("episode").orderBy("frame")) - 1).cast("long")
    keys: dict[str, list[str]] = {}
    for s in contract.observations + contract.actions:
        keys.setdefault(s.key, []).append(s.unique_key)
    vectors = [F.concat(*[F.col(f"`{u}`") for u in us]).cast("array<float>").alias(k.replace(".", "_")) for k, us in keys.items()]
    out = frames.select("episode", renumbered.alias("frame"), (renumbered / contract.fps).cast("float").alias("timestamp"), F.col("ts").alias("ts_ns"), *vectors)
    return Frames(out, errors)
