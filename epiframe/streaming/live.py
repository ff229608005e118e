"""Online alignment: bounded buffers per stream, sampled on ticks, with causal filters carried in state.

Messages and ticks are rows of one keyed stream; a tick is a row of topic ``tick``. Under Structured Streaming a state machine
has the buffers and filters of a scope. A batch replay without filters needs no state: a tick's sample is the last one
before it, so one sweep over windows gives it; with filters it runs the same state machine.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from epiframe.operators import asof, kernels

TICK = "tick"
CAPACITY = 64


@dataclass(frozen=True)
class Online:
    """One stream: hold or nearest within ``tolerance_ns`` (above 0), and filters (fs, cutoff_hz, order).

    ``filter`` runs on samples before they are buffered, ``tick_filter`` on what each tick takes.
    """

    topic: str
    method: str = "hold"
    tolerance_ns: int = 50_000_000
    filter: tuple[float, float, int] | None = None
    tick_filter: tuple[float, float, int] | None = None

    def __post_init__(self):
        if self.tolerance_ns <= 0:
            raise ValueError(f"{self.topic}: an online tolerance must be above 0")
        if self.method not in ("hold", "nearest"):
            raise ValueError(f"{self.topic}: online alignment is hold or nearest, not {self.method!r}")


class Aligner:
    """Buffers of all streams of one scope. Its state is plain JSON."""

    def __init__(self, streams: tuple[Online, ...], state: dict | None = None):
        self.streams = {s.topic: s for s in streams}
        self.state = state or {"buffers": {s.topic: [] for s in streams}, "filters": {}}

    def push(self, topic: str, ts: int, value: float, strict: bool = True) -> None:
        """Enter a sample; the oldest pushed one leaves a full buffer. Unknown topics are an error if ``strict``, else ignored."""
        s = self.streams.get(topic)
        if s is None:
            if strict:
                raise KeyError(f"no stream reads topic {topic!r}")
            return
        value = self._smooth(topic, s.filter, value)
        buffer = self.state["buffers"][topic]
        buffer.append((ts, value))
        del buffer[:-CAPACITY]

    def _smooth(self, name: str, spec: tuple[float, float, int] | None, value: float) -> float:
        """The next output of a filter, whose state is kept under ``name``; it starts at rest on its first value."""
        if spec is None:
            return value
        fs, cutoff, order = spec
        sos, x = kernels.butter_sos(order, cutoff, fs), np.array([[value]])
        z = self.state["filters"].get(name)
        y, z = kernels.sos_run(sos, x, np.array(z) if z is not None else kernels.sos_rest(sos)[:, :, None] * x[0])
        self.state["filters"][name] = z.tolist()
        return float(y[0, 0])

    def sample(self, now: int) -> dict[str, float] | None:
        """Every stream's value at ``now``; None if one has no sample within its tolerance."""
        out = {}
        for topic, s in self.streams.items():
            rows = self.state["buffers"][topic]
            if s.method == "hold":
                fits = [(ts, -i) for i, (ts, _) in enumerate(rows[::-1]) if ts <= now]
                best = max(fits, default=None)
                best = None if best is None else rows[::-1][-best[1]]
            else:
                best = min(rows, key=lambda r: (abs(r[0] - now), r[0]), default=None)
            if best is None or abs(best[0] - now) > s.tolerance_ns:
                return None
            out[topic] = best[1]
        # a tick that gives no frame does not move the filters
        return {topic: self._smooth(f"{TICK}:{topic}", self.streams[topic].tick_filter, v) for topic, v in out.items()}


SCHEMA = "scope long, ts long, frame map<string,double>"
STATE = "json string"


def _feed(aligner: Aligner, rows: pd.DataFrame, strict: bool) -> list[tuple[int, dict]]:
    out = []
    # at one time ticks come first: a tick sees what was there before it
    for r in rows.assign(_m=rows.topic != TICK).sort_values(["ts", "_m", "seq"], kind="stable").itertuples():
        if r.topic == TICK:
            if (found := aligner.sample(int(r.ts))) is not None:
                out.append((int(r.ts), found))
        else:
            aligner.push(r.topic, int(r.ts), float(r.value), strict)
    return out


def align_stream(rows: DataFrame, streams: tuple[Online, ...], strict: bool = True) -> DataFrame:
    """``scope, ts, frame`` of a streaming frame ``scope, topic, ts, seq, value``; buffers and filters live in the state."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        aligner = Aligner(streams, json.loads(state.get[0]) if state.exists else None)
        found = _feed(aligner, pd.concat(list(batches)), strict)
        state.update((json.dumps(aligner.state),))
        yield pd.DataFrame({"scope": [key[0]] * len(found), "ts": [t for t, _ in found], "frame": [f for _, f in found]})

    return rows.groupBy("scope").applyInPandasWithState(step, SCHEMA, STATE, "append", GroupStateTimeout.NoTimeout)


def replay(messages: DataFrame, streams: tuple[Online, ...], step_ns: int, slice_ns: int | None = None) -> DataFrame:
    """The same over recorded messages: ticks from each scope's first message on, unknown topics ignored.

    A tick comes before messages of its time. ``slice_ns`` cuts the time of a scope, see ``asof``.
    """
    rows = messages.select("scope", "topic", "ts", "seq", "value")
    spans = rows.groupBy("scope").agg(F.min("ts").alias("start_ns"), F.max("ts").alias("end_ns"))
    ticks = asof.timeline(spans, "scope", step_ns)
    if any(s.filter or s.tick_filter for s in streams):
        both = rows.union(ticks.select("scope", F.lit(TICK).alias("topic"), "ts", F.lit(-1).cast("long").alias("seq"), F.lit(0.0).alias("value")))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            found = _feed(Aligner(streams), pdf, False)
            return pd.DataFrame({"scope": [pdf.scope.iloc[0]] * len(found), "ts": [t for t, _ in found], "frame": [f for _, f in found]})

        return both.groupBy("scope").applyInPandas(run, SCHEMA)
    # of samples at one time hold takes the last, nearest the first that is still buffered
    first = Window.partitionBy("scope", "topic", "ts").orderBy("seq").rowsBetween(1 - CAPACITY, 0)
    own = {}
    for i, s in enumerate(streams):
        mine = rows.where(F.col("topic") == s.topic)
        own[f"s{i}"] = mine.withColumn("value", F.first("value").over(first)) if s.method == "nearest" else mine
    before = ticks.withColumn("ts", F.col("ts") - 1)  # what came strictly before the tick
    found = asof.held(before, own, "scope", {f"s{i}": s.tolerance_ns - 1 for i, s in enumerate(streams)}, slice_ns)
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in own])
    frame = F.map_from_arrays(F.array(*[F.lit(s.topic) for s in streams]), F.array(*map(F.col, own)))
    return found.where(whole).select(F.col("scope").cast("long").alias("scope"), (F.col("ts") + 1).alias("ts"), frame.alias("frame"))
