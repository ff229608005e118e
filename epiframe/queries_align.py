"""Queries on timelines, as-of joins and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from epiframe.operators import asof
from epiframe.registry import query
from epiframe.sources import tables

HOUR = 3600 * asof.NS
STEP = 6 * HOUR
#: Windows see ten days of one scope.
SLICE = 10 * 24 * HOUR

SQL_GRID = f"""
m AS (SELECT user_id AS scope, event_type AS topic, event_id AS seq, epoch_us(ts) * 1000 AS ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
s AS (SELECT scope, min(ts) AS a, max(ts) AS b FROM m GROUP BY scope),
g AS (SELECT scope, unnest(range(0, (b - a) // {STEP} + 1)) AS frame, a FROM s),
grid AS (SELECT scope, frame, a + frame * {STEP} AS ts FROM g)"""


def grid(spark, sf_dir):
    return asof.timeline(tables.spans(tables.messages(spark, sf_dir)), "scope", STEP)


def stream(spark, sf_dir, name):
    return tables.topic(tables.messages(spark, sf_dir), name)


@query(f"WITH {SQL_GRID} SELECT scope, frame, ts FROM grid")
def timeline(spark, sf_dir):
    """Reference timelines."""
    return grid(spark, sf_dir)


def _sql_side(op: str, tolerance_h: int | None) -> str:
    ok = "true" if tolerance_h is None else f"abs(grid.ts - v.ts) <= {tolerance_h * HOUR}"
    return f"""WITH {SQL_GRID}, v AS (SELECT * FROM m WHERE topic = 'view')
SELECT grid.scope, grid.frame, CASE WHEN {ok} THEN v.ts END AS sample_ts, CASE WHEN {ok} THEN v.value END AS value
FROM grid ASOF LEFT JOIN v ON grid.scope = v.scope AND grid.ts {op} v.ts"""


@query(_sql_side(">=", 24))
def asof_hold(spark, sf_dir):
    """The last sample at or before each grid time, 24 hours back at most."""
    return asof.asof(grid(spark, sf_dir), stream(spark, sf_dir, "view"), "scope", ["value"], "backward", 24 * HOUR, SLICE).select("scope", "frame", "sample_ts", "value")


@query(_sql_side(">=", None))
def asof_hold_unlimited(spark, sf_dir):
    """The last sample at or before each grid time, however old."""
    return asof.asof(grid(spark, sf_dir), stream(spark, sf_dir, "view"), "scope", ["value"], "backward", None, SLICE).select("scope", "frame", "sample_ts", "value")


@query(_sql_side("<=", 24))
def asof_forward(spark, sf_dir):
    """The first sample at or after each grid time, 24 hours ahead at most."""
    return asof.asof(grid(spark, sf_dir), stream(spark, sf_dir, "view"), "scope", ["value"], "forward", 24 * HOUR, SLICE).select("scope", "frame", "sample_ts", "value")


_BOTH = f"""WITH {SQL_GRID}, v AS (SELECT * FROM m WHERE topic = 'view'),
b AS (SELECT grid.scope, grid.frame, grid.ts, CASE WHEN grid.ts - v.ts <= {24 * HOUR} THEN v.ts END AS bt, CASE WHEN grid.ts - v.ts <= {24 * HOUR} THEN v.value END AS bv
      FROM grid ASOF LEFT JOIN v ON grid.scope = v.scope AND grid.ts >= v.ts),
f AS (SELECT b.*, CASE WHEN v.ts - b.ts <= {24 * HOUR} THEN v.ts END AS ft, CASE WHEN v.ts - b.ts <= {24 * HOUR} THEN v.value END AS fv
      FROM b ASOF LEFT JOIN v ON b.scope = v.scope AND b.ts <= v.ts)"""


@query(_BOTH + " SELECT scope, frame, CASE WHEN bt IS NOT NULL AND (ft IS NULL OR ts - bt <= ft - ts) THEN bt ELSE ft END AS sample_ts, CASE WHEN bt IS NOT NULL AND (ft IS NULL OR ts - bt <= ft - ts) THEN bv ELSE fv END AS value FROM f")
def asof_nearest(spark, sf_dir):
    """The nearest sample within 24 hours, the earlier one on ties."""
    return asof.nearest(grid(spark, sf_dir), stream(spark, sf_dir, "view"), "scope", ["value"], 24 * HOUR, SLICE).select("scope", "frame", "sample_ts", "value")


@query(_BOTH + " SELECT scope, frame, round(CASE WHEN bt IS NULL THEN fv WHEN ft IS NULL OR ft = bt THEN bv ELSE bv + (fv - bv) * ((ts - bt)::DOUBLE / (ft - bt)) END, 6) AS value FROM f")
def asof_linear(spark, sf_dir):
    """Interpolation within 24 hours, one side alone where the other is too far."""
    return asof.linear(grid(spark, sf_dir), stream(spark, sf_dir, "view"), "scope", ["value"], 24 * HOUR, SLICE).select("scope", "frame", F.round("value", 6).alias("value"))


@query(f"WITH {SQL_GRID} SELECT grid.scope, grid.frame, m.topic, m.value FROM grid LEFT JOIN m ON grid.scope = m.scope AND grid.ts = m.ts")
def asof_none(spark, sf_dir):
    """Samples at the grid time itself."""
    return asof.exact(grid(spark, sf_dir), tables.messages(spark, sf_dir), "scope", ["topic", "value"]).select("scope", "frame", "topic", "value")


def _held(name: str) -> str:
    return f"SELECT grid.scope, grid.frame, CASE WHEN grid.ts - v.ts <= {24 * HOUR} THEN v.value END AS {name} FROM grid ASOF LEFT JOIN (SELECT * FROM m WHERE topic = '{name}') v ON grid.scope = v.scope AND grid.ts >= v.ts"


@query(f"""WITH {SQL_GRID}, v AS ({_held("view")}), c AS ({_held("click")})
SELECT scope, count(*) AS n_frames, round(avg(view), 6) AS mean_view, round(avg(click), 6) AS mean_click FROM v JOIN c USING (scope, frame) WHERE view IS NOT NULL AND click IS NOT NULL GROUP BY scope""")
def asof_hold_summary(spark, sf_dir):
    """Two held streams on one grid, frames with a missing stream dropped, per-scope means."""
    streams = {n: (stream(spark, sf_dir, n).withColumnRenamed("value", "values"), "hold", 24 * 3600 * 1000) for n in ("view", "click")}
    frames = asof.align_all(grid(spark, sf_dir), streams, "scope", SLICE).dropna(subset=["view", "click"])
    return frames.groupBy("scope").agg(F.count("*").alias("n_frames"), F.round(F.avg("view"), 6).alias("mean_view"), F.round(F.avg("click"), 6).alias("mean_click"))


_TYPES = ["view", "click", "purchase", "signup", "error"]


@query(f"WITH {SQL_GRID}, " + ", ".join(f"s_{t} AS ({_held(t)})" for t in _TYPES) + " SELECT scope, frame, view, click, purchase, signup, error FROM s_view JOIN s_click USING (scope, frame) JOIN s_purchase USING (scope, frame) JOIN s_signup USING (scope, frame) JOIN s_error USING (scope, frame)")
def multi_stream_merge(spark, sf_dir):
    """All five streams held onto the grid."""
    streams = {t: (stream(spark, sf_dir, t).withColumnRenamed("value", "values"), "hold", 24 * 3600 * 1000) for t in _TYPES}
    return asof.align_all(grid(spark, sf_dir), streams, "scope", SLICE).select("scope", "frame", *_TYPES)


@query("WITH m AS (SELECT user_id AS scope, event_type AS topic, event_id AS seq, epoch_us(ts) * 1000 AS ts, value FROM events) SELECT scope, seq, ts, value FROM m WHERE topic = 'click' AND ts BETWEEN 1704499200000000000 AND 1706745600000000000")
def topic_scan(spark, sf_dir):
    """One topic in a time window."""
    return tables.topic(tables.messages(spark, sf_dir), "click", 1704499200000000000, 1706745600000000000).select("scope", "seq", "ts", "value")


_CHUNKS = """WITH m AS (SELECT user_id AS scope, event_type AS topic, ts AS t, epoch_us(ts) * 1000 AS ts FROM events),
c AS (SELECT scope, topic, strftime(t, '%Y%m') AS chunk, min(ts) AS start_ns, max(ts) AS end_ns, count(*) AS message_count FROM m GROUP BY ALL)"""


@query(_CHUNKS + " SELECT * FROM c WHERE end_ns >= 1704499200000000000 AND start_ns <= 1706745600000000000")
def chunk_skipping(spark, sf_dir):
    """Chunks that may hold messages of a window."""
    return tables.overlapping(tables.chunks(tables.messages(spark, sf_dir)), 1704499200000000000, 1706745600000000000)
