import pytest

from epiframe import contract as C
from epiframe.operators import asof, kernels
from epiframe.plans.frames import build_frames
from epiframe.streaming import live


def test_buffer_rules():
    a = live.Aligner((live.Online("x", "hold", 50), live.Online("y", "nearest", 50)))
    a.push("x", 100, 1.0)
    assert a.sample(120) is None
    a.push("y", 100, 1.0)
    a.push("y", 200, 2.0)
    assert a.sample(150) == {"x": 1.0, "y": 1.0}  # the earlier of two, the bound included
    assert a.sample(151) is None
    a.push("x", 90, 9.0)  # out of order: the largest time at or before now counts
    assert a.sample(110) == {"x": 1.0, "y": 1.0}
    for i in range(live.CAPACITY):
        a.push("x", 1000 + i, float(i))
    assert len(a.state["buffers"]["x"]) == live.CAPACITY and a.sample(110) is None
    with pytest.raises(KeyError):
        a.push("z", 1, 1.0)
    a.push("z", 1, 1.0, strict=False)
    for bad in ({"tolerance_ns": 0}, {"method": "linear"}):
        with pytest.raises(ValueError):
            live.Online("x", **bad)


def rows(spark):
    data = [(s, t, ts, i, float(ts % 97)) for s in (1, 2) for t in ("x", "y") for i, ts in enumerate(range(10 * s, 600, 13 if t == "x" else 29))]
    return spark.createDataFrame(data, "scope long, topic string, ts long, seq long, value double")


STREAMS = (live.Online("x", "hold", 40), live.Online("y", "hold", 40, (50.0, 3.0, 2)))


def test_streaming_equals_replay(spark, tmp_path):
    m = rows(spark)
    want = {(r.scope, r.ts): r.frame for r in live.replay(m, STREAMS, 20).collect()}
    assert len(want) > 40
    ticks = [(s, "tick", ts, -1, 0.0) for s in (1, 2) for ts in range(10 * s, 600, 20)]
    both = m.union(spark.createDataFrame(ticks, m.schema))
    for k, (lo, hi) in enumerate(((0, 200), (200, 400), (400, 700))):  # three micro-batches: buffers and filters go on in the state
        both.where(f"ts >= {lo} AND ts < {hi}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{k}")
    source = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = live.align_stream(source, STREAMS).writeStream.format("memory").queryName("aligned").option("checkpointLocation", f"{tmp_path}/ck").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.scope, r.ts): r.frame for r in spark.table("aligned").collect()}
    assert got.keys() <= want.keys() | got.keys() and {k: got[k] for k in want if k in got} == {k: want[k] for k in want if k in got} and set(want) == {k for k in got if k in want}


def test_replay_sees_strictly_earlier_samples(spark):
    m = spark.createDataFrame([(1, "x", 0, 0, 5.0), (1, "x", 20, 1, 6.0)], "scope long, topic string, ts long, seq long, value double")
    got = {r.ts: r.frame["x"] for r in live.replay(m, (live.Online("x", "hold", 100),), 20).collect()}
    assert got == {20: 5.0}


def test_frames_skip_an_episode_that_a_transform_refuses(spark):
    text = """
fps: 10
observations:
  - {key: observation.state, topic: x, type: std_msgs/Float64, align: {method: hold, tolerance_ms: 150}}
actions:
  - {key: action, topic: y, type: std_msgs/Float64, align: {method: hold, tolerance_ms: 150}, transforms: [{type: butterworth_lowpass_causal, stage: post, cutoff_hz: 2}]}
"""
    c, ms = C.parse(text), 1_000_000
    data = [(s, t, i * 100 * ms, i, float(i)) for s in ("a", "b") for t in ("x", "y") for i in range(30) if not (s == "b" and t == "y" and 10 < i < 20)]
    m = spark.createDataFrame(data, "scope string, topic string, ts long, seq long, data double")
    e = spark.createDataFrame([(0, "a", 0, 2900 * ms), (1, "b", 0, 2900 * ms)], "episode long, scope string, start_ns long, end_ns long")
    out = build_frames(m, e, c)
    got = out.frames.orderBy("frame").collect()
    assert {r.episode for r in got} == {0} and len(got) == 30 and [r.observation_state[0] for r in got] == [float(i) for i in range(30)]
    import numpy as np

    assert np.allclose([r.action[0] for r in got], kernels.lowpass_causal(np.arange(30.0)[:, None], 10, 2)[:, 0], atol=1e-5)
    assert [(r.episode, r.error_class) for r in out.skipped.collect()] == [(1, "ValueError")]


def test_slices_do_not_change_frames(spark):
    m = rows(spark)
    g = asof.timeline(spark.createDataFrame([(1, 0, 600), (2, 0, 600)], "scope long, start_ns long, end_ns long"), "scope", 7)
    whole = asof.nearest(g, m.where("topic = 'y'"), "scope", ["value"], 20).collect()
    cut = asof.nearest(g, m.where("topic = 'y'"), "scope", ["value"], 20, 50).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, cut))
