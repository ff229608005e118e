import numpy as np
import pytest
from pyspark.sql import functions as F

from epiframe.contract import Transform
from epiframe.operators import dataset, episodes
from epiframe.operators.transforms import transform

S = 1_000_000_000


def test_monotonic(spark):
    rng = np.random.default_rng(0)
    rows = [(k, i, int(t)) for k in range(20) for i, t in enumerate(rng.integers(0, 15, 12))]
    got = {(r.k, r.seq) for r in episodes.keep_monotonic(spark.createDataFrame(rows, "k long, seq long, ts long"), ["k"]).collect()}
    assert got == {(k, i) for k, i, t in rows if all(t <= u for kk, j, u in rows if kk == k and j > i)}


def test_subtasks(spark):
    e = spark.createDataFrame([(0, 1000 * S, 20), (1, 0, 5)], "episode long, start_ns long, n_frames long")
    w = [("g", "grasp", 0.5, 1.0), ("s", "slip", 0.7, 0.8), ("l", "lift", 1.5, 99.0), ("z", "zero", 0.3, 0.3)]
    w = spark.createDataFrame([(0, i, n, int((1000 + a) * S), int((1000 + b) * S)) for i, n, a, b in w], "episode long, event_id string, name string, start_ns long, end_ns long")
    frames, dropped = episodes.subtask_frames(e, w, S // 10)
    assert [r.name for r in frames.where("episode = 0").orderBy("frame").collect()] == [None] * 5 + ["grasp"] * 2 + ["slip"] + ["grasp"] * 2 + [None] * 5 + ["lift"] * 5
    assert [r.event_id for r in dropped.collect()] == ["z"]
    seg = [(r.start_frame, r.content) for r in episodes.segments(frames).orderBy("start_frame").collect()]
    assert seg == [(0, "no_subtask"), (5, "grasp"), (7, "slip"), (8, "grasp"), (10, "no_subtask"), (15, "lift")]


def test_dedup_keeps_nulls_apart(spark):
    t = spark.createDataFrame([("a", "x", 1, 2, None, 9), ("a", "x", 1, 2, None, 3), ("a", "x", 1, 2, 5, 4), ("a", "x", 1, None, 5, 7)], "scope string, name string, start_ns long, end_ns long, message_count long, file_id long")
    kept, dropped = episodes.dedup_topics(t)
    assert sorted(r.file_id for r in kept.collect()) == [3, 4, 7]
    assert [(r.file_id, r.kept_file_id) for r in dropped.collect()] == [(9, 3)]
    assert tuple(episodes.dedup_rollup(dropped).first()) == (1, 1, 1)


def test_pairs():
    assert episodes.pair_dims(["observation.state.a", "observation.state.b"], ["action.b", "action.c"]) == ("name", [("observation.state.b", "action.b")])
    assert episodes.pair_dims(["left/arm.j1", "j2"], ["arm.j1", "x.j2"]) == ("name", [("left/arm.j1", "arm.j1"), ("j2", "x.j2")])
    assert episodes.pair_dims(["p", "q"], ["r", "s", "t"]) == ("position", [("p", "r"), ("q", "s")])
    assert episodes.pair_dims([], ["r"]) == ("none", [])


def test_routing_and_tasks(spark):
    e = spark.createDataFrame([(1, ["d1", "d2"]), (2, [])], "event long, dataset_ids array<string>")
    assert [(r.event, r.scope) for r in episodes.with_scope(e).collect()] == [(1, "d1")]
    ep = spark.createDataFrame([(1, "s", 0, 10, ""), (2, "s", 20, 30, None), (3, "s", 0, 10, "own")], "episode long, scope string, start_ns long, end_ns long, label string")
    t = spark.createDataFrame([("s", 10, 1, "late"), ("s", 10, 0, "first"), ("s", 31, 0, "out")], "scope string, ts long, seq long, data string")
    assert {r.episode: r.task for r in episodes.task_labels(ep, t).collect()} == {1: "first", 2: "default", 3: "own"}


def test_shards():
    plan = dataset.plan_shards([10, 9, 8, 7, 6, 5, 4, 3], 2)
    frames = [10, 9, 8, 7, 6, 5, 4, 3]
    loads = [sum(frames[i] for i in p) for p in plan]
    assert abs(loads[0] - loads[1]) <= 10 and sorted(i for p in plan for i in p) == list(range(8))
    assert plan[0][0] == 0 and plan[1][0] != 1
    with pytest.raises(ValueError):
        dataset.plan_shards([1], 0)
    assert dataset.pack([3, 4, 3, 10, 1], 10) == [0, 0, 1, 2, 3]


def frames(spark, n=3, first=0):
    rows = [(e + first, f, float(f), [float(e), 1.0], [float(f), 2.0]) for e in range(n) for f in range(3 + 2 * e)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, timestamp float, state array<float>, action array<float>")


def test_layouts_round_trip(spark, tmp_path):
    f = frames(spark)
    dataset.write_packed(f, f"{tmp_path}/a", 10, {"action": {"dtype": "float32"}})
    dataset.convert_layout(spark, f"{tmp_path}/a", f"{tmp_path}/b", "v2.1")
    dataset.convert_layout(spark, f"{tmp_path}/b", f"{tmp_path}/c", "v3.0")
    key = lambda d: sorted(map(repr, d.select(*f.columns).collect()))
    for p, v in (("a", "v3.0"), ("b", "v2.1"), ("c", "v3.0")):
        got, info = dataset.read_dataset(spark, f"{tmp_path}/{p}")
        assert key(got) == key(f) and info["codebase_version"] == v and info["fps"] == 10
    dataset.write_packed(f, f"{tmp_path}/d", 10, {"cam": {"dtype": "image"}})
    with pytest.raises(ValueError, match="pictures"):
        dataset.convert_layout(spark, f"{tmp_path}/d", f"{tmp_path}/e", "v2.1")
    dataset.write_info(f, f"{tmp_path}/f", {"codebase_version": "v1"})
    with pytest.raises(ValueError, match="v1"):
        dataset.read_info(spark, f"{tmp_path}/f")


def test_sharded_union_is_the_single_run(spark):
    def shard(n, first):
        f = frames(spark, n, first)
        e = f.groupBy("episode_index").agg(F.count("*").alias("length")).withColumn("task", F.lit(f"t{first % 2}"))
        return f, e

    merged, eps, tasks = dataset.merge([shard(2, 0), shard(3, 5), shard(1, 0)])
    assert [(r.episode_index, r.length, r.from_index, r.source_shard, r.source_episode) for r in eps.orderBy("episode_index").collect()] == [(0, 3, 0, 0, 0), (1, 5, 3, 0, 1), (2, 3, 8, 1, 5), (3, 5, 11, 1, 6), (4, 7, 16, 1, 7), (5, 3, 23, 2, 0)]
    assert [r["index"] for r in merged.orderBy("episode_index", "frame_index").collect()] == list(range(26))
    assert {r.task: r.task_index for r in tasks.collect()} == {"t0": 0, "t1": 1}
    empty = spark.createDataFrame([], eps.select(F.col("episode_index"), "length", "task").schema)
    with pytest.raises(ValueError, match="none of"):
        dataset.merge([(frames(spark, 1), empty)])


def test_cache_and_enrich(spark):
    want = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "slot long, key string")
    hits, misses = dataset.missing_keys(want, spark.createDataFrame([("b",), ("b",)], "key string"))
    assert [(r.slot, r.key) for r in hits.collect()] == [(2, "b")] and [(r.slot, r.key) for r in misses.collect()] == [(1, "a")]
    e = dataset.enrich(frames(spark))
    assert e.schema["action_minus_state"].dataType == e.schema["action"].dataType and e.where("episode_index = 1 AND frame_index = 2").first().action_minus_state == [1.0, 1.0]


def test_transform_errors_are_rows(spark):
    rows = [(0, t * 10, t, [float(t)]) for t in range(40)] + [(1, t * 10, t, [1.0]) for t in range(3)] + [(2, t, t, None if t == 1 else [1.0]) for t in range(30)]
    s = spark.createDataFrame(rows, "ep long, ts long, seq long, `values` array<double>")
    good, bad = transform(s, "ep", [Transform("butterworth_lowpass", params={"cutoff_hz": 1e6})])
    assert {r.ep for r in good.collect()} == {0} and {r.ep for r in bad.collect()} == {1, 2}
    _, bad = transform(s.where("ep = 0"), "ep", [Transform("butterworth_lowpass", params={"cutoff_hz": 1e9})])
    assert "half the sampling rate" in bad.first().error
