"""Contracts for nodes, datasets of one episode, archives, pictures, metadata and the metric registry."""

import hashlib
import json

import numpy as np
import pytest

from epiframe import contract as C
from epiframe.functions import pictures
from epiframe.functions.decoders import depth_to_gray
from epiframe.operators import dataset, kernels, layouts, manifests
from epiframe.operators.episodes import within
from epiframe.plans import audit as A
from epiframe.sources import catalog, files
from epiframe.sources.shared import discard, new_path, staged


def stream(key="observation.state", kind="sensor_msgs/JointState", method="hold", transforms=(), names=("a",), topic="/t"):
    return C.Stream(key=key, type=kind, align=C.Align(method), topic=topic, names=names, transforms=transforms)


def make(observations=(), videos=(), actions=()):
    return C.Contract("n", 1, 10.0, None, 0, tuple(observations), tuple(videos), tuple(actions), ())


def causal(stage, **params):
    return C.Transform("butterworth_lowpass_causal", stage, params)


def test_node_refusals():
    assert C.node_refusals(make([stream()], [stream("v", "sensor_msgs/CompressedImage")], [stream("action", method="linear", transforms=(causal("pre"),))])) == []
    cases = [
        (make([stream(method="linear")]), "hold or nearest"),
        (make([stream(transforms=(C.Transform("butterworth_lowpass", "pre", {}),))]), "later samples"),
        (make([stream(transforms=(causal("pre"),))]), "must declare fs_hz"),
        (make([stream(transforms=(causal("post", fs_hz=20),))]), "must be the contract's"),
        (make([], [stream("v", "sensor_msgs/CompressedImage", transforms=(causal("post"),))]), "no transforms on videos"),
        (make([], [stream("v", "video")]), "do not come online"),
        (make([stream(kind="no/Such")]), "do not come online"),
        (make(actions=[stream("action", "std_msgs/String")]), "no encoder"),
        (make(actions=[stream("action"), stream("action", names=(), topic="/u")]), "must select names"),
    ]
    for c, what in cases:
        found = C.node_refusals(c)
        assert len(found) == 1 and what in found[0], (what, found)
    assert C.node_refusals(make([stream(transforms=(causal("pre", fs_hz=50), causal("post", fs_hz=10)))])) == []


def test_a_contract_that_a_node_takes_runs_online():
    for c in (make([stream()]), make([stream(transforms=(causal("pre", fs_hz=50),))])):
        assert not C.node_refusals(c)
        C.check_online(c)


def test_concat_spec():
    c = make([stream(names=("a", "b")), stream(topic="/u", names=()), stream("other")], actions=[stream("action", names=())])
    assert C.concat_spec(c, {"observation.state.u": 2}, "observation.state") == (4, ["a", "b", "observation.state.u.0", "observation.state.u.1"])
    assert C.concat_spec(c, {}, "observation.state") == (2, ["a", "b"])
    assert C.concat_spec(c, {}, "action", action=True) is None


def test_archive_contract(spark, tmp_path):
    raw = "name: é\n".encode()
    ref = catalog.archive_contract(spark, raw, f"file://{tmp_path}/out")
    assert (tmp_path / "out" / "contract.yaml").read_bytes() == raw and ref["sha256"] == hashlib.sha256(raw).hexdigest()


def test_merge_options_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("EPIFRAME_CHUNK_SIZE", "7")
    assert catalog.merge_sizes({"data_files_size_in_mb": ""}) == {"chunk_size": 7}
    for raw in ('["a/b"]', '[" "]', "[]", '["a", 3]', '"a"', "nope", '["/"]'):
        with pytest.raises(ValueError, match="bare names"):
            catalog.shard_ids(raw)


def test_datasets_of_one_episode(spark, tmp_path):
    out = dataset.EpisodeDatasets(spark, f"file://{tmp_path}/d", 10.0)
    frames = spark.createDataFrame([(0, 1.0), (1, 2.0)], "frame_index long, x double")
    out.add_frames(frames)
    first = out.finish_episode("lift")
    out.add_frames(frames)
    out.discard_episode()
    out.add_frames(frames.limit(1))
    last = out.finish_episode()
    with pytest.raises(ValueError, match="needs a frame"):
        out.finish_episode()
    assert first.endswith("episode-0000") and last.endswith("episode-0002")
    assert sorted(p.name for p in (tmp_path / "d").iterdir()) == ["episode-0000", "episode-0002"]
    assert dataset.read_dataset(spark, first)[0].count() == 2 and dataset.read_dataset(spark, last)[0].count() == 1


@pytest.mark.parametrize("version", ["v2.1", "v3.0"])
def test_whole_layouts(spark, tmp_path, version):
    rows = [(0, 0, 0, [1.0, 5.0]), (0, 1, 0, [3.0, 5.0]), (1, 0, 1, [7.0, 8.0])]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, task_index long, state array<double>")
    tasks = spark.createDataFrame([(0, "lift"), (1, "put")], "task_index long, task string")
    root, out = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    layouts.write_dataset(frames, tasks, root, "v3.0", 10.0, {}, ["state"])
    layouts.convert(spark, root, out, version)
    eps, tasks, stats = layouts.read_meta(spark, out, version)
    assert sorted((r.episode_index, r.length, list(r.tasks)) for r in eps.collect()) == [(0, 2, ["lift"]), (1, 1, ["put"])]
    assert sorted((r.task_index, r.task) for r in tasks.collect()) == [(0, "lift"), (1, "put")]
    found = {r.episode_index: r for r in stats.collect()}
    assert (found[0].min, found[0].max, found[0].mean, found[0].std, found[0]["count"]) == ([1.0, 5.0], [3.0, 5.0], [2.0, 5.0], [1.0, 0.0], 2)
    assert dataset.read_info(spark, out)["codebase_version"] == version


def test_copied_files(spark, tmp_path):
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "a.PNG").write_bytes(b"x")
    assert [bytes(r.data) for r in layouts.copied_files(spark, f"file://{tmp_path}", "images").collect()] == [b"x"]
    (tmp_path / "images" / "b.sh").write_bytes(b"y")
    with pytest.raises(Exception, match="not a picture"):
        layouts.copied_files(spark, f"file://{tmp_path}", "images").collect()
    for bad in ("/etc", "images/../.."):
        with pytest.raises(ValueError, match="leaves"):
            layouts.copied_files(spark, f"file://{tmp_path}", bad)


def test_manifest_document(spark, tmp_path):
    one = {"total_episodes": 2, "contract": {"name": "c", "sha256": "s"}, "episodes_per_dataset": {"d": 2}, "source_datasets": ["d"], "episode_to_event": [{"episode_index": i, "event": f"e{i}"} for i in range(2)], "skipped": [{"event": "x"}]}
    shards = spark.createDataFrame([(0, json.dumps(one), 2), (1, None, 3), (2, json.dumps(one), 2)], "shard int, manifest string, total_episodes long")
    found = manifests.write_document(shards, f"file://{tmp_path}/m")
    assert found["total_episodes"] == 7 and found["shards_with_manifest"] == 2 and found["episodes_per_dataset"] == {"d": 4} and found["contract"]["name"] == "c"
    assert json.loads((tmp_path / "m" / "manifest.json").read_text())["source_datasets"] == ["d"]
    assert sorted(r.episode_index for r in spark.read.json(f"file://{tmp_path}/m/episode_to_event.jsonl").collect()) == [0, 1, 5, 6]
    assert spark.read.json(f"file://{tmp_path}/m/skipped.jsonl").count() == 2


def test_resize_equals_the_formula():
    rng = np.random.default_rng(1)
    px = rng.integers(0, 256, (5, 4, 3)).astype(np.uint8)
    got = pictures.resize(px, 7, 9)
    for i in range(7):
        for j in range(9):
            y, x = min(max((i + 0.5) * 5 / 7 - 0.5, 0), 4), min(max((j + 0.5) * 4 / 9 - 0.5, 0), 3)
            a, b = min(int(y), 3), min(int(x), 2)
            u, v = y - a, x - b
            want = (1 - u) * ((1 - v) * px[a, b] + v * px[a, b + 1]) + u * ((1 - v) * px[a + 1, b].astype(float) + v * px[a + 1, b + 1])
            assert np.abs(got[i, j] - want).max() <= 0.5 + 1e-9
    assert pictures.resize(px, 5, 4) is px and pictures.resize(px[:1, :1], 2, 2).shape == (2, 2, 3)


def test_depth_policies():
    d = [0.0, np.nan, 5.0, 20.0, 50.0]
    for policy, byte in (("near", 0), ("far", 255), ("zero", 0), (25.0, 128)):
        assert depth_to_gray(d, 10, 40, policy).tolist() == [byte, byte, 0, 85, 255]


def test_filter_blocks_equal_a_plain_recursion():
    rng = np.random.default_rng(2)
    for order in (1, 2, 3, 5):
        sos = kernels.butter_sos(order, 3.0, 50.0)
        for n in (1, 2, 63, 64, 65, 300):
            x = rng.normal(size=(n, 3))
            state = rng.normal(size=(len(sos), 2, 3))
            y, z = x.copy(), state.copy()
            for t in range(n):
                v = y[t]
                for k, (b0, b1, b2, _, a1, a2) in enumerate(sos):
                    out = b0 * v + z[k, 0]
                    z[k, 0], z[k, 1] = b1 * v - a1 * out + z[k, 1], b2 * v - a2 * out
                    v = out
                y[t] = v
            got, end = kernels.sos_run(sos, x, state)
            assert np.allclose(got, y, atol=1e-10) and np.allclose(end, z, atol=1e-10)


def test_within_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    windows = [(int(rng.integers(3)), i, int(a), int(a + rng.integers(-5, 400))) for i, a in enumerate(rng.integers(0, 1000, 60))]
    points = [(int(rng.integers(3)), int(t)) for t in rng.integers(-50, 1500, 300)]
    w, p = spark.createDataFrame(windows, "scope long, id long, lo long, hi long"), spark.createDataFrame(points, "scope long, ts long")
    got = sorted((r.id, r.ts) for r in within(p, w, "scope", "ts", "lo", "hi").collect())
    assert got == sorted((i, t) for s, i, a, b in windows for q, t in points if q == s and a <= t <= b)
    assert within(p, w.limit(0), "scope", "ts", "lo", "hi").count() == 0


def test_a_users_metric_and_one_that_fails_in_a_task(spark):
    frames = spark.createDataFrame([(e, f, [float(f % 7), float(f)], [float(f * e)]) for e in range(3) for f in range(20)], "episode long, frame long, state array<double>, action array<double>")

    def broken(x):
        return {"broken": x.frames.selectExpr("episode", "raise_error('in a task') AS bad")}

    A.register_metric("long", "long_flags")(lambda x: {"long_flags": x.frames.groupBy("episode").count().selectExpr("episode", "count > 10 AS is_long")})
    A.register_metric("broken")(broken)
    try:
        found = A.audit(frames, 10.0, 2, 1, [(0, 0)], ["broken", "long"])
    finally:
        del A.METRICS["long"], A.METRICS["broken"]
        A.FLAGGED.remove("long_flags")
    assert set(found.errors) == {"broken"} and {r.episode: r.flags for r in found.flags.collect()} == {e: ["is_long"] for e in range(3)}


def test_staged_and_discard(spark):
    t = staged(spark.range(5), "t")
    assert t.count() == 5
    discard(t)
    again = staged(spark.range(2), "t")
    assert again.count() == 2 and new_path(spark, "t") != new_path(spark, "t")


@pytest.mark.parametrize("version", ["v2.1", "v3.0"])
def test_drop_episodes(spark, tmp_path, version, capsys):
    from epiframe import __main__
    from epiframe.operators import metrics

    rows = [(e, f, 10 * e + f, float(e)) for e in range(5) for f in range(e + 1)]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, index long, x double")
    root = f"file://{tmp_path}/d"
    {"v2.1": dataset.write_by_episode, "v3.0": dataset.write_packed}[version](frames, root, 10.0)
    said = metrics.cleanup_command(root, [3, 1, 3])
    assert said == f'python -m epiframe drop-episodes {root} --episodes "[1, 3]"' and metrics.cleanup_command(root, []) is None
    __main__.main(["drop-episodes", root, "--episodes", "[1, 3]"])
    assert "3 episodes" in capsys.readouterr().out
    back, info = dataset.read_dataset(spark, root + "-kept")
    got = sorted((r.episode_index, r.frame_index, r["index"], r.x) for r in back.collect())
    assert info["codebase_version"] == version and [g[2] for g in got] == list(range(9)) and [g[3] for g in got] == [0.0, *[2.0] * 3, *[4.0] * 5]
    with pytest.raises(ValueError, match="no episode is left"):
        dataset.drop_episodes(spark, root, f"file://{tmp_path}/none", list(range(5)))


def test_picture_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for name, data in (("cam_100.jpg", b"a"), ("cam_200.jpeg", b"b"), ("300.PNG", b"c"), ("400.png", b""), ("500.txt", b"d"), ("noname.png", b"e")):
        (tmp_path / "p" / name).write_bytes(data)
    found = sorted((r.ts, r.format, bytes(r.data)) for r in files.picture_files(spark, f"file://{tmp_path}/p").collect())
    assert found == [(100, "jpeg", b"a"), (200, "jpeg", b"b"), (300, "png", b"c")]
    refs = spark.createDataFrame([("e1", "/b"), ("e1", "/a"), ("e2", "/a"), ("e1", "/a")], "association string, path string")
    assert {r.association: r.paths for r in files.by_association(refs).collect()} == {"e1": ["/a", "/b"], "e2": ["/a"]}
