import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from epiframe.contract import parse
from epiframe.operators import dataset, manifests
from epiframe.sources import catalog

TABLE = "shard long, manifest string, total_episodes long"


def shards(spark, rows):
    return spark.createDataFrame([(i, m if m is None or isinstance(m, str) else json.dumps(m), n) for i, (m, n) in enumerate(rows)], TABLE)


def manifest(sha="x", n=2, **more):
    return {"contract": {"name": "c", "version": 1, "sha256": sha}, "total_episodes": n, "episode_to_event": [{"episode_index": i, "event": f"e{i}", "tags": {"a": [1]}} for i in range(n)], **more}


def test_episodes_get_new_numbers(spark):
    s = shards(spark, [(manifest(n=2), 9), (None, 3), ("no json", 1), (manifest(n=1), 1)])
    got = manifests.episode_events(s).orderBy("episode_index").collect()
    assert [(r.episode_index, r.source_shard) for r in got] == [(0, 0), (1, 0), (6, 3)]
    assert json.loads(got[1].entry) == {"episode_index": 1, "event": "e1", "tags": {"a": [1]}}
    assert manifests.episode_events(s.limit(0)).count() == 0


def test_lists_and_counts_unite(spark):
    a = manifest(episodes_per_dataset={"d1": 2, "d2": 1}, source_datasets=["d2", "d1"], skipped_events=[{"stage": "x"}])
    b = manifest(episodes_per_dataset={"d1": 5}, source_datasets=["d1"], skipped_events=[{"stage": "y"}, {"stage": "x"}])
    s = shards(spark, [(a, 2), (b, 2), (None, 1)])
    assert {r.name: r.n for r in manifests.counts(s).collect()} == {"d1": 7, "d2": 1}
    assert sorted(r.name for r in manifests.names(s).collect()) == ["d1", "d2"]
    assert sorted((r.shard, json.loads(r.entry)["stage"]) for r in manifests.listed(s, "skipped_events").collect()) == [(0, "x"), (1, "x"), (1, "y")]


def test_contract_must_agree(spark):
    assert manifests.contract_of(shards(spark, [(None, 1), (manifest(), 2)])) == {"name": "c", "version": "1", "path": None, "sha256": "x"}
    assert manifests.contract_of(shards(spark, [(None, 1)])) == {}
    with pytest.raises(manifests.ManifestError, match="different contracts"):
        manifests.contract_of(shards(spark, [(manifest(), 1), (manifest("y"), 1)]))


def test_empty_shards_go(spark):
    s = shards(spark, [(None, 0), (None, 2)])
    assert [r.shard for r in manifests.with_episodes(s).collect()] == [1]
    with pytest.raises(manifests.ManifestError, match="0: bad"):
        manifests.with_episodes(s.where("shard = 0").withColumn("reason", F.lit("bad")))


def test_sink(spark, tmp_path):
    f = spark.createDataFrame([(0, 0.5), (1, 0.7)], "frame_index long, x double")
    for version in ("v3.0", "v2.1"):
        sink = dataset.EpisodeSink(spark, f"{tmp_path}/{version}", 10.0, version)
        sink.add_frames(f)
        assert sink.save_episode("a") == 0
        sink.add_frames(f)
        with pytest.raises(ValueError, match="open"):
            sink.finalize()
        sink.discard_episode()
        sink.add_frames(f.limit(1))
        sink.add_frames(f.where("frame_index = 1"))
        assert sink.save_episode("b") == 1
        with pytest.raises(ValueError, match="frame"):
            sink.save_episode()
        assert sink.finalize()["codebase_version"] == version
        rows, _ = dataset.read_dataset(spark, f"{tmp_path}/{version}")
        assert sorted((r.episode_index, r.frame_index, r.task) for r in rows.collect()) == [(0, 0, "a"), (0, 1, "a"), (1, 0, "b"), (1, 1, "b")]
    with pytest.raises(ValueError, match="no episode"):
        dataset.EpisodeSink(spark, f"{tmp_path}/z", 10.0).finalize()
    assert catalog.find_dataset(str(tmp_path)) == f"{tmp_path}/v2.1"


def test_foreign_files_are_read(spark, tmp_path):
    f = spark.createDataFrame([(0, 0, [1.0, 2.0], [3.0])], "episode_index int, frame_index int, `observation.state` array<float>, action array<float>")
    f.write.parquet(f"{tmp_path}/d/data/chunk-000")
    (tmp_path / "d/meta/episodes").mkdir(parents=True)
    (tmp_path / "d/meta/info.json").write_text(json.dumps({"codebase_version": "v3.0", "fps": 30}, indent=4))
    rows, info = dataset.read_dataset(spark, f"{tmp_path}/d")
    assert info["fps"] == 30
    r = dataset.audit_frames(rows).first()
    assert (r.episode, r.frame, r.state, r.action) == (0, 0, [1.0, 2.0], [3.0])
    assert dataset.audit_frames(rows.drop("action")).first().action == []
    with pytest.raises(FileNotFoundError):
        catalog.find_dataset(f"{tmp_path}/d/data")


def test_places(spark):
    assert dataset.place([3, 4, 3, 10], [1.0, 2.0, 4.0, 8.0], 10) == [(0, 0.0), (0, 1.0), (1, 0.0), (2, 0.0)]
    e = spark.createDataFrame([(1, 0, 0), (0, 0, 0), (2, 0, 1), (3, None, 1)], "episode_index long, `data/chunk` int, `data/file` int")
    assert sorted((r.chunk, r.file, r.episodes) for r in dataset.by_location(e, "data/chunk", "data/file").collect()) == [(0, 0, [0, 1]), (0, 1, [2])]


def test_features_of_info():
    info = {"features": {"a": {"names": {"y": "q", "x": "p"}, "shape": [2], "stats": {"min": [0, 0], "max": 3}}, "b": {"shape": [2]}}}
    assert catalog.feature(info, "a") == catalog.Feature("a", ["p", "q"], 2, [0, 0], None)
    assert catalog.feature(info, "b").names == ["b.0", "b.1"] and catalog.feature(info, "c") is None


def test_versions_and_sinks():
    assert [catalog.layout_of(v) for v in ("0.3.1", "0.4", "0.6.0", "1.0")] == ["v2.1", "v2.1", "v3.0", "v3.0"]
    for v in ("0.5.2", "0.2", "new"):
        with pytest.raises(ValueError):
            catalog.layout_of(v)
    assert catalog.sink_of(" Episodes ") == catalog.sink_of() == "episodes"
    for v in ("table", "both", "x"):
        with pytest.raises(ValueError):
            catalog.sink_of(v)


def test_options_and_names(monkeypatch):
    monkeypatch.setenv("EPIFRAME_FPS", "5")
    assert [catalog.option("fps", p, 1) for p in ({"fps": 9}, {"fps": ""}, {})] == [9, "5", "5"] and catalog.option("none", {}, 1) == 1
    assert catalog.shard_ids('["/a/", " b"]') == ["a", "b"]
    for raw in ("x", "[]", '[""]', "[1]", '["a/b"]', '{"a": 1}'):
        with pytest.raises(ValueError):
            catalog.shard_ids(raw)
    assert catalog.merge_sizes({"chunk_size": "10", "data_files_size_in_mb": "1.5", "other": 1}) == {"data_files_size_in_mb": 1.5, "chunk_size": 10}
    assert catalog.run_folder("/o", "a b/c") == "/o/audit_reports/a-b-c"
    assert catalog.run_folder("/o", now=datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC)) == "/o/audit_reports/20260102T030405Z"
    assert catalog.converted_name(" n ", "d", "v2.1") == "n (v2.1)" and catalog.converted_name(" ", "d", "v2.1") == "v2.1 conversion of d"
    assert catalog.pool_warning(2, 3, 6) is None and "share 5" in catalog.pool_warning(2, 3, 5)


def test_manifest_and_contract(tmp_path, caplog):
    text = "fps: 10\n"
    c = parse(text)
    catalog.check_manifest(json.dumps({"contract": {"sha256": c.sha256}}), c)
    for m in ({}, {"contract": "x"}, {"contract": {"sha256": "0"}}):
        with pytest.raises(ValueError):
            catalog.check_manifest(json.dumps(m), c)
    with pytest.raises(FileNotFoundError):
        catalog.find_contract(str(tmp_path))
    for d in ("b", "a"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "contract.yaml").write_text(text)
    assert catalog.find_contract(str(tmp_path)) == f"{tmp_path}/a/contract.yaml" and "2 contracts" in caplog.text
    assert catalog.find_contract(str(tmp_path), "b/contract.yaml") == f"{tmp_path}/b/contract.yaml"
