"""Queries on decoders, encoders, layouts, rollups and the streaming path."""

from __future__ import annotations

from pyspark.sql import functions as F

from epiframe.functions import decoders as D
from epiframe.functions import scalars
from epiframe.operators import asof, dataset, episodes, layouts, manifests
from epiframe.operators import metrics as M
from epiframe.queries_align import HOUR, STEP
from epiframe.queries_episodes import _shards
from epiframe.queries_metrics import SQL_LONG, long
from epiframe.registry import ORACLES, query
from epiframe.sources import tables
from epiframe.sources.shared import new_path, staged


def _lines(spark, sf_dir):
    li = tables.read(spark, sf_dir, "lineitem")
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")]
    return li, order


@query("SELECT l_orderkey, l_linenumber, l_extendedprice AS v0, l_tax AS v1, l_discount AS v2 FROM lineitem")
def decode_joint_state(spark, sf_dir):
    """Joint values by name and field; of a joint listed twice the last counts."""
    li, _ = _lines(spark, sf_dir)
    names = F.array(*map(F.lit, ("q", "p", "q")))
    m = li.select("l_orderkey", "l_linenumber", names.alias("name"), F.array("l_quantity", "l_extendedprice", "l_discount").alias("position"), F.array("l_discount", "l_tax", "l_discount").alias("velocity"))
    v = D.decode("sensor_msgs/JointState", m.schema, ("p", "velocity.p", "velocity.q"))
    return m.select("l_orderkey", "l_linenumber", v.alias("v")).select("l_orderkey", "l_linenumber", *D.exploded(F.col("v"), ("v0", "v1", "v2")))


@query("SELECT l_orderkey, l_linenumber, l_quantity + 3 AS total FROM lineitem")
def decode_nested_paths(spark, sf_dir):
    """A motion message's defaults through nested structs."""
    li, _ = _lines(spark, sf_dir)
    xyz = lambda x, y, z: F.struct(F.lit(x).alias("x") if isinstance(x, float) else F.col(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z"))
    m = li.select("l_orderkey", "l_linenumber", xyz("l_quantity", 0.5, 0.5).alias("linear"), xyz(1.0, 0.5, 0.5).alias("angular"))
    v = D.decode("geometry_msgs/Twist", m.schema)
    return m.select("l_orderkey", "l_linenumber", F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("SELECT l_orderkey, l_linenumber, p AS point, (l_orderkey * 1000000000 + p * 7)::BIGINT AS ts, (l_tax * 100 + p)::FLOAT::DOUBLE AS v FROM lineitem, range(0, 3) t(p)")
def decode_trajectory(spark, sf_dir):
    """A trajectory's points as rows with their own time."""
    li, _ = _lines(spark, sf_dir)
    point = lambda p: F.struct(F.array(F.lit(0.0), F.col("l_tax") * 100 + p).alias("positions"), F.struct(F.lit(0).alias("sec"), F.lit(p * 7).alias("nanosec")).alias("time_from_start"))
    stamp = F.struct(F.struct(F.col("l_orderkey").alias("sec"), F.lit(0).cast("long").alias("nanosec")).alias("stamp"))
    m = li.select("l_orderkey", "l_linenumber", stamp.alias("header"), F.array(F.lit("a"), F.lit("b")).alias("joint_names"), F.array(*map(point, range(3))).alias("points"))
    rows = m.select("l_orderkey", "l_linenumber", F.posexplode(D.decode("trajectory_msgs/JointTrajectory", m.schema, ("b",))).alias("point", "s"))
    return rows.select("l_orderkey", "l_linenumber", "point", F.col("s.ts").alias("ts"), F.get(F.col("s.values"), F.lit(0)).cast("double").alias("v"))


@query("SELECT c_custkey AS event, 'ds' || (c_custkey % 4) AS scope FROM customer WHERE c_custkey % 5 > 0")
def event_routing(spark, sf_dir):
    """Events go to their first dataset; those without are left out."""
    ids = F.when(F.col("c_custkey") % 5 > 0, F.array(F.concat(F.lit("ds"), F.col("c_custkey") % 4), F.lit("other"))).otherwise(F.array().cast("array<string>"))
    return episodes.with_scope(tables.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event"), ids.alias("dataset_ids"))).select("event", "scope")


@query("SELECT event_type AS topic, min(epoch_us(ts)) * 1000 AS first_ns, max(epoch_us(ts)) * 1000 AS last_ns, count(*) AS n FROM events GROUP BY event_type")
def topic_bounds(spark, sf_dir):
    """First and last time of each topic."""
    return tables.bounds(tables.messages(spark, sf_dir))


@query(f"""WITH {SQL_LONG}, s AS (SELECT episode, frame, sqrt(sum(d * d)) AS step FROM dv WHERE role = 'action' AND d IS NOT NULL GROUP BY ALL), e AS (SELECT episode, avg(step) AS v FROM s GROUP BY episode),
r AS (SELECT min(v) AS lo, CASE WHEN max(v) > min(v) THEN max(v) ELSE min(v) + 1e-9 END AS hi, least(30, ceil(sqrt(count(*))))::INT AS bins FROM e)
SELECT least(floor((v - lo) / ((hi - lo) / bins)), bins - 1)::INT AS bin, count(*) AS n FROM e, r GROUP BY ALL""")
def speed_histogram(spark, sf_dir):
    """Episodes by action speed, in as many bins as the root of their number, 30 at most."""
    bins = F.least(F.lit(30), F.ceil(F.sqrt("_count")))
    return M.histogram(M.action_speed(long(spark, sf_dir)), "action_speed", [], bins).select("bin", "n")


@query("SELECT (l_suppkey % 3)::INT AS shard, count(DISTINCT l_suppkey) AS n_episodes, count(*) AS n_frames, 10.0::DOUBLE AS fps, 'v3.0' AS version FROM lineitem GROUP BY 1")
def shard_summary(spark, sf_dir):
    """Episodes, frames, rate and version of each shard of a merge, from its info file."""
    eps = tables.read(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 3).cast("int").alias("shard")).agg(F.count_distinct("l_suppkey").alias("e"), F.count("*").alias("f"))
    info = F.to_json(F.struct(F.lit("v3.0").alias("codebase_version"), F.lit(10).alias("fps"), F.col("e").alias("total_episodes"), F.col("f").alias("total_frames")))
    return manifests.shard_summary(eps.select("shard", info.alias("info")))


@query("SELECT n_regionkey AS merge_id, count(DISTINCT n_nationkey % 2) AS n_contracts, count(DISTINCT n_nationkey % 2) = 1 AS consistent FROM nation GROUP BY 1")
def manifest_check(spark, sf_dir):
    """Whether the shards of a merge come from one contract."""
    sha = F.sha2((F.col("n_nationkey") % 2).cast("string"), 256)
    text = F.to_json(F.struct(F.struct(sha.alias("sha256")).alias("contract")))
    return manifests.contracts(tables.read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("merge_id"), text.alias("manifest")), "merge_id")


@query("SELECT episode_index, source_shard, event FROM (SELECT row_number() OVER (ORDER BY n_regionkey, n_nationkey) - 1 AS episode_index, n_regionkey AS source_shard, n_name AS event FROM nation) WHERE source_shard <> 2")
def manifest_episodes(spark, sf_dir):
    """Provenance of a merge's episodes under new numbers, out of the shards' manifests; one shard has lost its own."""
    n = tables.read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("l"))
    entries = F.transform("l", lambda x, i: F.struct(i.alias("episode_index"), x["n_name"].alias("event")))
    text = F.when(F.col("n_regionkey") != 2, F.to_json(F.struct(entries.alias("episode_to_event"))))
    shards = n.select(F.col("n_regionkey").alias("shard"), text.alias("manifest"), F.size("l").alias("total_episodes"))
    return manifests.episode_events(shards).select("episode_index", "source_shard", F.get_json_object("entry", "$.event").alias("event"))


@query("SELECT c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 1")
def manifest_counts(spark, sf_dir):
    """Sums over the shards of a count that each manifest keeps per name."""
    per = tables.read(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    per = per.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("episodes_per_dataset"))
    return manifests.counts(per.select(F.to_json(F.struct("episodes_per_dataset")).alias("manifest")))


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS a0, round(embedding[2]::DOUBLE, 6) AS a1, round(embedding[3]::DOUBLE, 6) AS b0, 'j1,j2' AS names FROM embeddings")
def encode_action(spark, sf_dir):
    """An action vector cut by stream and packed into command messages."""
    e = tables.read(spark, sf_dir, "embeddings")
    part = D.split_action(F.slice("embedding", 1, 3), {"arm": 2, "grip": 1})
    out = e.select("vec_id", D.ENCODERS["sensor_msgs/JointState"](part["arm"], ("j1", "position.j2")).alias("arm"), D.ENCODERS["std_msgs/Float64"](part["grip"], ()).alias("grip"))
    at = lambda i: F.round(F.get(F.col("arm.position"), F.lit(i)), 6)
    return out.select("vec_id", at(0).alias("a0"), at(1).alias("a1"), F.round("grip.data", 6).alias("b0"), F.array_join("arm.name", ",").alias("names"))


@query("""WITH t AS (SELECT o_custkey AS scope, o_orderkey AS seq, epoch_us(o_orderdate) + p * 3600000000 AS ts, o_orderkey * 10 + p AS pos, o_totalprice + p AS v FROM orders, range(0, 2) r(p))
SELECT scope, ts, v FROM (SELECT *, min(ts) OVER (PARTITION BY scope ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM t) WHERE low IS NULL OR ts <= low""")
def flatten_nested(spark, sf_dir):
    """Samples within a message as rows with their own offsets, then the monotonic filter."""
    o = tables.read(spark, sf_dir, "orders")
    us = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    m = o.select(F.col("o_custkey").alias("scope"), F.col("o_orderkey").alias("seq"), us.alias("ts"), F.array(F.col("o_totalprice"), F.col("o_totalprice") + 1).alias("samples"))
    return episodes.keep_monotonic(episodes.flattened(m, "samples", 3_600_000_000), ["scope"]).select("scope", "ts", F.col("value").alias("v"))


def _layout(spark, sf_dir, version):
    frames = dataset.merge(_shards(spark, sf_dir))[0].select("episode_index", "frame_index", "index", "task_index", "x")
    root, out = new_path(spark, "dataset"), new_path(spark, "dataset")
    dataset.write_packed(frames, root, 10.0)
    dataset.convert_layout(spark, root, out, version)
    back, info = dataset.read_dataset(spark, out)
    return back.select("episode_index", "frame_index", "index", "task_index", "x", F.lit(info["codebase_version"]).alias("version"))


@query(ORACLES["merge_frames"].replace("task_index, x FROM", "task_index, x, 'v2.1' AS version FROM"))
def layout_v21(spark, sf_dir):
    """A merged dataset written packed, converted to a folder an episode, and read back."""
    return _layout(spark, sf_dir, "v2.1")


@query(ORACLES["merge_frames"].replace("task_index, x FROM", "task_index, x, 'v3.0' AS version FROM"))
def layout_v30(spark, sf_dir):
    """The same, rewritten packed."""
    return _layout(spark, sf_dir, "v3.0")


@query(ORACLES["replay_hold"])
def stream_hold(spark, sf_dir):
    """Online alignment under Structured Streaming: messages and ticks as one keyed stream, buffers in its state."""
    from epiframe.streaming import live

    m = tables.messages(spark, sf_dir).select("scope", "topic", "ts", "seq", "value")
    ticks = asof.timeline(tables.spans(m), "scope", STEP).select("scope", F.lit(live.TICK).alias("topic"), "ts", F.lit(-1).cast("long").alias("seq"), F.lit(0.0).alias("value"))
    source = staged(m.union(ticks), "stream-in")
    rows = spark.readStream.schema(source.schema).parquet(source._staged_at)
    streams = (live.Online("view", "hold", 120 * HOUR), live.Online("click", "hold", 120 * HOUR))
    out = new_path(spark, "stream-out")
    live.align_stream(rows, streams, strict=False).writeStream.format("parquet").option("checkpointLocation", new_path(spark, "stream-state")).trigger(availableNow=True).start(out).awaitTermination()
    found = spark.read.parquet(out)
    return found.select("scope", "ts", F.round(F.col("frame")["view"], 6).alias("view"), F.round(F.col("frame")["click"], 6).alias("click"))


@query("SELECT s_suppkey, sha256('{\"k\":' || s_suppkey || ',\"n\":\"' || s_name || '\"}') AS key FROM supplier")
def content_keys(spark, sf_dir):
    """Content address of a record: the hash of its canonical JSON."""
    s = tables.read(spark, sf_dir, "supplier")
    return s.select("s_suppkey", scalars.content_key(F.col("s_suppkey").alias("k"), F.col("s_name").alias("n")).alias("key"))


@query("SELECT event_id, user_id AS scope, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id DESC) - 1 AS rank FROM events")
def source_order(spark, sf_dir):
    """Events of a scope by start, ties by the larger id first."""
    e = tables.read(spark, sf_dir, "events")
    return episodes.by_start(e, "user_id", "ts", "event_id").select("event_id", F.col("user_id").alias("scope"), "rank")


@query("""WITH s AS (SELECT DISTINCT p_brand AS n FROM part), a AS (SELECT DISTINCT p_brand AS n FROM part WHERE p_size % 7 = 3 AND p_type LIKE '%E%')
SELECT 'observation.state.' || s.n AS state, 'action.' || a.n AS action, 'name' AS method FROM s JOIN a USING (n)""")
def dim_pairing(spark, sf_dir):
    """State and action dims that belong together by name; brands are joints."""
    p = tables.read(spark, sf_dir, "part")
    named = lambda rows: [r[0] for r in rows.select("p_brand").distinct().orderBy("p_brand").collect()]  # noqa: E731  names of dims
    state, action = named(p), named(p.where("p_size % 7 = 3 AND p_type LIKE '%E%'"))
    method, pairs = episodes.pair_dims([f"observation.state.{n}" for n in state], [f"action.{n}" for n in action])
    return spark.createDataFrame([(s, a, method) for s, a in pairs], "state string, action string, method string")


@query("SELECT o_orderkey, o_orderstatus = 'F' AS flagged, CASE WHEN o_orderstatus = 'F' THEN 'session' ELSE 'event' END AS kind, coalesce(nullif(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END, ''), 'none') AS label FROM orders")
def relabel_sources(spark, sf_dir):
    """Entries relabelled by the kind of their source."""
    o = tables.read(spark, sf_dir, "orders")
    flagged = F.col("o_orderstatus") == "F"
    return episodes.relabelled(o.select("o_orderkey", "o_orderpriority", flagged.alias("flagged")), F.col("flagged"), F.col("o_orderpriority")).select("o_orderkey", "flagged", "kind", "label")


def _whole_layout(spark, sf_dir, version):
    """A merged dataset with its metadata written packed and converted; (episodes, tasks, stats) read back."""
    frames, eps, *_ = dataset.merge(_shards(spark, sf_dir))
    frames = staged(frames.select("episode_index", "frame_index", "index", "task_index", "x"), "merged")
    tasks = eps.select("task_index", "task").distinct()
    root, out = new_path(spark, "dataset"), new_path(spark, "dataset")
    layouts.write_dataset(frames, tasks, root, "v3.0", 10.0, {}, ["x"])
    layouts.convert(spark, root, out, version)
    return layouts.read_meta(spark, out, version)


_EPISODES = ORACLES["merge_union"].split(" SELECT episode_index, length")[0] + " SELECT episode_index, length::BIGINT AS length, task AS tasks FROM n"
_TASKS = ORACLES["merge_union"].split(" SELECT episode_index, length")[0] + " SELECT task_index, task FROM t"
_EP_STATS = """WITH n AS (SELECT l_suppkey AS episode, row_number() OVER (ORDER BY l_suppkey % 3, l_suppkey) - 1 AS episode_index, min(l_quantity) AS min, max(l_quantity) AS max, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS std, count(*) AS count FROM lineitem GROUP BY 1)
SELECT episode_index, 'x' AS feature, min, max, round(mean, 6) AS mean, round(std, 6) AS std, count FROM n"""


def _stats_row(stats):
    one = lambda c: F.get(c, F.lit(0))
    return stats.select("episode_index", "feature", one("min").alias("min"), one("max").alias("max"), F.round(one("mean"), 6).alias("mean"), F.round(one("std"), 6).alias("std"), "count")


@query(_EPISODES)
def layout_episodes_v21(spark, sf_dir):
    """Episodes of a packed dataset after its conversion to lines of JSON."""
    return _whole_layout(spark, sf_dir, "v2.1")[0].select("episode_index", F.col("length").cast("long").alias("length"), F.array_join("tasks", ",").alias("tasks"))


@query(_TASKS)
def layout_tasks_v21(spark, sf_dir):
    """Its tasks."""
    return _whole_layout(spark, sf_dir, "v2.1")[1].select("task_index", "task")


@query(_EP_STATS)
def layout_stats_v21(spark, sf_dir):
    """Its statistics of each episode."""
    return _stats_row(_whole_layout(spark, sf_dir, "v2.1")[2])


@query(_EP_STATS)
def layout_stats_v30(spark, sf_dir):
    """The same in the packed layout."""
    return _stats_row(_whole_layout(spark, sf_dir, "v3.0")[2])


@query("SELECT 5 AS total_shards, (SELECT count(*) FROM nation) AS total_episodes, 4 AS shards_with_manifest, sha256('c') AS sha, c_mktsegment AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2 GROUP BY c_mktsegment")
def manifest_document(spark, sf_dir):
    """The merged manifest, written and read again: totals, contract and counts; one shard has lost its own."""
    n, c = tables.read(spark, sf_dir, "nation"), tables.read(spark, sf_dir, "customer")
    per = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "c_mktsegment").agg(F.count("*").alias("n"))
    per = per.groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("episodes_per_dataset"))
    totals = n.groupBy(F.col("n_regionkey").alias("r")).agg(F.count("*").alias("total_episodes"))
    contract = F.struct(F.lit("demo").alias("name"), F.sha2(F.lit("c"), 256).alias("sha256")).alias("contract")
    text = F.when(F.col("r") != 2, F.to_json(F.struct("episodes_per_dataset", "total_episodes", contract)))
    shards = staged(totals.join(per, F.col("r") == F.col("n_regionkey"), "left").select(F.col("r").alias("shard"), text.alias("manifest"), "total_episodes"), "shards")
    folder = new_path(spark, "manifest")
    manifests.write_document(shards, folder)
    m = spark.read.schema("total_shards long, total_episodes long, shards_with_manifest long, contract struct<sha256:string>, episodes_per_dataset map<string,long>").json(f"{folder}/manifest.json", multiLine=True)
    return m.select("total_shards", "total_episodes", "shards_with_manifest", F.col("contract.sha256").alias("sha"), F.explode("episodes_per_dataset").alias("name", "n"))


@query("""WITH RECURSIVE n AS (SELECT l_suppkey AS episode, count(*) AS n FROM lineitem GROUP BY 1), i AS (SELECT episode, n, row_number() OVER (ORDER BY episode) - 1 AS place, row_number() OVER (ORDER BY n DESC, episode) AS rn FROM n),
r AS (SELECT 0::BIGINT AS rn, [0, 0, 0]::BIGINT[] AS loads, 0 AS pos, 0::BIGINT AS episode UNION ALL
SELECT i.rn, list_transform(loads, lambda x, k: CASE WHEN k = list_position(loads, list_min(loads)) THEN x + i.n ELSE x END), list_position(loads, list_min(loads)), i.episode FROM r JOIN i ON i.rn = r.rn + 1),
l AS (SELECT pos - 1 AS shard, episode, row_number() OVER (PARTITION BY pos ORDER BY rn) - 1 AS k, count(*) OVER (PARTITION BY pos) AS m FROM r WHERE rn > 0)
SELECT shard::INT AS shard, episode, ((k + shard * m // 3) % m)::BIGINT AS place FROM l""")
def shard_plan(spark, sf_dir):
    """Episodes dealt over three shards, longest first, each shard's list begun at a place of its own."""
    n = tables.read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")).orderBy("l_suppkey").collect()  # a row an episode: the plan is made on the driver
    plan = dataset.plan_shards([r.n for r in n], 3)
    return spark.createDataFrame([(k, n[i].l_suppkey, at) for k, own in enumerate(plan) for at, i in enumerate(own)], "shard int, episode long, place long")


@query("""WITH RECURSIVE n AS (SELECT l_suppkey % 4 AS shard, l_suppkey AS episode, count(*) AS n, row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY l_suppkey) AS rn FROM lineitem GROUP BY 1, 2),
r AS (SELECT shard, episode, rn, n, 0 AS file, n AS total, 0.0::DOUBLE AS start FROM n WHERE rn = 1 UNION ALL SELECT n.shard, n.episode, n.rn, n.n, CASE WHEN r.total + n.n >= 2000 THEN r.file + 1 ELSE r.file END, CASE WHEN r.total + n.n >= 2000 THEN n.n ELSE r.total + n.n END, CASE WHEN r.total + n.n >= 2000 THEN 0 ELSE r.start + r.n / 10.0 END FROM r JOIN n ON n.shard = r.shard AND n.rn = r.rn + 1)
SELECT shard, episode, file, round(start, 6) AS start, round_even(start * 10, 0)::BIGINT AS start_frame FROM r""")
def packed_places(spark, sf_dir):
    """File, second and frame at which each episode begins in a shard's packed files."""
    import pandas as pd

    n = tables.read(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 4).alias("shard"), F.col("l_suppkey").alias("episode")).agg(F.count("*").alias("n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("episode")
        places = dataset.place(pdf.n.tolist(), (pdf.n / 10).tolist(), 2000)
        return pdf[["shard", "episode"]].assign(file=[f for f, _ in places], start=[s for _, s in places])

    found = n.groupBy("shard").applyInPandas(run, "shard long, episode long, file int, start double")
    return found.select("shard", "episode", "file", F.round("start", 6).alias("start"), layouts.start_frame(F.col("start"), 10.0).alias("start_frame"))


@query("SELECT o_custkey % 7 AS chunk, o_orderstatus AS file, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL")
def episodes_by_file(spark, sf_dir):
    """The episodes of each file of a dataset; those without a place are left out."""
    o = tables.read(spark, sf_dir, "orders")
    e = o.select(F.col("o_orderkey").alias("episode_index"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") % 7).alias("data/chunk"), F.col("o_orderstatus").alias("data/file"))
    return dataset.by_location(e, "data/chunk", "data/file").select("chunk", "file", F.size("episodes").cast("long").alias("n"), F.element_at("episodes", 1).alias("first"), F.element_at("episodes", -1).alias("last"))


@query("SELECT n_nationkey AS shard, count(c_custkey) FILTER (c_acctbal > 9000) AS total_episodes FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1 HAVING count(c_custkey) FILTER (c_acctbal > 9000) > 0")
def shards_with_episodes(spark, sf_dir):
    """Shards without an episode drop out of a merge."""
    n, c = tables.read(spark, sf_dir, "nation"), tables.read(spark, sf_dir, "customer")
    per = n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy(F.col("n_nationkey").alias("shard")).agg(F.count(F.when(F.col("c_acctbal") > 9000, 1)).alias("total_episodes"))
    return manifests.with_episodes(per)


@query("SELECT vec_id AS frame, label::BIGINT AS episode, len(embedding)::INT AS n_state, round(embedding[1]::DOUBLE, 6) AS first, 0 AS n_action FROM embeddings")
def audit_vectors(spark, sf_dir):
    """A dataset's vectors in the form that the audit takes; one that is missing is empty."""
    e = tables.read(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("episode_index"), F.col("vec_id").alias("frame_index"), F.col("embedding").alias("observation.state"))
    f = dataset.audit_frames(e)
    return f.select("frame", "episode", F.size("state").alias("n_state"), F.round(F.get("state", F.lit(0)), 6).alias("first"), F.size("action").alias("n_action"))


@query("""WITH v AS (SELECT user_id AS scope, epoch_us(ts) * 1000 AS ts, event_id AS seq FROM events WHERE event_type = 'view'), d AS (SELECT *, ts - lag(ts) OVER (PARTITION BY scope ORDER BY ts, seq) AS d FROM v)
SELECT scope, count(*) AS n FROM d GROUP BY scope HAVING count(*) <= 9 OR 1e9 / quantile_cont(d, 0.5) / 2 <= 4e-6""")
def transform_errors(spark, sf_dir):
    """Streams that a zero-phase filter refuses: too short, or too slow for its cut-off."""
    from epiframe.contract import Transform
    from epiframe.operators.transforms import transform

    m = tables.messages(spark, sf_dir).where("topic = 'view'").select("scope", "ts", "seq", F.array("value").alias("values"))
    errors = transform(m, "scope", [Transform("butterworth_lowpass", params={"cutoff_hz": 4e-6})])[1]
    return errors.join(m.groupBy("scope").agg(F.count("*").alias("n")), "scope").select("scope", "n")


# samples of a causal filter by the recursion of its textbook coefficients, then a sweep
@query(f"""{ORACLES["lowpass_causal"].rpartition("SELECT scope, ts, rn - 1")[0].rstrip()}, sp AS (SELECT scope, min(ts) AS a, max(ts) AS b FROM m GROUP BY scope),
gr AS (SELECT scope, a + unnest(range(0, (b - a) // {STEP} + 1)) * {STEP} AS ts FROM sp)
SELECT gr.scope, gr.ts, round(y.y, 6) AS view FROM gr ASOF JOIN (SELECT scope, ts, arg_max(y, rn) AS y FROM r GROUP BY scope, ts) y ON gr.scope = y.scope AND gr.ts > y.ts WHERE gr.ts - y.ts <= {120 * HOUR}""")
def replay_filtered(spark, sf_dir):
    """Replay with a causal filter before the buffer."""
    from epiframe.streaming import live

    out = live.replay(tables.messages(spark, sf_dir), (live.Online("view", "hold", 120 * HOUR, filter=(1e-5, 1e-6, 2)),), STEP)
    return out.select("scope", "ts", F.round(F.col("frame")["view"], 6).alias("view"))


@query(f"""WITH RECURSIVE {{m}}, {{coefficients}}, sp AS (SELECT scope, min(ts) AS a, max(ts) AS b FROM m GROUP BY scope), gr AS (SELECT scope, a + unnest(range(0, (b - a) // {STEP} + 1)) * {STEP} AS ts FROM sp),
h AS (SELECT gr.scope, gr.ts, x.value AS x FROM gr ASOF JOIN (SELECT scope, ts, arg_max(value, seq) AS value FROM m WHERE topic = 'view' GROUP BY scope, ts) x ON gr.scope = x.scope AND gr.ts > x.ts WHERE gr.ts - x.ts <= {120 * HOUR}),
s AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY ts) AS rn FROM h),
r AS (SELECT scope, ts, rn, x AS y, (b - a2) * x + 2 * b * x - a1 * x AS z, b * x - a2 * x AS z1 FROM s, q WHERE rn = 1
UNION ALL SELECT n.scope, n.ts, n.rn, b * n.x + r.z, 2 * b * n.x - a1 * (b * n.x + r.z) + r.z1, b * n.x - a2 * (b * n.x + r.z) FROM r JOIN s n ON n.scope = r.scope AND n.rn = r.rn + 1, q)
SELECT scope, ts, round(y, 6) AS view FROM r""".format(m=ORACLES["lowpass_causal"].partition("WITH RECURSIVE ")[2].partition(", w AS (")[0], coefficients="w AS (" + ORACLES["lowpass_causal"].partition(", w AS (")[2].partition(",\ns AS (")[0]))
def replay_smoothed(spark, sf_dir):
    """Replay with a causal filter at the tick, over what each tick takes."""
    from epiframe.streaming import live

    out = live.replay(tables.messages(spark, sf_dir), (live.Online("view", "hold", 120 * HOUR, tick_filter=(1e-5, 1e-6, 2)),), STEP)
    return out.select("scope", "ts", F.round(F.col("frame")["view"], 6).alias("view"))
