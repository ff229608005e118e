"""Queries on episode algebra and datasets: orders stand for episodes, customers for shards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from epiframe import contract as C
from epiframe.functions import decoders, scalars
from epiframe.operators import asof, dataset, episodes
from epiframe.operators import metrics as M
from epiframe.plans import frames as plan
from epiframe.queries_align import HOUR, SLICE, SQL_GRID, STEP, grid, stream
from epiframe.registry import ORACLES, query
from epiframe.sources import tables

DAY = 24 * HOUR
_M = "m AS (SELECT user_id AS scope, event_type AS topic, event_id AS seq, epoch_us(ts) * 1000 AS ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"


@query(f"WITH {_M} SELECT scope, seq, ts FROM (SELECT *, min(ts) OVER (PARTITION BY scope ORDER BY seq DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM m) WHERE low IS NULL OR ts <= low")
def keep_monotonic(spark, sf_dir):
    """Messages that no later one precedes in time."""
    return episodes.keep_monotonic(tables.messages(spark, sf_dir), ["scope"]).select("scope", "seq", "ts")


@query(f"WITH {_M}, d AS (SELECT scope, ts - lag(ts) OVER (PARTITION BY scope ORDER BY seq) AS d FROM m) SELECT scope, quantile_cont(d, 0.5) AS median_step FROM d GROUP BY scope HAVING quantile_cont(d, 0.5) <= 0")
def degenerate_guard(spark, sf_dir):
    """Scopes whose messages, in order of sequence, do not move forward in time."""
    return episodes.degenerate(tables.messages(spark, sf_dir), "scope").select("scope", "median_step")


_TOPICS = """t AS (SELECT o_custkey % 50 AS scope, o_orderpriority AS name, epoch_us(o_orderdate) AS start_ns, epoch_us(o_orderdate) AS end_ns, CAST(NULL AS BIGINT) AS message_count, o_orderkey AS file_id FROM orders)"""


def _topics(spark, sf_dir):
    o = tables.read(spark, sf_dir, "orders")
    us = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    return o.select((F.col("o_custkey") % 50).alias("scope"), F.col("o_orderpriority").alias("name"), us.alias("start_ns"), us.alias("end_ns"), F.lit(None).cast("long").alias("message_count"), F.col("o_orderkey").alias("file_id"))


@query(f"WITH {_TOPICS} SELECT scope, name, start_ns, min(file_id) AS file_id FROM t GROUP BY scope, name, start_ns")
def dedup_topics(spark, sf_dir):
    """One recording of those with equal name, span and count."""
    return episodes.dedup_topics(_topics(spark, sf_dir))[0].select("scope", "name", "start_ns", "file_id")


@query(f"WITH {_TOPICS}, g AS (SELECT count(*) - 1 AS d FROM t GROUP BY scope, name, start_ns HAVING count(*) > 1) SELECT count(*) AS n_groups, coalesce(sum(d), 0)::BIGINT AS topics_dropped, coalesce(sum(d), 0)::BIGINT AS files_affected FROM g")
def dedup_rollup(spark, sf_dir):
    """How many recordings were repeats."""
    return episodes.dedup_rollup(episodes.dedup_topics(_topics(spark, sf_dir))[1])


_ROLES = """s AS (SELECT n_name AS key, 'role_' || n_nationkey AS role, ['p' || (n_nationkey % 5)] AS names FROM nation),
g AS (SELECT s_suppkey AS file_id, s_nationkey AS nation, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier),
f AS (SELECT file_id, 'role_' || nation AS role, 'topic_' || t AS topic, ['p' || t, 'p' || (t + 1 + n % 2)] AS paths FROM g, range(0, 3) r(t))"""


@query(f"""WITH {_ROLES}, n AS (SELECT role, count(DISTINCT file_id) AS nf FROM f GROUP BY role),
c AS (SELECT s.key, count(*) AS nt, min(topic) AS topic FROM s JOIN f USING (role) WHERE list_has_all(f.paths, s.names) GROUP BY s.key),
x AS (SELECT s.key, s.role, CASE WHEN coalesce(nf, 0) = 0 THEN 'role not found' WHEN nf > 1 THEN 'role on several files' WHEN coalesce(nt, 0) = 0 THEN 'no topic has the names' WHEN nt > 1 THEN 'several topics have the names' ELSE 'ok' END AS status, c.topic FROM s LEFT JOIN n USING (role) LEFT JOIN c USING (key))
SELECT key, role, status, CASE WHEN status = 'ok' THEN topic END AS topic FROM x""")
def role_binding(spark, sf_dir):
    """The topic of each role-bound stream, or why it has none."""
    n, s = tables.read(spark, sf_dir, "nation"), tables.read(spark, sf_dir, "supplier")
    specs = n.select(F.col("n_name").alias("key"), F.concat(F.lit("role_"), F.col("n_nationkey")).alias("role"), F.array(F.concat(F.lit("p"), F.col("n_nationkey") % 5)).alias("names"))
    more = F.count("*").over(Window.partitionBy("s_nationkey")) % 2
    files = s.select(F.col("s_suppkey").alias("file_id"), F.concat(F.lit("role_"), F.col("s_nationkey")).alias("role"), more.alias("more"), F.explode(F.array(*map(F.lit, range(3)))).alias("t"))
    files = files.select("file_id", "role", F.concat(F.lit("topic_"), "t").alias("topic"), F.array(F.concat(F.lit("p"), "t"), F.concat(F.lit("p"), F.col("t") + 1 + F.col("more"))).alias("paths"))
    return episodes.bind_roles(specs, files)


@query("SELECT DISTINCT p_type AS topic FROM part WHERE p_type NOT IN (SELECT p_type FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity = 50 AND l_discount = 0 AND l_tax = 0)")
def missing_topics(spark, sf_dir):
    """Wanted topics that nothing offers."""
    p, li = tables.read(spark, sf_dir, "part"), tables.read(spark, sf_dir, "lineitem")
    offered = p.join(li.where("l_quantity = 50 AND l_discount = 0 AND l_tax = 0"), F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_type").alias("topic"))
    return episodes.missing_topics(p.select(F.col("p_type").alias("topic")).distinct(), offered)


_EP = f"""{_M}, ep AS (SELECT o_orderkey AS episode, o_custkey AS scope, epoch_us(o_orderdate) * 1000 AS start_ns, epoch_us(o_orderdate) * 1000 + {20 * DAY} AS end_ns, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END AS label FROM orders)"""


def _episodes(spark, sf_dir):
    o = tables.read(spark, sf_dir, "orders")
    start = F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000
    return o.select(F.col("o_orderkey").alias("episode"), F.col("o_custkey").alias("scope"), start.alias("start_ns"), (start + 20 * DAY).alias("end_ns"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("").alias("label"))


def _first_task(ep: str) -> str:
    return f"""t AS (SELECT e.episode, arg_min(m.topic, (m.ts, m.seq)) AS first FROM {ep} e JOIN m ON m.scope = e.scope AND m.ts BETWEEN e.start_ns AND e.end_ns GROUP BY e.episode)
SELECT e.episode, coalesce(nullif(label, ''), nullif(t.first, ''), 'default') AS task FROM {ep} e LEFT JOIN t USING (episode)"""


@query(f"WITH {_EP}, " + _first_task("ep"))
def task_label(spark, sf_dir):
    """Each episode's own label, else its first task message, else the default."""
    t = tables.messages(spark, sf_dir).select("scope", "ts", "seq", F.col("topic").alias("data"))
    return episodes.task_labels(_episodes(spark, sf_dir), t)


_SUB = f"""s AS (SELECT user_id AS episode, min(epoch_us(ts) * 1000) AS start_ns, (max(epoch_us(ts)) - min(epoch_us(ts))) * 1000 // {STEP} + 1 AS n_frames FROM events GROUP BY user_id),
w AS (SELECT user_id AS episode, event_id, event_type AS name, epoch_us(ts) * 1000 AS a, epoch_us(ts) * 1000 + (event_id % 40) * {HOUR} AS b FROM events),
c AS (SELECT w.*, greatest(round_even((a - start_ns) / {STEP}.0, 0)::BIGINT, 0) AS f, least(round_even((b - start_ns) / {STEP}.0, 0)::BIGINT, n_frames) - 1 AS l FROM w JOIN s USING (episode)),
e AS (SELECT episode, event_id, name, a, b, unnest(range(f, l + 1)) AS frame FROM c WHERE f <= l),
top AS (SELECT episode, frame, arg_max({{'event_id': event_id, 'name': name}}, {{'a': a, 'b': -b, 'event_id': event_id}}) AS t FROM e GROUP BY ALL),
fr AS (SELECT s.episode, unnest(range(0, n_frames)) AS frame FROM s),
x AS (SELECT fr.episode, fr.frame, t.event_id AS event_id, t.name AS name FROM fr LEFT JOIN top USING (episode, frame)),
g AS (SELECT *, lag(event_id) OVER w AS p, row_number() OVER w AS rn, count(event_id) OVER (PARTITION BY episode) AS n_some FROM x WINDOW w AS (PARTITION BY episode ORDER BY frame))"""


def _subtasks(spark, sf_dir):
    m = tables.messages(spark, sf_dir)
    s = tables.spans(m).select(F.col("scope").alias("episode"), "start_ns", (F.expr(f"(end_ns - start_ns) div {STEP}") + 1).alias("n_frames"))
    w = m.select(F.col("scope").alias("episode"), F.col("seq").alias("event_id"), F.col("topic").alias("name"), F.col("ts").alias("start_ns"), (F.col("ts") + (F.col("seq") % 40) * HOUR).alias("end_ns"))
    return episodes.subtask_frames(s, w, STEP)


@query(f"WITH {_SUB} SELECT episode, frame AS start_frame, coalesce(name, 'no_subtask') AS content, event_id FROM g WHERE n_some > 0 AND (rn = 1 OR p IS DISTINCT FROM event_id)")
def subtask_segments(spark, sf_dir):
    """Segments of one sub-task, the window that started last being active."""
    return episodes.segments(_subtasks(spark, sf_dir)[0])


@query(f"WITH {_SUB} SELECT episode, event_id, name FROM c WHERE f > l")
def subtask_dropped(spark, sf_dir):
    """Windows that cover no frame."""
    return _subtasks(spark, sf_dir)[1]


@query("""WITH s AS (SELECT c_custkey AS session, CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 10 END AS a, CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 20 END AS b FROM customer),
f AS (SELECT o_custkey AS session, min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), t AS (SELECT user_id AS session, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY 1)
SELECT s.session, coalesce(s.a, f.a, t.a) AS start_ns, coalesce(s.b, f.b, t.b) AS end_ns FROM s LEFT JOIN f USING (session) LEFT JOIN t USING (session)""")
def session_window(spark, sf_dir):
    """Bounds of a session from itself, its files or its topics."""
    c, o, e = (tables.read(spark, sf_dir, t) for t in ("customer", "orders", "events"))
    own = lambda k: F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") * k)
    s = c.select(F.col("c_custkey").alias("session"), own(10).alias("start_ns"), own(20).alias("end_ns"))
    f = o.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("session"), F.col("o_orderkey").alias("start_ns"), F.col("o_orderkey").alias("end_ns"))
    t = e.select(F.col("user_id").alias("session"), F.col("event_id").alias("start_ns"), F.col("event_id").alias("end_ns"))
    return episodes.session_windows(s, f, t)


@query("WITH n AS (SELECT l_suppkey AS episode, l_suppkey % 7 AS shard, count(*) AS length FROM lineitem GROUP BY ALL) SELECT shard, episode, length, row_number() OVER w - 1 AS episode_index, (coalesce(sum(length) OVER (ORDER BY shard, episode ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS from_index, (sum(length) OVER (ORDER BY shard, episode ROWS UNBOUNDED PRECEDING))::BIGINT AS to_index FROM n WINDOW w AS (ORDER BY shard, episode)")
def renumber(spark, sf_dir):
    """Episode numbers and frame offsets of a union of shards."""
    n = tables.read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("episode"), (F.col("l_suppkey") % 7).alias("shard")).agg(F.count("*").alias("length"))
    return dataset.renumber(n, ["shard", "episode"]).select("shard", "episode", "length", "episode_index", "from_index", "to_index")


@query("SELECT o_orderstatus AS stage, o_orderpriority AS error_class, count(*) AS n, array_to_string(list_sort(list_distinct(list((o_custkey % 9)::VARCHAR))), ',') AS datasets FROM orders GROUP BY ALL")
def skip_rollup(spark, sf_dir):
    """Skipped events by stage and error, with the datasets concerned."""
    s = tables.read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("stage"), F.col("o_orderpriority").alias("error_class"), (F.col("o_custkey") % 9).cast("string").alias("source_dataset_id"))
    return episodes.skip_rollup(s).select("stage", "error_class", "n", F.array_join("datasets", ",").alias("datasets"))


@query("""WITH t AS (SELECT c_custkey AS id, ['audit:' || c_mktsegment, 'audit:' || (c_nationkey % 3)] AS wanted, ['audit:' || (c_custkey % 3), 'own:' || c_nationkey] AS existing FROM customer)
SELECT id, array_to_string(list_sort(list_filter(wanted, lambda x: NOT list_contains(existing, x))), ',') AS to_add, array_to_string(list_sort(list_filter(existing, lambda x: starts_with(x, 'audit:') AND NOT list_contains(wanted, x))), ',') AS to_remove FROM t""")
def tag_diff(spark, sf_dir):
    """Tags to add and to remove."""
    c = tables.read(spark, sf_dir, "customer")
    tag = lambda x: F.concat(F.lit("audit:"), x)
    t = c.select(F.col("c_custkey").alias("id"), F.array(tag("c_mktsegment"), tag(F.col("c_nationkey") % 3)).alias("wanted"), F.array(tag(F.col("c_custkey") % 3), F.concat(F.lit("own:"), "c_nationkey")).alias("existing"))
    return episodes.tag_diff(t, "audit:").select("id", F.array_join("to_add", ",").alias("to_add"), F.array_join("to_remove", ",").alias("to_remove"))


@query("SELECT o_orderpriority AS task, row_number() OVER (ORDER BY min(o_orderkey), o_orderpriority) - 1 AS index FROM orders GROUP BY 1")
def distinct_tasks(spark, sf_dir):
    """Tasks numbered as they are first seen."""
    return episodes.first_seen(tables.read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("task"), "o_orderkey"), "task", F.col("o_orderkey"))


_CONTRACT = """
name: shop
fps: 0.001
observations:
  - {key: observation.state, topic: view, type: value_k, selector: {names: [value, k]}, align: {method: hold, tolerance_ms: 86400000}}
  - {key: observation.state, topic: click, type: value_k, selector: {names: [value]}, align: {method: nearest, tolerance_ms: 172800000}}
actions:
  - {key: action, topic: purchase, type: value_k, selector: {names: [value]}, align: {method: hold, tolerance_ms: null}}
"""
decoders.register_decoder("value_k")(lambda schema, names: F.array(*[decoders.path(schema, n).cast("double") for n in names]))


def _contract(lead: int = 0) -> C.Contract:
    from dataclasses import replace

    return replace(C.parse(_CONTRACT), fps=1e9 / STEP, action_lead_steps=lead)


def _frames(spark, sf_dir, lead=0):
    m = tables.messages(spark, sf_dir)
    e = tables.spans(m).withColumn("episode", F.col("scope"))
    return plan.build_frames(m, e, _contract(lead), SLICE)


def _frames_sql(lead: int) -> str:
    step = int(1e9 / (1e9 / STEP))
    shift = f"- {lead * step}" if lead else ""
    return f"""WITH {SQL_GRID}, pm AS (SELECT * FROM (SELECT *, min(ts) OVER (PARTITION BY scope ORDER BY seq DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM m WHERE topic = 'purchase') WHERE low IS NULL OR ts <= low),
p AS (SELECT scope, ts {shift} AS ts, value FROM pm), bad AS (
  SELECT DISTINCT scope FROM (SELECT scope, topic, ts - lag(ts) OVER (PARTITION BY scope, topic ORDER BY seq) AS d FROM m WHERE topic IN ('view', 'click')) GROUP BY scope, topic HAVING quantile_cont(d, 0.5) <= 0
  UNION SELECT scope FROM (SELECT scope, ts - lag(ts) OVER (PARTITION BY scope ORDER BY seq) AS d FROM pm) GROUP BY scope HAVING quantile_cont(d, 0.5) <= 0),
vv AS (SELECT g.scope, g.frame, g.ts, CASE WHEN g.ts - v.ts <= {24 * HOUR} THEN v.value END AS v0, CASE WHEN g.ts - v.ts <= {24 * HOUR} THEN v.k END AS v1, g.ts - v.ts <= {24 * HOUR} AS vok FROM grid g ASOF LEFT JOIN (SELECT * FROM m WHERE topic = 'view') v ON g.scope = v.scope AND g.ts >= v.ts),
cb AS (SELECT g.scope, g.frame, g.ts, CASE WHEN g.ts - v.ts <= {48 * HOUR} THEN v.ts END AS bt, v.value AS bv FROM grid g ASOF LEFT JOIN (SELECT * FROM m WHERE topic = 'click') v ON g.scope = v.scope AND g.ts >= v.ts),
cf AS (SELECT cb.*, CASE WHEN v.ts - cb.ts <= {48 * HOUR} THEN v.ts END AS ft, v.value AS fv FROM cb ASOF LEFT JOIN (SELECT * FROM m WHERE topic = 'click') v ON cb.scope = v.scope AND cb.ts <= v.ts),
pp AS (SELECT g.scope, g.frame, p.value AS a FROM grid g ASOF LEFT JOIN p ON g.scope = p.scope AND g.ts >= p.ts)
SELECT vv.scope AS episode, row_number() OVER (PARTITION BY vv.scope ORDER BY vv.frame) - 1 AS frame, vv.ts AS ts_ns, round(v0::FLOAT::DOUBLE, 4) AS s0, round(v1::FLOAT::DOUBLE, 4) AS s1,
  round((CASE WHEN bt IS NOT NULL AND (ft IS NULL OR vv.ts - bt <= ft - vv.ts) THEN bv ELSE fv END)::FLOAT::DOUBLE, 4) AS s2, round(a::FLOAT::DOUBLE, 4) AS a0
FROM vv JOIN cf USING (scope, frame) JOIN pp USING (scope, frame) WHERE vok AND (bt IS NOT NULL OR ft IS NOT NULL) AND a IS NOT NULL AND vv.scope NOT IN (SELECT scope FROM bad)"""


def _cells(f):
    s, a = "observation_state", "action"
    cell = lambda c, i: F.round(F.get(c, F.lit(i)).cast("double"), 4)
    return f.frames.select("episode", "frame", "ts_ns", cell(s, 0).alias("s0"), cell(s, 1).alias("s1"), cell(s, 2).alias("s2"), cell(a, 0).alias("a0"))


@query(_frames_sql(0))
def frames(spark, sf_dir):
    """Frames by contract: three streams with their own alignment, vectors by key."""
    return _cells(_frames(spark, sf_dir))


@query(_frames_sql(2))
def frames_lead(spark, sf_dir):
    """The same with actions two steps ahead."""
    return _cells(_frames(spark, sf_dir, 2))


@query("SELECT vec_id, label AS episode, round(list_sum(list_transform(range(1, 33), lambda i: (embedding[i + 32]::DOUBLE - embedding[i]::DOUBLE))), 6) AS total FROM embeddings")
def enrich_diff(spark, sf_dir):
    """Action minus state."""
    e = tables.read(spark, sf_dir, "embeddings")
    v = F.col("embedding").cast("array<double>")
    f = e.select("vec_id", F.col("label").alias("episode"), F.slice(v, 1, 32).alias("state"), F.slice(v, 33, 32).alias("action"))
    return dataset.enrich(f, "diff").select("vec_id", "episode", F.round(F.aggregate("diff", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def _shards(spark, sf_dir):
    li = tables.read(spark, sf_dir, "lineitem")
    out = []
    for k in range(3):
        own = li.where(F.col("l_suppkey") % 3 == k)
        order = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
        f = own.select(F.col("l_suppkey").alias("episode_index"), (F.row_number().over(order) - 1).cast("long").alias("frame_index"), F.col("l_quantity").alias("x"))
        e = own.groupBy(F.col("l_suppkey").alias("episode_index")).agg(F.count("*").alias("length")).withColumn("task", F.concat(F.lit("task "), F.col("episode_index") % 5))
        out.append((f, e))
    return out


_MERGE = """WITH e AS (SELECT l_suppkey % 3 AS shard, l_suppkey AS episode, count(*) AS length, 'task ' || (l_suppkey % 5) AS task FROM lineitem GROUP BY ALL),
t AS (SELECT task, row_number() OVER (ORDER BY min(shard * 1000000 + episode), task) - 1 AS task_index FROM e GROUP BY task),
n AS (SELECT shard, episode, length, task, row_number() OVER (ORDER BY shard, episode) - 1 AS episode_index, (coalesce(sum(length) OVER (ORDER BY shard, episode ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS from_index FROM e)"""


@query(_MERGE + " SELECT episode_index, length, task, task_index, from_index, from_index + length AS to_index, shard::INT AS source_shard, episode AS source_episode FROM n JOIN t USING (task)")
def merge_union(spark, sf_dir):
    """Three shards as one dataset: episodes with new numbers and provenance."""
    return dataset.merge(_shards(spark, sf_dir))[1]


@query(_MERGE + ", f AS (SELECT l_suppkey % 3 AS shard, l_suppkey AS episode, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS fi, l_quantity AS x FROM lineitem) SELECT episode_index, fi AS frame_index, from_index + fi AS index, task_index, x FROM f JOIN n USING (shard, episode) JOIN t USING (task)")
def merge_frames(spark, sf_dir):
    """Frames of the merged dataset."""
    return dataset.merge(_shards(spark, sf_dir))[0].select("episode_index", "frame_index", "index", "task_index", "x")


_STATS = "s AS (SELECT l_suppkey AS episode_index, min(l_quantity) AS min, max(l_quantity) AS max, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS std, count(l_quantity) AS count, quantile_cont(l_quantity, 0.01) AS q01, quantile_cont(l_quantity, 0.1) AS q10, quantile_cont(l_quantity, 0.5) AS q50, quantile_cont(l_quantity, 0.9) AS q90, quantile_cont(l_quantity, 0.99) AS q99 FROM lineitem GROUP BY l_suppkey)"


def _stats(spark, sf_dir):
    return dataset.column_stats(tables.read(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "episode_index"), "l_quantity")


def _round_all(df):
    return df.select(*[F.round(c, 5).alias(c) if t == "double" else c for c, t in df.dtypes])


@query(f"WITH {_STATS} SELECT episode_index, min, max, round(mean, 5) AS mean, round(std, 5) AS std, count, round(q01, 5) AS q01, round(q10, 5) AS q10, round(q50, 5) AS q50, round(q90, 5) AS q90, round(q99, 5) AS q99 FROM s")
def restat(spark, sf_dir):
    """Statistics of each episode."""
    return _round_all(_stats(spark, sf_dir))


@query(f"WITH {_STATS}, g AS (SELECT avg(l_quantity) AS mean, stddev_pop(l_quantity) AS std, count(*) AS count FROM lineitem) SELECT min(min) AS min, max(max) AS max, round(any_value(g.mean), 5) AS mean, round(any_value(g.std), 5) AS std, any_value(g.count) AS count, round(min(q01), 5) AS q01, round(min(q10), 5) AS q10, round(min(q50), 5) AS q50, round(max(q90), 5) AS q90, round(max(q99), 5) AS q99 FROM s, g")
def merge_stats(spark, sf_dir):
    """Statistics of the whole from those of its episodes."""
    return _round_all(dataset.merge_stats(_stats(spark, sf_dir)))


@query("SELECT count(*) AS total_episodes, sum(n)::BIGINT AS total_frames, count(DISTINCT e % 5) AS total_tasks, ceil(count(*) / 1000.0)::BIGINT AS total_chunks FROM (SELECT l_suppkey AS e, count(*) AS n FROM lineitem GROUP BY 1)")
def dataset_totals(spark, sf_dir):
    e = tables.read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("episode")).agg(F.count("*").alias("length")).withColumn("task", (F.col("episode") % 5).cast("string"))
    return dataset.totals(e)


@query("SELECT min(o_orderkey) AS slot, md5(o_custkey || ':' || o_orderpriority) AS key FROM orders GROUP BY 2 HAVING NOT list_contains(list(o_orderstatus), 'F')")
def cache_misses(spark, sf_dir):
    """Content keys that no cached episode has; the first slot stands for equal ones."""
    o = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slot"), F.md5(F.concat_ws(":", "o_custkey", "o_orderpriority").cast("binary")).alias("key"), "o_orderstatus")
    return dataset.missing_keys(o, o.where("o_orderstatus = 'F'"))[1].select("slot", "key")


@query("SELECT o.o_orderkey AS episode_index, c.c_name AS \"lineage/name\", c.c_nationkey AS \"lineage/nation\" FROM orders o LEFT JOIN (SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 2 = 0) c ON c.c_custkey = o.o_orderkey")
def lineage(spark, sf_dir):
    """Lineage columns beside the episodes."""
    o, c = tables.read(spark, sf_dir, "orders"), tables.read(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    own = c.select(F.col("c_custkey").alias("episode_index"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return dataset.with_lineage(o.select(F.col("o_orderkey").alias("episode_index")), own)


@query("SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only left' WHEN a.o_orderkey IS NULL THEN 'only right' ELSE 'differs' END AS why FROM (SELECT * FROM orders WHERE o_orderkey % 5 > 0) a FULL JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 7 > 0) b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR abs(a.o_totalprice - b.p) > 1e-6 + 1e-6 * abs(b.p)")
def equivalence(spark, sf_dir):
    """Episodes that two datasets do not share or that differ."""
    o = tables.read(spark, sf_dir, "orders")
    b = o.where("o_orderkey % 7 > 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return dataset.differing(o.where("o_orderkey % 5 > 0"), b, ["o_orderkey"], "o_totalprice").select("o_orderkey", "why")


@query("SELECT event_id, round(value, 6) AS v0, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v1 FROM events")
def decode_selector(spark, sf_dir):
    """Values by name from a JSON payload and a column."""
    e = tables.read(spark, sf_dir, "events").select("event_id", "value", F.col("props").alias("data"))
    k = decoders.decode("string_typed_msg", e.schema, ("k",))
    return e.select("event_id", F.round("value", 6).alias("v0"), F.get(k, F.lit(0)).alias("v1"))


@query("SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_type || ' , ' || p_brand || ',,', ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS tags, starts_with(p_name, 'a') AS a, CASE WHEN starts_with(p_brand, 'Brand#') THEN substr(p_brand, 7) ELSE p_brand END AS bare, round_even(p_retailprice / 2, 0)::BIGINT AS half FROM part")
def scalar_functions(spark, sf_dir):
    """Tag lists, prefixes and half-even rounding."""
    p = tables.read(spark, sf_dir, "part")
    text = F.concat("p_type", F.lit(" , "), "p_brand", F.lit(",,"))
    return p.select("p_partkey", F.array_join(scalars.tags(text), "|").alias("tags"), F.col("p_name").startswith("a").alias("a"), scalars.strip_prefix(F.col("p_brand"), "Brand#").alias("bare"), scalars.half_even(F.col("p_retailprice") / 2).alias("half"))


@query(f"WITH {_M}, w AS (SELECT scope, min(ts) AS a, max(ts) AS b FROM m GROUP BY scope) SELECT scope, a - 1000000000 AS lo, b + 1000000000 + 2 * {STEP} AS hi FROM w")
def fetch_window(spark, sf_dir):
    """Bounds of the messages that an episode can need."""
    before, after = (abs(x) for x in C.scan_window(_contract(2), 0, 0))
    return tables.spans(tables.messages(spark, sf_dir)).select("scope", (F.col("start_ns") - before).alias("lo"), (F.col("end_ns") + after).alias("hi"))


@query(f"""WITH {_M}, s AS (SELECT scope, min(ts) AS a, max(ts) AS b FROM m GROUP BY scope), g AS (SELECT scope, a + unnest(range(0, (b - a) // {STEP} + 1)) * {STEP} AS ts FROM s),
v AS (SELECT g.scope, g.ts, x.ts AS t, x.value FROM g ASOF JOIN (SELECT * FROM m WHERE topic = 'view') x ON g.scope = x.scope AND g.ts > x.ts), c AS (SELECT g.scope, g.ts, x.ts AS t, x.value FROM g ASOF JOIN (SELECT * FROM m WHERE topic = 'click') x ON g.scope = x.scope AND g.ts > x.ts)
SELECT v.scope, v.ts, round(v.value, 6) AS view, round(c.value, 6) AS click FROM v JOIN c USING (scope, ts) WHERE v.ts - v.t <= {5 * DAY} AND v.ts - c.t <= {5 * DAY}""")
def replay_hold(spark, sf_dir):
    """Replay of recorded messages through the online buffers: a tick sees what came strictly before it."""
    from epiframe.streaming import live

    out = live.replay(tables.messages(spark, sf_dir), (live.Online("view", "hold", 5 * DAY), live.Online("click", "hold", 5 * DAY)), STEP)
    return out.select("scope", "ts", F.round(F.col("frame")["view"], 6).alias("view"), F.round(F.col("frame")["click"], 6).alias("click"))


@query(f"""WITH {_M}, s AS (SELECT scope, min(ts) AS a, max(ts) AS b FROM m GROUP BY scope), g AS (SELECT scope, a + unnest(range(0, (b - a) // {STEP} + 1)) * {STEP} AS ts FROM s),
x AS (SELECT scope, ts, arg_min(value, seq) AS value FROM m WHERE topic = 'view' GROUP BY scope, ts)
SELECT g.scope, g.ts, round(x.value, 6) AS view FROM g ASOF JOIN x ON g.scope = x.scope AND g.ts > x.ts WHERE g.ts - x.ts <= {5 * DAY}""")
def replay_nearest(spark, sf_dir):
    """Replay with the nearest buffered sample."""
    from epiframe.streaming import live

    out = live.replay(tables.messages(spark, sf_dir), (live.Online("view", "nearest", 5 * DAY),), STEP)
    return out.select("scope", "ts", F.round(F.col("frame")["view"], 6).alias("view"))


def _filtered(spark, sf_dir, *chain):
    from epiframe.operators.transforms import transform

    v = stream(spark, sf_dir, "view").select("scope", "ts", "seq", F.array("value", "k").alias("values"))
    out, _ = transform(v, "scope", list(chain))
    return out.select("scope", "ts", "seq", F.round(F.get("values", F.lit(0)), 6).alias("v0"), F.round(F.get("values", F.lit(1)), 6).alias("v1"))


@query(f"""WITH {_M}, v AS (SELECT scope, ts, seq, value, k FROM m WHERE topic = 'view'), d AS (SELECT *, ts - lag(ts) OVER (PARTITION BY scope ORDER BY ts, seq) AS d FROM v),
s AS (SELECT scope, min(ts) AS a, max(ts) - min(ts) AS span, round_even((max(ts) - min(ts)) / quantile_cont(d, 0.5), 0)::BIGINT AS steps, count(*) AS n FROM d GROUP BY scope),
g AS (SELECT scope, i, a + CASE WHEN i = steps THEN span ELSE round_even(i::DOUBLE * (span::DOUBLE / steps), 0)::BIGINT END AS ts FROM (SELECT *, unnest(range(0, steps + 1)) AS i FROM s WHERE n > 1)),
t AS (SELECT scope, ts, arg_min(value, seq) AS f0, arg_min(k, seq) AS f1, arg_max(value, seq) AS l0, arg_max(k, seq) AS l1 FROM v GROUP BY scope, ts),
b AS (SELECT g.*, t.ts AS bt, l0, l1 FROM g ASOF LEFT JOIN t ON g.scope = t.scope AND g.ts > t.ts),
x AS (SELECT b.*, t.ts AS nt, f0, f1 FROM b ASOF LEFT JOIN t ON b.scope = t.scope AND b.ts <= t.ts)
SELECT scope, ts, i AS seq, round(CASE WHEN ts - bt < nt - ts THEN l0 ELSE f0 END, 6) AS v0, round(CASE WHEN ts - bt < nt - ts THEN l1 ELSE f1 END, 6) AS v1 FROM x
UNION ALL SELECT scope, ts, 0, round(value, 6), round(k, 6) FROM v JOIN s USING (scope) WHERE n = 1""")
def resample_uniform(spark, sf_dir):
    """Streams on an even grid of their median step."""
    return _filtered(spark, sf_dir, C.Transform("resample_uniform"))


def _zero_phase() -> str:
    """Resampled streams, extended oddly by nine rows at both ends, through a section of order 2 forward and then backward."""
    even = ORACLES["resample_uniform"].replace("round(CASE", "(CASE").replace("END, 6)", "END)").replace("round(value, 6), round(k, 6)", "value, k")
    step = lambda x, z, z1: f"b * {x} + {z}, 2 * b * {x} - a1 * (b * {x} + {z}) + {z1}, b * {x} - a2 * (b * {x} + {z})"
    rest = lambda x: f"{x}, (b - a2) * {x} + 2 * b * {x} - a1 * {x}, b * {x} - a2 * {x}"
    return f"""WITH RECURSIVE rs AS ({even}), d AS (SELECT *, ts - lag(ts) OVER (PARTITION BY scope ORDER BY seq) AS d FROM rs),
k AS (SELECT scope, count(*) AS n, tan(pi() * 1e-6 / (1e9 / quantile_cont(d, 0.5))) AS w, 1e9 / quantile_cont(d, 0.5) AS fs FROM d GROUP BY scope HAVING count(*) > 9),
q AS (SELECT scope, n, w * w / (1 + sqrt(2) * w + w * w) AS b, 2 * (w * w - 1) / (1 + sqrt(2) * w + w * w) AS a1, (1 - sqrt(2) * w + w * w) / (1 + sqrt(2) * w + w * w) AS a2 FROM k WHERE fs / 2 > 1e-6),
i AS (SELECT scope, n, b, a1, a2, unnest(range(-9, n + 9)) AS i FROM q),
e AS (SELECT i.*, CASE WHEN i < 0 THEN 2 * f.v0 - m.v0 WHEN i >= n THEN 2 * l.v0 - m.v0 ELSE m.v0 END AS x, CASE WHEN i < 0 THEN 2 * f.v1 - m.v1 WHEN i >= n THEN 2 * l.v1 - m.v1 ELSE m.v1 END AS u
  FROM i JOIN rs m ON m.scope = i.scope AND m.seq = CASE WHEN i < 0 THEN -i WHEN i >= n THEN 2 * (n - 1) - i ELSE i END JOIN rs f ON f.scope = i.scope AND f.seq = 0 JOIN rs l ON l.scope = i.scope AND l.seq = n - 1),
fw(scope, i, y, z, z1, v, t, t1) AS (SELECT scope, i, {rest("x")}, {rest("u")} FROM e WHERE i = -9 UNION ALL SELECT e.scope, e.i, {step("e.x", "p.z", "p.z1")}, {step("e.u", "p.t", "p.t1")} FROM fw p JOIN e ON e.scope = p.scope AND e.i = p.i + 1),
g AS (SELECT e.scope, e.i, n, b, a1, a2, y AS x, v AS u FROM e JOIN fw ON fw.scope = e.scope AND fw.i = e.i),
bw(scope, i, y, z, z1, v, t, t1) AS (SELECT scope, i, {rest("x")}, {rest("u")} FROM g WHERE i = n + 8 UNION ALL SELECT g.scope, g.i, {step("g.x", "p.z", "p.z1")}, {step("g.u", "p.t", "p.t1")} FROM bw p JOIN g ON g.scope = p.scope AND g.i = p.i - 1)
SELECT rs.scope, rs.ts, rs.seq, round(y, 6) AS v0, round(v, 6) AS v1 FROM bw JOIN rs ON rs.scope = bw.scope AND rs.seq = bw.i"""


@query(_zero_phase())
def lowpass(spark, sf_dir):
    """Zero-phase low-pass of resampled streams."""
    return _filtered(spark, sf_dir, C.Transform("resample_uniform"), C.Transform("butterworth_lowpass", params={"cutoff_hz": 1e-6}))


# a Butterworth section of order 2 by its textbook coefficients, one row of every stream a step
@query(f"""WITH RECURSIVE {_M}, w AS (SELECT tan(pi() * 0.1) AS w), q AS (SELECT w * w / (1 + sqrt(2) * w + w * w) AS b, 2 * (w * w - 1) / (1 + sqrt(2) * w + w * w) AS a1, (1 - sqrt(2) * w + w * w) / (1 + sqrt(2) * w + w * w) AS a2 FROM w),
s AS (SELECT scope, ts, value AS x, k AS u, row_number() OVER (PARTITION BY scope ORDER BY ts, seq) AS rn FROM m WHERE topic = 'view'),
r AS (SELECT scope, ts, rn, x AS y, (b - a2) * x + 2 * b * x - a1 * x AS z, b * x - a2 * x AS z1, u AS v, (b - a2) * u + 2 * b * u - a1 * u AS t, b * u - a2 * u AS t1 FROM s, q WHERE rn = 1
UNION ALL SELECT n.scope, n.ts, n.rn, b * n.x + r.z, 2 * b * n.x - a1 * (b * n.x + r.z) + r.z1, b * n.x - a2 * (b * n.x + r.z), b * n.u + r.t, 2 * b * n.u - a1 * (b * n.u + r.t) + r.t1, b * n.u - a2 * (b * n.u + r.t)
FROM r JOIN s n ON n.scope = r.scope AND n.rn = r.rn + 1, q)
SELECT scope, ts, rn - 1 AS seq, round(y, 6) AS v0, round(v, 6) AS v1 FROM r""")
def lowpass_causal(spark, sf_dir):
    """Causal low-pass of streams."""
    return _filtered(spark, sf_dir, C.Transform("butterworth_lowpass_causal", params={"cutoff_hz": 1e-6, "fs_hz": 1e-5}))


@query("""WITH RECURSIVE n AS (SELECT l_suppkey % 4 AS shard, l_suppkey AS episode, count(*) AS n, row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY l_suppkey) AS rn FROM lineitem GROUP BY 1, 2),
r AS (SELECT shard, episode, rn, 0 AS file, n AS total FROM n WHERE rn = 1 UNION ALL SELECT n.shard, n.episode, n.rn, CASE WHEN r.total + n.n >= 2000 THEN r.file + 1 ELSE r.file END, CASE WHEN r.total + n.n >= 2000 THEN n.n ELSE r.total + n.n END FROM r JOIN n ON n.shard = r.shard AND n.rn = r.rn + 1)
SELECT shard, episode, file FROM r""")
def pack_plan(spark, sf_dir):
    """File number of each episode within its shard, a file being closed at 2,000 frames."""
    import pandas as pd

    n = tables.read(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 4).alias("shard"), F.col("l_suppkey").alias("episode")).agg(F.count("*").alias("n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("episode")
        return pdf[["shard", "episode"]].assign(file=dataset.pack(pdf.n.tolist(), 2000))

    return n.groupBy("shard").applyInPandas(run, "shard long, episode long, file int")
