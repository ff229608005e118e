"""Queries on the audit metrics: suppliers' line items and labels' embeddings stand for episodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from epiframe.operators import metrics as M
from epiframe.registry import ORACLES, query
from epiframe.sources import tables

FPS = 10.0

SQL_LONG = """
f AS (SELECT l_suppkey AS episode, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS frame,
  l_quantity::FLOAT::DOUBLE AS q, l_extendedprice::FLOAT::DOUBLE AS p, l_discount::FLOAT::DOUBLE AS d, l_tax::FLOAT::DOUBLE AS t FROM lineitem),
x AS (SELECT episode, frame, 'state' AS role, 0 AS dim, q AS x FROM f UNION ALL SELECT episode, frame, 'state', 1, p FROM f UNION ALL SELECT episode, frame, 'action', 0, d FROM f UNION ALL SELECT episode, frame, 'action', 1, t FROM f),
dv AS (SELECT *, lead(x) OVER w - x AS d, x - lag(x) OVER w AS b FROM x WINDOW w AS (PARTITION BY episode, role, dim ORDER BY frame)),
v AS (SELECT episode, frame, role, dim, x, coalesce(d, b, 0) * 10 AS v FROM dv),
j AS (SELECT *, coalesce(lead(v) OVER w - v, v - lag(v) OVER w, 0) * 10 AS j FROM v WINDOW w AS (PARTITION BY episode, role, dim ORDER BY frame))"""


def long(spark, sf_dir):
    return tables.lineitem_frames(spark, sf_dir)


def rounded(df, *keys):
    return df.select(*[c if c in keys or dict(df.dtypes)[c] != "double" else F.round(c, 5).alias(c) for c in df.columns])


@query(f"WITH {SQL_LONG} SELECT role, dim, count(*) AS n, round(avg(x), 5) AS mean, round(quantile_cont(x, 0.5), 5) AS median, round(stddev_pop(x), 5) AS std, round(min(x), 5) AS min, round(max(x), 5) AS max, round(quantile_cont(x, 0.05), 5) AS p05, round(quantile_cont(x, 0.95), 5) AS p95 FROM x GROUP BY role, dim")
def scalar_summary(spark, sf_dir):
    """Seven figures of each dim."""
    return rounded(M.scalar_summary(long(spark, sf_dir), "x", ["role", "dim"]))


@query(f"WITH {SQL_LONG} SELECT episode, frame, role, dim, round(v, 4) AS v FROM v")
def finite_difference(spark, sf_dir):
    """Velocities by forward differences, the last one repeated."""
    return M.differences(long(spark, sf_dir), FPS).select("episode", "frame", "role", "dim", F.round("v", 4).alias("v"))


@query(f"""WITH {SQL_LONG}, e AS (SELECT 1e-3 * coalesce(nullif(quantile_cont(abs(v), 0.75) - quantile_cont(abs(v), 0.25), 0), 1) AS eps FROM v WHERE role = 'action'),
still AS (SELECT episode, role, dim, avg((abs(v) < eps)::INT) AS s FROM v, e GROUP BY ALL), st AS (SELECT episode, role, max(s) AS stillness_max_dim, avg(s) AS stillness_mean FROM still GROUP BY ALL)
SELECT episode, role, round(avg(abs(v)), 5) AS mean_speed, round(quantile_cont(abs(v), 0.5), 5) AS median_speed, round(quantile_cont(abs(v), 0.95), 5) AS p95_speed, round(max(abs(v)), 5) AS max_speed, round(quantile_cont(abs(j), 0.95), 4) AS p95_jerk,
  round(any_value(stillness_max_dim), 8) AS stillness_max_dim, round(any_value(stillness_mean), 8) AS stillness_mean FROM j JOIN st USING (episode, role) GROUP BY episode, role""")
def speed(spark, sf_dir):
    """Speed, jerk and stillness of each episode and role."""
    per, _ = M.speed(long(spark, sf_dir), FPS)
    return rounded(per.withColumn("p95_jerk", F.round("p95_jerk", 4)), "stillness_max_dim", "stillness_mean").withColumns({c: F.round(c, 8) for c in ("stillness_max_dim", "stillness_mean")})


_SPEED = f"""WITH {SQL_LONG}, s AS (SELECT episode, frame, sqrt(sum(d * d)) AS step FROM dv WHERE role = 'action' AND d IS NOT NULL GROUP BY ALL), e AS (SELECT episode, avg(step) AS action_speed FROM s GROUP BY episode)"""


@query(_SPEED + " SELECT episode, round(action_speed, 6) AS action_speed FROM e")
def hf_speed(spark, sf_dir):
    """Mean step length of each episode's actions."""
    return M.action_speed(long(spark, sf_dir)).select("episode", F.round("action_speed", 6).alias("action_speed"))


@query(_SPEED + ", c AS (SELECT stddev_pop(action_speed) / avg(action_speed) AS cv FROM e) SELECT round(cv, 6) AS cv, CASE WHEN cv < 0.2 THEN 'consistent' WHEN cv < 0.4 THEN 'moderate' ELSE 'high_variance' END AS verdict FROM c")
def speed_verdict(spark, sf_dir):
    """How much the episodes' speeds differ."""
    return M.speed_verdict(M.action_speed(long(spark, sf_dir))).select(F.round("cv", 6).alias("cv"), "verdict")


_VELOCITY = f"""WITH {SQL_LONG}, s AS (SELECT episode, dim, stddev_pop(d) AS s, sum(abs(d)) AS t, max(abs(d)) AS m, count(*) AS n FROM dv WHERE role = 'action' AND d IS NOT NULL GROUP BY ALL),
e AS (SELECT episode, sum(t) / sum(n) AS mean_abs_delta, max(m) AS max_abs_delta, avg(s) AS std_delta_mean FROM s GROUP BY episode),
m AS (SELECT quantile_cont(mean_abs_delta, 0.5) AS med FROM e), a AS (SELECT coalesce(nullif(quantile_cont(abs(mean_abs_delta - med), 0.5), 0), 1) AS mad FROM e, m)"""


@query(_VELOCITY + " SELECT episode, round(mean_abs_delta, 6) AS mean_abs_delta, round(max_abs_delta, 6) AS max_abs_delta, round(std_delta_mean, 6) AS std_delta_mean, (mean_abs_delta - med) / mad > 3 AS high_action_velocity FROM e, m, a")
def action_velocity(spark, sf_dir):
    """Step sizes of actions, and the episodes that stand out upwards."""
    v = M.action_velocity(long(spark, sf_dir)).drop("z")
    return v.select("episode", *[F.round(c, 6).alias(c) for c in ("mean_abs_delta", "max_abs_delta", "std_delta_mean")], "high_action_velocity")


@query(_VELOCITY + " SELECT episode, round(mean_abs_delta, 6) AS mean_abs_delta FROM e ORDER BY e.mean_abs_delta DESC, episode DESC LIMIT 10")
def top_jerky(spark, sf_dir):
    """The ten episodes with the largest steps (the limit is the feature)."""
    return M.top_jerky(M.action_velocity(long(spark, sf_dir))).select("episode", F.round("mean_abs_delta", 6).alias("mean_abs_delta"))


@query(f"""WITH {SQL_LONG}, a AS (SELECT dim, x FROM x WHERE role = 'state'), r AS (SELECT dim, min(x) AS lo, CASE WHEN max(x) > min(x) THEN max(x) ELSE min(x) + 1e-9 END AS hi FROM a GROUP BY dim)
SELECT dim, least(floor((x - lo) / ((hi - lo) / 30)), 29)::INT AS bin, count(*) AS n FROM a JOIN r USING (dim) GROUP BY ALL""")
def delta_histogram(spark, sf_dir):
    """Thirty even bins of each state dim."""
    rows = long(spark, sf_dir).where("role = 'state'")
    return M.histogram(rows, "x", ["dim"], 30).select("dim", "bin", "n")


@query(f"""WITH {SQL_LONG}, n AS (SELECT episode, (max(frame) - min(frame) + 1)::DOUBLE AS n FROM x GROUP BY episode), m AS (SELECT quantile_cont(n, 0.5) AS med FROM n), a AS (SELECT coalesce(nullif(quantile_cont(abs(n - med), 0.5), 0), 1) AS mad FROM n, m),
z AS (SELECT episode, max((s < 1e-6)::INT) = 1 AS flat FROM (SELECT episode, role, dim, stddev_pop(x) AS s, count(*) AS c FROM x GROUP BY ALL HAVING count(*) >= 2) GROUP BY episode)
SELECT episode, n::BIGINT AS n_frames, n - med AS length_deviation, abs(n - med) > 3 * mad AS outlier_length, coalesce(flat, false) AS zero_variance_dim FROM n, m, a LEFT JOIN z USING (episode)""".replace("FROM n, m, a LEFT JOIN z USING (episode)", "FROM n LEFT JOIN z USING (episode), m, a"))
def filtering(spark, sf_dir):
    """Episodes of odd length, and those with a dead channel."""
    return M.filtering(long(spark, sf_dir))


@query(f"""WITH {SQL_LONG}, a AS (SELECT * FROM x WHERE role = 'action'), n AS (SELECT episode, max(frame) AS last, count(DISTINCT frame) AS c FROM a GROUP BY episode HAVING count(DISTINCT frame) >= 2),
b AS (SELECT episode, bin, round_even(bin * last / 49.0, 0)::BIGINT AS frame FROM n, range(0, 50) t(bin))
SELECT dim, bin::INT AS bin, round(var_pop(x), 8) AS variance FROM a JOIN b USING (episode, frame) GROUP BY dim, bin""")
def variance_bins(spark, sf_dir):
    """Variance over episodes of actions at fifty even times."""
    return M.variance_bins(long(spark, sf_dir)).select("dim", "bin", F.round("variance", 8).alias("variance"))


@query(f"""WITH {SQL_LONG}, a AS (SELECT *, coalesce(lead(v) OVER w - v, v - lag(v) OVER w, 0) * 10 AS a FROM v WINDOW w AS (PARTITION BY episode, role, dim ORDER BY frame)),
s AS (SELECT episode, role, dim, stddev_pop(x) AS position, stddev_pop(v) AS speed, stddev_pop(a) AS acceleration FROM a GROUP BY ALL HAVING count(*) >= 2),
u AS (UNPIVOT s ON position, speed, acceleration INTO NAME kind VALUE std), m AS (SELECT role, dim, kind, coalesce(nullif(quantile_cont(std, 0.5), 0), 1) AS med FROM u GROUP BY ALL)
SELECT episode, role, dim, kind, round(std, 5) AS std, round(std / med, 6) AS relative FROM u JOIN m USING (role, dim, kind)""")
def variance_heatmap(spark, sf_dir):
    """Spread of each channel in position, speed and acceleration, relative to its median over episodes."""
    return M.spread(long(spark, sf_dir), FPS).select("episode", "role", "dim", "kind", F.round("std", 5).alias("std"), F.round("relative", 6).alias("relative"))


@query(f"""WITH {SQL_LONG}, s AS (SELECT episode, dim, stddev_pop(x) AS std FROM x WHERE role = 'action' GROUP BY ALL HAVING count(*) >= 2), m AS (SELECT dim, coalesce(nullif(quantile_cont(std, 0.5), 0), 1) AS med FROM s GROUP BY dim),
r AS (SELECT episode, dim, std / med AS rel FROM s JOIN m USING (dim)), c AS (SELECT dim, quantile_cont(rel, 0.5) AS c FROM r GROUP BY dim), n AS (SELECT episode, sqrt(sum((rel - c) * (rel - c))) AS norm, avg((rel < 0.1)::INT) AS near_zero_fraction FROM r JOIN c USING (dim) GROUP BY episode),
k AS (SELECT quantile_cont(norm, 0.5) AS k FROM n), a AS (SELECT coalesce(nullif(quantile_cont(abs(norm - k), 0.5), 0), 1) AS mad FROM n, k)
SELECT episode, round((norm - k) / mad, 5) AS variance_z, round(near_zero_fraction, 6) AS near_zero_fraction, abs((norm - k) / mad) > 3 AS variance_outlier FROM n, k, a""")
def variance_outliers(spark, sf_dir):
    """Episodes whose action spread lies far from the usual."""
    return M.variance_outliers(M.spread(long(spark, sf_dir), FPS)).select("episode", F.round("variance_z", 5).alias("variance_z"), F.round("near_zero_fraction", 6).alias("near_zero_fraction"), "variance_outlier")


@query(f"WITH {SQL_LONG}, q AS (SELECT role, dim, quantile_cont(x, 0.99) - quantile_cont(x, 0.01) AS visited FROM x GROUP BY ALL) SELECT role, dim, round(visited, 5) AS visited, CASE WHEN role = 'state' AND dim = 0 THEN round(visited / 49, 5) END AS fraction FROM q")
def coverage(spark, sf_dir):
    """Span that each dim visits, and its part of the declared range where there is one."""
    declared = spark.createDataFrame([("state", 0, 1.0, 50.0)], "role string, dim int, lo double, hi double")
    return rounded(M.coverage(long(spark, sf_dir), declared))


def _acf_sql(role: str) -> str:
    # r(k) by a self-join on frame + k, for the lags that the cap allows
    return f"""WITH {SQL_LONG}, a AS (SELECT * FROM x WHERE role = '{role}'), c AS (SELECT episode, dim, frame, x - avg(x) OVER (PARTITION BY episode, dim) AS x, count(*) OVER (PARTITION BY episode, dim) AS n FROM a),
k AS (SELECT DISTINCT episode, dim, n, unnest(range(0, CASE_CAP + 1)) AS lag FROM (SELECT DISTINCT episode, dim, n FROM c WHERE n >= 4)),
s AS (SELECT k.episode, k.dim, k.n, k.lag, sum(p.x * q.x) AS s FROM k JOIN c p ON p.episode = k.episode AND p.dim = k.dim JOIN c q ON q.episode = p.episode AND q.dim = p.dim AND q.frame = p.frame + k.lag GROUP BY ALL),
r AS (SELECT episode, dim, n, lag, s / first_value(s) OVER (PARTITION BY episode, dim ORDER BY lag) AS r FROM s)"""


@query(_acf_sql("action").replace("CASE_CAP", "least(n // 2, 100)") + " SELECT episode, dim, lag::INT AS lag, round(r, 5) + 0.0 AS r FROM r")
def action_acf(spark, sf_dir):
    """Autocorrelation curves of actions."""
    return M.action_acf(long(spark, sf_dir)).select("episode", "dim", "lag", (F.round("r", 5) + 0.0).alias("r"))  # no negative zeros


@query(_acf_sql("state").replace("CASE_CAP", "least(n // 4, 20)") + """, z AS (SELECT episode, dim, min(lag) FILTER (r < 0) AS z, min(lag) FILTER (r < 0.5) AS half FROM r GROUP BY ALL)
SELECT episode, dim, n, round(1 + 2 * sum(CASE WHEN lag > 0 AND (z IS NULL OR lag < z) THEN r ELSE 0 END), 4) AS tau_int, any_value(half)::DOUBLE AS tau_half, round(n / (1 + 2 * sum(CASE WHEN lag > 0 AND (z IS NULL OR lag < z) THEN r ELSE 0 END)), 3) AS ess FROM r JOIN z USING (episode, dim) GROUP BY episode, dim, n""")
def autocorrelation(spark, sf_dir):
    """Integrated and half autocorrelation times of states, and the samples they are worth."""
    a = M.autocorrelation(long(spark, sf_dir).where("role = 'state'"), FPS)
    return a.select("episode", "dim", "n", F.round("tau_int", 4).alias("tau_int"), "tau_half", F.round("ess", 3).alias("ess"))


@query(_acf_sql("action").replace("CASE_CAP", "least(n // 4, 20)") + """, z AS (SELECT episode, dim, min(lag) FILTER (r < 0) AS z FROM r GROUP BY ALL),
e AS (SELECT episode, dim, n / (1 + 2 * sum(CASE WHEN lag > 0 AND (z IS NULL OR lag < z) THEN r ELSE 0 END)) AS ess FROM r JOIN z USING (episode, dim) GROUP BY episode, dim, n), m AS (SELECT episode, avg(ess) AS e FROM e GROUP BY episode)
SELECT round(sum(e), 3) AS total_ess_action FROM m""")
def ess_total(spark, sf_dir):
    """Action samples that the whole dataset is worth."""
    return M.ess_total(M.autocorrelation(long(spark, sf_dir).where("role = 'action'"), FPS)).select(F.round("total_ess_action", 3).alias("total_ess_action"))


DIMS = 32

# embeddings in the roles of frames: 32 numbers of state and 32 of action, in single precision; d: steps to the next frame, v: the same with the last repeated
_EMB = f"""WITH f AS (SELECT label::BIGINT AS episode, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, embedding::DOUBLE[] AS e FROM embeddings),
x AS (SELECT episode, frame, i AS dim, e[i + 1] AS s, e[i + {DIMS + 1}] AS a FROM f, range(0, {DIMS}) t(i)),
d AS (SELECT *, lead(s) OVER w - s AS ds, lead(a) OVER w - a AS da, s - lag(s) OVER w AS bs, a - lag(a) OVER w AS ba, count(*) OVER (PARTITION BY episode, dim) AS n FROM x WINDOW w AS (PARTITION BY episode, dim ORDER BY frame))"""


def _aligned(spark, sf_dir):
    return M.alignment(M.long_form(tables.embedding_frames(spark, sf_dir)), [(i, i) for i in range(DIMS)], FPS)


@query(_EMB + """, v AS (SELECT episode, dim, frame, n, coalesce(ds, bs, 0) * 10 AS s, coalesce(da, ba, 0) * 10 AS a FROM d WHERE n >= 4),
z AS (SELECT episode, dim, frame, n, (s - avg(s) OVER w) / stddev_pop(s) OVER w AS s, (a - avg(a) OVER w) / stddev_pop(a) OVER w AS a FROM v WINDOW w AS (PARTITION BY episode, dim)),
k AS (SELECT unnest(range(-10, 11)) AS lag),
c AS (SELECT p.episode, p.dim, k.lag, sum(p.a * q.s) / greatest(any_value(p.n) - abs(any_value(k.lag)), 1) AS c FROM k CROSS JOIN z p JOIN z q ON q.episode = p.episode AND q.dim = p.dim AND q.frame = p.frame + k.lag WHERE abs(k.lag) <= greatest(1, least(p.n // 4, 10)) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY episode, dim ORDER BY round(abs(c), 9) DESC, lag) AS best FROM c)
SELECT episode, dim::INT AS state_dim, dim::INT AS action_dim, lag::INT AS peak_lag, round(c, 6) AS peak_value FROM b WHERE best = 1""")
def state_action_alignment(spark, sf_dir):
    """Lags at which actions and states move together."""
    return _aligned(spark, sf_dir).select("episode", "state_dim", "action_dim", "peak_lag", F.round("peak_value", 6).alias("peak_value"))


@query(_EMB + """, k AS (SELECT unnest(range(-30, 31)) AS lag), y AS (SELECT * FROM d WHERE ds IS NOT NULL AND n >= 5),
c AS (SELECT p.episode, p.dim, k.lag, corr(p.da, q.ds) AS r FROM k CROSS JOIN y p JOIN y q ON q.episode = p.episode AND q.dim = p.dim AND q.frame = p.frame + k.lag WHERE abs(k.lag) <= least((p.n - 1) // 4, 30) GROUP BY ALL HAVING count(*) >= 2),
t AS (SELECT episode, lag, max(r) AS r FROM c WHERE NOT isnan(r) GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY round(abs(r), 9) DESC, lag) AS best FROM t)
SELECT episode, lag::INT AS envelope_peak_lag, abs(lag) >= 2 AS alignment_fail FROM b WHERE best = 1""")
def alignment_flags(spark, sf_dir):
    """Episodes whose actions and states are out of step."""
    return M.alignment_flags(_aligned(spark, sf_dir))


@query()
def sparc(spark, sf_dir):
    """Spectral arc length of each channel's velocity."""
    return M.smoothness(long(spark, sf_dir), FPS).select("episode", "role", "dim", F.round("sparc", 5).alias("sparc"))


@query("WITH d AS (SELECT label, embedding::DOUBLE[] AS e FROM embeddings), i AS (SELECT unnest(range(1, 33)) AS i) SELECT (a.i - 1)::INT AS i, (b.i - 1)::INT AS j, round(covar_samp(e[a.i], e[b.i]), 8) AS cov FROM d, i a JOIN i b ON b.i >= a.i GROUP BY ALL".replace("FROM d, i a JOIN i b ON b.i >= a.i", "FROM d CROSS JOIN i a JOIN i b ON b.i >= a.i"))
def state_covariance(spark, sf_dir):
    """Covariance of the state dims, pooled."""
    return M.covariance(tables.embedding_frames(spark, sf_dir), "state", DIMS).select("i", "j", F.round("cov", 8).alias("cov"))


@query()
def effective_dim(spark, sf_dir):
    """Dimensions that the pooled vectors really use."""
    f = tables.embedding_frames(spark, sf_dir)
    return M.effective_dim(f, "state", DIMS).union(M.effective_dim(f, "action", DIMS)).select("role", "dim", F.round("pr", 6).alias("pr"), "pcs_95", "low")


@query(f"""WITH d AS (SELECT embedding::DOUBLE[] AS e FROM embeddings), i AS (SELECT unnest(range(1, 65)) AS i),
c AS (SELECT a.i AS i, b.i AS j, covar_samp(e[a.i], e[b.i]) AS cov FROM d CROSS JOIN i a JOIN i b ON (a.i <= {DIMS}) = (b.i <= {DIMS}) GROUP BY ALL),
r AS (SELECT CASE WHEN i <= {DIMS} THEN 'state' ELSE 'action' END AS role, sum(cov) FILTER (i = j) AS trace, sum(cov * cov) AS squares FROM c GROUP BY 1)
SELECT role, {DIMS} AS dim, round(trace * trace / squares, 6) AS pr, trace * trace / squares / {DIMS} < 0.3 AS low FROM r""")
def participation_ratio(spark, sf_dir):
    """The participation ratio alone, which needs no eigenvalues in SQL: the trace squared over the sum of squares."""
    return effective_dim(spark, sf_dir).drop("pcs_95")


@query(f"""WITH e AS (SELECT vec_id, list_slice(embedding, 1, {DIMS})::DOUBLE[{DIMS}] AS v FROM embeddings),
p AS (SELECT a.vec_id, list_distance(a.v::DOUBLE[], b.v::DOUBLE[]) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id),
k AS (SELECT vec_id, d, row_number() OVER (PARTITION BY vec_id ORDER BY d) AS rk FROM p), g AS (SELECT d FROM k WHERE rk = 5 AND d > 0),
s AS (SELECT count(*) AS n, min(d) AS lo, max(d) AS hi, least(30, greatest(4, count(*) // 10)) AS bins FROM g),
h AS (SELECT least(floor((d - lo) / (hi - lo) * bins), bins - 1) AS bin, count(*) AS c FROM g, s GROUP BY 1)
SELECT 'state' AS role, (SELECT count(*) FROM e) AS n, round((SELECT ln(n) - sum(c * ln(c)) / any_value(n) FROM h, s GROUP BY n) / ln((SELECT greatest(2, count(*)) FROM h)), 6) AS density_entropy""")
def density_entropy(spark, sf_dir):
    """How evenly the states lie, from the neighbour distances of all of them."""
    return M.density_entropy(tables.embedding_frames(spark, sf_dir), "state").select("role", "n", F.round("density_entropy", 6).alias("density_entropy"))


#: The flags of the other queries, by their SQL.
_FLAGS = """WITH f AS ({filtering}), v AS ({action_velocity}), o AS ({variance_outliers}), s AS ({speed}), m AS (SELECT quantile_cont(p95_jerk, 0.5) AS med FROM s WHERE role = 'action'),
u AS (SELECT episode, 'outlier_length' AS flag FROM f WHERE outlier_length UNION ALL SELECT episode, 'zero_variance_dim' FROM f WHERE zero_variance_dim UNION ALL SELECT episode, 'high_action_velocity' FROM v WHERE high_action_velocity
UNION ALL SELECT episode, 'variance_outlier' FROM o WHERE variance_outlier UNION ALL SELECT episode, 'low_movement' FROM s WHERE role = 'action' AND stillness_max_dim > 0.9 UNION ALL SELECT episode, 'jerky_motion' FROM s, m WHERE role = 'action' AND med > 0 AND p95_jerk > 3 * med)
SELECT episode, string_agg(DISTINCT flag, ',' ORDER BY flag) AS flags FROM u GROUP BY episode"""


def _flags(spark, sf_dir):
    rows = long(spark, sf_dir)
    return M.flag_table(M.filtering(rows), M.action_velocity(rows), M.variance_outliers(M.spread(rows, FPS)), M.speed_flags(M.speed(rows, FPS)[0]))


@query(_FLAGS.format(**{k: ORACLES[k] for k in ("filtering", "action_velocity", "variance_outliers", "speed")}))
def flag_aggregate(spark, sf_dir):
    """The flags of each flagged episode."""
    return _flags(spark, sf_dir).select("episode", F.array_join("flags", ",").alias("flags"))


@query("WITH n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label) SELECT count(*) AS n_episodes, sum(n)::BIGINT AS n_frames, quantile_cont(n, 0.5) AS median_frames FROM n")
def audit_summary(spark, sf_dir):
    """Episodes, frames and their median."""
    per = tables.embedding_frames(spark, sf_dir).groupBy("episode").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("n_episodes"), F.sum("n").alias("n_frames"), F.percentile("n", 0.5).alias("median_frames"))
