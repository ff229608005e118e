import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from epiframe.operators import kernels as K
from epiframe.operators import metrics as M
from epiframe.plans import audit as A

FPS = 30.0


def episode(i, n=300, dims=6):
    rng = np.random.default_rng(i)
    state = np.tanh(np.cumsum(rng.normal(0, 0.02, (n, dims)), axis=0))
    return state, np.concatenate([state[1:], state[-1:]])


def faults():
    """Nine episodes, each with one fault, but for the controls 0, 1 and 3."""
    out = {i: episode(i) for i in range(9)}
    out[2][0][:, 0] = 0.37
    out[4] = (out[4][0], 1e-6 * np.arange(300)[:, None] * np.ones((1, 6)))
    s, a = out[5]
    out[5] = (s, np.concatenate([a[3:], np.repeat(a[-1:], 3, axis=0)]))
    out[6] = episode(6, 600)
    out[7][0][:, 3] = 0.5
    out[8] = (out[8][0], np.random.default_rng(8).normal(0, 5, (300, 6)))
    return out


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(e, f, s[f].tolist(), a[f].tolist()) for e, (s, a) in faults().items() for f in range(len(s))]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["episode", "frame", "state", "action"])).repartition(4).cache()


@pytest.fixture(scope="module")
def audited(frames):
    return A.audit(frames, FPS, 6, 6, [(i, i) for i in range(6)])


def test_each_fault_raises_its_flag(audited):
    assert not audited.errors
    flags = {r.episode: set(r.flags) for r in audited.flags.collect()}
    for e, flag in ((2, "stuck_sensor"), (2, "zero_variance_dim"), (4, "low_movement"), (5, "alignment_fail"), (6, "outlier_length"), (7, "zero_variance_dim"), (7, "stuck_sensor"), (8, "high_action_velocity")):
        assert flag in flags[e], (e, flag)
    for control in (0, 1, 3):
        assert not flags.get(control, set()) & {"zero_variance_dim", "alignment_fail", "outlier_length", "low_movement", "high_action_velocity"}


def test_failing_metric_is_noted(frames, monkeypatch):
    def fail(*_):
        raise ValueError("no such dim")

    monkeypatch.setattr(A.M, "coverage", fail)
    a = A.audit(frames, FPS, 6, 6, [(0, 0)])
    assert a.errors == {"coverage": "ValueError: no such dim"} and "speed" in a.tables


def test_report(audited, frames):
    js, page = A.report(audited, 5)
    assert '"flags"' in js and "<table>" in page
    s = A.summary(frames, audited.flags).first()
    assert (s.n_episodes, s.n_frames, s.median_frames) == (9, 3000, 300.0)


def test_report_lists_all_flags(spark, tmp_path):
    many = spark.range(300).selectExpr("299 - id AS episode")
    a = A.Audit({"speed": many}, {}, many)
    js, page = A.report(a)
    found = json.loads(js)
    assert [r["episode"] for r in found["tables"]["flags"]] == list(range(300))
    assert [r["episode"] for r in found["tables"]["speed"]] == list(range(200)) and found["totals"]["speed"] == 300
    assert page.count("first 200 of 300 rows") == 1
    A.write(a, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/speed").count() == 300


def test_speed_equals_numpy(frames, audited):
    data = {e: np.float32(a).astype(float) for e, (_, a) in faults().items()}
    v = {e: K.finite_diff(a, FPS) for e, a in data.items()}
    flat = np.abs(np.concatenate([x.ravel() for x in v.values()]))
    eps = 1e-3 * (np.percentile(flat, 75) - np.percentile(flat, 25))
    for r in audited.tables["speed"].where("role = 'action'").collect():
        x, j = np.abs(v[r.episode]), np.abs(K.finite_diff(v[r.episode], FPS))
        assert np.allclose([r.mean_speed, r.median_speed, r.p95_speed, r.max_speed, r.p95_jerk], [x.mean(), np.median(x), np.percentile(x, 95), x.max(), np.percentile(j, 95)], rtol=1e-6)
        assert abs(r.stillness_max_dim - (x < eps).mean(axis=0).max()) < 1e-9


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.normal(size=3000)] + [("b", float(x)) for x in rng.integers(0, 5, 2000)] + [("c", 7.0), ("d", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    got = M.pooled_quantiles(df, "x", (0.01, 0.5, 0.99), ["g"], bins=16, few=50)
    assert set(got) == {("a",), ("b",), ("c",)}
    for g in "abc":
        assert np.allclose(got[g,], np.percentile([x for k, x in rows if k == g], [1, 50, 99]))
    assert M.pooled_quantiles(df.limit(0), "x", (0.5,)) == {}


def test_autocorrelation_kernels():
    rng = np.random.default_rng(0)
    x = np.cumsum(rng.normal(size=400))
    c = x - x.mean()
    want = [float(c[: 400 - k] @ c[k:]) / float(c @ c) for k in range(41)]
    assert np.allclose(K.acf(x, 40), want) and np.isnan(K.acf(np.full(9, 0.37), 3)).all()
    assert K.tau_int(np.array([1, 0.5, 0.25, -0.1, 0.9])) == 2.5 and K.tau_half(np.array([1, 0.6, 0.4])) == 2


def test_ess_of_alternating_signs(spark):
    rows = [(e, f, "action", d, float((-1) ** f) if d == 0 else 1.0) for e, n in ((0, 4), (1, 8)) for f in range(n) for d in range(2)]
    long = spark.createDataFrame(rows, "episode long, frame long, role string, dim int, x double")
    assert M.ess_total(M.autocorrelation(long, 30.0)).first()[0] == 12


def test_summary_leaves_out_what_is_not_finite(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    r = M.scalar_summary(df, "x").first()
    assert (r.n, r.mean, r.median, r.std, r.min, r.max) == (2, 2.0, 2.0, 1.0, 1.0, 3.0)
    assert M.scalar_summary(df.limit(0), "x").first().mean is None


def test_histogram_closes_its_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    assert [r.n for r in M.histogram(df, "x", [], 5).orderBy("bin").collect()] == np.histogram(range(11), 5)[0].tolist()
    assert [r.n for r in M.histogram(df.where("x = 3"), "x", [], 5).collect()] == [1]


def test_filters():
    for order in (1, 2, 3, 4):
        sos = K.butter_sos(order, 3.0, 50.0)
        w = np.exp(-1j * np.array([0.0, 2 * np.pi * 3 / 50, np.pi]))
        h = np.prod([(b0 + b1 * w + b2 * w**2) / (1 + a1 * w + a2 * w**2) for b0, b1, b2, _, a1, a2 in sos], axis=0)
        assert np.allclose(np.abs(h), [1, np.sqrt(0.5), 0], atol=1e-9)
        x = np.full((60, 2), 3.7)
        assert np.allclose(K.lowpass_causal(x, 50, 3, order), 3.7) and np.allclose(K.lowpass(x, 50, 3, order), 3.7)
    t = np.arange(400) / 50
    low, high = np.sin(2 * np.pi * 0.3 * t)[:, None], np.sin(2 * np.pi * 20 * t)[:, None]
    assert np.abs(K.lowpass(low + high, 50, 3)[50:-50] - low[50:-50]).max() < 0.02
    with pytest.raises(ValueError, match="half the sampling rate"):
        K.butter_sos(2, 30, 50)
    x, ts = K.resample_uniform(np.array([[0.0], [1.0], [2.0], [3.0]]), np.array([0, 10, 21, 30]))
    assert ts.tolist() == [0, 10, 20, 30] and x[:, 0].tolist() == [0, 1, 2, 3]


def test_causal_filter_sample_by_sample_is_the_batch():
    x = np.random.default_rng(1).normal(size=(50, 1))
    sos = K.butter_sos(2, 3, 50)
    state, out = K.sos_rest(sos)[:, :, None] * x[0], []
    for row in x:
        y, state = K.sos_run(sos, row[None], state)
        out.append(y[0])
    assert np.allclose(out, K.lowpass_causal(x, 50, 3))


def test_knn_entropy():
    rng = np.random.default_rng(0)
    even, tight = rng.uniform(size=(500, 2)), np.concatenate([rng.normal(0, 1e-3, (490, 2)), rng.uniform(size=(10, 2))])
    assert 0 <= K.knn_entropy(tight) < K.knn_entropy(even) <= 1 and np.isnan(K.knn_entropy(np.zeros((3, 2))))


def brute_entropy(x, k=5):
    near = np.array([np.sort(np.sqrt(((x - r) ** 2).sum(axis=1)))[k] for r in x])
    return K.histogram_entropy(near[near > 0])


def test_density_entropy_takes_all_rows(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(5400, 4)), rng.normal(100, 0.01, (400, 4)), np.repeat(rng.normal(size=(3, 4)), [2, 4, 300], axis=0)])
    f = spark.createDataFrame([(0, i, r.tolist()) for i, r in enumerate(x)], "episode long, frame long, state array<double>")
    odd = spark.createDataFrame([(1, 0, None), (1, 1, [1.0]), (1, 2, [1.0, None, 2.0, 3.0]), (1, 3, [float("nan")] * 4)], f.schema)
    for rows, n in ((f, len(x)), (f.union(odd), len(x) + 4)):
        r = M.density_entropy(rows, "state").collect()
        assert len(r) == 1 and r[0].n == n and abs(r[0].density_entropy - brute_entropy(x)) < 1e-9
    r = M.density_entropy(f.where("frame >= 5806"), "state").first()  # copies of one vector alone
    assert r.n == 300 and r.density_entropy is None
    r = M.density_entropy(f.limit(0), "state").first()
    assert r.n == 0 and r.density_entropy is None


def test_nearest_over_blocks():
    rng = np.random.default_rng(4)
    for x in (rng.normal(size=(300, 3)), np.unique(rng.integers(0, 5, (200, 3)), axis=0) + 1e7, np.concatenate([rng.normal(size=(90, 3)), [[1e9, 0, 0]]])):
        for q in (x, x[:70]):
            blocks = [(0, q[:7], np.ones(7, int)), (7, q[7:], np.ones(len(q) - 7, int))] + [(None, x[at : at + 64], np.ones(len(x[at : at + 64]), int)) for at in range(len(q), len(x), 64)]
            best, copies = K.nearest(q, blocks, 5, rows=32)
            full = np.sort(((q[:, None] - x[None]) ** 2).sum(axis=2), axis=1)[:, 1:6]
            assert np.array_equal(best, full) and (copies == 1).all()


def test_effective_dim(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 1)) * np.ones((1, 4)) + rng.normal(size=(200, 4)) * 0.01
    f = spark.createDataFrame([(0, i, r.tolist()) for i, r in enumerate(x)], "episode long, frame long, state array<double>")
    v = np.linalg.eigvalsh(np.cov(x, rowvar=False))
    r = M.effective_dim(f, "state", 4).first()
    assert abs(r.pr - v.sum() ** 2 / (v**2).sum()) < 1e-9 and r.pcs_95 == 1 and r.low
