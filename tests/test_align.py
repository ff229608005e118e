import numpy as np
import pandas as pd
import pytest

from epiframe.operators import asof

KEY = "ep"


def tables(spark, seed):
    rng = np.random.default_rng(seed)
    g, s = [], []
    for ep in range(6):
        for f, t in enumerate(np.sort(rng.choice(2400, rng.integers(1, 30), replace=False)) - 200):
            g.append((ep, f, int(t)))
        for q, t in enumerate(np.sort(rng.choice(2000, rng.integers(1, 29), replace=seed % 2 == 0))):
            s.append((ep, int(t), q, float(rng.normal())))
    grid = spark.createDataFrame(g, "ep long, frame long, ts long")
    return grid, spark.createDataFrame(s, "ep long, ts long, seq long, v double"), pd.DataFrame(g, columns=["ep", "frame", "ts"]), pd.DataFrame(s, columns=["ep", "ts", "seq", "v"])


def merged(g, s, direction, tolerance):
    # pandas takes the later of equal nearest distances nowhere: backward wins, as here
    return pd.merge_asof(g.sort_values("ts", kind="stable"), s.sort_values(["ts", "seq"])[["ep", "ts", "v"]].assign(st=lambda d: d.ts), on="ts", by="ep", direction=direction, tolerance=tolerance)


@pytest.mark.parametrize("slice_ns", [None, 300])
@pytest.mark.parametrize("tolerance", [None, 20, 100])
def test_asof_equals_pandas(spark, tolerance, slice_ns):
    for seed in (1, 2):
        grid, stream, g, s = tables(spark, seed)
        for direction in ("backward", "forward"):
            want = {(r.ep, r.frame): None if r.v != r.v else r.v for r in merged(g, s, direction, tolerance).itertuples()}
            got = {(r.ep, r.frame): r.v for r in asof.asof(grid, stream, KEY, ["v"], direction, tolerance, slice_ns).collect()}
            assert got == want
        if seed % 2:
            want = {(r.ep, r.frame): None if r.v != r.v else r.v for r in merged(g, s, "nearest", tolerance).itertuples()}
            got = {(r.ep, r.frame): r.v for r in asof.nearest(grid, stream, KEY, ["v"], tolerance, slice_ns).collect()}
            assert got == want


def small(spark, rows):
    return spark.createDataFrame([(0, t, i, float(v)) for i, (t, v) in enumerate(rows)], "ep long, ts long, seq long, v double")


def at(spark, *times):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(times)], "ep long, frame long, ts long")


def values(df):
    return [r.v for r in df.orderBy("frame").collect()]


def test_ties_duplicates_and_bounds(spark):
    s = small(spark, [(100, 1), (200, 2), (200, 3), (400, 4)])
    assert values(asof.nearest(at(spark, 150), s, KEY, ["v"])) == [1.0]
    assert values(asof.asof(at(spark, 200, 300, 301, 99), s, KEY, ["v"], "backward", 100)) == [3.0, 3.0, None, None]
    assert values(asof.asof(at(spark, 200, 401), s, KEY, ["v"], "forward")) == [2.0, None]
    assert values(asof.linear(at(spark, 100, 150, 300, 50, 450), s, KEY, ["v"], 100)) == [1.0, 1.5, 3.5, 1.0, 4.0]
    assert values(asof.linear(at(spark, 120, 180), small(spark, [(100, 0), (200, 10)]), KEY, ["v"], 30)) == [0.0, 10.0]
    assert len(values(asof.exact(at(spark, 200, 201), s, KEY, ["v"]))) == 3
    with pytest.raises(ValueError, match="unknown alignment"):
        asof.align(at(spark, 1), s, KEY, ["v"], "cubic")


def test_timeline(spark):
    e = spark.createDataFrame([(0, 10, 35), (1, 5, 5), (2, 9, 8), (3, None, 4)], "ep long, start_ns long, end_ns long")
    assert [(r.ep, r.frame, r.ts) for r in asof.timeline(e, KEY, 10).orderBy("ep", "frame").collect()] == [(0, 0, 10), (0, 1, 20), (0, 2, 30), (1, 0, 5)]


def test_empty_sides(spark):
    s, g = small(spark, [(1, 1)]), at(spark, 1)
    assert values(asof.nearest(g, s.limit(0), KEY, ["v"])) == [None]
    assert values(asof.nearest(g.limit(0), s, KEY, ["v"])) == []


def test_one_sweep_for_all_methods(spark):
    """Vectors of several streams with their own methods, in one exchange by key; exact repeats repeat frames."""
    s = small(spark, [(0, 0), (100, 10), (100, 20)])
    vec = s.selectExpr("ep", "ts", "seq", "array(v, -v) AS values")
    one = s.selectExpr("ep", "ts", "seq", "v AS values")
    grid = at(spark, 0, 25, 100, 300)
    out = asof.align_all(grid, {"a.b": (vec, "linear", None), "h": (one, "hold", 0.0001), "n": (vec, "nearest", None), "x": (one, "none", None)}, KEY)
    got = sorted(((r.frame, r["a.b"], r.h, r.n, r.x) for r in out.collect()), key=repr)
    assert got == [(0, [0.0, 0.0], 0.0, [0.0, 0.0], 0.0), (1, [2.5, -2.5], 0.0, [0.0, 0.0], None), (2, [20.0, -20.0], 20.0, [20.0, -20.0], 10.0), (2, [20.0, -20.0], 20.0, [20.0, -20.0], 20.0), (3, [20.0, -20.0], None, [20.0, -20.0], None)]
    held = asof.align_all(grid, {k: (vec, "nearest", None) for k in "abcde"}, KEY)
    assert held._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError, match="unknown alignment"):
        asof.align_all(grid, {"a": (one, "cubic", None)}, KEY)
