"""Timelines and as-of joins.

A stream has the episode key, ``ts`` (long nanoseconds), ``seq`` (tie-break) and value columns; a grid has the key,
``frame`` and ``ts``. Samples and grid rows are united and a running window carries the last sample (or,
in descending order, the next one) to each grid row: no inequality join, no unbounded-following frame. With ``slice_ns`` the time axis is cut, a
window sees one slice of one episode, and the last sample of earlier slices is carried in by a second,
small pass; an episode that holds a third of all rows is then many groups.

Rules: a sample at the grid time counts for both directions; tolerance is inclusive and None means any
distance; of samples at one time, backward takes the last by ``seq`` and forward the first; nearest takes
the earlier of two at the same distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NS = 1_000_000_000
METHODS = ("hold", "nearest", "linear", "none")


def timeline(episodes: DataFrame, key: str, step_ns: int, start: str = "start_ns", end: str = "end_ns") -> DataFrame:
    """``key, frame, ts``: a row each ``step_ns`` from start to end, both included where they fit."""
    last = F.expr(f"(`{end}` - `{start}`) div {int(step_ns)}")
    rows = episodes.where(F.col(end) >= F.col(start)).select(key, F.col(start).alias("_s"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("frame"))
    return rows.select(key, "frame", (F.col("_s") + F.col("frame") * step_ns).alias("ts"))


def _sweep(grid: DataFrame, streams: dict[str, tuple[DataFrame, list[str], set[str]]], key: str, slice_ns: int | None) -> DataFrame:
    """Grid rows with ``_<side>_<name>``: struct of ``ts`` and values of the sample beside each, by stream.

    ``streams``: name to (stream, value columns, sides of ``back`` and ``ahead``). All streams share one exchange by
    key and slice, and one sort a direction, however many there are.
    """
    rows = grid.select(key, "frame", "ts", F.lit(1).alias("_grid"), F.lit(None).cast("long").alias("seq"))
    for name, (stream, values, _) in streams.items():
        own = stream.select(key, "ts", F.lit(0).alias("_grid"), F.col("seq").cast("long").alias("seq"), F.struct("ts", *values).alias(f"_own_{name}"))
        rows = rows.unionByName(own, allowMissingColumns=True)
    rows = rows.withColumn("_cut", F.expr(f"ts div {int(slice_ns)}") if slice_ns else F.lit(0).cast("long"))
    order = {"back": [F.col("ts"), F.col("_grid"), F.col("seq")], "ahead": [F.col("ts").desc(), F.col("_grid"), F.col("seq").desc()]}
    run = {side: Window.partitionBy(key, "_cut").orderBy(*o).rowsBetween(Window.unboundedPreceding, 0) for side, o in order.items()}
    wanted = [(side, name) for name, (_, _, sides) in streams.items() for side in sorted(sides)]
    hits = [F.last(f"_own_{name}", ignorenulls=True).over(run[side]).alias(f"_{side}_{name}") for side, name in wanted]
    found = rows.select(key, "frame", "ts", "_grid", "_cut", *hits).where("_grid = 1").drop("_grid")
    if not slice_ns:
        return found.drop("_cut")

    def end(side: str, name: str) -> Column:
        own = F.col(f"_own_{name}")
        at = F.when(own.isNotNull(), F.struct("ts", "seq"))  # other rows have no sample of this stream to leave
        return (F.max_by(own, at) if side == "back" else F.min_by(own, at)).alias(f"_{side}_{name}")

    ends = rows.groupBy(key, "_cut").agg(*[end(*w) for w in wanted])
    past = {side: Window.partitionBy(key).orderBy(F.col("_cut") if side == "back" else F.col("_cut").desc()).rowsBetween(Window.unboundedPreceding, -1) for side in order}
    carried = ends.select(F.col(key).alias("_k"), F.col("_cut").alias("_c"), *[F.last(f"_{s}_{n}", ignorenulls=True).over(past[s]).alias(f"_carry_{s}_{n}") for s, n in wanted])
    joined = found.join(carried, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_cut") == F.col("_c")), "left")
    return joined.select(key, "frame", "ts", *[F.coalesce(f"_{s}_{n}", f"_carry_{s}_{n}").alias(f"_{s}_{n}") for s, n in wanted])


def _within(hit: Column, distance: Column, tolerance_ns: int | None) -> Column:
    near = hit.isNotNull() if tolerance_ns is None else distance <= F.lit(tolerance_ns).cast("long")
    return F.when(near, hit)


#: Which neighbours a method looks at.
SIDES = {"hold": {"back"}, "forward": {"ahead"}, "nearest": {"back", "ahead"}, "linear": {"back", "ahead"}}


def _chosen(name: str, method: str, values: dict[str, str], tolerance_ns: int | None) -> dict[str, Column]:
    """Columns of one stream after a sweep: each value, and ``sample_ts`` where one sample is taken."""
    ts = F.col("ts")
    if "back" in SIDES[method]:
        b = F.col(f"`_back_{name}`")
        b = _within(b, ts - b["ts"], tolerance_ns)
    if "ahead" in SIDES[method]:
        a = F.col(f"`_ahead_{name}`")
        a = _within(a, a["ts"] - ts, tolerance_ns)
    if method == "linear":
        span = a["ts"] - b["ts"]
        at = F.when(span == 0, F.lit(0.0)).otherwise((ts - b["ts"]) / F.nullif(span, F.lit(0)))

        def mixed(v: str, kind: str) -> Column:
            if kind == "array":
                both = F.zip_with(b[v], F.transform(a[v], lambda y: F.struct(y.alias("y"), at.alias("at"))), lambda x, p: x + (p["y"] - x) * p["at"])
            else:
                both = b[v] + (a[v] - b[v]) * at
            return F.when(b.isNull(), a[v]).when(a.isNull() | (at == 0), b[v]).otherwise(both)

        return {v: mixed(v, kind) for v, kind in values.items()}
    if method == "nearest":
        hit = F.when(b.isNotNull() & (a.isNull() | (ts - b["ts"] <= a["ts"] - ts)), b).otherwise(a)
    else:
        hit = b if method == "hold" else a
    return {"sample_ts": hit["ts"], **{v: hit[v] for v in values}}


def _one(grid: DataFrame, stream: DataFrame, key: str, values: list[str], method: str, tolerance_ns: int | None, slice_ns: int | None) -> DataFrame:
    kinds = {v: stream.schema[v].dataType.typeName() for v in values}
    swept = _sweep(grid, {"s": (stream, values, SIDES[method])}, key, slice_ns)
    return swept.select(key, "frame", "ts", *[c.alias(n) for n, c in _chosen("s", method, kinds, tolerance_ns).items()])


def asof(grid: DataFrame, stream: DataFrame, key: str, values: list[str], direction: str = "backward", tolerance_ns: int | None = None, slice_ns: int | None = None) -> DataFrame:
    """Grid plus ``values`` and ``sample_ts`` of the sample ``backward`` (at or before) or ``forward`` (at or after)."""
    return _one(grid, stream, key, values, "forward" if direction == "forward" else "hold", tolerance_ns, slice_ns)


def nearest(grid: DataFrame, stream: DataFrame, key: str, values: list[str], tolerance_ns: int | None = None, slice_ns: int | None = None) -> DataFrame:
    return _one(grid, stream, key, values, "nearest", tolerance_ns, slice_ns)


def linear(grid: DataFrame, stream: DataFrame, key: str, values: list[str], tolerance_ns: int | None = None, slice_ns: int | None = None) -> DataFrame:
    """Interpolated values; with one side out of tolerance the other side's value, with both out NULL.

    Values are doubles or arrays of them. The fraction is of exact nanosecond differences.
    """
    return _one(grid, stream, key, values, "linear", tolerance_ns, slice_ns)


def held(grid: DataFrame, streams: dict[str, DataFrame], key: str, tolerances_ns: dict[str, int], slice_ns: int | None = None) -> DataFrame:
    """Grid plus the column ``value`` of each stream's last sample within its tolerance, under the stream's name; one sweep for all."""
    swept = _sweep(grid, {k: (s, ["value"], SIDES["hold"]) for k, s in streams.items()}, key, slice_ns)
    return swept.select(key, "frame", "ts", *[_chosen(k, "hold", {"value": "double"}, tolerances_ns[k])["value"].alias(k) for k in streams])


def exact(grid: DataFrame, stream: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Samples at the grid time itself; repeated samples repeat the grid row."""
    there = stream.select(F.col(key).alias("_k"), F.col("ts").alias("_t"), *values)
    return grid.join(there, F.col(key).eqNullSafe(F.col("_k")) & (F.col("ts") == F.col("_t")), "left").drop("_k", "_t")


def align(grid: DataFrame, stream: DataFrame, key: str, values: list[str], method: str, tolerance_ms: float | None = None, slice_ns: int | None = None) -> DataFrame:
    """One of METHODS, with the tolerance in milliseconds; grid columns and ``values`` come back."""
    tolerance = None if tolerance_ms is None else int(tolerance_ms * 1e6)
    if method == "hold":
        return asof(grid, stream, key, values, "backward", tolerance, slice_ns).drop("sample_ts")
    if method == "nearest":
        return nearest(grid, stream, key, values, tolerance, slice_ns).drop("sample_ts")
    if method == "linear":
        return linear(grid, stream, key, values, tolerance, slice_ns)
    if method == "none":
        return exact(grid, stream, key, values)
    raise ValueError(f"unknown alignment method {method!r}; known: {', '.join(METHODS)}")


def align_all(grid: DataFrame, streams: dict[str, tuple[DataFrame, str, float | None]], key: str, slice_ns: int | None = None) -> DataFrame:
    """Grid plus one column per stream: name to (stream with a column ``values``, method, tolerance in ms).

    All but exact streams are aligned in one sweep; exact ones are joined, and their repeats repeat rows.
    """
    for name, (_, method, _) in streams.items():
        if method not in METHODS:
            raise ValueError(f"{name}: unknown alignment method {method!r}; known: {', '.join(METHODS)}")
    swept = {f"s{i}": (name, *spec) for i, (name, spec) in enumerate(streams.items()) if spec[1] != "none"}
    out = grid.select(key, "frame", "ts")
    if swept:
        out = _sweep(grid, {k: (stream, ["values"], SIDES[method]) for k, (_, stream, method, _) in swept.items()}, key, slice_ns)
        cols = []
        for k, (name, stream, method, tolerance) in swept.items():
            kinds = {"values": stream.schema["values"].dataType.typeName()}
            cols.append(_chosen(k, method, kinds, None if tolerance is None else int(tolerance * 1e6))["values"].alias(name))
        out = out.select(key, "frame", "ts", *cols)
    for name, (stream, method, _) in streams.items():
        if method == "none":
            there = stream.select(F.col(key).alias("_k"), F.col("ts").alias("_t"), F.col("values").alias(name))
            out = out.join(there, F.col(key).eqNullSafe(F.col("_k")) & (F.col("ts") == F.col("_t")), "left").drop("_k", "_t")
    return out.select(key, "frame", "ts", *[F.col(f"`{n}`") for n in streams])
