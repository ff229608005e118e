"""All audit metrics over an episode dataset; a metric that fails is noted and the others run."""

from __future__ import annotations

import html
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.operators import metrics as M
from epiframe.sources.shared import staged


@dataclass
class Audit:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    flags: DataFrame | None = None


@dataclass(frozen=True)
class Inputs:
    """What a metric may read: ``frames`` (episode, frame, state, action), their long form, and the dataset's figures."""

    frames: DataFrame
    long: DataFrame
    fps: float
    state_dims: int
    action_dims: int
    pairs: tuple[tuple[int, int], ...]


#: name -> f(inputs) giving tables by name. Boolean columns of tables with ``episode`` whose names are in FLAGGED are flags.
METRICS: dict[str, Callable[[Inputs], dict[str, DataFrame]]] = {}
FLAGGED: list[str] = []


def register_metric(name: str, *flagged: str):
    """Enter a metric; ``flagged`` are those of its tables that hold flags."""

    def add(f):
        METRICS[name] = f
        FLAGGED.extend(t for t in flagged if t not in FLAGGED)
        return f

    return add


@register_metric("autocorrelation", "stuck")
def autocorrelation(x: Inputs) -> dict[str, DataFrame]:
    acf = staged(M.autocorrelation(x.long, x.fps), "acf")
    return {"autocorrelation": acf, "stuck": acf.groupBy("episode").agg(F.max("stuck").alias("stuck_sensor")), "ess_total": M.ess_total(acf), "action_acf": M.action_acf(x.long)}


@register_metric("alignment", "alignment_flags")
def alignment(x: Inputs) -> dict[str, DataFrame]:
    found = staged(M.alignment(x.long, list(x.pairs), x.fps), "lags")
    return {"alignment": found, "alignment_flags": M.alignment_flags(found)}


@register_metric("speed", "speed_flags")
def speed(x: Inputs) -> dict[str, DataFrame]:
    per, _ = M.speed(x.long, x.fps)
    per, own = staged(per, "speed"), M.action_speed(x.long)
    return {"speed": per, "speed_flags": M.speed_flags(per), "action_speed": own, "speed_verdict": M.speed_verdict(own)}


@register_metric("variance", "variance_outliers")
def variance(x: Inputs) -> dict[str, DataFrame]:
    found = M.spread(x.long, x.fps)
    return {"spread": found, "variance_bins": M.variance_bins(x.long), "variance_outliers": M.variance_outliers(found)}


@register_metric("action_velocity", "action_velocity")
def action_velocity(x: Inputs) -> dict[str, DataFrame]:
    found = M.action_velocity(x.long)
    return {"action_velocity": found, "top_jerky": M.top_jerky(found)}


@register_metric("filtering", "filtering")
def filtering(x: Inputs) -> dict[str, DataFrame]:
    return {"filtering": M.filtering(x.long)}


@register_metric("coverage")
def coverage(x: Inputs) -> dict[str, DataFrame]:
    sides = [M.density_entropy(x.frames, side) for side, n in (("state", x.state_dims), ("action", x.action_dims)) if n]
    return {"coverage": M.coverage(x.long), **({"density_entropy": reduce(DataFrame.union, sides)} if sides else {})}


@register_metric("effective_dim")
def effective_dim(x: Inputs) -> dict[str, DataFrame]:
    return {"effective_dim": M.effective_dim(x.frames, "state", x.state_dims).union(M.effective_dim(x.frames, "action", x.action_dims))}


@register_metric("smoothness")
def smoothness(x: Inputs) -> dict[str, DataFrame]:
    return {"smoothness": M.smoothness(x.long, x.fps)}


def audit(frames: DataFrame, fps: float, state_dims: int, action_dims: int, pairs: list[tuple[int, int]], metrics: list[str] | None = None) -> Audit:
    """All registered metrics, or those named, over ``episode, frame, state, action``.

    Each metric's tables are written to the shared folder before the next one begins, so one that fails, in whatever task, is noted
    and has no table, and the others stand.
    """
    inputs, out = Inputs(frames, M.long_form(frames), fps, state_dims, action_dims, tuple(map(tuple, pairs))), Audit()
    for name in METRICS if metrics is None else metrics:
        try:
            out.tables |= {n: staged(t, n.replace("_", "-")) for n, t in METRICS[name](inputs).items()}
        except Exception as e:  # noqa: BLE001  one metric shall not stop the others
            out.errors[name] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    flagged = [out.tables[t] for t in FLAGGED if t in out.tables]
    out.flags = M.flag_table(*flagged) if flagged else None
    return out


def summary(frames: DataFrame, flags: DataFrame) -> DataFrame:
    per = frames.groupBy("episode").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("n_episodes"), F.sum("n").alias("n_frames"), F.percentile("n", 0.5).alias("median_frames")).withColumn("n_flagged", flags.agg(F.count("*")).scalar())


def write(a: Audit, folder: str) -> None:
    """Each whole table as parquet under its name in ``folder``, which the executors share."""
    for name, t in (a.tables | ({"flags": a.flags} if a.flags is not None else {})).items():
        t.write.mode("overwrite").parquet(f"{folder}/{name}")


def report(a: Audit, rows: int = 200) -> tuple[str, str]:
    """(JSON, HTML) with all flags and the first ``rows`` of each other table, sorted, with the total of a table that is cut; ``write`` has them whole."""
    found, totals = {}, {}
    for n, t in a.tables.items():
        t = t.orderBy(*[c for c, kind in t.dtypes if "map<" not in kind])
        top = t.limit(rows + 1).collect()
        totals[n] = t.count() if len(top) > rows else len(top)
        found[n] = [r.asDict(recursive=True) for r in top[:rows]]
    if a.flags is not None:
        found["flags"] = [r.asDict() for r in a.flags.orderBy("episode").collect()]
        totals["flags"] = len(found["flags"])
    parts = []
    for name, rs in found.items():
        head = "".join(f"<th>{html.escape(c)}</th>" for c in (rs[0] if rs else ()))
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r.values()) + "</tr>" for r in rs)
        cut = f"<p>first {len(rs)} of {totals[name]} rows</p>" if len(rs) < totals[name] else ""
        parts.append(f"<h2>{html.escape(name)}</h2>{cut}<table><tr>{head}</tr>{body}</table>")
    return json.dumps({"tables": found, "totals": totals, "errors": a.errors}, default=str), f"<!doctype html><title>Audit</title>{''.join(parts)}"
