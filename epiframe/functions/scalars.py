"""Small expressions with the rounding and null rules that the engine keeps to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """NULL for NaN and infinities, so that aggregates leave them out."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def half_even(x: Column) -> Column:
    """Round to an integer, halves to the even one."""
    return F.rint(x).cast("long")


def stamp_ns(sec: Column, nanosec: Column) -> Column:
    return sec.cast("long") * 1_000_000_000 + nanosec.cast("long")


def frame_of(ts: Column, start: Column, step_ns: int) -> Column:
    return half_even((ts - start) / step_ns)


def frame_ts(frame: Column, start: Column, step_ns: int) -> Column:
    return start + frame * step_ns


def video_frame(offset_s: Column, fps: float) -> Column:
    """Number of a packed video's frame at an offset in seconds."""
    return half_even(offset_s * fps)


def strip_prefix(name: Column, prefix: str) -> Column:
    return F.regexp_replace(name, "^" + prefix.replace(".", r"\."), "")


def tags(text: Column) -> Column:
    """Comma-separated tags, trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(text, ","), lambda t: F.trim(t)), lambda t: t != "")


def is_true(text: Column) -> Column:
    return F.lower(F.trim(text)).isin("1", "true", "yes", "on")


def or_one(x: Column) -> Column:
    """0 and NULL count as 1."""
    return F.coalesce(F.nullif(x, F.lit(0.0)), F.lit(1.0))


def content_key(*cols: Column) -> Column:
    """SHA-256 of the columns as canonical JSON."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def minus(a: Column, b: Column) -> Column:
    """Element-wise difference of two vectors."""
    return F.zip_with(a, b, lambda x, y: x - y)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
