"""Picture columns: raw pixels, depths and sizes in Arrow batches; codecs as plain filters.

A picture is a struct ``height, width, data`` of red, green and blue bytes. Encoded pictures are never decoded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.functions.decoders import depth_to_gray, rgb_pixels

PICTURE = "height int, width int, data binary"


def of_codec(rows: DataFrame, column: str, *codecs: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose picture is there and in one of the codecs, rows of other codecs); case does not count, rows without a picture are in neither."""
    there = rows.where(F.col(f"{column}.data").isNotNull() & (F.octet_length(f"{column}.data") > 0))
    own = F.coalesce(F.lower(f"{column}.format").isin(*[c.lower() for c in codecs]), F.lit(False))
    return there.where(own), there.where(~own)


def _each(run: Callable, kind: str):
    """A pandas function over a struct column that gives null for null rows."""

    @F.pandas_udf(kind)
    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([run(*r) for r in pdf.itertuples(index=False, name=None)], columns=["height", "width", "data"])

    return call


def rgb(image: Column) -> Column:
    """A raw picture (``height, width, encoding, data``) as a picture; an unknown encoding raises."""

    def run(height, width, encoding, data) -> tuple:
        return (None, None, None) if data is None else (height, width, np.ascontiguousarray(rgb_pixels(data, int(height), int(width), encoding)).tobytes())

    return _each(run, PICTURE)(image)


def gray(depth: Column, near: float, far: float, invalid: str | float = "far") -> Column:
    """Depths (an array of numbers) as bytes, see ``depth_to_gray``."""

    @F.pandas_udf("binary")
    def run(d: pd.Series) -> pd.Series:
        return d.map(lambda v: None if v is None else depth_to_gray(np.asarray(v, float), near, far, invalid).tobytes())

    return run(depth.cast("array<double>"))


def resize(px: np.ndarray, height: int, width: int) -> np.ndarray:
    """Linear between the middles of pixels, edges repeated; as it is if the size is the same."""
    if px.shape[:2] == (height, width):
        return px

    def axis(x: np.ndarray, n: int) -> np.ndarray:
        at = np.clip((np.arange(n) + 0.5) * len(x) / n - 0.5, 0, len(x) - 1)
        low = np.minimum(at.astype(int), max(0, len(x) - 2))
        part = (at - low).reshape(-1, *[1] * (x.ndim - 1))
        return x[low] * (1 - part) + x[np.minimum(low + 1, len(x) - 1)] * part

    tall = axis(px.astype(float), height)
    return np.rint(axis(tall.swapaxes(0, 1), width).swapaxes(0, 1)).astype(np.uint8)


def resized(picture: Column, height: int, width: int) -> Column:
    """A picture at another size."""

    def run(h, w, data) -> tuple:
        if data is None:
            return None, None, None
        px = np.frombuffer(data, np.uint8).reshape(int(h), int(w), 3)
        return height, width, np.ascontiguousarray(resize(px, height, width)).tobytes()

    return _each(run, PICTURE)(picture)
