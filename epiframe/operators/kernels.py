"""Numpy kernels on one episode's or stream's rows: what built-in expressions cannot say."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np


def finite_diff(x: np.ndarray, fps: float = 1.0) -> np.ndarray:
    """Forward differences times fps, the last one repeated; zeros for a single row."""
    if len(x) < 2:
        return np.zeros_like(x, dtype=float)
    d = np.diff(x, axis=0) * fps
    return np.concatenate([d, d[-1:]])


def acf(col: np.ndarray, max_lag: int) -> np.ndarray:
    """Biased autocorrelation r(0..max_lag); NaN for a constant column."""
    c = np.asarray(col, float)
    if np.ptp(c) == 0 or not np.isfinite(c).all():
        return np.full(max_lag + 1, np.nan)
    c = c - c.mean()
    n = 1 << int(np.ceil(np.log2(2 * len(c))))
    f = np.fft.rfft(c, n)
    r = np.fft.irfft(f * np.conj(f), n)[: max_lag + 1]
    return r / r[0]


def tau_int(r: np.ndarray) -> float:
    """1 + 2 * the sum of r(1..) up to the first value that is negative or not finite."""
    if np.isnan(r).all():
        return float("nan")
    stop = np.flatnonzero(~np.isfinite(r[1:]) | (r[1:] < 0))
    return float(1 + 2 * r[1 : 1 + (stop[0] if len(stop) else len(r) - 1)].sum())


def tau_half(r: np.ndarray) -> float:
    """First lag whose r is below one half; NaN if there is none."""
    at = np.flatnonzero(np.nan_to_num(r, nan=1.0) < 0.5)
    return float(at[0]) if len(at) else float("nan")


def lag_cap(n: int, fps: float) -> int:
    return int(min(n // 4, max(1, 2 * round(fps)))) if fps > 0 else n // 4


def pearson_lags(a: np.ndarray, s: np.ndarray, max_lag: int) -> np.ndarray:
    """corr(a[t], s[t + lag]) for lags -max_lag..max_lag; NaN where a part is constant."""
    out, n = np.full(2 * max_lag + 1, np.nan), min(len(a), len(s))
    for k in range(-max_lag, max_lag + 1):
        x, y = a[max(0, -k) : n - max(0, k)], s[max(0, k) : n - max(0, -k)]
        if len(x) >= 2:
            x, y = x - x.mean(), y - y.mean()
            d = np.sqrt((x @ x) * (y @ y))
            if d >= 1e-12:
                out[k + max_lag] = x @ y / d
    return out


def xcorr_lags(a: np.ndarray, s: np.ndarray, max_lag: int) -> np.ndarray:
    """Mean product of the z-scores of a[t] and s[t + lag]."""
    x, y = (a - a.mean()) / (a.std() or 1.0), (s - s.mean()) / (s.std() or 1.0)
    n = len(x)
    return np.array([x[max(0, -k) : n - max(0, k)] @ y[max(0, k) : n - max(0, -k)] / max(n - abs(k), 1) for k in range(-max_lag, max_lag + 1)])


def sparc(speed: np.ndarray, fps: float, pad: int = 4, band_hz: float = 10.0) -> float:
    """Spectral arc length of a speed profile up to ``band_hz``; NaN for a short or silent one."""
    if len(speed) < 4 or fps <= 0:
        return float("nan")
    n = 1 << int(np.ceil(np.log2(len(speed))) + pad)
    f, m = np.fft.rfftfreq(n, 1 / fps), np.abs(np.fft.rfft(speed, n))
    if m.max() == 0:
        return float("nan")
    keep = f <= band_hz
    f, m = f[keep], m[keep] / m.max()
    if len(f) < 2 or f[-1] == 0:
        return float("nan")
    return float(-np.sqrt((np.diff(f) / f[-1]) ** 2 + np.diff(m) ** 2).sum())


def butter_sos(order: int, cutoff_hz: float, fs: float) -> np.ndarray:
    """Second-order sections (b0 b1 b2 a0 a1 a2) of a Butterworth low-pass: poles on a circle, bilinear map with pre-warping, gain 1 at rest."""
    if not 0 < cutoff_hz < fs / 2:
        raise ValueError(f"cutoff_hz={cutoff_hz} must lie between 0 and half the sampling rate ({fs / 2:.3f} Hz at fs={fs:.3f})")
    warped = 2 * fs * np.tan(np.pi * cutoff_hz / fs)
    poles = warped * np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    z = (2 * fs + poles) / (2 * fs - poles)
    rows = []
    for p in sorted((p for p in z if p.imag > 1e-12), key=lambda p: abs(p)):
        a = np.array([1.0, -2 * p.real, abs(p) ** 2])
        rows.append([*(np.array([1.0, 2.0, 1.0]) * a.sum() / 4), *a])
    for p in (p.real for p in z if abs(p.imag) <= 1e-12):
        rows.insert(0, [(1 - p) / 2, (1 - p) / 2, 0.0, 1.0, -p, 0.0])
    return np.array(rows)


def sos_rest(sos: np.ndarray) -> np.ndarray:
    """State of each section after it has seen ones for ever."""
    out, level = [], 1.0
    for b0, b1, b2, _, a1, a2 in sos:
        y = level * (b0 + b1 + b2) / (1 + a1 + a2)
        out.append([y - b0 * level, b2 * level - a2 * y])
        level = y
    return np.array(out)


@lru_cache(maxsize=64)
def _block(b0: float, b1: float, b2: float, a1: float, a2: float, size: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A section over ``size`` rows at once: rows to rows, state to rows, powers of the state's step, and a row's part in it so many rows on."""
    step, entry = np.array([[-a1, 1.0], [-a2, 0.0]]), np.array([b1 - a1 * b0, b2 - a2 * b0])
    powers = [np.eye(2)]
    for _ in range(size):
        powers.append(step @ powers[-1])
    into = np.array([p @ entry for p in powers[:size]])
    answer = np.append(b0, into[: size - 1, 0])
    lag = np.subtract.outer(np.arange(size), np.arange(size))
    return np.where(lag >= 0, answer[lag], 0.0), np.array([p[0] for p in powers[:size]]), np.array(powers), into


def sos_run(sos: np.ndarray, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filter rows of ``x`` (time, channels) from ``state`` (sections, 2, channels), a block of rows at a time; the state after them comes back too."""
    y, state = np.array(x, float), np.array(state, float)
    for k, (b0, b1, b2, _, a1, a2) in enumerate(sos):
        rows, out, powers, into = _block(*map(float, (b0, b1, b2, a1, a2)))
        z = state[k]
        for at in range(0, len(y), len(out)):
            part = y[at : at + len(out)].copy()
            n = len(part)
            y[at : at + n] = rows[:n, :n] @ part + out[:n] @ z
            z = powers[n] @ z + into[:n][::-1].T @ part
        state[k] = z
    return y, state


def lowpass_causal(x: np.ndarray, fs: float, cutoff_hz: float, order: int = 2, fs_hz: float | None = None) -> np.ndarray:
    sos = butter_sos(order, cutoff_hz, fs_hz or fs)
    return sos_run(sos, x, sos_rest(sos)[:, :, None] * x[0])[0]


def lowpass(x: np.ndarray, fs: float, cutoff_hz: float, order: int = 2) -> np.ndarray:
    """Forward and backward, on a signal that is extended oddly at both ends."""
    sos = butter_sos(order, cutoff_hz, fs)
    taps = 2 * len(sos) + 1 - min((sos[:, 2] == 0).sum(), (sos[:, 5] == 0).sum())
    pad = 3 * int(taps)
    if len(x) <= pad:
        raise ValueError(f"{len(x)} rows are too few for a zero-phase filter; more than {pad} are needed")
    wide = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]])
    rest = sos_rest(sos)[:, :, None]
    y, _ = sos_run(sos, wide, rest * wide[0])
    y, _ = sos_run(sos, y[::-1], rest * y[-1])
    return y[::-1][pad:-pad]


def resample_uniform(x: np.ndarray, ts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest samples (the later on ties) on an even grid from first to last time, stepping by the median interval.

    ``ts`` ascends. A grid time belongs to the sample whose cell it lies in; cells meet halfway between samples.
    """
    if len(ts) < 2:
        return x, ts
    span = ts[-1] - ts[0]
    steps = int(np.round(span / np.median(np.diff(ts))))
    grid = ts[0] + np.round(np.linspace(0, float(span), steps + 1)).astype(ts.dtype)
    cell = np.searchsorted(ts[:-1] + ts[1:], 2 * grid, side="right")  # twice the times: whole numbers stay whole
    cell = np.where(ts[cell] == grid, np.searchsorted(ts, grid), cell)  # of equal times the first
    return x[cell], grid


def histogram_entropy(values: np.ndarray) -> float:
    """Entropy of a histogram of a tenth as many bins (4 to 30), as a share of the most that its filled bins allow."""
    counts = np.histogram(values, bins=int(np.clip(len(values) // 10, 4, 30)))[0]
    counts, n = counts[counts > 0], len(values)
    return float((np.log(n) - counts @ np.log(counts) / n) / np.log(max(2, len(counts))))


def nearest(q: np.ndarray, blocks: Iterable[tuple[int | None, np.ndarray, np.ndarray]], k: int, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of the ``k`` nearest other vectors of each of ``q``, and how often each of those occurs.

    A block is distinct vectors and their numbers of copies, behind the row of ``q`` that its first vector is, if they are rows of ``q``.
    A matrix product gives a lower bound of each distance; where it is not above the k-th found, the distance is taken exactly.
    """
    best, copies = np.full((len(q), k), np.inf), np.zeros((len(q), k), np.int64)
    less = 1 - 4 * (q.shape[1] + 4) * np.finfo(float).eps
    square = less * (q * q).sum(axis=1)

    def exact(i: np.ndarray, x: np.ndarray, j: np.ndarray) -> np.ndarray:
        parts = [((q[i[at : at + 65536]] - x[j[at : at + 65536]]) ** 2).sum(axis=1) for at in range(0, len(i), 65536)]
        return np.concatenate([*parts, np.zeros(0)])

    for at, x, n in blocks:
        other = less * (x * x).sum(axis=1)
        for s in range(0, len(q), rows):
            low = square[s : s + rows, None] + other[None] - 2 * q[s : s + rows] @ x.T
            top = best[s : s + rows, -1]
            own = np.arange(max(s, at), min(s + len(low), at + len(x))) if at is not None else np.zeros(0, int)
            low[own - s, own - (at or 0)] = np.inf
            if len(x) > k and np.isinf(top).any():
                near = np.argpartition(low, k, axis=1)[:, :k]
                d = exact(s + np.repeat(np.arange(len(low)), k), x, near.ravel()).reshape(-1, k)
                top = np.minimum(top, np.where(np.isinf(np.take_along_axis(low, near, 1)), np.inf, d).max(axis=1))
            mask = ~(low > top[:, None])
            mask[own - s, own - (at or 0)] = False
            i, j = np.nonzero(mask)
            if not len(i):
                continue
            hit = np.unique(i)
            row = np.concatenate([np.repeat(hit, k), i])
            d = np.concatenate([best[s + hit].ravel(), exact(s + i, x, j)])
            c = np.concatenate([copies[s + hit].ravel(), n[j]])
            order = np.lexsort((d, row))
            row = row[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            order, row, rank = order[rank < k], row[rank < k], rank[rank < k]
            best[s + row, rank], copies[s + row, rank] = d[order], c[order]
    return best, copies


def kth_distance(best: np.ndarray, copies: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Distance to the k-th other row: 0 within the ``own`` copies of a vector, then by the copies of ``nearest``; infinite where there is none."""
    need = k + 1 - own
    reached = np.cumsum(copies, axis=1) >= need[:, None]
    d = np.sqrt(best[np.arange(len(best)), reached.argmax(axis=1)])
    return np.where(need <= 0, 0, np.where(reached.any(axis=1), d, np.inf))


def knn_entropy(x: np.ndarray, k: int = 5) -> float:
    """Entropy of the histogram of k-th neighbour distances of all rows over the log of its filled bins."""
    k = min(k, max(1, len(x) - 1))
    x, n = np.unique(x, axis=0, return_counts=True)
    near = np.repeat(kth_distance(*nearest(x, [(0, x, n)], k), n, k), n)
    near = near[np.isfinite(near) & (near > 0)]
    return histogram_entropy(near) if len(near) >= 4 else float("nan")
