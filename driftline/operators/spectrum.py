"""Multitaper spectra (X1-X5): one pandas call per (probe, window), as an FFT is no column expression."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..schema import SECOND

SCHEMA = "probe string, w_start long, freq double, psd double"


#: Places in each interval at which eigenvalues are counted in a pass.
SECTIONS = 48


def _largest(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The `count` largest eigenvalues of a symmetric tridiagonal matrix, descending: each is in an interval that is cut into
    sections, for all at once, by the number of negative pivots."""
    reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low, high = np.full(count, (diagonal - reach).min()), np.full(count, (diagonal + reach).max())
    wanted, squares, tiny = len(diagonal) - np.arange(count), off**2, np.finfo(float).tiny ** 0.5
    rows = list(zip(diagonal.tolist(), [0.0, *squares.tolist()]))
    while True:
        inner = np.linspace(0, 1, SECTIONS + 2)[1:-1]
        x = low[:, None] + (high - low)[:, None] * inner
        below, pivot = np.zeros(x.shape, np.int64), np.ones(x.shape)
        for d, s in rows:
            pivot = d - x - s / pivot
            pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
            below += pivot < 0
        # The k-th largest is above x where fewer than n - k eigenvalues are below it.
        above = (below < wanted[:, None]).sum(axis=1)
        edges = np.concatenate([low[:, None], x, high[:, None]], axis=1)
        at = np.arange(count)
        new_low, new_high = edges[at, above], edges[at, above + 1]
        if not ((new_high - new_low) < (high - low)).any() or (new_high - new_low <= 4e-16 * np.abs(new_high)).all():
            return (new_low + new_high) / 2
        low, high = new_low, new_high


def _vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, passes: int = 3) -> np.ndarray:
    """Eigenvectors (rows) of a symmetric tridiagonal matrix by inverse iteration, all values at once."""
    n, k = len(diagonal), len(values)
    scale = np.abs(diagonal).max() + np.abs(off).max()
    shift = values + scale * 1e-15 * (1 + np.arange(k))
    v = np.random.default_rng(0).standard_normal((n, k))
    # One elimination for all passes. Without exchange of rows: a shift near an eigenvalue makes the last pivots small, as it should.
    pivots, factors = np.empty((n, k)), np.empty((n, k))
    pivots[0] = diagonal[0] - shift
    for i in range(1, n):
        pivots[i - 1] = np.where(np.abs(pivots[i - 1]) < scale * 1e-17, scale * 1e-17, pivots[i - 1])
        factors[i] = off[i - 1] / pivots[i - 1]
        pivots[i] = diagonal[i] - shift - factors[i] * off[i - 1]
    pivots[-1] = np.where(np.abs(pivots[-1]) < scale * 1e-17, scale * 1e-17, pivots[-1])
    for _ in range(passes):
        for i in range(1, n):
            v[i] -= factors[i] * v[i - 1]
        v[-1] /= pivots[-1]
        for i in range(n - 2, -1, -1):
            v[i] = (v[i] - off[i] * v[i + 1]) / pivots[i]
        v, _ = np.linalg.qr(v)
    return v.T


@lru_cache(maxsize=32)
def tapers(n: int, half_bandwidth: float) -> tuple[np.ndarray, np.ndarray]:
    """The discrete prolate sequences and their concentrations, from the symmetric tridiagonal form: the few largest
    eigenvalues by bisection, their vectors by inverse iteration. Time and memory are in proportion to n."""
    w = half_bandwidth / n
    k = np.arange(n)
    diagonal = ((n - 1 - 2 * k) / 2) ** 2 * np.cos(2 * np.pi * w)
    off = k[1:] * (n - k[1:]) / 2
    count = max(1, int(2 * half_bandwidth) - 1)
    v = _vectors(diagonal, off, _largest(diagonal, off, count))
    for i in range(count):
        sign = v[i].sum() if i % 2 == 0 else v[i, 1] - v[i, 0] + v[i] @ (n - 1 - 2 * k)
        v[i] *= -1 if sign < 0 else 1
    lag = np.arange(n)
    kernel = np.where(lag == 0, 2 * w, np.sin(2 * np.pi * w * lag) / (np.pi * np.maximum(lag, 1)))
    size = 1 << (2 * n - 1).bit_length()
    correlation = np.fft.irfft(np.abs(np.fft.rfft(v, size, axis=1)) ** 2, size, axis=1)[:, :n]
    return v, correlation[:, 0] * kernel[0] + 2 * (correlation[:, 1:] * kernel[1:]).sum(axis=1)


def adaptive_weights(power: np.ndarray, ratios: np.ndarray, variance: float | None = None, most: int = 150, tolerance: float = 1e-10) -> np.ndarray:
    """Weights per taper and frequency, iterated until they settle (the largest mean square change of a frequency's weights).

    variance: of the series; None: the integral over all frequencies of the estimate with the tapers' own weights. Fewer than three
    tapers are an error; a spectrum of zeros has NaN weights.
    """
    if len(ratios) < 3:
        raise ValueError("adaptive weights need three tapers")
    e = ratios[:, None]

    def mean(weights: np.ndarray, part: np.ndarray) -> np.ndarray:
        return (weights**2 * part).sum(0) / (weights**2).sum(0)

    if variance is None:
        # One-sided densities: twice the weighted mean, half over the whole circle.
        variance = float(np.trapezoid(2 * mean(np.sqrt(e), power), dx=np.pi / power.shape[1]) / (2 * np.pi))
    s = mean(np.sqrt(e[:2]), power[:2])
    if not s.any():
        return np.full(power.shape, np.nan)
    before = np.zeros_like(power)
    for _ in range(most):
        d = np.sqrt(e) * s / (e * s + (1 - e) * variance)
        settled = np.max(np.mean((d - before) ** 2, axis=0)) < tolerance
        if settled:
            break
        s, before = mean(d, power), d
    return d


def multitaper(x: np.ndarray, dt: float, half_bandwidth: float = 4.0, weights: str = "eigen", n_fft: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(frequencies, one-sided density) of one series; weights: eigen, unity or adaptive."""
    n = len(x)
    n_fft = n_fft or max(256, 1 << (n - 1).bit_length())
    v, ratios = tapers(n, half_bandwidth)
    if weights != "unity":
        v, ratios = v[ratios > 0.9], ratios[ratios > 0.9]
    power = np.abs(np.fft.rfft((x - x.mean()) * v, n_fft, axis=1)) ** 2
    power[:, 0] /= 2
    if n_fft % 2 == 0:
        power[:, -1] /= 2
    if weights == "adaptive":
        d = adaptive_weights(power, ratios)
        psd = (d**2 * power).sum(0) / (d**2).sum(0)
    else:
        w = np.ones(len(ratios)) if weights == "unity" else ratios
        psd = (w[:, None] * power).sum(0) / w.sum()
    return np.fft.rfftfreq(n_fft, dt), psd * 2 * dt


def welch(x: np.ndarray, dt: float, segment: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Mean periodogram of half-overlapping Hann segments."""
    segment = min(segment, len(x))
    hann = np.sin(np.pi * np.arange(segment) / segment) ** 2
    parts = np.stack([x[i : i + segment] for i in range(0, len(x) - segment + 1, max(1, segment // 2))])
    power = np.abs(np.fft.rfft((parts - parts.mean(1, keepdims=True)) * hann, axis=1)) ** 2 / (hann**2).sum()
    psd = 2 * dt * power.mean(0)
    psd[0] /= 2
    if segment % 2 == 0:
        psd[-1] /= 2
    return np.fft.rfftfreq(segment, dt), psd


def density(x: np.ndarray, step: int, *, method: str = "eigen", half_bandwidth: float = 4.0, low: float = 0.0, high: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(frequencies from low to high, density) of a regular series; NaN where a value is not finite or none varies."""
    f, p = welch(x, step / SECOND) if method == "welch" else multitaper(x, step / SECOND, half_bandwidth, method)
    if not np.isfinite(x).all() or np.ptp(x) == 0:
        p = np.full(len(f), np.nan)
    use = (f >= low) & (f <= (high if high is not None else np.inf))
    return f[use], p[use]


def spectra(df: DataFrame, column: str, step: int, *, low: float = 0.0, high: float | None = None, method: str = "eigen", half_bandwidth: float = 4.0) -> DataFrame:
    """Density of each (probe, w_start) window of a regular series with the given step (microseconds);
    a window without variation gives NULLs. Group size is the window's length, whatever the probe's."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("t")[column].to_numpy(float)
        f, p = density(x, step, method=method, half_bandwidth=half_bandwidth, low=low, high=high)
        return pd.DataFrame({"probe": pdf["probe"].iloc[0], "w_start": pdf["w_start"].iloc[0], "freq": f, "psd": p})

    return df.select("probe", "w_start", "t", column).groupBy("probe", "w_start").applyInPandas(run, SCHEMA)
