"""Instrument physics as column expressions (P1-P17). They stay in whole-stage codegen: no Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]
#: Highest speed up to which the force polynomial is used, where it begins, and the inclination there.
GOOD_SPEED, GOOD_FORCE, GOOD_INCLINATION = 0.5, 0.25, 0.0623
STEEPEST = 10.0


def calibrate(counts: Vector, gain: Column, shift: Column) -> Vector:
    """gain (3x3 array column) times (counts - shift)."""
    d = [c.cast("double") - shift[i] for i, c in enumerate(counts)]
    return tuple(gain[i][0] * d[0] + gain[i][1] * d[1] + gain[i][2] * d[2] for i in range(3))  # type: ignore[return-value]


def norm(v: Sequence[Column]) -> Column:
    return F.sqrt(sum((x * x for x in v[1:]), v[0] * v[0]))


def inclination(g: Vector) -> Column:
    return F.atan2(F.sqrt(g[0] * g[0] + g[1] * g[1]), g[2])


def pitch(g: Vector) -> Column:
    return -F.atan(g[0] / F.sqrt(g[1] * g[1] + g[2] * g[2]))


def roll(g: Vector) -> Column:
    return F.atan2(g[1], g[2])


def horner(x: Column, coefs: Sequence[float]) -> Column:
    """Polynomial with the highest power first."""
    out = F.lit(float(coefs[0]))
    for c in coefs[1:]:
        out = out * x + F.lit(float(c))
    return out


def trig_speed(r: Column, coefs: Column, terms: int) -> Column:
    """sqrt of sin r over a trigonometric series with coefficients c0, a1, b1, ...; 0 where negative.

    coefs is an array column, terms the number of harmonics: one expression serves all probes.
    """
    series = coefs[0]
    for n in range(1, terms + 1):
        series = series + coefs[2 * n - 1] * F.cos(r * n) + coefs[2 * n] * F.sin(r * n)
    squared = F.sin(r) / F.when(series != 0, series)
    return F.when(r.isNull(), F.lit(None)).when(squared > 0, F.sqrt(squared)).otherwise(0.0)


def line_end(coefs: Column, terms: int, limit_deg: Column) -> tuple[Column, Column, Column]:
    """(limit in radians, speed there, slope there, at most 10): once per probe, not per row."""
    x0 = F.radians(limit_deg)
    at, before = trig_speed(x0, coefs, terms), trig_speed(x0 - 0.01, coefs, terms)
    slope = (at - before) / 0.01
    slope = F.least(F.when((slope == 0) | slope.isNull() | F.isnan(slope) | (F.abs(slope) == float("inf")), STEEPEST).otherwise(slope), F.lit(STEEPEST))
    return x0, at, slope


def speed(r: Column, coefs: Column, terms: int, x0: Column, at: Column, slope: Column) -> Column:
    """Speed by inclination (radians); beyond the limit a line with the slope there (see line_end)."""
    return F.when(r < x0, trig_speed(r, coefs, terms)).when(r.isNotNull(), at + (r - x0) * slope)


def force(r: Column) -> Column:
    return F.sqrt(F.tan(r) / F.cos(r))


def _force(r: float) -> float:
    import math

    return math.sqrt(math.tan(r) / math.cos(r))


def interpolated(x: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Linear interpolation in a short fixed table; constant outside."""
    out = F.when(x <= xs[0], F.lit(ys[0]))
    for a, b, p, q in zip(xs, xs[1:], ys, ys[1:]):
        out = out.when(x <= b, F.lit(p) + (x - F.lit(a)) * F.lit((q - p) / (b - a)))
    return out.when(x.isNotNull(), F.lit(ys[-1]))


def polynomial_speed(f: Column, coefs: Sequence[float]) -> Column:
    """Speed by force: linear in the angle up to force 0.25, polynomial, then a line beyond 0.5 m/s."""
    def value(x: float) -> float:
        out = 0.0
        for c in coefs:
            out = out * x + c
        return out

    x0 = next((1 + k / 100 for k in range(300) if value(1 + k / 100) > GOOD_SPEED), 4.0)
    end = F.lit(value(x0)) + (f - x0) * F.lit((value(x0) - value(x0 - 0.1)) / 0.1)
    angles = [GOOD_INCLINATION * k / 14 for k in range(15)]
    start = interpolated(f, [_force(a) for a in angles], angles) * F.lit(value(GOOD_FORCE) / GOOD_INCLINATION)
    return F.when(f <= GOOD_FORCE, start).when(f < x0, horner(f, coefs)).otherwise(end)


def direction(g: Vector, h: Vector, azimuth: Column) -> Column:
    """Degrees, not wrapped, from the horizontal parts of the magnetic field."""
    east = (g[0] * h[1] - g[1] * h[0]) * norm(g)
    north = h[2] * (g[0] * g[0] + g[1] * g[1]) - g[2] * (g[0] * h[0] + g[1] * h[1])
    return azimuth - F.degrees(F.atan2(east, north))


def direction_without_field(g: Vector, azimuth: Column) -> Column:
    return azimuth - F.degrees(F.atan2(g[0], g[1]))


def components(v: Column, deg: Column) -> tuple[Column, Column]:
    """(northward v, eastward u)."""
    return v * F.cos(F.radians(deg)), v * F.sin(F.radians(deg))


def polar(v: Column, u: Column) -> tuple[Column, Column]:
    return F.sqrt(u * u + v * v), F.degrees(F.atan2(u, v))


def pressure(p: Column, temp: Column, table: Sequence[Sequence[float]]) -> Column:
    """Sum of c[i][j] P^i T^j by nested Horner steps."""
    rows = [horner(temp, list(reversed(row))) for row in table]
    out = rows[-1]
    for row in reversed(rows[:-1]):
        out = out * p + row
    return out


def rotation(axis: str, degrees: Column) -> list[list[Column]]:
    c, s, one, zero = F.cos(F.radians(degrees)), F.sin(F.radians(degrees)), F.lit(1.0), F.lit(0.0)
    return {"x": [[one, zero, zero], [zero, c, -s], [zero, s, c]], "y": [[c, zero, s], [zero, one, zero], [-s, zero, c]], "z": [[c, -s, zero], [s, c, zero], [zero, zero, one]]}[axis]


def matmul(a: Sequence[Sequence[Column]], b: Sequence[Sequence[Column]]) -> list[list[Column]]:
    return [[a[i][0] * b[0][j] + a[i][1] * b[1][j] + a[i][2] * b[2][j] for j in range(3)] for i in range(3)]


def turn_to_vertical(g: Vector) -> list[list[Column]]:
    """Rodrigues' rotation that takes the unit vector along g to (0, 0, 1): I + K + K^2 / (1 + cos)."""
    n = norm(g)
    x, y, z = (c / n for c in g)
    f = 1 / (1 + z)
    return [[1 - x * x * f, -x * y * f, -x], [-x * y * f, 1 - y * y * f, -y], [x, y, z]]


def year_fraction(ts: Column) -> Column:
    y = F.year(ts)
    days = F.when((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0)), 366.0).otherwise(365.0)
    return y + (F.dayofyear(ts) - 1) / days


def degrees_minutes(x: Column) -> Column:
    """DDMM.mmm as a number -> degrees."""
    d = F.floor(x / 100)
    return d + (x - d * 100) / 60
