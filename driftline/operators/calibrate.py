"""Calibration (A10-A14, P18): sums per probe in Spark, small solves on the sums.

A fit needs moments only: 55 sums for the ellipsoid, a few for a polynomial. They are one partial
aggregate over all rows; the solve sees one row per probe.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import kept_table
from .aggregates import in_cells

#: Fits that rows were held against, and their limits.
USED = "array<struct<A:array<array<double>>,b:array<double>,limit:double>>"
FIT_SCHEMA = "probe string, A array<array<double>>, b array<double>"


def quadric_terms(x, y, z) -> list:
    return [x * x, y * y, z * z, 2 * y * z, 2 * x * z, 2 * x * y, 2 * x, 2 * y, 2 * z, x * 0 + 1]


def moments(df: DataFrame, columns: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """The upper triangle of the 10 x 10 moment matrix of the quadric's terms, per probe."""
    terms = quadric_terms(*[F.col(c) for c in columns])
    sums = [F.sum(terms[i] * terms[j]).alias(f"m{i}_{j}") for i in range(10) for j in range(i, 10)]
    spans = [s(c).alias(f"{n}_{k}") for k, c in enumerate(columns) for n, s in (("lo", F.min), ("hi", F.max))]
    return df.groupBy("probe").agg(*sums, *spans)


#: The quadratic form 4 (ab + bc + ca) - (a + b + c)^2 - 4 (f^2 + g^2 + h^2) of a quadric's first six coefficients; where it is positive,
#: the quadric is an ellipsoid.
ELLIPSOID = np.diag([-1.0, -1.0, -1.0, -4.0, -4.0, -4.0])
ELLIPSOID[:3, :3] += 2 * (1 - np.eye(3)) - (1 - np.eye(3))


def solve_ellipsoid(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Quadric (M, n, d) of least squared error v' S v under v' ELLIPSOID v = 1.

    For given quadratic coefficients the best linear ones follow by least squares, which leaves a 6 x 6 error form. In
    coordinates where that form is the identity, the constraint is a symmetric matrix, and its largest eigenvalue, the only positive one,
    belongs to the smallest error. Points that lie on a quadric exactly leave a form without an inverse, so its
    smallest eigenvalues are kept above rounding.
    """
    linear = -np.linalg.solve(s[6:, 6:], s[6:, :6])
    error = s[:6, :6] + s[:6, 6:] @ linear
    size, axes = np.linalg.eigh((error + error.T) / 2)
    unit = axes / np.sqrt(np.maximum(size, size[-1] * 1e-18))
    q = unit @ np.linalg.eigh(unit.T @ ELLIPSOID @ unit)[1][:, -1]
    q = q / np.sign(q[:3].sum()) / np.linalg.norm(q)
    rest = linear @ q
    m = np.diag(q[:3])
    m[np.triu_indices(3, 1)] = q[[5, 4, 3]]
    return np.triu(m) + np.triu(m, 1).T, rest[:3], float(rest[3])


def gain_and_shift(m: np.ndarray, n: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """A and b such that A (x - b) lies on the unit sphere: the symmetric square root of the scaled M."""
    inverse = np.linalg.inv(m)
    b = -inverse @ n
    values, vectors = np.linalg.eigh(m / (n @ inverse @ n - d))
    return vectors @ np.diag(np.sqrt(np.maximum(values, 0))) @ vectors.T, b


def fit_ellipsoid(df: DataFrame, columns: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Gain matrix A and shift b of each probe. A channel without spread gets gain 0, the
    others their gain from their extremes."""

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                s = np.zeros((10, 10))
                for i in range(10):
                    for j in range(i, 10):
                        s[i, j] = s[j, i] = r[f"m{i}_{j}"]
                lo, hi = (np.array([r[f"{n}_{k}"] for k in range(3)], float) for n in ("lo", "hi"))
                flat = hi - lo == 0
                if flat.any():
                    a, b = np.diag(np.where(flat, 0.0, 2 / np.where(flat, 1, hi - lo))), (hi + lo) / 2
                else:
                    a, b = gain_and_shift(*solve_ellipsoid(s))
                out.append((r["probe"], a.tolist(), b.tolist()))
            yield pd.DataFrame(out, columns=["probe", "A", "b"])

    return moments(df, columns).mapInPandas(solve, FIT_SCHEMA)


def residual(df: DataFrame, fit: DataFrame, columns: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """abs(1 - |A (x - b)|) of each row, as column residual."""
    joined = df.join(fit, "probe")
    d = [F.col(c) - F.col("b")[i] for i, c in enumerate(columns)]
    rows = [F.col("A")[i][0] * d[0] + F.col("A")[i][1] * d[1] + F.col("A")[i][2] * d[2] for i in range(3)]
    return joined.withColumn("residual", F.abs(1 - F.sqrt(rows[0] ** 2 + rows[1] ** 2 + rows[2] ** 2))).drop("A", "b")


def calibrated(df: DataFrame, *, bins: int = 200, passes: int = 10, first: float = 0.5, shrink: float = 0.7, most: float = 0.1) -> DataFrame:
    """Fit on cell means, drop rows beyond a shrinking limit, fit again; a probe stops before a limit
    that would take more than `most` of its rows.

    Rows are never written: a row is in the series if it is within the limits of all fits so far, which are a short array per
    probe. A pass is one aggregate by cell: how many rows are left in it, how many of them the limit leaves, and the
    mean of the latter. Only the fits, a row per probe, are kept between passes.
    """
    point = ("x", "y", "z")
    x = in_cells(df, bins)

    def away(f: Column) -> Column:
        d = [F.col(c) - f["b"][i] for i, c in enumerate(point)]
        return F.abs(1 - F.sqrt(sum(((f["A"][i][0] * d[0] + f["A"][i][1] * d[1] + f["A"][i][2] * d[2]) ** 2 for i in range(3)), F.lit(0.0))))

    means = x.groupBy("probe", "cell_a", "cell_b").agg(*[F.avg(c).alias(c) for c in point])
    fits = kept_table(fit_ellipsoid(means).select("probe", "A", "b", F.array().cast(USED).alias("_used"), F.lit(False).alias("_stop")))
    for k in range(passes):
        limit = first * shrink**k
        kept = x.join(fits.where("not _stop"), "probe").where(F.forall("_used", lambda f: away(f) <= f["limit"]))
        left = away(F.struct("A", "b")) <= limit
        cells = kept.groupBy("probe", "cell_a", "cell_b").agg(F.count(F.lit(1)).alias("_all"), F.count_if(left).alias("_left"), *[F.avg(F.when(left, F.col(c))).alias(c) for c in point])
        cells = kept_table(cells)
        share = cells.groupBy("probe").agg((1 - F.sum("_left") / F.sum("_all") > most).alias("_over"))
        went_on = cells.where("_left > 0").join(share.where("not _over").select("probe"), "probe", "left_semi")
        new = fit_ellipsoid(went_on.select("probe", *point)).select("probe", F.col("A").alias("_A"), F.col("b").alias("_b"))
        used = F.concat("_used", F.array(F.struct("A", "b", F.lit(limit).alias("limit"))).cast(USED))
        on = F.col("_A").isNotNull()
        fits = kept_table(fits.join(new, "probe", "left").select(
            "probe", F.coalesce("_A", "A").alias("A"), F.coalesce("_b", "b").alias("b"), F.when(on, used).otherwise(F.col("_used")).alias("_used"), (~on).alias("_stop")))
    return fits.select("probe", "A", "b")


def fit_axes(df: DataFrame, columns: Sequence[str] = ("x", "y", "z"), parameters: int = 9) -> DataFrame:
    """Centre and radii by least squares of a quadric equal to 1; 9 terms, or 6 without rotation. Two columns: an
    ellipse, with 5 terms, or 4 without rotation."""
    axes = [F.col(c) for c in columns]
    k = len(axes)
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)] if parameters in (5, 9) else []
    terms = [x * x for x in axes] + [2 * axes[i] * axes[j] for i, j in pairs] + [2 * x for x in axes]
    n = len(terms)
    sums = df.groupBy("probe").agg(*[F.sum(terms[i] * terms[j]).alias(f"m{i}_{j}") for i in range(n) for j in range(i, n)], *[F.sum(t).alias(f"s{i}") for i, t in enumerate(terms)])

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                d = np.zeros((n, n))
                for i in range(n):
                    for j in range(i, n):
                        d[i, j] = d[j, i] = r[f"m{i}_{j}"]
                u = np.linalg.solve(d, [r[f"s{i}"] for i in range(n)])
                q = np.diag(u[:k])
                for (i, j), value in zip(pairs, u[k:]):
                    q[i, j] = q[j, i] = value
                centre = -np.linalg.solve(q, u[-k:])
                radii = np.sort(1 / np.sqrt(np.abs(np.linalg.eigvalsh(q / (1 + centre @ q @ centre)))))
                out.append((r["probe"], centre.tolist(), radii.tolist()))
            yield pd.DataFrame(out, columns=["probe", "centre", "radii"])

    return sums.mapInPandas(solve, "probe string, centre array<double>, radii array<double>")


def pressure_fits(df: DataFrame, degrees: Sequence[int] = range(1, 8)) -> DataFrame:
    """For each degree, least squares of P on all products U^i T^j with i + j <= degree (the coefficients by degree, powers
    of U falling), and the root mean square error. Rows with a NULL in U, T or P take no part.

    U and T are scaled to their probe's mean and deviation first, so the normal equations stay solvable; coefficients are those of
    the scaled inputs. The sums of the highest degree hold those of all others, so all fits are one aggregate.
    """
    df = df.where("U is not null and T is not null and P is not null")
    top = max(degrees)
    centre = df.groupBy("probe").agg(*[s(c).alias(f"_{n}{c}") for c in ("U", "T", "P") for n, s in (("m", F.avg), ("d", F.stddev_pop))])
    scale = lambda c: (F.col(c) - F.col(f"_m{c}")) / F.coalesce(F.nullif(F.col(f"_d{c}"), F.lit(0.0)), F.lit(1.0))
    x = df.join(centre, "probe").select("probe", "_mP", scale("U").alias("_u1"), scale("T").alias("_t1"), (F.col("P") - F.col("_mP")).alias("_p"))
    for k in range(2, 2 * top + 1):
        x = x.withColumns({f"_u{k}": F.col(f"_u{k // 2}") * F.col(f"_u{k - k // 2}"), f"_t{k}": F.col(f"_t{k // 2}") * F.col(f"_t{k - k // 2}")})
    power = lambda c, k: F.col(f"_{c}{k}") if k else F.lit(1.0)
    products = {(i, j): power("u", i) * power("t", j) for i in range(2 * top + 1) for j in range(2 * top + 1 - i)}
    sums = [F.sum(v).alias(f"m{i}_{j}") for (i, j), v in products.items()] + [F.sum(v * F.col("_p")).alias(f"s{i}_{j}") for (i, j), v in products.items() if i + j <= top]
    sums = x.groupBy("probe").agg(*sums, F.sum(F.col("_p") ** 2).alias("pp"), F.first("_mP").alias("mean"))

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                for degree in degrees:
                    powers = [(i, k - i) for k in range(degree + 1) for i in range(k, -1, -1)]
                    a = np.array([[r[f"m{i + k}_{j + l}"] for k, l in powers] for i, j in powers])
                    s = np.array([r[f"s{i}_{j}"] for i, j in powers])
                    c = np.linalg.lstsq(a, s, rcond=None)[0]
                    rmse = float(np.sqrt(max(0.0, r["pp"] - 2 * c @ s + c @ a @ c) / r["m0_0"]))
                    c[0] += r["mean"]
                    out.append((r["probe"], degree, c.tolist(), rmse))
            yield pd.DataFrame(out, columns=["probe", "degree", "coefs", "rmse"])

    return sums.mapInPandas(solve, "probe string, degree int, coefs array<double>, rmse double")


def imported_speed(coefs: DataFrame, fitted: DataFrame) -> DataFrame:
    """Fitted speed coefficients with their limit angle appended; the zeroing rotation is kept as Rz."""
    f = fitted.select("probe", F.concat("k", F.array("limit_deg")).alias("_k"), F.col("Rz").alias("_r"))
    return coefs.join(f, "probe", "left").withColumn("kVabs", F.coalesce("_k", "kVabs")).withColumn("Rz", F.col("_r")).drop("_k", "_r")
