"""What SQL cannot express, against brute force or known truth."""

import bisect
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import aggregates, calibrate, spectrum, timefix, windows
from driftline.sources import instruments, text
from driftline.streaming import bins, resolved_times, run_to_end, sessions


def longest(t):
    """Length of a longest non-decreasing subsequence."""
    ends = []
    for x in t:
        at = bisect.bisect_right(ends, x)
        ends[at : at + 1] = [x]
    return len(ends)


def test_heaviest_increasing_is_heaviest():
    rng = np.random.default_rng(1)
    for _ in range(60):
        v, w = rng.permutation(9), rng.integers(1, 5, 9)
        keep = timefix.heaviest_increasing(v, w)
        assert (np.diff(v[keep]) > 0).all()
        best = max(w[list(c)].sum() for k in range(1, 10) for c in itertools.combinations(range(9), k) if all(v[a] < v[b] for a, b in zip(c, c[1:])))
        assert w[keep].sum() == best
    assert len(timefix.heaviest_increasing(np.array([], int), np.array([], int))) == 0


def series_with_inversions():
    rng = np.random.default_rng(2)
    t = np.arange(300) * 10
    t[50:60] += 200
    t[200] -= 900
    t[rng.integers(0, 300, 10)] += 35
    far = np.r_[10**9, np.arange(500)]
    last = np.r_[np.arange(500), -5]
    return [t, far, last, rng.integers(0, 40, 400), np.arange(50)[::-1], np.zeros(40, int), rng.permutation(300) // 3, np.array([7])]


@pytest.mark.parametrize("case", range(8))
def test_without_inversions_keeps_longest(spark, case):
    t = series_with_inversions()[case]
    rows = [("a", int(x), i) for i, x in enumerate(t)] + [("b", 5, 0), ("c", None, 0), ("a", None, len(t))]
    df = spark.createDataFrame(rows, "probe string, t long, seq long")
    found = timefix.without_inversions(df, width=64).collect()
    assert len(found) == len(rows)
    got = {(r["probe"], r["seq"]): r["ok"] for r in found}
    kept = t[[got["a", i] for i in range(len(t))]]
    assert (np.diff(kept) >= 0).all() and len(kept) == longest(t)
    assert (got["b", 0], got["c", 0], got["a", len(t)]) == (True, False, False)


def test_one_far_time_is_two_blocks(spark):
    """What reaches Python does not grow with the rows between two disturbances."""
    df = spark.range(20_000).select(F.lit("a").alias("probe"), F.when(F.col("id") == 0, 10**12).otherwise(F.col("id") * 10).alias("t"), F.col("id").alias("seq"))
    assert [(r["seq"], r["_n"]) for r in timefix.blocks_in_order(df).orderBy("seq").collect()] == [(0, 1), (1, 19_999)]
    assert [r["seq"] for r in timefix.without_inversions(df).where("not ok").collect()] == [0]


def frequency(t, precision):
    """T2, step by step."""
    equal, falls = sum(b == a for a, b in zip(t, t[1:])), sum(b < a for a, b in zip(t, t[1:]))
    if falls:
        def alone(i):
            sides = [np.sign(t[i] - t[j]) for j in (i - 1, i + 1) if 0 <= j < len(t)]
            return all(s > 0 for s in sides) or all(s < 0 for s in sides)

        t = [x for i, x in enumerate(t) if not alone(i)]
    ups, count = [], 0  # steps upwards, and how many steps that do not fall there are up to each
    for a, b in zip(t, t[1:]):
        count += b >= a
        if b > a:
            ups.append((b - a, count))
    if not ups:
        return None, equal, falls
    most = sum(u for u, _ in ups) / (len(ups) + 1) + 1e6 * 10**precision
    ends = [c for _, c in ups[1:]] + [count + 1]
    f = [(e - c) * 1e6 / u for i, ((u, c), e) in enumerate(zip(ups, ends)) if all(ups[j][0] < most for j in (i - 1, i, i + 1) if 0 <= j < len(ups))]
    if not f:
        return None, equal, falls
    good = [x for x in f if abs(x - np.median(f)) < 3 * np.std(f)]
    mean = np.mean(good if len(good) > 1 else f)
    near = round(mean, max(precision, int(np.log10(mean))))
    return near or mean, equal, falls


@pytest.mark.parametrize("precision", [0, 6])
def test_sampling_frequency_step_by_step(spark, precision):
    rng = np.random.default_rng(7)
    s = 1_000_000
    packets = np.concatenate([k * 3600 * s + np.arange(200) * s // 20 for k in range(6)])
    whole = np.sort(rng.integers(0, 60, 700)) * s
    spiked = np.arange(400) * s // 8
    spiked[[40, 90]] += 50 * s
    spiked[200:204] -= 30 * s
    cases = {"packets": packets // s * s, "whole": whole, "spiked": spiked, "one": np.array([5]), "same": np.full(9, 5), "slow": np.arange(50) * 100 * s, "fast": np.arange(3000) * s // 512, "down": np.arange(20)[::-1] * s}
    df = spark.createDataFrame([(p, int(x), i) for p, t in cases.items() for i, x in enumerate(t)] + [("none", None, 0)], "probe string, t long, seq long")
    got = {r["probe"]: (r["fs"], r["equal"], r["decreasing"]) for r in timefix.sampling_frequency(df, precision=precision, width=50).collect()}
    assert set(got) == set(cases)
    for p, t in cases.items():
        fs, equal, falls = frequency(t.tolist(), precision)
        assert got[p][1:] == (equal, falls), p
        assert got[p][0] == (None if fs is None else pytest.approx(fs, rel=1e-9)), p


def test_ellipsoid_is_recovered(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(500, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    gain = np.array([[1.2, 0.1, 0], [0.1, 0.9, 0.05], [0, 0.05, 1.1]])
    p = v @ np.linalg.inv(gain).T + [0.3, -0.2, 0.1]
    df = spark.createDataFrame([("a", int(i), int(i), *map(float, r)) for i, r in enumerate(p)], "probe string, t long, seq long, x double, y double, z double")
    r = calibrate.fit_ellipsoid(df).first()
    assert np.allclose(r["A"], gain, atol=1e-6) and np.allclose(r["b"], [0.3, -0.2, 0.1], atol=1e-6)
    worst = calibrate.residual(df, calibrate.fit_ellipsoid(df)).agg(F.max("residual")).first()[0]
    assert worst < 1e-6
    axes = calibrate.fit_axes(df).first()
    assert np.allclose(axes["centre"], [0.3, -0.2, 0.1], atol=1e-6)


def test_flat_channel(spark):
    df = spark.createDataFrame([("a", i, i, float(np.cos(i)), float(np.sin(i)), 2.0) for i in range(50)], "probe string, t long, seq long, x double, y double, z double")
    r = calibrate.fit_ellipsoid(df).first()
    assert r["A"][2][2] == 0 and abs(r["A"][0][0] - 1) < 0.01


def test_outliers_go(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(800, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[:20] *= 1.6
    df = spark.createDataFrame([("a", i, i, *map(float, r)) for i, r in enumerate(v)], "probe string, t long, seq long, x double, y double, z double")
    r = calibrate.calibrated(df, passes=4).first()
    assert np.allclose(r["A"], np.eye(3), atol=0.05)


@pytest.mark.parametrize("weights", ["eigen", "unity", "adaptive"])
def test_spectrum_finds_power_and_peak(weights):
    t = np.arange(1024) * 2.0
    x = np.sin(2 * np.pi * 0.05 * t) + 0.1 * np.random.default_rng(5).normal(size=1024)
    f, p = spectrum.multitaper(x, 2.0, weights=weights)
    assert abs(f[p.argmax()] - 0.05) < 0.005
    assert abs(p.sum() * (f[1] - f[0]) / x.var() - 1) < 0.1
    f, p = spectrum.welch(x, 2.0)
    assert abs(f[p.argmax()] - 0.05) < 0.005 and abs(p.sum() * (f[1] - f[0]) / x.var() - 1) < 0.15


def test_tapers_are_orthonormal():
    v, ratios = spectrum.tapers(200, 4.0)
    assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-8) and ratios[0] > 0.999 and (np.diff(ratios) < 0).all()


def test_linear_with_shifts_stays_near(spark):
    rng = np.random.default_rng(6)
    true = np.cumsum(np.where(np.arange(2000) < 1000, 200_000, 201_000))
    raw = true + rng.integers(-300_000, 300_000, 2000)
    df = spark.createDataFrame([("a", int(t), i, 0) for i, t in enumerate(np.sort(raw))], "probe string, t long, seq long, burst int")
    out = np.array([r["t"] for r in timefix.linear_with_shifts(df, 5.0, 1_000_000).orderBy("seq").collect()])
    assert np.abs(out - true).max() < 1_500_000


def test_forward_backward_despike(spark):
    x = np.sin(np.arange(400) / 10)
    x[100] += 9
    df = spark.createDataFrame([("a", i, i, float(v), 0.0 + i % 2) for i, v in enumerate(x)], "probe string, t long, seq long, x double, y double")
    bad = [r["seq"] for r in windows.vector_despiked(df, ("x",), (3.0, 4.0)).where("not ok").collect()]
    assert 100 in bad and len(bad) < 40


def test_utm_and_formats(spark):
    df = spark.createDataFrame([(500000.0, 6_000_000.0)], "x double, y double")
    lat, lon = instruments.utm_to_degrees(F.col("x"), F.col("y"))
    r = df.select(lat.alias("lat"), lon.alias("lon")).first()
    assert abs(r["lon"] - 21) < 1e-9 and abs(r["lat"] - 54.1470) < 0.01
    d = spark.createDataFrame([("a", 0, "03.02.2024", "1:02:03.5"), ("a", 1, "99.02.2024", "1:02:03")], "probe string, seq long, Date string, Time string")
    t = [r["t"] for r in instruments.dated_log(d, "log").orderBy("seq").collect()]
    assert t == [1706922123500000, None]
    assert spark.createDataFrame([("54°30'36.0\"N",)], "s string").select(instruments.dms(F.col("s"))).first()[0] == pytest.approx(54.51)


def test_declared_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,1.5,q\ny,NaN,w\n")
    df = text.read_csv(spark, str(tmp_path / "a.csv"), "Name(text),Pres,")
    assert [tuple(r) for r in df.orderBy("Name").collect()] == [("x", 1.5), ("y", None)]
    files = spark.createDataFrame([("/d/incl_b03.txt",), ("/d/w12.csv",), ("/d/i5coef.txt",), ("/d/notes.md",)], "path string")
    assert {r["probe"] for r in text.discovered(files).collect()} == {"b03", "w12"}


def test_short_span_makes_one_row(spark):
    df = spark.createDataFrame([("a", 86_399_000_000 + k * 1_000_000, k, float(k)) for k in range(4)], "probe string, t long, seq long, x double")
    r = aggregates.binned(df, 7200, ["x"]).collect()
    assert len(r) == 1 and r[0]["x"] == 1.5 and r[0]["rows"] == 4


def test_streams(spark, tmp_path):
    from driftline.schema import timestamp

    base = spark.range(200).select(F.lit("a").alias("probe"), F.col("id").alias("seq"), timestamp(F.col("id") * 60_000_000 + F.when(F.col("id") > 100, 7_200_000_000).otherwise(0)).alias("ts"), F.col("id").cast("double").alias("x"))
    base.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
    b = run_to_end(bins(stream(), 600, ["x"], "1 minute"), str(tmp_path / "b"), str(tmp_path / "bc"))
    assert b.agg(F.sum("rows")).first()[0] >= 180 and b.where("rows = 10").count() >= 15
    s = run_to_end(sessions(stream(), "30 minutes", "1 minute"), str(tmp_path / "s"), str(tmp_path / "sc"))
    assert s.where("rows = 101").count() == 1
    low = base.withColumn("ts", F.date_trunc("hour", "ts")).select("probe", "seq", F.col("ts").cast("timestamp_ntz").alias("ts"))
    low.write.parquet(str(tmp_path / "low"))
    r = run_to_end(resolved_times(spark.readStream.schema(low.schema).parquet(str(tmp_path / "low")), 0.1), str(tmp_path / "r"), str(tmp_path / "rc"))
    t = [x["t"] for x in r.orderBy("seq").collect()]
    assert len(t) == 200 and all(a < b for a, b in zip(t, t[1:]))


def test_corrected_times(spark):
    s = 1_000_000
    times = [k * s for k in range(20)]
    raw = list(times)
    raw[5] -= 86_400 * s
    raw[8] = None
    df = spark.createDataFrame([("a", t, k) for k, t in enumerate(raw)], "probe string, t long, seq long")
    got = {r["seq"]: (r["t"], r["ok"]) for r in timefix.corrected_times(df, mode="delete_inversions").collect()}
    assert got == {k: (t, k != 5) for k, t in enumerate(times)}
    got = {r["seq"]: (r["t"], r["ok"]) for r in timefix.corrected_times(df).collect()}
    assert got == {k: (t, True) for k, t in enumerate(times)}
    # Rows before the first allowed time get it and are not ok; the rest is shifted first.
    got = {r["seq"]: (r["t"], r["ok"]) for r in timefix.corrected_times(df, shift=s, t_min=2 * s).collect()}
    assert got == {k: (max(t - s, 2 * s), t - s >= 2 * s and k != 5) if k != 5 else (2 * s, False) for k, t in enumerate(times)}
    # Five rows a second with the second's time: spread by the frequency that T2 finds.
    low = spark.createDataFrame([("a", k // 5 * s, k) for k in range(100)], "probe string, t long, seq long")
    found = [(r["t"], r["ok"]) for r in timefix.corrected_times(low).orderBy("seq").collect()]
    assert all(ok for _, ok in found) and max(abs(t - k * s // 5) for k, (t, _) in enumerate(found)) <= 1.5 * s
    assert timefix.corrected_times(df.where("false")).count() == 0


def test_pressure_fits_match_least_squares(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"probe": np.repeat(["a", "b"], 160), "U": rng.normal(5, 2, 320), "T": np.r_[rng.normal(10, 3, 160), np.full(160, 4.0)]})
    pdf["P"] = 3 + 2 * pdf.U - 0.5 * pdf["T"] + 0.1 * pdf.U * pdf["T"] + rng.normal(0, 0.2, 320)
    df = spark.createDataFrame(pdf).union(spark.createDataFrame([("a", None, 1.0, 2.0), ("c", 1.0, None, 2.0)], "probe string, U double, T double, P double"))
    got = {(r.probe, r.degree): r for r in calibrate.pressure_fits(df).collect()}
    assert set(got) == {(p, d) for p in "ab" for d in range(1, 8)}
    for probe, d in pdf.groupby("probe"):
        u, t = ((d[c] - d[c].mean()) / (d[c].std(ddof=0) or 1.0) for c in ("U", "T"))
        for degree in range(1, 8):
            a = np.stack([u**i * t ** (k - i) for k in range(degree + 1) for i in range(k, -1, -1)], axis=1)
            fit = np.linalg.lstsq(a, d.P, rcond=None)[0]
            assert np.allclose(got[probe, degree].coefs, fit, atol=1e-5), (probe, degree)
            assert abs(got[probe, degree].rmse - np.sqrt(np.mean((a @ fit - d.P) ** 2))) < 1e-6


def test_calibrated_drops_what_is_off(spark):
    """Against the same passes over arrays: which points stay, and a probe that stops early."""
    rng = np.random.default_rng(8)

    def points(n, off, by):
        v = rng.normal(size=(n, 3))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        v[:off] *= by
        return v * [1.2, 0.9, 1.1] + [0.1, -0.2, 0.05]

    probes = {"few": points(600, 20, 1.3), "many": points(600, 150, 1.25), "none": points(300, 0, 1.0)}
    df = spark.createDataFrame([(p, i, i, *map(float, r)) for p, v in probes.items() for i, r in enumerate(v)], "probe string, t long, seq long, x double, y double, z double")
    got = {r["probe"]: r for r in calibrate.calibrated(df, bins=40).collect()}

    def fit(v):
        polar = np.arccos(v[:, 2] / np.linalg.norm(v, axis=1))
        cell = np.minimum(polar / (2 * np.pi) * 40, 39).astype(int) * 40 + np.minimum((np.cos(np.arctan2(v[:, 1], v[:, 0])) + 1) / 2 * 40, 39).astype(int)
        x, y, z = (pd.DataFrame(v).groupby(cell).mean().to_numpy()).T
        terms = np.stack([x * x, y * y, z * z, 2 * y * z, 2 * x * z, 2 * x * y, 2 * x, 2 * y, 2 * z, np.ones_like(x)])
        return calibrate.gain_and_shift(*calibrate.solve_ellipsoid(terms @ terms.T))

    for p, v in probes.items():
        a, b = fit(v)
        for k in range(10):
            off = np.abs(1 - np.linalg.norm((v - b) @ a.T, axis=1)) > 0.5 * 0.7**k
            if off.mean() > 0.1:
                break
            v = v[~off]
            a, b = fit(v)
        assert np.allclose(got[p]["A"], a, atol=1e-6) and np.allclose(got[p]["b"], b, atol=1e-6), p
