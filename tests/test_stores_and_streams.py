"""K1 files, K11 stages, streams in two zones, P12 with despiking, T7 in blocks, X1-X3, W13 by gradient."""

import math
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftline import streaming
from driftline.operators import spectrum, stages, timefix, velocity, windows
from driftline.plans.fixtures import coefs
from driftline.schema import DAY, SECOND, micros
from driftline.sinks import tsv
from driftline.sources import text

HOUR = 3600 * SECOND


# ---- K1 -----------------------------------------------------------------------------------------
def test_named_files(spark, tmp_path):
    at = 1_704_067_200 * SECOND  # 2024-01-01
    rows = [("i01", at + 500, 1.23456789, 12345.678, None), ("i01", at + 2 * SECOND, float("nan"), 1e-7, 3), ("i01", at + DAY, 0.5, 100000.0, 4), ("w_2", at + 90 * SECOND, 2.0, -0.0, 5)]
    df = spark.createDataFrame(rows, "probe string, t long, Vdir double, P double, n int")
    tsv.write_files(df, str(tmp_path), ["Vdir", "P", "n"], bin_s=2, period=DAY)
    found = {f: open(tmp_path / f).read().splitlines() for f in os.listdir(tmp_path)}
    assert found == {
        "240101_0000bin2s@i01.tsv": ["Time\tVdir\tP\tn", "2024-01-01 00:00:01\t1.2346\t12346\t", "2024-01-01 00:00:02\t\t1e-07\t3"],
        "240102_0000bin2s@i01.tsv": ["Time\tVdir\tP\tn", "2024-01-02 00:00:00\t0.5\t1e+05\t4"],
        "240101_0001bin2s@w_2.tsv": ["Time\tVdir\tP\tn", "2024-01-01 00:01:30\t2\t-0\t5"],
    }
    with pytest.raises(Exception, match="are there already"):
        tsv.write_files(df, str(tmp_path), ["P"], bin_s=2, period=DAY)
    assert {f: open(tmp_path / f).read().splitlines() for f in os.listdir(tmp_path)} == found
    tsv.write_files(df, str(tmp_path), ["P"], bin_s=2, period=DAY, overwrite=True)
    assert open(tmp_path / "240101_0001bin2s@w_2.tsv").read() == "Time\tP\n2024-01-01 00:01:30\t-0\n"


def test_an_aborted_job_leaves_no_file(tmp_path):
    writer = tsv.TsvWriter(str(tmp_path), 0, "%.5g", False)
    batch = pa.RecordBatch.from_pydict({"probe": ["a", "a", "b"], "period": [0, 0, 0], "start": ["x", "x", "y"], "Time": ["1", "2", "3"]})
    written = writer.write(iter([batch, batch.slice(2)]))
    assert [name for _, name in written.files] == ["x@a.tsv", "y@b.tsv"]
    writer.abort([written, None])
    assert os.listdir(tmp_path) == []


# ---- K11 ----------------------------------------------------------------------------------------
def test_stages_remake_only_what_is_out_of_date(spark, tmp_path):
    raw = spark.createDataFrame([(p, d * DAY + k * HOUR, k, float(k)) for p in ("a", "b") for d in range(3) for k in range(4)], "probe string, t long, seq long, v double")
    made = stages.StagedStore(spark, str(tmp_path), lambda x: x.withColumn("v", F.col("v") * 2), ["v"], ["a", "b"], 3600)
    made.deliver(raw, 1)
    made.refresh(1)
    first = made.log().count()
    assert first == 3 * 6 + 3
    made.refresh(2)
    assert made.log().count() == first
    made.deliver(raw.where(f"probe = 'b' and t < {DAY}").withColumn("v", F.lit(9.0)), 3)
    made.refresh(3)
    assert sorted((r["stage"], r["probe"], r["day"]) for r in made.log().where("run = 3").collect()) == [("bins", "b", 0), ("physical", "b", 0), ("raw", "b", 0), ("wide", None, 0)]
    got = {r["t"]: (r["v_a"], r["v_b"]) for r in made.read("wide").collect()}
    assert got == {d * DAY + k * HOUR: (2.0 * k, 18.0 if d == 0 else 2.0 * k) for d in range(3) for k in range(4)}


# ---- streams ------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def arrived(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stream") / "rows")
    rows = [(p, k * HOUR, math.sin(k) + math.cos(k * k) * (p == "b")) for p in ("a", "b") for k in range(120)]
    table = spark.createDataFrame(rows, "probe string, t long, v double")
    table.select("probe", F.timestamp_add("MICROSECOND", F.col("t"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"), "v").write.parquet(path)
    return table, path


def ran(spark, path, make, where):
    stream = spark.readStream.schema("probe string, ts timestamp_ntz, v double").parquet(path)
    return streaming.run_to_end(make(stream), f"{where}/out", f"{where}/state")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_windows_do_not_depend_on_the_zone(spark, arrived, tmp_path, zone):
    _, path = arrived
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        slid = ran(spark, path, lambda s: streaming.sliding(s, 86400, 43200, "v"), tmp_path / "slid")
        starts = {r[0] for r in slid.select(micros(F.col("w_start"))).collect()}
        binned = {r[0] for r in ran(spark, path, lambda s: streaming.bins(s, 21600, ["v"]), tmp_path / "bins").select(micros(F.col("ts"))).collect()}
        ends = {tuple(r) for r in ran(spark, path, lambda s: streaming.sessions(s, "30 minutes"), tmp_path / "ses").where("probe = 'a'").select(micros(F.col("t_start")), micros(F.col("t_end"))).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert starts == {k * 12 * HOUR for k in range(-1, 8)}
    assert binned == {k * 6 * HOUR for k in range(19)}
    assert ends == {(k * HOUR, k * HOUR + HOUR // 2) for k in range(119)}


def test_spectra_of_closed_windows(spark, arrived, tmp_path):
    table, path = arrived
    got = ran(spark, path, lambda s: streaming.sliding_spectra(s, 2 * 86400, 86400, "v", step=HOUR, method="adaptive"), tmp_path)
    rows = {(r["probe"], r["w_start"], round(r["freq"], 12)): r["psd"] for r in got.collect()}
    starts = {w for _, w, _ in rows}
    assert starts == {k * DAY for k in range(-1, 3)}
    batch = spectrum.spectra(timefix.sliding_starts(table, 2 * DAY, 0.5).where(F.col("w_start").isin(*starts)), "v", HOUR, method="adaptive")
    want = {(r["probe"], r["w_start"], round(r["freq"], 12)): r["psd"] for r in batch.collect()}
    assert rows.keys() == want.keys() and all(rows[k] == pytest.approx(want[k]) for k in want)


# ---- P12, T7, X, W13 ----------------------------------------------------------------------------
def test_no_row_is_lost_or_made(spark):
    rows = [("i00", None if k == 3 else k // 2, k % 4, 10.0 * k, 5.0, 16000.0, 100.0, 50.0, 400.0) for k in range(8)]
    df = spark.createDataFrame(rows, "probe string, t long, seq long, Ax double, Ay double, Az double, Mx double, My double, Mz double")
    for despike in (True, False):
        got = velocity.recovered_velocity(df, coefs(spark, df), despike=despike).collect()
        assert sorted(((r["t"], r["seq"]) for r in got), key=str) == sorted(((r[1], r[2]) for r in rows), key=str)


def test_line_with_shifts_in_batches(spark):
    r = random.Random(1)
    t, rows = 0, []
    for k in range(300):
        t += 200_000 + r.choice([0, 0, 0, 30_000, 900_000, -60_000])
        rows.append(("ab"[k % 2], k // 150, t, k))
    want, line = {}, {}
    for p, b, t, k in sorted(rows, key=lambda x: (x[0], x[1], x[2], x[3])):
        base, n = line.get((p, b), (t, 0))
        at = base + n * 200_000.0
        line[p, b] = (t, 1) if abs(at - t) > 100_000 else (base, n + 1)
        want[k] = t if abs(at - t) > 100_000 else round(at)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = timefix.linear_with_shifts(spark.createDataFrame(rows, "probe string, burst long, t long, seq long"), 5.0, 100_000).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {x["seq"]: x["t"] for x in got} == want
    long = np.cumsum(np.random.default_rng(2).integers(0, 3, 20_000))
    whole, base, n = timefix._follow(long, 1.0, 2, float(long[0]), 0)
    again, _, _ = timefix._follow(long, 1.0, 2, float(long[0]), 0, block=5)
    assert (whole == again).all() and np.abs(whole - long).max() <= 2


def test_tapers_of_long_windows():
    n, bandwidth = 500, 4.0
    v, ratios = spectrum.tapers(n, bandwidth)
    k, w = np.arange(n), bandwidth / n
    off = k[1:] * (n - k[1:]) / 2
    _, dense = np.linalg.eigh(np.diag(((n - 1 - 2 * k) / 2) ** 2 * np.cos(2 * np.pi * w)) + np.diag(off, 1) + np.diag(off, -1))
    assert np.abs(np.abs((v * dense[:, ::-1][:, :7].T).sum(1)) - 1).max() < 1e-9
    lag = k[:, None] - k[None, :]
    kernel = np.where(lag == 0, 2 * w, np.sin(2 * np.pi * w * lag) / (np.pi * np.where(lag == 0, 1, lag)))
    assert ratios == pytest.approx([x @ kernel @ x for x in v], abs=1e-10)
    v, ratios = spectrum.tapers(6000, bandwidth)
    assert np.abs(v @ v.T - np.eye(7)).max() < 1e-9 and (np.diff(ratios) < 0).all() and ratios[0] > 0.999999


def test_adaptive_weights_settle():
    x = np.random.default_rng(3).standard_normal(512)
    f, flat = spectrum.multitaper(x, 1.0)
    _, own = spectrum.multitaper(x, 1.0, weights="adaptive")
    assert np.abs(own / flat - 1)[1:-1].max() < 0.2  # white noise: the tapers agree
    assert np.isnan(spectrum.adaptive_weights(np.zeros((5, 9)), np.full(5, 0.99))).all()
    with pytest.raises(ValueError, match="three"):
        spectrum.adaptive_weights(np.ones((2, 9)), np.full(2, 0.99))


def test_sign_by_gradient(spark):
    r = random.Random(5)
    rows = [(p, k, k, r.uniform(-1.1, 1.1)) for p in ("a", "b") for k in range(200)]
    df = spark.createDataFrame(rows, "probe string, t long, seq long, x double")
    want = {}
    for p in ("a", "b"):
        s = [math.sqrt(max(0.0, 1 - x * x)) for q, _, _, x in rows if q == p]
        d, sign = [0.0] + [b - a for a, b in zip(s, s[1:])], 1
        for i in range(200):
            if d[i] < 0 and i + 1 < 200 and not d[i + 1] < 0 and abs(d[i - 1] - (s[i] + s[i + 1])) < abs(d[i - 1] - d[i]):
                sign = -sign
            want[p, i] = sign * s[i]
    assert min(want.values()) < 0
    for width in (None, 7):
        got = {(r["probe"], r["t"]): r["z"] for r in windows.recovered_by_gradient(df, "z", ["x"], width=width).collect()}
        assert got == pytest.approx(want)


def test_files_are_listed_and_claimed_once(spark, tmp_path):
    for name in ("incl_i05.txt", "sub/inclp12.txt", "sub/other.csv", "i7@coef.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    files = text.list_files(spark, str(tmp_path), "*.txt")
    found = text.discovered(files)
    assert sorted((r["path"].rsplit("/", 1)[1], r["probe"]) for r in found.collect()) == [("incl_i05.txt", "i05"), ("inclp12.txt", "p12")]
    assert files.where("changed is null").count() == 0 and text.double_claims(found).count() == 0
    # The same file found for another probe too.
    again = found.unionByName(found.where("probe = 'i05'").select("path", "changed", F.lit("b05").alias("probe")))
    assert [(r["path"].rsplit("/", 1)[1], r["probes"]) for r in text.double_claims(again.unionByName(found)).collect()] == [("incl_i05.txt", 2)]
