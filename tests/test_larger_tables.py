"""What only larger tables show: sums that overflow, ties, long runs, joins by few probes."""

import random
import re
from datetime import datetime, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

from driftline import streaming
from driftline.operators import aggregates, scan, timefix, windows
from driftline.plans.catalog import HOUR, ORACLES, QUERIES
from driftline.schema import timestamp
from driftline.scratch import kept_table

T0 = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp()) * 1_000_000


def test_mean_time_of_many_rows(spark):
    """20,000 times of today add up to more than a LONG holds, as the one bin of a probe and within a bin of two hours."""
    n = 20_000
    df = spark.range(n).select(F.lit("a").alias("probe"), (F.col("id") * 100_000 + T0).alias("t"), F.col("id").cast("double").alias("x"))
    whole = aggregates.binned(df, 400 * 86400, ["x"]).first()
    assert (whole["t"], whole["rows"], whole["x"]) == (T0 + (n - 1) * 50_000, n, (n - 1) / 2)
    late = df.unionByName(df.withColumn("t", F.col("t") + 86400 * 1_000_000))
    assert sorted((r["t"], r["rows"]) for r in aggregates.binned(late, 7200, ["x"]).collect()) == [(T0, n), (T0 + 86400 * 1_000_000, n)]


def test_bins_make_their_columns_once(spark):
    """Where no probe is shorter than a bin, no row is read a second time for such probes; one that is has its row, over a bin's border too."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(x):
        made.add(1)
        return x

    row = F.col("id")
    df = spark.range(4000).select(F.when(row % 2 == 0, "a").otherwise("b").alias("probe"), (row * 60_000_000 + T0).alias("t"), row.cast("double").alias("x"))
    short = spark.range(30).select(F.lit("c").alias("probe"), (row * 60_000_000 + T0 + 6_600_000_000).alias("t"), row.cast("double").alias("x"))
    assert sum(r["rows"] for r in aggregates.binned(df.withColumn("x", costly("x")), 7200, ["x"]).collect()) == made.value == 4000
    got = aggregates.binned(df.unionByName(short), 7200, ["x"]).collect()
    assert sum(r["rows"] for r in got) == 4030
    assert [(r["t"], r["rows"], r["x"]) for r in got if r["probe"] == "c"] == [(T0 + 7_470_000_000, 30, 14.5)]


def test_serial_days_near_half_seconds(spark, tmp_path):
    """5,000 times within 20 microseconds of half a second, and some before 1970: the query and its SQL round each alike."""
    folder = str(tmp_path)
    ts = F.timestamp_add("MICROSECOND", F.col("id") * 86_413_000_000 % 1_700_000_000_000_000 - F.col("id") % 7 * 10_000_000_000_000 + 500_000 + F.col("id") % 41 - 20, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    spark.range(5000).select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 50).alias("user_id"), F.lit(1.0).alias("value")).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.sql(f"create view events as from '{folder}/events.parquet/*.parquet'")
    assert sorted(map(tuple, QUERIES["l11_serial_day"](spark, folder).collect())) == sorted(con.sql(f"select seq, s from ({ORACLES['l11_serial_day']})").fetchall())


def test_chunks_cut_long_runs(spark, tmp_path):
    """Runs of 90 rows of one time, more than the overlap of 50, in four chunks by two calls: as over the whole after each call, also for a
    probe that ends early, one with a single time and a row without a time at a chunk's end."""
    row = F.col("id")
    probe = F.when(row % 10 == 3, "short").when(row % 10 == 7, "one").otherwise("long")
    time = F.when(row % 10 == 7, 0).otherwise(F.floor(row / 128)) * HOUR + T0
    rows = spark.range(1200).where("id % 10 <> 3 or id < 250").select(probe.alias("probe"), row.alias("seq"), F.when(~row.isin(299, 905), time).alias("t")).persist()
    folders = [str(tmp_path / n) for n in ("in", "out", "state")]
    for calls, chunks in ((1, (0, 1)), (2, (2, 3))):
        for k in chunks:
            part = rows.where(F.floor(F.col("seq") / 300) == k).select("probe", "seq", timestamp(F.col("t")).alias("ts"))
            part.coalesce(1).write.mode("append").parquet(folders[0])
        stream = spark.readStream.schema("probe string, seq long, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(folders[0])
        got = streaming.corrected_to(stream, folders[1], folders[2], fs=1 / 60, overlap=50)
        whole = timefix.corrected_times(rows.where(F.col("seq") < calls * 600), fs=1 / 60).select("probe", "seq", "t", "ok")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("name", ["p12_recovered", "p12_full", "flow_2h", "t2_sampling_frequency"])
def test_no_shuffle_by_probe_alone(spark, name):
    """At the size where slices begin and Spark broadcasts nothing by itself, no join has the rows of a probe in one task."""
    wanted = {"driftline.scan.smallBytes": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert not re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[probe#\w+\], ", plan)


@pytest.mark.parametrize("name", ["p12_full", "p12_recovered"])
def test_generated_methods_are_compiled(spark, name, monkeypatch):
    """In slices, no plan that is written or returned has a generated method of 8,000 bytes or more: the JVM would interpret it row by row."""
    plans = []
    for module in (scan, windows):
        monkeypatch.setattr(module, "kept_table", lambda df: plans.append(df) or kept_table(df))
    wanted = {"driftline.scan.smallBytes": "0", "spark.sql.adaptive.enabled": "false"}
    kept = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        plans.append(QUERIES[name](spark, "/root/testdata/sf0.001"))
        code = [spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan()) for df in plans]
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    sizes = [int(n) for text in code for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(plans) > 1 and sizes and max(sizes) < 8000


@pytest.mark.parametrize("width", [2, 7, 1000])
def test_despiked_slices_are_the_windows(spark, width):
    """Spikes and gaps at slices' borders, over whole slices and at a series' ends, rows without a time, a channel without values,
    series of one and two rows: each channel as by W2 and W4 with a window per probe."""
    r = random.Random(5)
    rows = [("one", 3, 0, 5.0, None, 1.0), ("two", 1, 0, 5.0, 2.0, None), ("two", 1, 1, 90.0, None, None)]
    for p, n in (("a", 120), ("b", 31)):
        for k in range(n):
            a = None if 40 <= k < 70 or r.random() < 0.2 else r.choice([1.0, 2.0, 3.0, 80.0, -70.0])
            rows.append((p, None if k % 19 == 4 else k // 2, k, a, None if p == "a" else float(k * k % 11), r.choice([0.0, 50.0, None])))
    df = spark.createDataFrame(rows, "probe string, t long, seq long, Ax double, My double, Mz double").repartition(3)
    limits = {"Ax": 20.0, "My": 4.0, "Mz": 30.0}
    want = df
    for c, most in limits.items():
        want = windows.filled(windows.spikes(want, c, most, width=1 << 40), c, F.col("spike"), width=1 << 40).drop("spike")
    got = windows.despiked_counts(df, limits, width=width)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*df.columns).collect()))
