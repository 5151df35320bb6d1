"""Scans in slices give what one window per probe gives, and a long probe is many tasks."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftline.operators import aggregates, joins, scan, timefix, windows
from driftline.operators.scan import after, before, haloed, highest, last, lowest_from, position, total, upcoming

SO_FAR, EARLIER = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)


@pytest.fixture(scope="module")
def rows(spark):
    """Two probes and a single row; repeated times, NULL times and values, gaps longer than several slices."""
    r = random.Random(2)
    found = [("c", 5, 0, 1.5)]
    for p, n in (("a", 300), ("b", 90)):
        t = 0
        for k in range(n):
            t += r.choice([0, 0, 1, 3, 8, 200] if p == "a" else [1, 2])
            found.append((p, None if k % 97 == 3 else t, k, None if r.random() < 0.6 else float(r.randint(-5, 5))))
    r.shuffle(found)
    return spark.createDataFrame(found, "probe string, t long, seq long, v double")


def table(df, *columns):
    return sorted((tuple(x) for x in df.select("probe", "seq", *columns).collect()), key=str)


def forth():
    return Window.partitionBy("probe").orderBy("t", "seq")


def forms():
    """What a scan carries, beside the window that it stands for."""
    W, BACK = forth(), Window.partitionBy("probe").orderBy(F.col("t").desc(), F.col("seq").desc())
    V = F.col("v")
    return {
        "last": (last(V), F.last("v", True).over(W.rowsBetween(*SO_FAR))),
        "last_before": (last(V, own=False), F.last("v", True).over(W.rowsBetween(*EARLIER))),
        "upcoming": (upcoming(V), F.last("v", True).over(BACK.rowsBetween(*SO_FAR))),
        "upcoming_after": (upcoming(V, own=False), F.last("v", True).over(BACK.rowsBetween(*EARLIER))),
        "before": (before(V), F.lag("v").over(W)),
        "after": (after(V), F.lead("v").over(W)),
        "before_row": (before(F.struct("v", "seq")), F.lag(F.struct("v", "seq")).over(W)),
        "total": (total(V), F.sum("v").over(W.rowsBetween(*SO_FAR))),
        "total_before": (total(V, own=False), F.sum("v").over(W.rowsBetween(*EARLIER))),
        "position": (position(), F.row_number().over(W).cast("long") - 1),
        "highest": (highest(V), F.max("v").over(W.rowsBetween(*SO_FAR))),
        "highest_before": (highest(V, own=False), F.max("v").over(W.rowsBetween(*EARLIER))),
        "lowest_from": (lowest_from(V), F.min("v").over(BACK.rowsBetween(*SO_FAR))),
    }


@pytest.mark.parametrize("width", [1, 7, 100_000])
def test_scan_is_the_window(rows, width):
    every = forms()
    got = scan.scan(rows, {n: c for n, (c, _) in every.items()}, width=width)
    assert got.columns == [*rows.columns, *every]
    want = rows.withColumns({n: w for n, (_, w) in every.items()})
    assert table(got, *every) == table(want, *every)


def test_scans_in_a_row_share_slices(rows):
    once = scan.scan(rows, {"p": position()}, width=9, keep_slices=True)
    twice = scan.scan(once, {"s": total(F.col("p"))}, width=9)
    want = rows.withColumn("p", F.row_number().over(forth()).cast("long") - 1).withColumn("s", F.sum("p").over(forth().rowsBetween(*SO_FAR)))
    assert table(twice, "p", "s") == table(want, "p", "s")


@pytest.mark.parametrize("size", [4, 11, 1000])
def test_halo_is_the_window(rows, size):
    h = haloed(rows, 3, rows=size)
    got = h.done(h.rows.withColumns({"m": F.sum("v").over(h.forth.rowsBetween(-3, 2)), "l": F.lag("seq", 3).over(h.forth)}))
    want = rows.withColumns({"m": F.sum("v").over(forth().rowsBetween(-3, 2)), "l": F.lag("seq", 3).over(forth())})
    assert got.columns == [*rows.columns, "m", "l"] and table(got, "m", "l") == table(want, "m", "l")


def test_medians_are_exact(rows, spark):
    want = {}
    for r in rows.where("v is not null").collect():
        want.setdefault(r["probe"], []).append(r["v"])
    assert {r["probe"]: r["median"] for r in aggregates.medians(rows, "v").collect()} == {p: statistics.median(v) for p, v in want.items()}
    far = spark.createDataFrame([("a", x) for x in [1e300, -1e300, 3.0, 4.0, 4.0, 1e-9]] + [("b", 2.0)] * 4, "probe string, v double")
    assert {r["probe"]: r["median"] for r in aggregates.medians(far, "v").collect()} == {"a": 3.5, "b": 2.0}


def one_probe(spark):
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    return events.select(F.lit("i00").alias("probe"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.col("event_id").alias("seq"), F.col("value"))


def test_one_probe_is_many_tasks(spark):
    """All rows of sf0.1 as one probe: the largest task has at most twice the median's rows."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = one_probe(spark)
        n = df.count()
        for made in (windows.spikes(df, "value", 10.0), windows.filled(df, "value", F.col("seq") % 5 == 0), windows.bursts(df, 3_600_000_000), timefix.spread_repeats(df, 0.1), timefix.filled_times(df.withColumn("bad", F.col("seq") % 5 == 0), "bad", 0.1), windows.sigma_despiked(df, "value"),
                     joins.neighbours(df.select("probe", F.col("seq").alias("qid"), (F.col("t") + 1).alias("t")), df, "value")):
            # All columns are asked for, so that no window is left out.
            sizes = [r["n"] for r in made.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(*made.columns))).collect()]
            assert sum(sizes) == n and len(sizes) >= 6
            assert max(sizes) <= 2 * statistics.median(sizes), sizes
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("form", ["w1", "w2", "w3", "w4", "w7", "w8", "w11", "w12", "t2", "t3", "t4", "t5", "t6", "t8", "t10", "j2"])
def test_slices_make_no_difference(spark, form):
    """Each operator over tiny slices gives what one slice gives."""
    r = random.Random(9)
    t, found = 0, []
    for k in range(400):
        t += r.choice([0, 1, 1, 2, 30, 86_400]) * 1_000_000
        found.append(("ab"[k % 2], t, k, float(r.choice([1, 1, 2, 50, -40])) if r.random() < 0.8 else None, r.random() < 0.3, 6.0 - k / 150))
    df = spark.createDataFrame(found, "probe string, t long, seq long, v double, flag boolean, bat double")
    make = {
        "w1": lambda w: windows.bursts(df, width=w), "w2": lambda w: windows.spikes(df, "v", 20.0, width=w), "w3": lambda w: windows.despiked_counts(df, {"v": 20.0, "bat": 0.001}, width=w),
        "w4": lambda w: windows.filled(df, "v", F.col("flag"), width=w), "w7": lambda w: windows.true_regions(df, "flag", width=w), "w8": lambda w: windows.kept_position(df, "flag", "right", width=w),
        "w11": lambda w: windows.smoothed_steps(df, "v", width=w), "w12": lambda w: windows.battery_tail(df, "bat", 4.5, width=w), "t2": lambda w: timefix.sampling_frequency(df, width=w),
        "t3": lambda w: timefix.without_inversions(df.withColumn("t", F.when(F.col("seq") % 9 != 0, F.col("t")).otherwise(F.col("t") + 90_000_000)), width=w), "t4": lambda w: timefix.spread_repeats(df, 5.0, width=w), "t5": lambda w: timefix.day_jumps(df, width=w), "t6": lambda w: timefix.linear_between_holes(df, 1.0, width=w), "t8": lambda w: timefix.filled_times(df, "flag", 5.0, width=w),
        "t10": lambda w: timefix.equal_spacing(df, width=w), "j2": lambda w: joins.nearest(df.select("probe", F.col("seq").alias("qid"), (F.col("t") + 700_000).alias("t")), df, "v", width=w),
    }[form]
    small, whole = 3 if form in ("t2", "t3", "t4", "t5", "t8") else 40_000_000, 1 << 50
    assert sorted(map(str, make(small).collect())) == sorted(map(str, make(whole).collect()))


def test_neighbours_at_equal_times(spark):
    data = spark.createDataFrame([("a", 5, 1.0), ("a", 9, 2.0)], "probe string, t long, v double")
    asked = spark.createDataFrame([("a", 0, 4), ("a", 1, 5), ("a", 2, 6), ("a", 3, 9), ("a", 4, 11), ("b", 5, 1)], "probe string, qid long, t long")
    got = {r["qid"]: (r["before_t"], r["after_t"]) for r in joins.neighbours(asked, data, "v", width=2).collect()}
    assert got == {0: (None, 5), 1: (5, 5), 2: (5, 9), 3: (9, 9), 4: (9, None), 5: (None, None)}
