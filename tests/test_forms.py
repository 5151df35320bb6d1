"""Small cases of T11 by monotone cubics, F4 and W3 over several channels."""

from pyspark.sql import functions as F

from driftline.operators import filters, timefix, windows
from driftline.schema import DAY


def frame(spark, rows, columns="probe string, t long, seq long, y double"):
    return spark.createDataFrame(rows, columns)


def test_monotone_grid_stays_between_its_knots(spark):
    knots = [(0, 0.0), (10, 0.0), (20, 1.0), (30, 5.0), (50, 5.0), (60, 2.0)]
    df = frame(spark, [("a", t, k, y) for k, (t, y) in enumerate(knots)] + [("one", 7, 0, 3.0), ("two", 0, 0, 1.0), ("two", 4, 1, 3.0), ("a", 20, 9, None)])
    found = {(r.probe, r.t): r.y for r in timefix.monotone_grid(df, 2, "y").collect()}
    for (t0, y0), (t1, y1) in zip(knots, knots[1:]):
        inside = [found["a", t] for t in range(t0, t1 + 1, 2)]
        assert inside[0] == y0 and inside[-1] == y1
        assert inside == sorted(inside, reverse=y1 < y0)
    assert found["one", 7] == 3.0
    assert found["two", 2] == 2.0
    # Slopes at 20 and 30: the weighted harmonic mean of 0.1 and 0.4, and 0 before a flat step.
    m = 2 / (1 / 0.1 + 1 / 0.4)
    u = 0.4
    assert abs(found["a", 24] - ((1 + 2 * u) * (1 - u) ** 2 + 10 * m * u * (1 - u) ** 2 + 5 * u * u * (3 - 2 * u))) < 1e-12


def test_monotone_grid_of_nothing(spark):
    assert timefix.monotone_grid(frame(spark, []), 2, "y").count() == 0


def test_mask_ranges_meet_overlap_and_stay_open(spark):
    df = frame(spark, [("a", k * DAY // 4, k, None) for k in range(20)] + [("b", 5, 1, None)])
    ranges = spark.createDataFrame([("a", 0, DAY), ("a", DAY // 2, 2 * DAY), ("a", 4 * DAY, None), ("a", None, 3 * DAY), ("a", 3 * DAY, 2 * DAY), ("c", 0, None)], "probe string, t_start long, t_end long")
    out = filters.mask_ranges(df, ranges)
    assert out.columns == [*df.columns, "good"] and out.count() == 21
    assert sorted(r.seq for r in out.where("good and probe = 'a'").collect()) == [*range(9), *range(16, 20)]
    assert out.where("good and probe = 'b'").count() == 0


def test_despiked_counts_equals_one_channel_at_a_time(spark):
    df = spark.range(200).select(F.lit("p").alias("probe"), F.col("id").alias("t"), F.col("id").alias("seq"), *[F.when(F.col("id") % k == 0, F.lit(9000)).when(F.col("id") % 13 != 0, F.col("id") * 3 % 50).alias(c) for c, k in (("Ax", 17), ("Mx", 19))])
    limits = {"Ax": 1500, "Mx": 100}
    want = df
    for c, most in limits.items():
        want = windows.filled(windows.spikes(want, c, most), c, F.col("spike")).drop("spike")
    got = windows.despiked_counts(df, limits)
    assert got.columns == df.columns
    assert sorted(got.collect()) == sorted(want.select(*df.columns).collect())
