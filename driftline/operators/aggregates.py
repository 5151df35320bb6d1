"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics
from ..schema import DAY, SECOND
from .scan import SLICE, is_small, scan, total, with_facts


def bin_start(seconds: int) -> Column:
    """Left-closed bins that start at the midnight of the probe's first day."""
    size = seconds * SECOND
    if DAY % size == 0:
        return F.floor(F.col("t") / size) * size
    return F.floor((F.col("t") - F.col("_day0")) / size) * size + F.col("_day0")


def binned(df: DataFrame, seconds: int, columns: Sequence[str]) -> DataFrame:
    """A1, A2: means per bin, and rows per bin. Bins with at most a tenth of the mean number of rows go,
    and so do bins without values; where the bin exceeds a probe's span its rows make one at their mean time.

    One shuffle of partial sums. A probe's span and mean number of rows come from its bins, by one more aggregate over them, for which times
    are read once more without the columns; the tenth rule is a join with those few numbers. The rows of short probes are read again by
    a join with the same numbers, which adaptive execution leaves out where there is no such probe. Without a bin that divides the day, the first day of
    each probe comes from an aggregate of its own. Times are summed as decimals: a LONG overflows at some 5,400 times of today.
    """
    size = seconds * SECOND
    rows = df if DAY % size == 0 else with_facts(df, df.groupBy("probe").agg((F.floor(F.min("t") / DAY) * DAY).alias("_day0")))
    means = [(F.sum(c) / F.nullif(F.count(c), F.lit(0))).alias(c) for c in columns]
    out = rows.groupBy("probe", bin_start(seconds).alias("t")).agg(F.count(F.lit(1)).alias("rows"), F.min("t").alias("_t0"), F.max("t").alias("_t1"), *means)
    whole = out.groupBy("probe").agg((F.max("_t1") - F.min("_t0") < size).alias("_one"), F.avg("rows").alias("_mean_rows"))
    many = with_facts(out, whole).where(~F.col("_one") & (F.col("rows") > F.col("_mean_rows") / 10) & F.coalesce(*columns).isNotNull())
    # A short probe may lie over a bin border: its one row is made of all its rows. Both numbers are asked for, so that whole is made once.
    short = whole.where(F.col("_one") & F.col("_mean_rows").isNotNull()).select("probe")
    one = with_facts(df, short).groupBy("probe").agg(F.floor(F.sum(F.col("t").cast("decimal(20,0)")).cast("double") / F.count(F.lit(1))).alias("t"), F.count(F.lit(1)).alias("rows"), *means)
    return many.select("probe", "t", "rows", *columns).unionByName(one.select("probe", "t", "rows", *columns))


def binned_many(df: DataFrame, bins: Sequence[int], columns: Sequence[str]) -> DataFrame:
    """A3 for bins over two seconds: averages of the physical frame, one bin_s each."""
    out = None
    for seconds in bins:
        part = binned(df, seconds, columns).withColumn("bin_s", F.lit(seconds))
        out = part if out is None else out.unionByName(part)
    return out


def binned_counts_or_physics(df: DataFrame, bins: Sequence[int], counts: Sequence[str], physical, columns: Sequence[str], short: int = 2) -> DataFrame:
    """A3, all bins: those of at most `short` seconds average the counts and then make them physical, longer ones average
    what physical(df) gives for each row."""
    out = None
    for seconds in bins:
        if seconds <= short:
            part = physical(binned(df, seconds, counts)).select("probe", "t", "rows", *columns)
        else:
            part = binned(physical(df), seconds, columns)
        part = part.withColumn("bin_s", F.lit(seconds))
        out = part if out is None else out.unionByName(part)
    return out


def first_per_bin(df: DataFrame, seconds: int, columns: Sequence[str]) -> DataFrame:
    """A4: the first row of each bin over stacked probes."""
    key = F.struct("t", "probe", "seq")
    return df.groupBy((F.floor(F.col("t") / (seconds * SECOND)) * seconds * SECOND).alias("bin_t")).agg(*[F.min_by(c, key).alias(c) for c in ("probe", *columns)])


def modes(df: DataFrame, column: str) -> DataFrame:
    """A5: the most frequent value, the smallest on ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy("probe", column).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("probe").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(column).alias("v"))).alias("_b"))
    return best.select("probe", F.col("_b.v").alias("mode"), (-F.col("_b.m")).alias("n"))


def mean_deviation(df: DataFrame, column: str) -> DataFrame:
    """Mean absolute deviation around the mean: two passes of partial aggregates, no window."""
    mean = df.groupBy("probe").agg(F.avg(column).alias("_m"))
    return with_facts(df, mean).groupBy("probe").agg(F.avg(F.abs(F.col(column) - F.col("_m"))).alias("mad"))


#: Ranges of values that a median is looked for in.
MEDIAN_RANGES = 256


def medians(df: DataFrame, column: str) -> DataFrame:
    """The exact median of each probe: probe, median (the mean of the two middle values of an even number).

    Values are counted by aggregation, and the counts, dealt into ranges of values, are summed up in order by a scan: no probe's values
    are in one task, and nothing is held but counts. Small tables have Spark's own median.
    """
    v = df.where(F.col(column).isNotNull()).select("probe", F.col(column).cast("double").alias("v"))
    if is_small(df):
        return v.groupBy("probe").agg(F.median("v").alias("median"))
    counts = v.groupBy("probe", "v").agg(F.count(F.lit(1)).alias("n"))
    # From the counts as well, so that the values are shuffled once.
    ends = counts.groupBy("probe").agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.sum("n").alias("_all"))
    part = F.coalesce(F.floor((F.col("v") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * MEDIAN_RANGES), F.lit(0)).cast("long")
    x = scan(with_facts(counts, ends).withColumn(SLICE, part), {"_upto": total(F.col("n"))}, ("v",))
    holds = lambda k: (F.col("_upto") > k) & (F.col("_upto") - F.col("n") <= k)
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    return x.groupBy("probe").agg(((F.max(F.when(holds(low), F.col("v"))) + F.max(F.when(holds(high), F.col("v")))) / 2).alias("median"))


def median_direction(df: DataFrame) -> DataFrame:
    """A7."""
    m = medians(df, "u").withColumnRenamed("median", "mu").join(medians(df, "v").withColumnRenamed("median", "mv"), "probe")
    return m.select("probe", (-F.degrees(F.atan2("mu", "mv"))).alias("azimuth_add"))


def zeroing(df: DataFrame, columns: Sequence[str] = ("Gx", "Gy", "Gz")) -> DataFrame:
    """Mean gravity of zeroing rows and the rotation that sets it upright, as an array of rows."""
    m = df.groupBy("probe").agg(*[F.avg(c).alias(f"g{i}") for i, c in enumerate(columns)])
    r = physics.turn_to_vertical((F.col("g0"), F.col("g1"), F.col("g2")))
    return m.select("probe", "g0", "g1", "g2", F.array(*[F.array(*row) for row in r]).alias("Rz"))


def in_cells(df: DataFrame, bins: int = 200, columns: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """df with the cell of each point of a sphere: by polar angle (0 to 2 pi) and cosine of azimuth."""
    x, y, z = (F.col(c) for c in columns)
    polar = F.acos(z / F.sqrt(x * x + y * y + z * z))
    a = F.least(F.floor(polar / (2 * 3.141592653589793) * bins), F.lit(bins - 1))
    b = F.least(F.floor((F.cos(F.atan2(y, x)) + 1) / 2 * bins), F.lit(bins - 1))
    return df.withColumns({"cell_a": a, "cell_b": b})


def sphere_cells(df: DataFrame, bins: int = 200, columns: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Points of a sphere by cells; a cell's mean point, its first time and its number of points."""
    cells = in_cells(df, bins, columns).groupBy("probe", "cell_a", "cell_b")
    return cells.agg(*[F.avg(c).alias(c) for c in columns], F.min("t").alias("t"), F.count(F.lit(1)).alias("n"))


def burst_statistics(df: DataFrame) -> DataFrame:
    """Number of bursts, mean rows of inner bursts, largest gap between bursts (rows carry burst)."""
    b = df.groupBy("probe", "burst").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("s"), F.max("t").alias("e"))
    w = Window.partitionBy("probe").orderBy("burst")
    b = b.withColumns({"_gap": F.col("s") - F.lag("e").over(w), "_last": F.max("burst").over(Window.partitionBy("probe"))})
    inner = F.when((F.col("burst") > 0) & (F.col("burst") < F.col("_last")), F.col("n"))
    return b.groupBy("probe").agg(F.count(F.lit(1)).alias("bursts"), F.avg(inner).alias("mean_rows"), F.max("_gap").alias("largest_gap"))


def summary(df: DataFrame, kept: Column) -> DataFrame:
    """A16."""
    return df.groupBy("probe").agg(F.min("t").alias("t_start"), F.max("t").alias("t_end"), F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("rows_kept"))
