"""Ordered operators per probe (W1-W13). Rows are scanned in slices (scan.py), so a long probe is many tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ..schema import SECOND
from ..scratch import kept_table
from .scan import SLICE, SMALL_BYTES, Haloed, after, before, haloed, in_slices, is_small, kept_if_large, last, position, scan, total, upcoming, with_facts

#: How far above the least good battery voltage the tail's line begins, ends and takes over.
TAIL_MARKS = (0.08, 0.02, 0.001)
#: Several channels go in slices from here on: 6,000,000 events may be under 32 MB, and took longer than in slices with windows per probe.
MANY_BYTES = 4 << 20


def bursts(df: DataFrame, gap: int | None = None, *, width: int | None = None) -> DataFrame:
    """burst = number of gaps longer than `gap` microseconds so far. None: the smaller of the
    first two gaps of the probe plus a second. width: of a slice, as in every operator here that has it."""
    want = {"_t": before(F.col("t"))} | ({"_i": position()} if gap is None else {})
    x = scan(df, want, width=width, keep_slices=True).withColumn("_d", F.col("t") - F.col("_t"))
    if gap is None:
        least = x.where(F.col("_i").isin(1, 2)).groupBy("probe").agg((F.min("_d") + SECOND).alias("_g"))
        x = with_facts(x, least, "left")
    else:
        x = x.withColumn("_g", F.lit(gap))
    x = scan(x, {"burst": total(F.when(F.col("_d") > F.col("_g"), 1).otherwise(0))}, width=width)
    return x.select(*df.columns, "burst")


def _spike(x: Column, back: Column, ahead: Column, most: float, up_only: bool = False) -> Column:
    """Steps of more than most into and out of x; back and ahead: the neighbours as structs (v), NULL where there is none."""
    into, out = x - back["v"], ahead["v"] - x

    def step(d: Column, edge: Column, up: bool) -> Column:
        return edge | F.coalesce(d > most if up else d < -most, F.lit(False))

    rise_fall = step(into, back.isNull(), True) & step(out, ahead.isNull(), False)
    fall_rise = step(into, back.isNull(), False) & step(out, ahead.isNull(), True)
    return fall_rise if up_only else rise_fall | fall_rise


def spikes(df: DataFrame, column: str, most: float, up_only: bool = False, *, width: int | None = None) -> DataFrame:
    """spike = steps of more than `most` into and out of the row, in opposite directions; a missing
    neighbour at an end of the series counts as such a step, a NULL one does not."""
    v = F.struct(F.col(column).alias("v"))
    x = scan(df, {"_before": before(v), "_after": after(v)}, width=width)
    return x.withColumn("spike", _spike(F.col(column), F.col("_before"), F.col("_after"), most, up_only)).drop("_before", "_after")


def _line(p: Column, n: Column, x: Column) -> Column:
    """Between known points (x, y) before and after; the nearer one where there is one only."""
    line = p["y"] + (n["y"] - p["y"]) * ((x - p["x"]) / F.nullif(n["x"] - p["x"], F.lit(0.0)))
    return F.coalesce(line, p["y"], n["y"])


def _fill(x: DataFrame, bad: dict[str, Column], pos: Column, width: int | None) -> DataFrame:
    """Columns by interpolation where NULL or bad; _x is added, and slices kept."""
    x = x.withColumn("_x", pos).withColumns({f"_y_{c}": F.when(~F.coalesce(b, F.lit(False)), F.col(c).cast("double")) for c, b in bad.items()})
    known = {c: F.when(F.col(f"_y_{c}").isNotNull(), F.struct(F.col("_x").alias("x"), F.col(f"_y_{c}").alias("y"))) for c in bad}
    x = scan(x, {f"_p_{c}": last(k) for c, k in known.items()} | {f"_n_{c}": upcoming(k) for c, k in known.items()}, width=width)
    x = x.withColumns({c: F.coalesce(f"_y_{c}", _line(F.col(f"_p_{c}"), F.col(f"_n_{c}"), F.col("_x"))) for c in bad})
    return x.drop("_x", *[f"_{k}_{c}" for c in bad for k in "ypn"])


def filled(df: DataFrame, column: str, bad: Column | None = None, x: str | None = None, *, width: int | None = None) -> DataFrame:
    """NULL or bad values by linear interpolation over row position (or x); constant at the ends."""
    return filled_all(df, {column: F.lit(False) if bad is None else bad}, x, width=width)


def filled_all(df: DataFrame, bad: dict[str, Column], x: str | None = None, *, width: int | None = None) -> DataFrame:
    """W4 for several columns in one scan: the rows whose values are bad, for each."""
    r = df if x is not None else scan(df, {"_i": position()}, width=width, keep_slices=True)
    return _fill(r, bad, F.col(x or "_i").cast("double"), width).select(*df.columns)


def despiked_counts(df: DataFrame, limits: dict[str, float], *, width: int | None = None) -> DataFrame:
    """W2 then W4 for each count channel (defaults of use: 1500 for A, 100 for M), all channels in the same two scans.

    Tables over MANY_BYTES (one channel: large ones) go through Arrow, a slice at a time: as columns of one plan six channels are so much code that the JVM does not compile it."""
    if width is not None or not is_small(df, MANY_BYTES if len(limits) > 1 else SMALL_BYTES):
        return _despiked_in_slices(df, limits, width)
    v = {c: F.struct(F.col(c).alias("v")) for c in limits}
    x = scan(df, {"_i": position()} | {f"_b_{c}": before(k) for c, k in v.items()} | {f"_a_{c}": after(k) for c, k in v.items()}, keep_slices=True)
    bad = {c: _spike(F.col(c), F.col(f"_b_{c}"), F.col(f"_a_{c}"), most) for c, most in limits.items()}
    return _fill(x, bad, F.col("_i").cast("double"), None).select(*df.columns)


def _despiked_in_slices(df: DataFrame, limits: dict[str, float], width: int | None) -> DataFrame:
    """despiked_counts() in three steps.

    1. By aggregation, each slice's number of rows and its first and last row; from these its neighbours' rows and the place of its own.
    2. Each slice by itself: spikes go, gaps between its known values are filled. Beside its rows, which are written down, a slice has one
       row more with the first and last known place and value of each channel.
    3. What is left is at a slice's ends: between its known values and those of the slices before and after.
    """
    names, keys = list(limits), ["probe", SLICE]
    x = in_slices(df, ("t", "seq"), width).withColumns({c: F.col(c).cast("double") for c in names})
    row = F.struct("t", "seq", F.array(*names).alias("v"))
    ends = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first"), F.max(row).alias("_last"))
    forth, back = Window.partitionBy("probe").orderBy(SLICE), Window.partitionBy("probe").orderBy(F.col(SLICE).desc())
    so_far = (Window.unboundedPreceding, -1)
    borders = ends.select(*keys, F.coalesce(F.sum("_n").over(forth.rowsBetween(*so_far)), F.lit(0)).alias("_at"), F.lag("_last").over(forth)["v"].alias("_b"), F.lead("_first").over(forth)["v"].alias("_a"))
    schema = StructType([StructField(f.name, f.dataType) for f in x.schema] + [StructField("_x", LongType()), StructField("_known", ArrayType(DoubleType()))])
    kept = kept_table(x.groupBy(*keys).cogroup(borders.groupBy(*keys)).applyInArrow(_slice_despiker(limits), schema))

    k = F.col("_known")
    place = lambda c, i: F.when(k[4 * c + i].isNotNull(), F.struct(k[4 * c + i].alias("x"), k[4 * c + i + 1].alias("y")))
    own = kept.where(k.isNotNull()).select(*keys, *[place(c, i).alias(f"_{e}{c}") for c in range(len(names)) for i, e in ((0, "f"), (2, "l"))])
    # Of each channel: the known point before the slice, its first and last one, and the one after it.
    points = [F.struct(F.last(f"_l{c}", True).over(forth.rowsBetween(*so_far)).alias("p"), F.col(f"_f{c}").alias("f"), F.col(f"_l{c}").alias("l"), F.last(f"_f{c}", True).over(back.rowsBetween(*so_far)).alias("n")) for c in range(len(names))]
    # Written down, so that Spark knows its size and sends it to every task where it is small.
    points = kept_table(own.select(*keys, F.array(*points).alias("_points")))
    at = F.col("_x").cast("double")

    def between(v: Column, p: Column) -> Column:
        line = _line(F.when(at >= p["f"]["x"], p["l"]).otherwise(p["p"]), F.when(at < p["f"]["x"], p["f"]).otherwise(p["n"]), at)
        return F.coalesce(v, line)

    rows = kept.where(k.isNull()).join(points, keys)
    whole = F.array(*names)
    some = F.col(names[0]).isNull()
    for c in names[1:]:
        some = some | F.col(c).isNull()
    rows = rows.withColumn("_filled", F.when(some, F.zip_with(whole, F.col("_points"), between)))
    return rows.withColumns({c: F.coalesce(F.col(c), F.col("_filled")[i]) for i, c in enumerate(names)}).select(*df.columns)


def _slice_despiker(limits: dict[str, float]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Step 2 of _despiked_in_slices() for a slice's rows and its one row of borders."""
    names = list(limits)

    def despiked(rows: pa.Table, border: pa.Table) -> pa.Table:
        n = rows.num_rows
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("t", "ascending"), ("seq", "ascending")], null_placement="at_start"))
        at, back, ahead = (border.column(c)[0].as_py() for c in ("_at", "_b", "_a"))
        first, final = np.arange(n) == 0, np.arange(n) == n - 1
        edge_b, edge_a = first & (back is None), final & (ahead is None)
        place, known = np.arange(at, at + n, dtype="float64"), []
        for i, (c, most) in enumerate(limits.items()):
            given = rows.column(c).combine_chunks()
            y = given.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            nan = float("nan")
            b = nan if back is None or back[i] is None else back[i]
            a = nan if ahead is None or ahead[i] is None else ahead[i]
            steps = np.diff(np.concatenate(([b], y, [a])))
            into, out = steps[:-1], steps[1:]
            spike = (edge_b | (into > most)) & (edge_a | (out < -most)) | (edge_b | (into < -most)) & (edge_a | (out > most))
            good = given.is_valid().to_numpy(zero_copy_only=False) & ~spike
            here = np.flatnonzero(good)
            missing = np.ones(n, bool)
            if len(here):
                known += [place[here[0]], y[here[0]], place[here[-1]], y[here[-1]]]
                missing[here[0] : here[-1] + 1] = False
                gap = np.flatnonzero(~good & ~missing)
                upper = np.searchsorted(here, gap)
                lo, hi = here[upper - 1], here[upper]
                y = y.copy()
                y[gap] = y[lo] + (y[hi] - y[lo]) * ((place[gap] - place[lo]) / (place[hi] - place[lo]))
            else:
                known += [None] * 4
            rows = rows.set_column(rows.schema.get_field_index(c), c, pa.array(y, mask=missing))
        rows = rows.append_column("_x", pa.array(place.astype("int64"))).append_column("_known", pa.nulls(n, pa.list_(pa.float64())))
        own = {"probe": rows.column("probe")[:1], SLICE: rows.column(SLICE)[:1], "_known": pa.array([known], pa.list_(pa.float64()))}
        more = pa.table([own.get(f.name, pa.nulls(1, f.type)) for f in rows.schema], names=rows.column_names)
        return pa.concat_tables([rows, more.cast(rows.schema)])

    return despiked


def _reach(blocks: Sequence[int], smooth: float | None) -> int:
    """Rows that a value depends on, on either side, after all passes, the nearest full window at an end included."""
    return sum(2 * b + (int(4 * smooth + 0.5) if smooth else 0) for b in blocks)


def sigma_despiked(df: DataFrame, column: str, offsets: Sequence[float] = (20.0, 5.0), blocks: Sequence[int] | int = 10, smooth: float | None = None, reverse: bool = False, *, rows: int | None = None) -> DataFrame:
    """Passes of (offset, block): values off the centred rolling mean by more than offset times the
    rolling deviation become NULL; rows near the ends take the nearest full window. rows: of a slice."""
    sizes = [blocks] * len(offsets) if isinstance(blocks, int) else list(blocks)
    h = _counted_halo(df, _reach(sizes, smooth), rows)
    return h.done(_sigma_passes(h, h.rows, column, offsets, sizes, smooth, reverse)).select(*df.columns)


def _counted_halo(df: DataFrame, reach: int, rows: int | None) -> Haloed:
    """haloed() with _n, the number of the probe's rows."""
    return haloed(with_facts(df, df.groupBy("probe").agg(F.count(F.lit(1)).alias("_n"))), reach, rows=rows)


def _sigma_passes(h: Haloed, x: DataFrame, column: str, offsets: Sequence[float], sizes: Sequence[int], smooth: float | None, reverse: bool) -> DataFrame:
    """The passes of W5 over rows of a halo with _n."""
    # Backwards, the row's place is counted from the end.
    x = x.withColumn("_k", F.col("_n") - 1 - F.col("_i") if reverse else F.col("_i"))
    w = h.whole.orderBy("_k")
    for offset, block in zip(offsets, sizes):
        start = block // 2
        r = w.rowsBetween(-start, block - start - 1)
        # In a slice with a halo, windows at the edge of the halo are cut off; no row that counts reaches them.
        full = (F.col("_k") >= start) & (F.col("_k") < F.col("_n") - block + start + 1)
        x = x.withColumn("_m", F.when(full, F.avg(column).over(r))).withColumn("_s", F.when(full, F.stddev_pop(column).over(r)))
        # Full windows are a contiguous stretch: its first and last values serve the ends.
        for c in ("_m", "_s"):
            lo, hi = F.max(F.when(F.col("_k") == start, F.col(c))).over(h.whole), F.max(F.when(F.col("_k") == F.col("_n") - block + start, F.col(c))).over(h.whole)
            x = x.withColumn(c, F.when(F.col("_k") < start, lo).when(F.col("_k") > F.col("_n") - block + start, hi).otherwise(F.col(c)))
        if smooth:
            x = x.withColumn("_s", gaussian("_s", smooth, w))
        x = x.withColumn(column, F.when(F.abs(F.col(column) - F.col("_m")) > offset * F.col("_s"), F.lit(None)).otherwise(F.col(column)))
    return x.drop("_k", "_m", "_s")


def gaussian(column: str, sigma: float, w) -> Column:
    """Weighted window sum; weights are renewed where rows are missing at the ends."""
    import math

    radius = int(4 * sigma + 0.5)
    total, weights = F.lit(0.0), F.lit(0.0)
    for k in range(-radius, radius + 1):
        g = math.exp(-0.5 * (k / sigma) ** 2)
        v = F.lead(column, k).over(w) if k >= 0 else F.lag(column, -k).over(w)
        total = total + F.coalesce(v * g, F.lit(0.0))
        weights = weights + F.when(v.isNotNull(), g).otherwise(0.0)
    return total / F.nullif(weights, F.lit(0.0))


def vector_despiked(df: DataFrame, columns: Sequence[str], offsets: Sequence[float] = (1.5, 2.0), blocks: Sequence[int] = (21, 7), smooth: float | None = 4.0, *, rows: int | None = None) -> DataFrame:
    """W5 backwards, then forwards, on each channel in turn with smoothed deviations. Rows that a channel loses
    are no part of the next channel's series; ok = the row is left after all of them. A row is known by its position, so
    rows without a time and rows with the same one are judged each."""
    numbered = scan(df, {"_row": position()}, width=None)
    # Written down: each pass reads what the one before left, more than once.
    x = kept_if_large(numbered.select("probe", "t", "seq", "_row", *[F.col(c).cast("double").alias(c) for c in columns]))
    for c in columns:
        # No row goes between the two directions, so both are made in one halo of twice the reach.
        x = x.where(F.col(c).isNotNull())
        h = _counted_halo(x, 2 * _reach(blocks, smooth), rows)
        made = h.rows
        for back in (True, False):
            made = _sigma_passes(h, made, c, offsets, blocks, smooth, back)
        x = kept_if_large(h.done(made).select(*x.columns)).where(F.col(c).isNotNull())
    left = x.select("probe", "_row", F.lit(True).alias("_ok"))
    return numbered.join(left, ["probe", "_row"], "left").withColumn("ok", F.coalesce("_ok", F.lit(False))).select(*df.columns, "ok")


def true_regions(df: DataFrame, flag: str, *, width: int | None = None) -> DataFrame:
    """[start, end) row positions of contiguous true stretches."""
    x = scan(df, {"_i": position(), "_k": total(F.when(F.col(flag), 1).otherwise(0))}, width=width).where(flag)
    return x.groupBy("probe", (F.col("_i") - F.col("_k")).alias("_g")).agg(F.min("_i").alias("start"), (F.max("_i") + 1).alias("end")).drop("_g")


def kept_position(df: DataFrame, bad: str, side: str = "left", *, width: int | None = None) -> DataFrame:
    """Position among the rows that stay: of the next kept row (left) or the kept row before (right)."""
    x = scan(df, {"_before": total(F.when(~F.col(bad), 1).otherwise(0), own=False)}, width=width)
    before_ = F.coalesce("_before", F.lit(0))
    return x.withColumn("kept_i", before_ if side == "left" else F.when(F.col(bad), before_ - 1).otherwise(before_)).drop("_before")


def burst_despiked(df: DataFrame, column: str, offset: float = 3.0) -> DataFrame:
    """Per burst, values off the burst's mean by more than offset deviations become NULL."""
    w = Window.partitionBy("probe", "burst")
    return df.withColumn(column, F.when(F.abs(F.col(column) - F.avg(column).over(w)) <= offset * F.stddev_pop(column).over(w), F.col(column)))


def burst_starts_nulled(df: DataFrame, column: str, period: int, rows: int = 2) -> DataFrame:
    """The first rows of each period become NULL."""
    w = Window.partitionBy("probe", F.floor(F.col("t") / period)).orderBy("t", "seq")
    return df.withColumn(column, F.when(F.row_number().over(w) > rows, F.col(column)))


def smoothed_steps(df: DataFrame, column: str, *, width: int | None = None) -> DataFrame:
    """Only rows where the value changes are trusted; between them it is interpolated."""
    x = scan(df, {"_i": position(), "_b": before(F.col(column))}, width=width, keep_slices=True)
    same = F.col("_b").isNotNull() & ~F.coalesce(F.col("_b") != F.col(column), F.lit(False))
    return _fill(x, {column: same}, F.col("_i").cast("double"), width).select(*df.columns)


def battery_tail(df: DataFrame, column: str, least: float, *, width: int | None = None) -> DataFrame:
    """From the first row below least + 0.001 on, the value goes on from there with the slope between the
    first rows below least + 0.08 and below least + 0.02; a probe whose two rows are one is left as it is."""
    x = scan(df, {"_i": position()}, width=width)

    def below(limit: float) -> Column:
        return F.min(F.when(F.col(column) < limit, F.struct(F.col("_i").alias("i"), F.col(column).alias("y"))))

    marks = x.groupBy("probe").agg(*(below(least + more).alias(name) for more, name in zip(TAIL_MARKS, ("_a", "_b", "_c"))))
    slope = (F.col("_b.y") - F.col("_a.y")) / F.nullif(F.col("_b.i") - F.col("_a.i"), F.lit(0))
    tail = F.when(F.col("_i") >= F.col("_c.i"), F.col("_c.y") + (F.col("_i") - F.col("_c.i")) * slope)
    return with_facts(x, marks).withColumn(column, F.coalesce(tail, F.col(column))).drop("_i", "_a", "_b", "_c")


def recovered_channel(df: DataFrame, lost: str, others: Sequence[str], helper: str) -> DataFrame:
    """A lost component of a unit vector: the magnitude that the others leave, the helper's sign."""
    rest = F.lit(1.0)
    for c in others:
        rest = rest - F.col(c) * F.col(c)
    return df.withColumn(lost, F.coalesce(F.col(lost), F.sqrt(F.greatest(F.lit(0.0), rest)) * F.signum(helper)))


def recovered_by_gradient(df: DataFrame, lost: str, others: Sequence[str], *, width: int | None = None) -> DataFrame:
    """W13 without a helper: the whole channel anew, from the magnitude s that the others leave. Its sign turns at rows whose s fell
    and does not fall after them, and where |d' - (s + s_next)| < |d' - d|, with d the step into the row and d' the one before
    it (0 for the first row). The sign of the first row is positive; from each such row on it is the other one. By this rule a
    smooth run through zero is not turned: it takes a row before the least one that rose."""
    rest = F.lit(1.0)
    for c in others:
        rest = rest - F.col(c) * F.col(c)
    x = scan(df.withColumn("_s", F.sqrt(F.greatest(F.lit(0.0), rest))), {"_b": before(F.col("_s")), "_a": after(F.col("_s"))}, width=width, keep_slices=True)
    x = x.withColumn("_d", F.coalesce(F.col("_s") - F.col("_b"), F.lit(0.0)))
    x = scan(x, {"_d0": before(F.col("_d"))}, width=width, keep_slices=True)
    turned = (F.col("_d") < 0) & (F.col("_a") >= F.col("_s")) & (F.abs(F.col("_d0") - (F.col("_s") + F.col("_a"))) < F.abs(F.col("_d0") - F.col("_d")))
    x = scan(x, {"_n": total(F.when(turned, 1).otherwise(0))}, width=width)
    return x.withColumn(lost, F.when(F.col("_n") % 2 == 1, -F.col("_s")).otherwise(F.col("_s"))).select(*dict.fromkeys([*df.columns, lost]))


def last_stored(df: DataFrame) -> DataFrame:
    """K5: of rows with one time, the one stored last."""
    w = Window.partitionBy("probe", "t").orderBy(F.col("seq").desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
