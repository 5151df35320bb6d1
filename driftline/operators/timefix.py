"""Time correction (T1-T15; T1 composes the others). Rows are scanned in slices by source order or by time (scan.py);
T3 and T7 go through Python where a step depends on all before it, T3 in blocks of rows that are in order."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DAY, SECOND, ordered, timestamp
from .aggregates import medians
from .scan import after, before, haloed, highest, kept_if_large, last, position, scan, total, upcoming, with_facts

#: Order of the source.
SOURCE = ("seq",)


def sampling_frequency(df: DataFrame, *, precision: int = 0, width: int | None = None) -> DataFrame:
    """Rows per second of each probe by source order, and the numbers of equal and of decreasing steps.

    1. Where a probe has decreasing steps, rows that stand out alone are left out: above or below both neighbours, a
       missing neighbour counting as either. A row before a step that still falls is not counted.
    2. A step upwards has the rows from it to the next one (from the last one: to the end) over its length as frequency.
    3. Packets: a step longer than the mean one by 10^precision s, and the steps beside it, take no part.
    4. The mean of the frequencies within three deviations of the median, of all where that leaves fewer than two;
       rounded to as many digits as it has whole ones after the first, at least `precision`. What would round to 0 is not rounded.

    Rows without a time are ignored; a probe without a step upwards, or with packets only, has NULL.
    """
    x = scan(df.where("t is not null").select("probe", "seq", "t"), {"_b": before(F.col("t")), "_a": after(F.col("t"))}, SOURCE, width, keep_slices=True)
    t, b, a = F.col("t"), F.col("_b"), F.col("_a")
    steps = x.groupBy("probe").agg(F.count_if(b == t).alias("equal"), F.count_if(t < b).alias("decreasing"))
    peak = (b.isNull() | (b < t)) & (a.isNull() | (a < t))
    pit = (b.isNull() | (b > t)) & (a.isNull() | (a > t))
    left = kept_if_large(with_facts(x, steps.where("decreasing > 0").select("probe", F.lit(True).alias("_falls")), "left").where(F.col("_falls").isNull() | ~(peak | pit)).select("probe", "seq", "t"))
    x = scan(left, {"_b": before(t)}, SOURCE, width, keep_slices=True).withColumn("_step", t - b)
    x = kept_if_large(scan(x, {"_rows": total(F.when(F.col("_step") >= 0, 1).otherwise(0))}, SOURCE, width).select("probe", "seq", "_step", "_rows"))
    up = F.when(F.col("_step") > 0, F.col("_step"))
    # The end of the series closes the last run, as a step of no length.
    whole = x.groupBy("probe").agg((F.max("_rows") + 1).alias("_end"), (F.sum(up) / (F.count(up) + 1) + SECOND * 10.0**precision).alias("_long"))
    ups = with_facts(scan(x.where("_step > 0"), {"_next": after(F.struct("_rows", "_step")), "_prev": before(F.col("_step"))}, SOURCE, width), whole)
    short = lambda c: F.coalesce(F.col(c) < F.col("_long"), F.lit(True))
    rate = ups.where(short("_step") & short("_prev") & short("_next._step")).select("probe", ((F.coalesce("_next._rows", "_end") - F.col("_rows")) * SECOND / F.col("_step")).alias("f"))
    mid = with_facts(medians(rate, "f"), rate.groupBy("probe").agg(F.stddev_pop("f").alias("_s")))
    good = F.when(F.abs(F.col("f") - F.col("median")) < 3 * F.col("_s"), F.col("f"))
    fs = with_facts(rate, mid).groupBy("probe").agg(F.when(F.count(good) > 1, F.avg(good)).otherwise(F.avg("f")).alias("_f"))
    digits = F.greatest(F.lit(precision), F.log10("_f").cast("int"))
    scale = F.pow(F.lit(10.0), digits)
    near = F.rint(F.col("_f") * scale) / scale
    return with_facts(steps, fs.select("probe", F.when(near == 0, F.col("_f")).otherwise(near).alias("fs")), "left").select("probe", "fs", "equal", "decreasing")


def heaviest_increasing(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mask of an increasing subsequence of distinct values with the largest sum of weights. Only values that end a
    heavier subsequence than all smaller ones do are held, in order."""
    tops: list[int] = []
    sums: list[int] = []
    at: list[int] = []
    back = np.full(len(values), -1, np.int64)
    for i, (v, w) in enumerate(zip(values.tolist(), weights.tolist())):
        p = bisect_left(tops, v)
        if p:
            back[i], w = at[p - 1], w + sums[p - 1]
        end = p
        while end < len(tops) and sums[end] <= w:
            end += 1
        tops[p:end], sums[p:end], at[p:end] = [v], [w], [i]
    keep = np.zeros(len(values), bool)
    i = at[-1] if at else -1
    while i >= 0:
        keep[i] = True
        i = back[i]
    return keep


def blocks_in_order(df: DataFrame, *, width: int | None = None) -> DataFrame:
    """The blocks of T3: rows that follow each other both by seq and by (t, seq). A row per block: probe, _part, seq of its first
    row, _rank (that row's place by time), _n rows. Where all blocks before have all the smaller places, a new _part begins."""
    places = scan(df.where("t is not null").select("probe", "seq", "t"), {"_rank": position()}, width=None if width is None else min(width * SECOND, 1 << 60))
    places = kept_if_large(places)
    x = scan(places, {"_i": position(), "_b": before(F.col("_rank"))}, SOURCE, width)
    starts = kept_if_large(x.where(F.col("_b").isNull() | (F.col("_rank") != F.col("_b") + 1)).select("probe", "seq", "_i", "_rank"))
    rows = places.groupBy("probe").agg(F.count(F.lit(1)).alias("_all"))
    blocks = with_facts(scan(starts, {"_next": after(F.col("_i"))}, SOURCE, width), rows).withColumn("_n", F.coalesce("_next", "_all") - F.col("_i"))
    blocks = scan(blocks, {"_top": highest(F.col("_rank") + F.col("_n") - 1, own=False)}, SOURCE, width, keep_slices=True)
    blocks = scan(blocks.withColumn("_cut", F.when(F.coalesce(F.col("_top") < F.col("_i"), F.lit(True)), 1).otherwise(0)), {"_part": total(F.col("_cut"))}, SOURCE, width)
    return blocks.select("probe", "_part", "seq", "_rank", "_n")


def without_inversions(df: DataFrame, *, width: int | None = None) -> DataFrame:
    """ok = the row is in a longest non-decreasing subsequence of times by source order. A row without a time is not ok.

    A row has a place by (t, seq) as well as by seq, so the series is a permutation, and a longest subsequence an increasing
    one. One that has a row of a block can have the whole block, so what is searched are blocks weighted by their rows: about three
    for each disturbance, however long the series is and however far a time is off. Parts go to Python one by one, a
    single block not at all. A part is one task's work, in blocks.
    """

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        keep = heaviest_increasing(pdf["_rank"].to_numpy(), pdf["_n"].to_numpy())
        return pd.DataFrame({"probe": pdf["probe"], "seq": pdf["seq"], "_keep": keep})

    several = F.count(F.lit(1)).over(Window.partitionBy("probe", "_part"))
    sized = blocks_in_order(df, width=width).withColumn("_size", several)
    judged = sized.where("_size > 1").groupBy("probe", "_part").applyInPandas(judge, "probe string, seq long, _keep boolean")
    # A block's first row has the answer; the rows behind it carry it on.
    first = sized.where("_size = 1").select("probe", "seq", F.lit(True).alias("_keep")).unionByName(judged)
    marked = scan(df.join(first, ["probe", "seq"], "left"), {"_ok": last(F.col("_keep"))}, SOURCE, width)
    return marked.select(*df.columns, (F.col("t").isNotNull() & F.coalesce("_ok", F.lit(False))).alias("ok"))


def spread_repeats(df: DataFrame, freq: float | Column, *, width: int | None = None) -> DataFrame:
    """T4: rows with one time are spread by 1/freq from the first; closer where the run would pass the next time."""
    x = scan(df, {"_b": before(F.struct("t")), "_i": position()}, SOURCE, width, keep_slices=True)
    start = F.when(F.col("_b").isNull() | F.coalesce(F.col("_b.t") != F.col("t"), F.lit(False)), F.struct("_i", "t"))
    x = scan(x.withColumn("_start", start), {"_own": last(F.col("_start")), "_next": upcoming(F.col("_start"), own=False)}, SOURCE, width)
    step = F.least(F.lit(SECOND / freq), (F.col("_next.t") - F.col("t")) / (F.col("_next._i") - F.col("_own._i")))
    moved = (F.col("t") + F.floor((F.col("_i") - F.col("_own._i")) * F.coalesce(step, F.lit(SECOND / freq)))).cast("long")
    return x.withColumn("t", moved).select(*df.columns)


def day_jumps(df: DataFrame, *, width: int | None = None) -> DataFrame:
    """T5: steps of a day, up or down (within ten median steps, at least ten seconds), bound stretches that are
    a day off: between the first and second jump, the third and fourth, and so on. A stretch moves
    against its first jump."""
    d = scan(df, {"_b": before(F.col("t"))}, SOURCE, width, keep_slices=True).withColumn("_d", F.col("t") - F.col("_b"))
    mid = medians(d, "_d").select("probe", (F.greatest("median", F.lit(float(SECOND))) * 10).alias("_tol"))
    j = with_facts(d, mid, "left").withColumn("_tol", F.coalesce("_tol", F.lit(10.0 * SECOND)))
    up = (F.col("_d") > DAY - F.col("_tol")) & (F.col("_d") <= DAY + F.col("_tol"))
    down = (F.col("_d") < -DAY + F.col("_tol")) & (F.col("_d") >= -DAY - F.col("_tol"))
    j = j.withColumn("_j", F.when(up, 1).when(down, -1))
    # Inside a stretch the latest jump is the one it began with.
    j = scan(j, {"_n": total(F.abs("_j")), "_sign": last(F.col("_j"))}, SOURCE, width)
    return j.withColumn("t", F.when(F.col("_n") % 2 == 1, F.col("t") - F.col("_sign") * DAY).otherwise(F.col("t"))).select(*df.columns)


def linear_between_holes(df: DataFrame, freq: float | Column, hole: int = 20 * SECOND, *, width: int | None = None) -> DataFrame:
    """Between holes longer than `hole`, steps of 1/freq from the first time, in three cases by where they end:
    nearer than two holes to the real end, they are the times; short of it (rows were lost), only rows whose
    time does not grow are moved, by steps after the last row that does; beyond it, the steps are made shorter,
    so that rows that repeat the first or the last time do not count."""
    h = scan(df, {"_b": before(F.col("t")), "_i": position()}, width=width, keep_slices=True)
    h = h.withColumns({"_new": F.col("_b").isNull() | (F.col("t") - F.col("_b") > hole), "_up": F.coalesce((F.col("t") > F.col("_b")) & (F.col("t") - F.col("_b") <= hole), F.lit(False))})
    # A stretch is known at its first row: where it starts, and what came before it, which is the end of the one before.
    up = F.when(F.col("_up"), F.col("_i"))
    ends = h.groupBy("probe").agg(F.count(F.lit(1)).alias("_rows"), F.max("t").alias("_t1"), F.max(up).alias("_all_ups"))
    h = scan(h, {"_ups": last(up, own=False), "_next_up": upcoming(up, own=False)}, width=width, keep_slices=True)
    start = F.when(F.col("_new"), F.struct("_i", "t", "_b", "_ups", "_next_up"))
    h = scan(h.withColumn("_start", start), {"_own": last(F.col("_start")), "_then": upcoming(F.col("_start"), own=False), "_kept_i": last(up)}, width=width)
    h = with_facts(h, ends)
    s0, k0 = F.col("_own.t"), F.col("_own._i")
    h = h.withColumns({"_k": F.col("_i") - k0, "_n": F.coalesce("_then._i", "_rows") - k0, "_s": s0, "_e": F.coalesce("_then._b", "_t1"), "_kept": F.greatest(F.coalesce(F.col("_kept_i") - k0, F.lit(0)), F.lit(0)),
                       "_first": F.col("_own._next_up") - k0, "_last": F.when(F.col("_then").isNull(), F.col("_all_ups")).otherwise(F.col("_then._ups")) - k0})
    some = (F.col("_first") < F.col("_n")) & (F.col("_last") > 0)  # rows that grow are inside the stretch
    h = h.withColumns({"_first": F.when(some, F.col("_first")), "_last": F.when(some, F.col("_last"))})
    ideal = SECOND / (F.lit(freq) if not isinstance(freq, Column) else freq)
    error = F.col("_e") - F.col("_s") - (F.col("_n") - 1) * ideal
    shorter = (F.col("_e") - F.col("_s")) / F.coalesce(F.col("_last") - F.col("_first") + 1, F.greatest(F.col("_n") - 1, F.lit(1)))
    near, lost = F.abs(error) < 2 * hole, error > 0
    start = F.when(near | ~lost, F.col("_s")).otherwise(F.col("t"))
    steps = F.when(near, F.col("_k") * ideal).when(lost, (F.col("_k") - F.col("_kept")) * ideal).otherwise(F.col("_k") * shorter)
    return h.withColumn("t", (start + F.floor(steps + 0.5)).cast("long")).select(*df.columns)


def _follow(t: np.ndarray, step: float, accuracy: int, base: float, k: int, block: int = 1 << 12) -> tuple[np.ndarray, float, int]:
    """Times t on a line base + k step that steps to the real time wherever it is off by more than accuracy; the base and k of
    the row after the last. Looked at in blocks, so a step costs a block and not the rest of the series."""
    out, i = np.empty(len(t)), 0
    while i < len(t):
        part = t[i : i + block]
        line = base + (k + np.arange(len(part))) * step
        off = np.flatnonzero(np.abs(line - part) > accuracy)
        end = int(off[0]) if len(off) else len(part)
        out[i : i + end] = line[:end]
        i, k = i + end, k + end
        if len(off):
            base, k = float(t[i]), 1
            out[i] = base
            i += 1
    return out, base, k


def linear_with_shifts(df: DataFrame, freq: float, accuracy: int) -> DataFrame:
    """An ideal line that steps to the real time wherever it is off by more than accuracy. Each step depends on the one before,
    so a (probe, burst) group is walked in order; rows carry burst.

    The rows come sorted, a batch at a time, and only the line (base, rows since) is carried from batch to batch: memory does not grow
    with the group. Groups are dealt by (probe, burst); one group is one task's work, a few numpy operations for a block.
    """
    step = SECOND / freq
    at = df.columns.index("t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, base, k = None, 0.0, 0
        for b in batches:
            probe, burst = b.column("probe").to_pylist(), b.column("burst").to_pylist()
            t = b.column("t").to_numpy(zero_copy_only=False)
            out, keys = np.empty(len(t), np.int64), list(zip(probe, burst))
            i = 0
            while i < len(keys):
                end = i + 1
                while end < len(keys) and keys[end] == keys[i]:
                    end += 1
                if keys[i] != group:
                    group, base, k = keys[i], float(t[i]), 0
                moved, base, k = _follow(t[i:end], step, accuracy, base, k)
                out[i:end] = np.rint(moved)
                i = end
            yield b.set_column(at, "t", pa.array(out))

    return df.repartition("probe", "burst").sortWithinPartitions("probe", "burst", "t", "seq").mapInArrow(run, df.schema)


def filled_times(df: DataFrame, bad: str, freq: float | Column, *, width: int | None = None) -> DataFrame:
    """Bad times by interpolation over rows; at the ends by steps of 1/freq."""
    x = scan(df, {"_i": position()}, SOURCE, width, keep_slices=True).withColumn("_g", F.when(~F.col(bad), F.struct("_i", "t")))
    x = scan(x, {"_p": last(F.col("_g")), "_n": upcoming(F.col("_g"))}, SOURCE, width)
    inner = F.col("_p.t") + (F.col("_n.t") - F.col("_p.t")) * ((F.col("_i") - F.col("_p._i")) / F.nullif(F.col("_n._i") - F.col("_p._i"), F.lit(0)))
    tail = F.coalesce(F.col("_p.t") + (F.col("_i") - F.col("_p._i")) * SECOND / freq, F.col("_n.t") - (F.col("_n._i") - F.col("_i")) * SECOND / freq)
    return x.withColumn("t", F.when(~F.col(bad), F.col("t")).otherwise(F.floor(F.coalesce(inner, tail) + 0.5).cast("long"))).select(*df.columns)


def shifted(df: DataFrame, shifts: DataFrame) -> DataFrame:
    """T - shift of the probe (microseconds ahead of UTC); probes without one stay."""
    return with_facts(df, shifts.select("probe", F.col("shift").alias("_s")), "left").withColumn("t", F.col("t") - F.coalesce(F.col("_s"), F.lit(0))).drop("_s")


def drift_removed(df: DataFrame, true_ends: DataFrame) -> DataFrame:
    """Times stretched so that a probe's last raw time meets its true end."""
    span = df.groupBy("probe").agg(F.min("t").alias("_a"), F.max("t").alias("_b")).join(true_ends.select("probe", F.col("t_end").alias("_c")), "probe")
    ratio = (F.col("_c") - F.col("_a")) / F.nullif(F.col("_b") - F.col("_a"), F.lit(0))
    return with_facts(df, span).withColumn("t", (F.col("_a") + F.floor((F.col("t") - F.col("_a")) * F.coalesce(ratio, F.lit(1.0)) + 0.5)).cast("long")).drop("_a", "_b", "_c")


def equal_spacing(df: DataFrame, *, width: int | None = None) -> DataFrame:
    """T10, by row number: equal steps from a probe's first to its last time."""
    ends = df.groupBy("probe").agg(F.count(F.lit(1)).alias("_n"), F.min("t").alias("_a"), F.max("t").alias("_b"))
    x = with_facts(scan(df, {"_k": position()}, width=width), ends)
    return x.withColumn("t", (F.col("_a") + F.floor((F.col("_b") - F.col("_a")) * F.col("_k") / F.greatest(F.col("_n") - 1, F.lit(1)) + 0.5)).cast("long")).select(*df.columns)


def regular_grid(df: DataFrame, step: int, column: str, *, width: int | None = None) -> DataFrame:
    """The column on a regular grid from a probe's first time, by linear interpolation.

    Each row fills the grid points up to the next row, so nothing is joined and a probe's grid is
    made where its rows are.
    """
    known = df.where(F.col(column).isNotNull())
    x = scan(known, {"_next": after(F.struct(F.col("t").alias("t"), F.col(column).alias("y")))}, width=width)
    x = with_facts(x, known.groupBy("probe").agg(F.min("t").alias("_t0"))).withColumns({"_t2": F.col("_next.t"), "_y2": F.col("_next.y")})
    first = F.ceil((F.col("t") - F.col("_t0")) / step)
    last_ = F.when(F.col("_t2").isNull(), F.floor((F.col("t") - F.col("_t0")) / step)).otherwise(F.ceil((F.col("_t2") - F.col("_t0")) / step) - 1)
    g = x.withColumns({"_f": first, "_l": last_}).where("_f <= _l").withColumn("_k", F.explode(F.sequence("_f", "_l")))
    at = F.col("_t0") + F.col("_k") * step
    y = F.when(F.col("_t2").isNull() | (at == F.col("t")), F.col(column)).otherwise(F.col(column) + (F.col("_y2") - F.col(column)) * ((at - F.col("t")) / (F.col("_t2") - F.col("t"))))
    return g.select("probe", at.alias("t"), y.alias(column))


def monotone_slopes(df: DataFrame, column: str, *, rows: int | None = None) -> DataFrame:
    """Slope of each row by the monotone cubic rule: 0 where the steps on both sides turn, else their harmonic mean
    weighted by the distances; one-sided and limited at the ends. Rows have distinct times. Adds _h (to the next
    row), _y2, _m and _m2 (the next row's slope). rows: of a slice; a row depends on three on either side."""
    halo = haloed(df, 4, rows=rows)
    w = halo.forth
    x = halo.rows.withColumns({"_h": (F.lead("t").over(w) - F.col("t")).cast("double"), "_y2": F.lead(column).over(w)})
    x = x.withColumn("_d", (F.col("_y2") - F.col(column)) / F.col("_h"))
    near = {"_hb": F.lag("_h"), "_db": F.lag("_d"), "_ha": F.lead("_h"), "_da": F.lead("_d"), "_hc": F.lag("_h", 2), "_dc": F.lag("_d", 2)}
    x = x.withColumns({n: c.over(w) for n, c in near.items()})
    h, d, hb, db = (F.col(c) for c in ("_h", "_d", "_hb", "_db"))
    # try_divide: a branch that is not taken may have nothing to divide by.
    inner = F.when(d * db <= 0, 0.0).otherwise(F.try_divide(3 * (h + hb), F.try_divide(2 * h + hb, db) + F.try_divide(h + 2 * hb, d)))

    def end(h0: Column, d0: Column, h1: Column, d1: Column) -> Column:
        s = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
        return F.when(d1.isNull(), d0).when(F.signum(s) != F.signum(d0), 0.0).when((F.signum(d0) != F.signum(d1)) & (F.abs(s) > 3 * F.abs(d0)), 3 * d0).otherwise(s)

    first, last_ = end(h, d, F.col("_ha"), F.col("_da")), end(hb, db, F.col("_hc"), F.col("_dc"))
    m = F.when(db.isNull(), first).when(d.isNull(), last_).otherwise(inner)
    x = x.withColumn("_m", m).drop("_d", *near)
    return halo.done(x.withColumn("_m2", F.lead("_m").over(w)))


def monotone_grid(df: DataFrame, step: int, column: str, *, width: int | None = None, rows: int | None = None) -> DataFrame:
    """T11 by monotone cubics (PCHIP): the column on a regular grid from a probe's first time. Of rows of one time the
    last in order counts, as in regular_grid()."""
    x = scan(df.where(F.col(column).isNotNull()).select("probe", "t", "seq", F.col(column).cast("double").alias(column)), {"_next": after(F.col("t"))}, width=width)
    x = x.where("_next is null or _next > t").drop("_next")
    x = with_facts(monotone_slopes(x, column, rows=rows), x.groupBy("probe").agg(F.min("t").alias("_t0")))
    first = F.ceil((F.col("t") - F.col("_t0")) / step)
    last_ = F.when(F.col("_h").isNull(), F.floor((F.col("t") - F.col("_t0")) / step)).otherwise(F.ceil((F.col("t") + F.col("_h") - F.col("_t0")) / step) - 1)
    g = x.withColumns({"_f": first.cast("long"), "_l": last_.cast("long")}).where("_f <= _l").withColumn("_k", F.explode(F.sequence("_f", "_l")))
    g = g.withColumn("_at", F.col("_t0") + F.col("_k") * step).withColumn("_u", (F.col("_at") - F.col("t")) / F.col("_h"))
    u, h, y, y2 = (F.col(c) for c in ("_u", "_h", column, "_y2"))
    # Written from y on, so that a flat stretch stays exactly flat.
    cubic = y + (y2 - y) * u * u * (3 - 2 * u) + h * u * (1 - u) * ((1 - u) * F.col("_m") - u * F.col("_m2"))
    return g.select("probe", F.col("_at").alias("t"), F.when(h.isNull() | (u == 0), y).otherwise(cubic).alias(column))


def period_intervals(spans: DataFrame, period: int) -> DataFrame:
    """[t_start, t_end] split by a period; borders at midnight where it is a day or more."""
    origin = F.floor(F.col("t_start") / DAY) * DAY if period >= DAY else F.col("t_start")
    x = spans.withColumn("_o", origin)
    starts = F.sequence("_o", "t_end", F.lit(period))
    x = x.withColumn("_s", F.explode(starts))
    return x.select("probe", F.greatest("_s", "t_start").alias("t_start"), F.least(F.col("_s") + period, F.col("t_end")).alias("t_end")).where("t_start < t_end")


def sliding_starts(df: DataFrame, length: int, overlap: float) -> DataFrame:
    """Each row in every window [start, start + length) that holds it; windows step by length * (1 - overlap)
    from the midnight of the epoch."""
    hop = int(length * (1 - overlap))
    first = F.floor((F.col("t") - length) / hop) + 1
    return df.withColumn("w_start", F.explode(F.transform(F.sequence(first, F.floor(F.col("t") / hop)), lambda k: k * hop)))


def shifted_from(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """T9, by pairs (probe, t_from, t_to): rows from t_from on, up to the probe's next t_from, move by t_to - t_from."""
    nxt = F.lead("t_from").over(Window.partitionBy("probe").orderBy("t_from"))
    spans = pairs.select("probe", "t_from", F.coalesce(nxt, F.lit((1 << 63) - 1)).alias("_until"), (F.col("t_to") - F.col("t_from")).alias("_by"))
    near = (F.col("d.probe") == F.col("p.probe")) & (F.col("d.t") >= F.col("p.t_from")) & (F.col("d.t") < F.col("p._until"))
    # A few pairs a probe: the join's equality is the probe.
    joined = df.alias("d").join(spans.alias("p"), near, "left")
    return joined.select(*[(F.col("d.t") + F.coalesce("p._by", F.lit(0))).alias("t") if c == "t" else F.col(f"d.{c}") for c in df.columns])


def at_offset(t: Column, offset_s: float) -> Column:
    """A UTC time as it reads at a fixed offset."""
    return timestamp(t + F.lit(int(offset_s * SECOND)))


def middle(a: Column, b: Column) -> Column:
    """Mean of two times in whole seconds, as microseconds."""
    return F.floor((F.floor(a / SECOND) + F.floor(b / SECOND)) / 2).cast("long") * SECOND


def apart(a: Column, b: Column) -> Column:
    """A - b in whole seconds."""
    return (F.floor(a / SECOND) - F.floor(b / SECOND)).cast("long")


def corrected_times(
    df: DataFrame, *, mode: str = "increase", fs: float | None = None, shift: int = 0, t_min: int | None = None, t_max: int | None = None,
    accuracy: int | None = None, hole: int = 1_500_000, most_error: int = 1_500_000,
) -> DataFrame:
    """Df with corrected t and ok (the row's time grows), by source order.

    1. Times are shifted to UTC (T9). Those beyond t_min or t_max become that limit, with ok false, and take no part.
    2. mode "none" ends here. Else NULL times and those outside a longest non-decreasing run (T3) are interpolated (T8); with
       "delete_inversions" the latter are not ok.
    3. With fs, rows of one time are spread by 1/fs (T4), or the series follows a line that steps where it is off by more than
       accuracy (T7). Without, probes faster than 1 Hz by T2 become linear between holes (T6), but for
       rows that would move by more than most_error.
    4. Times that still do not grow are interpolated (T8).
    """
    x = df.withColumn("t", F.col("t") - shift)
    low = F.coalesce(F.col("t") < t_min, F.lit(False)) if t_min is not None else F.lit(False)
    high = F.coalesce(F.col("t") > t_max, F.lit(False)) if t_max is not None else F.lit(False)
    outside = x.where(low | high).withColumn("t", F.when(low, F.lit(t_min)).otherwise(F.lit(t_max)).cast("long")).withColumn("ok", F.lit(False))
    x = x.where(~(low | high))
    if mode == "none":
        return x.withColumn("ok", F.lit(True)).unionByName(outside)
    judged = without_inversions(x.where("t is not null")).select("probe", "seq", F.col("ok").alias("_run"))
    rate = sampling_frequency(x, precision=6).select("probe", F.coalesce(F.lit(fs), F.col("fs"), F.lit(1.0)).alias("_fs"))
    x = with_facts(x.join(judged, ["probe", "seq"], "left"), rate, "left").withColumn("_fs", F.coalesce("_fs", F.lit(float(fs or 1))))
    # Each step scans what the one before gave more than once, so the steps' tables are written down.
    x = kept_if_large(x)
    # A NULL time is no inversion: it has no _run.
    x = filled_times(x.withColumn("_bad", F.col("t").isNull() | ~F.coalesce("_run", F.lit(False))), "_bad", F.col("_fs"))
    dropped = F.coalesce(~F.col("_run"), F.lit(False)) & F.lit(mode == "delete_inversions")
    x = kept_if_large(x.withColumn("_dropped", dropped).drop("_bad", "_run"))
    if fs and accuracy:
        x = linear_with_shifts(x.withColumn("burst", F.lit(0)), fs, accuracy).drop("burst")
    elif fs:
        x = spread_repeats(x, fs)
    else:
        line = linear_between_holes(x.withColumn("_before", F.col("t")), F.col("_fs"), hole)
        x = line.withColumn("t", F.when((F.col("_fs") > 1) & (F.abs(F.col("t") - F.col("_before")) <= most_error), F.col("t")).otherwise(F.col("_before"))).drop("_before")
    x = scan(kept_if_large(x), {"_top": highest(F.col("t"), own=False)}, SOURCE)
    x = filled_times(x.withColumn("_same", F.coalesce(F.col("t") <= F.col("_top"), F.lit(False))), "_same", F.col("_fs"))
    x = scan(x, {"_b": before(F.col("t"))}, SOURCE)
    ok = F.coalesce(F.col("t") > F.col("_b"), F.lit(True)) & ~F.col("_dropped")
    return x.withColumn("ok", ok).select(*df.columns, "ok").unionByName(outside)
