"""Ordered scans over long series: slices and carries instead of one window per probe.

A window over (probe; order) puts a whole probe into one task. Here a probe's rows are cut into slices of the ordering
column (hours of time, or thousands of source rows), each of which is a partition of its own. What a row needs from
other slices is small: the last value before the slice, the sum up to it, the next value after it. One summary row per slice
has what its rows give to others; a scan over the summaries makes one carry row per slice, which is joined back. So
a probe is as many tasks as it has slices, and only summaries, thousands of times fewer, meet in one task.

Windows that reach a bounded number of rows (rolling means, filters) take a slice with a halo: rows near its borders are copied
into the neighbouring slices by their position.

A table that one task reads in about a second gains nothing by this and has the plain window: `is_small` asks Spark for
the size of what it reads. What comes out is the same, so the choice is one of speed only; a width that is given always slices.

probe is never NULL. Rows of one order value are in one slice and, as in any window, in no given order. A NULL
order value comes first. A slice holds what its stretch holds: one time with very many rows is one slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schema import SECOND
from ..scratch import kept_table

#: A slice is so long: six hours of time, or so many source rows or positions.
SLICE_TIME, SLICE_ROWS = 6 * 3600 * SECOND, 1 << 11
SLICE = "_slice"
#: Tables that read less are one slice; the session may set another number, 0 for slices at every size.
SMALL_BYTES, SMALL_CONF = 32 << 20, "driftline.scan.smallBytes"
_FIRST_SLICE = -(1 << 62)


def is_small(df: DataFrame, most: int = SMALL_BYTES) -> bool:
    """Whether all that df reads (files, by their size; anything else is taken for large) is under the limit, or under `most` where that is less."""
    limit = min(most, int(df.sparkSession.conf.get(SMALL_CONF, str(SMALL_BYTES))))
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return limit > 0 and sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())) < limit


def kept_if_large(df: DataFrame) -> DataFrame:
    """Written down where scans will read it in slices, and so more than once."""
    return df if is_small(df) else kept_table(df)


@dataclass(frozen=True)
class Carried:
    """What a row gets from the rows before (or after) it."""

    kind: str
    value: Column
    own: bool = True  # whether the row itself counts


def last(value: Column, own: bool = True) -> Carried:
    """The last value that is not NULL, up to the row (own) or before it."""
    return Carried("last", value, own)


def upcoming(value: Column, own: bool = True) -> Carried:
    """The next value that is not NULL, from the row on (own) or after it."""
    return Carried("upcoming", value, own)


def before(value: Column) -> Carried:
    """The row before's value, NULL or not."""
    return Carried("before", value, False)


def after(value: Column) -> Carried:
    """The row after's value, NULL or not."""
    return Carried("after", value, False)


def total(value: Column, own: bool = True) -> Carried:
    """The sum up to the row (own) or before it; NULL where no value came yet."""
    return Carried("total", value, own)


def highest(value: Column, own: bool = True) -> Carried:
    """The largest value up to the row (own) or before it."""
    return Carried("highest", value, own)


def lowest_from(value: Column, own: bool = True) -> Carried:
    """The smallest value from the row on (own) or after it."""
    return Carried("lowest_from", value, own)


def position() -> Carried:
    """The row's number in the probe, from 0."""
    return Carried("position", F.lit(1).cast("long"), False)


def in_slices(df: DataFrame, by: Sequence[str] = ("t", "seq"), width: int | None = None) -> DataFrame:
    """df with the slice of each row; one that is there is kept, so that scans in a row share their partitions."""
    if SLICE in df.columns:
        return df
    width = width or (SLICE_TIME if by[0] == "t" else SLICE_ROWS)
    return df.withColumn(SLICE, F.coalesce(F.floor(F.col(by[0]) / F.lit(width)).cast("long"), F.lit(_FIRST_SLICE)))


def _orders(keys: Sequence[str], by: Sequence[str]) -> tuple[WindowSpec, WindowSpec]:
    """Forwards, and the same order backwards: a frame that ends at UNBOUNDED FOLLOWING is rebuilt for every row."""
    w = Window.partitionBy(*keys)
    return w.orderBy(*by), w.orderBy(*[F.col(c).desc() for c in by])


_SO_FAR, _EARLIER = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)


def _local(c: Carried, v: Column, forth: WindowSpec, back: WindowSpec) -> Column:
    frame = _SO_FAR if c.own else _EARLIER
    match c.kind:
        case "last":
            return F.last(v, True).over(forth.rowsBetween(*frame))
        case "upcoming":
            return F.last(v, True).over(back.rowsBetween(*frame))
        case "before":
            return F.lag(F.struct(v.alias("v"))).over(forth)
        case "after":
            return F.lead(F.struct(v.alias("v"))).over(forth)
        case "total" | "position":
            return F.sum(v).over(forth.rowsBetween(*frame))
        case "highest":
            return F.max(v).over(forth.rowsBetween(*frame))
        case "lowest_from":
            return F.min(v).over(back.rowsBetween(*frame))
    raise ValueError(c.kind)


def _summary(c: Carried, v: Column, place: Column) -> Column:
    """What a slice gives to others, by aggregation."""
    at = F.struct(place.alias("at"), v.alias("v"))
    match c.kind:
        case "last":
            return F.max(F.when(v.isNotNull(), at))["v"]
        case "upcoming":
            return F.min(F.when(v.isNotNull(), at))["v"]
        case "before":
            return F.struct(F.max(at)["v"].alias("v"))
        case "after":
            return F.struct(F.min(at)["v"].alias("v"))
        case "total" | "position":
            return F.sum(v)
        case "highest":
            return F.max(v)
    return F.min(v)


def _carry(c: Carried, s: Column, forth: WindowSpec, back: WindowSpec) -> Column:
    """The same over the summaries of the slices before (or after) a slice."""
    match c.kind:
        case "last":
            return F.last(s, True).over(forth.rowsBetween(*_EARLIER))
        case "upcoming":
            return F.last(s, True).over(back.rowsBetween(*_EARLIER))
        case "before":
            return F.lag(s).over(forth)
        case "after":
            return F.lead(s).over(forth)
        case "total" | "position":
            return F.sum(s).over(forth.rowsBetween(*_EARLIER))
        case "highest":
            return F.max(s).over(forth.rowsBetween(*_EARLIER))
    return F.min(s).over(back.rowsBetween(*_EARLIER))


def _both(c: Carried, own: Column, carried: Column) -> Column:
    match c.kind:
        case "last" | "upcoming":
            return F.coalesce(own, carried)
        case "before" | "after":
            return F.coalesce(own, carried)["v"]
        case "total":
            return F.coalesce(own + carried, own, carried)
        case "position":
            return F.coalesce(own, F.lit(0)) + F.coalesce(carried, F.lit(0))
        case "highest":
            return F.greatest(own, carried)
    return F.least(own, carried)


def with_facts(df: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """df with what is known of its probe; facts: a row per probe, so few that every task has them. A shuffled join would put a probe's
    rows into one task, and the windows and aggregates behind it would leave them there; Spark by itself shuffles where the facts' few
    probes leave most partitions empty."""
    return df.join(F.broadcast(facts), "probe", how)


def scan(df: DataFrame, want: dict[str, Carried], by: Sequence[str] = ("t", "seq"), width: int | None = None, keep_slices: bool = False) -> DataFrame:
    """df with the wanted columns, each what a window over (probe; by) would give."""
    if width is None and SLICE not in df.columns and is_small(df):
        return _whole(df, want, by)
    x = in_slices(df, by, width).withColumns({f"_v_{n}": c.value for n, c in want.items()})
    keys = ["probe", SLICE]
    place = F.struct(*by)
    forth, back = _orders(keys, by)
    summed = x.groupBy(*keys).agg(*[_summary(c, F.col(f"_v_{n}"), place).alias(f"_c_{n}") for n, c in want.items()])
    over, under = _orders(["probe"], [SLICE])
    carries = summed.select(*keys, *[_carry(c, F.col(f"_c_{n}"), over, under).alias(f"_c_{n}") for n, c in want.items()])
    x = x.withColumns({f"_l_{n}": _local(c, F.col(f"_v_{n}"), forth, back) for n, c in want.items()})
    joined = x.join(carries, keys, "left")
    out = {n: _both(c, F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n, c in want.items()}
    kept = [c for c in df.columns if c not in out] + ([SLICE] if keep_slices and SLICE not in df.columns else [])
    return joined.select(*kept, *[v.alias(n) for n, v in out.items()])


def _whole(df: DataFrame, want: dict[str, Carried], by: Sequence[str]) -> DataFrame:
    """scan() with a window per probe."""
    forth, back = _orders(["probe"], by)
    x = df.withColumns({f"_v_{n}": c.value for n, c in want.items()}).withColumns({f"_l_{n}": _local(c, F.col(f"_v_{n}"), forth, back) for n, c in want.items()})
    out = {n: F.coalesce(F.col(f"_l_{n}"), F.lit(0)) if c.kind == "position" else F.col(f"_l_{n}")["v"] if c.kind in ("before", "after") else F.col(f"_l_{n}") for n, c in want.items()}
    return x.select(*[c for c in df.columns if c not in out], *[v.alias(n) for n, v in out.items()])


@dataclass(frozen=True)
class Haloed:
    """Rows in slices of positions, with copies of their neighbours. rows: has _i (position in the probe) and _own (no copy)."""

    rows: DataFrame
    forth: WindowSpec
    whole: WindowSpec

    def done(self, rows: DataFrame) -> DataFrame:
        """Without the copies and the columns of the halo."""
        return rows.where("_own").drop("_i", "_own", SLICE)


def haloed(df: DataFrame, reach: int, by: Sequence[str] = ("t", "seq"), rows: int | None = None) -> Haloed:
    """Each row in the slice of its position and in those that it lies within `reach` rows of."""
    whole = Window.partitionBy("probe", SLICE)
    if rows is None and is_small(df):
        x = scan(df, {"_i": position()}, by).withColumns({SLICE: F.lit(0), "_own": F.lit(True)})
        return Haloed(x, Window.partitionBy("probe").orderBy("_i"), Window.partitionBy("probe"))
    rows = max(rows or SLICE_ROWS, reach + 1)
    x = scan(df, {"_i": position()}, by)
    near = F.array_distinct(F.array(*[F.floor((F.col("_i") + k) / rows).cast("long") for k in (-reach, 0, reach)]))
    x = x.withColumn(SLICE, F.explode(F.filter(near, lambda s: s >= 0))).withColumn("_own", F.col(SLICE) == F.floor(F.col("_i") / rows))
    return Haloed(x, whole.orderBy("_i"), whole)
