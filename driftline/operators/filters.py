"""Row and cell filters."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DAY
from .scan import after, before, position, scan


def _column(df: DataFrame, name: str) -> str | None:
    if name.lower() in ("date", "time"):
        return "t"
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def rows_within(df: DataFrame, low: dict[str, float] | None = None, high: dict[str, float] | None = None) -> DataFrame:
    """rows strictly inside all limits; a NULL is outside; limits of unknown columns are ignored."""
    tests = [F.col(c) > v for k, v in (low or {}).items() if (c := _column(df, k))] + [F.col(c) < v for k, v in (high or {}).items() if (c := _column(df, k))]
    return df.where(reduce(Column.__and__, tests)) if tests else df


def cells_within(df: DataFrame, low: dict[str, float] | None = None, high: dict[str, float] | None = None, inclusive: bool = False) -> DataFrame:
    """values outside limits become NULL. Keys with * or [ are patterns over column names."""
    tests: dict[str, list[Column]] = {}
    for limits, upper in ((low or {}, False), (high or {}, True)):
        for key, value in limits.items():
            names = [c for c in df.columns if re.fullmatch(key, c)] if re.search(r"[*\[]", key) else [c for c in (_column(df, key),) if c]
            for c in names:
                x = F.col(c)
                tests.setdefault(c, []).append((x <= value if inclusive else x < value) if upper else (x >= value if inclusive else x > value))
    return df.withColumns({c: F.when(reduce(Column.__and__, t), F.col(c)) for c, t in tests.items()})


def mask_ranges(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """good = t in one of its probe's [t_start, t_end], both ends inclusive; a NULL end is open.

    Ranges are cut to their probe's span and dealt to its days, so a row looks at the ranges of its own day alone and a
    long probe is many keys of the join.
    """
    span = df.groupBy("probe").agg(F.min("t").alias("_t0"), F.max("t").alias("_t1"))
    cut = ranges.join(span, "probe").select("probe", F.greatest("t_start", "_t0").alias("s"), F.least(F.coalesce("t_end", "_t1"), "_t1").alias("e"), F.col("t_start").alias("_given"))
    day = lambda c: F.floor(F.col(c) / DAY)
    dealt = cut.where("_given is not null and s <= e").withColumn("_day", F.explode(F.sequence(day("s"), day("e"))))
    own = dealt.groupBy("probe", "_day").agg(F.collect_set(F.struct(F.greatest("s", F.col("_day") * DAY).alias("s"), F.least("e", (F.col("_day") + 1) * DAY).alias("e"))).alias("_ranges"))
    inside = F.exists("_ranges", lambda r: F.col("t").between(r["s"], r["e"]))
    return df.withColumn("_day", day("t")).join(own, ["probe", "_day"], "left").withColumn("good", F.coalesce(inside, F.lit(False))).select(*df.columns, "good")


def clip_ranges(ranges: DataFrame, t_min: int | None, t_max: int | None) -> DataFrame:
    """ranges cut to [t_min, t_max]; empty ones go."""
    start = F.greatest("t_start", F.lit(t_min).cast("long")) if t_min is not None else F.col("t_start")
    end = F.least("t_end", F.lit(t_max).cast("long")) if t_max is not None else F.col("t_end")
    return ranges.withColumns({"t_start": start, "t_end": end}).where("t_end is null or t_start <= t_end")


def with_parameters(df: DataFrame, own: DataFrame, common: dict[str, object]) -> DataFrame:
    """a probe's parameters, else the common ones. One row per probe; Spark broadcasts it when small."""
    names = [c for c in own.columns if c != "probe"]
    joined = df.join(own, "probe", "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(common.get(n))) for n in names}).withColumns({n: F.lit(v) for n, v in common.items() if n not in names})


def moving(df: DataFrame, column: str, noise: float = 0.0) -> DataFrame:
    """works = the value moves by more than noise to the next row, or between stride starts of 16 or
    32 rows in either following block; all true where over 10 % of the steps are NULL."""
    x = scan(df, {"_i": position(), "_before": before(F.col(column)), "_after": after(F.col(column))}).withColumn("_d", F.col(column) - F.col("_before"))
    share = x.groupBy("probe").agg((F.count_if((F.col("_i") > 0) & F.col("_d").isNull()) / F.count(F.lit(1))).alias("_share"))
    # A step belongs to the row before it; the first row repeats the first step.
    step = F.coalesce(F.when(F.col("_i") == 0, F.col("_after") - F.col(column)).otherwise(F.col("_d")), F.lit(0.0))
    out = x.withColumn("_own", F.abs(step) > noise).withColumn("_p", F.greatest(F.col("_i") - 1, F.lit(0)))
    for stride in (16, 32):
        starts = x.where(F.col("_i") % stride == 0).select("probe", (F.col("_i") / stride).cast("long").alias("_b"), F.col(column).alias("_v"), "t", "seq")
        starts = scan(starts, {"_next": after(F.col("_v"))})
        jump = F.abs(F.col("_next") - F.col("_v")) > noise
        blocks = starts.select("probe", "_b", F.coalesce(jump, F.lit(False)).alias(f"_j{stride}"))
        out = out.withColumn("_b", F.floor(F.col("_p") / stride)).join(blocks, ["probe", "_b"], "left").drop("_b")
    works = F.col("_own") | F.coalesce("_j16", F.lit(False)) | F.coalesce("_j32", F.lit(False))
    return out.join(share, "probe").withColumn("works", (F.col("_share") > 0.1) | works).select(*df.columns, "works")


def too_frequent(df: DataFrame, column: str, percent: float = 0.5) -> DataFrame:
    """F8: frequent = the value makes more than percent of its probe's rows. Counted by aggregation."""
    values = df.groupBy("probe", column).agg(F.count(F.lit(1)).alias("_n"))
    totals = values.groupBy("probe").agg(F.sum("_n").alias("_all"))
    bad = values.join(totals, "probe").where(F.col("_n") * 100.0 / F.col("_all") > percent).select(F.col("probe").alias("_p"), F.col(column).alias("_v"))
    return df.join(bad, (df["probe"] == bad["_p"]) & df[column].eqNullSafe(bad["_v"]), "left").withColumn("frequent", F.col("_p").isNotNull()).drop("_p", "_v")


def gate(df: DataFrame, column: str = "inclination", low: float = 10.0, high: float = 170.0) -> DataFrame:
    """rows whose inclination suits a direction."""
    return df.where((F.col(column) > low) & (F.col(column) < high))
