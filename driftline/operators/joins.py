"""Joins on time, place and coefficients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DAY
from .scan import last, scan, upcoming


def coefficients(stores: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """The first store (lowest priority number) that has the probe; overrides win field by field;
    date is the latest of both."""
    first = Window.partitionBy("probe").orderBy("priority")
    found = stores.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn", "priority")
    if overrides is None:
        return found
    fields = [c for c in found.columns if c != "probe"]
    over = overrides.select("probe", *[F.col(c).alias(f"_{c}") for c in overrides.columns if c != "probe"])
    joined = found.join(over, "probe", "left")
    pick = {c: F.greatest(c, f"_{c}") if c == "date" else F.coalesce(F.col(f"_{c}"), F.col(c)) for c in fields if f"_{c}" in joined.columns}
    return joined.withColumns(pick).select("probe", *fields)


def neighbours(queries: DataFrame, data: DataFrame, value: str, *, width: int | None = None) -> DataFrame:
    """For each query the data rows before (or at) and after (or at) it, by one scan of both sides in slices of time.

    queries(probe, qid, t), data(probe, t, value). No pairs; a row per slice and probe goes into one task.
    """
    both = data.select("probe", "t", F.struct(F.col("t").alias("t"), F.col(value).alias("v")).alias("_r"), F.lit(None).cast("long").alias("qid")).unionByName(
        queries.select("probe", "t", F.lit(None).cast(f"struct<t:bigint,v:{dict(data.dtypes)[value]}>").alias("_r"), F.col("qid").cast("long").alias("qid")))
    # At one time data come before queries, so the row at a query's own time is before it; it is the one after it as well.
    both = both.withColumn("_q", F.col("qid").isNotNull().cast("int"))
    seen = scan(both, {"_b": last(F.col("_r")), "_a": upcoming(F.col("_r"))}, ("t", "_q"), width).where("qid is not null")
    seen = seen.withColumn("_a", F.when(F.col("_b.t") == F.col("t"), F.col("_b")).otherwise(F.col("_a")))
    return seen.select("probe", "qid", "t", F.col("_b.t").alias("before_t"), F.col("_b.v").alias("before_v"), F.col("_a.t").alias("after_t"), F.col("_a.v").alias("after_v"))


def _use_before() -> Column:
    return F.col("after_t").isNull() | ((F.col("before_t").isNotNull()) & (F.col("t") - F.col("before_t") < F.col("after_t") - F.col("t")))


def nearest(queries: DataFrame, data: DataFrame, value: str, *, width: int | None = None) -> DataFrame:
    """The nearest row; the one before only if strictly closer; ends take what there is."""
    n, use = neighbours(queries, data, value, width=width), _use_before()
    return n.select("probe", "qid", "t", F.when(use, F.col("before_t")).otherwise(F.col("after_t")).alias("found_t"), F.when(use, F.col("before_v")).otherwise(F.col("after_v")).alias("found_v"))


def points(queries: DataFrame, data: DataFrame, value: str, tolerance: int = 1_000_000, *, width: int | None = None) -> DataFrame:
    """Nearest values; if any query of a probe is farther than tolerance, all its queries are interpolated."""
    n, use = neighbours(queries, data, value, width=width), _use_before()
    n = n.withColumns({"found_t": F.when(use, F.col("before_t")).otherwise(F.col("after_t")), "found_v": F.when(use, F.col("before_v")).otherwise(F.col("after_v"))})
    far = n.groupBy("probe").agg(F.max(F.abs(F.col("found_t") - F.col("t")) > tolerance).alias("_far"))
    span = F.col("after_t") - F.col("before_t")
    line = F.when(span > 0, F.col("before_v") + (F.col("after_v") - F.col("before_v")) * ((F.col("t") - F.col("before_t")) / span)).otherwise(F.coalesce("before_v", "after_v"))
    return n.join(far, "probe").select("probe", "qid", "t", F.when(F.col("_far"), F.coalesce(line, "before_v", "after_v")).otherwise(F.col("found_v")).alias("value"), F.col("_far").alias("interpolated"))


def time_difference(found: DataFrame, tolerance: int = 1_000_000) -> DataFrame:
    """J5."""
    return found.withColumn("dt", F.col("found_t") - F.col("t")).withColumn("off", F.abs("dt") > tolerance)


def within_intervals(data: DataFrame, intervals: DataFrame, slot: int = DAY) -> DataFrame:
    """Rows of each interval [t_start, t_end]. Both sides are cut into time slots, so the join is an
    equality on (probe, slot) that partitions and skews like any other, with a filter."""
    cut = intervals.withColumn("_slot", F.explode(F.sequence(F.floor(F.col("t_start") / slot), F.floor(F.col("t_end") / slot))))
    rows = data.withColumn("_slot", F.floor(F.col("t") / slot))
    return rows.join(cut, ["probe", "_slot"]).where("t >= t_start and t <= t_end").drop("_slot")


def overlapping(log: DataFrame, t_start: int, t_end: int) -> DataFrame:
    """Log rows that meet a loaded range."""
    return log.where((F.col("t_start") <= t_end) & (F.col("t_end") > t_start))


def intersections(a: DataFrame, b: DataFrame, slot: int = DAY) -> DataFrame:
    """Common parts of the ranges of two tables, per probe. Both are cut into time slots, as in J6; a pair counts in the
    slot in which its common part begins, so it counts once."""

    def cut(x: DataFrame) -> DataFrame:
        return x.withColumn("_slot", F.explode(F.sequence(F.floor(F.col("_s") / slot), F.floor(F.col("_e") / slot))))

    x = cut(a.select("probe", F.col("t_start").alias("_s"), F.col("t_end").alias("_e")).where("_s <= _e"))
    y = cut(b.select("probe", F.col("t_start").alias("_s"), F.col("t_end").alias("_e")).where("_s <= _e")).withColumnsRenamed({"_s": "_s2", "_e": "_e2"})
    both = x.join(y, ["probe", "_slot"]).select("probe", "_slot", F.greatest("_s", "_s2").alias("t_start"), F.least("_e", "_e2").alias("t_end"))
    return both.where((F.col("t_start") <= F.col("t_end")) & (F.floor(F.col("t_start") / slot) == F.col("_slot"))).drop("_slot")


def wide(df: DataFrame, probes: list[str], columns: list[str], key: str = "t") -> DataFrame:
    """All probes side by side on time, columns {col}_{probe}; a probe list saves a pass for the pivot."""
    piv = df.groupBy(key).pivot("probe", probes).agg(*[F.first(c, True).alias(c) for c in columns])
    if len(columns) == 1:
        return piv.select(key, *[F.col(p).alias(f"{columns[0]}_{p}") for p in probes])
    return piv.select(key, *[F.col(f"{p}_{c}").alias(f"{c}_{p}") for p in probes for c in columns])


def nearest_node(points_: DataFrame, nodes: DataFrame, cell: float = 1.0) -> DataFrame:
    """The node of each point with the smallest squared distance, smallest id on ties.

    Nodes lie in square cells, each level's 4 x 4 to a cell of the level above. A point goes down from the
    whole extent by equalities on cells and leaves those whose nodes are all farther than the farthest node
    of another, so it meets few nodes, however far it lies from them. Levels are added until a cell has at
    most 64 places or is smaller than `cell`. Only the extent and two counts go to the driver. Points
    without a place (NULL, NaN) get NULL; nodes without one are left out.
    """
    placed = lambda x, y: F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    plain = points_.drop("node", "d2")
    at = nodes.select(F.col("x").cast("double").alias("_nx"), F.col("y").cast("double").alias("_ny"), F.col("node").cast("long").alias("node"))
    at = at.where(placed("_nx", "_ny")).groupBy("_nx", "_ny").agg(F.min("node").alias("node"))
    e = at.agg(F.min("_nx").alias("x0"), F.max("_nx").alias("x1"), F.min("_ny").alias("y0"), F.max("_ny").alias("y1"), F.count(F.lit(1)).alias("n")).first()
    if not e["n"]:
        return plain.withColumn("node", F.lit(None).cast("long")).withColumn("d2", F.lit(None).cast("double"))
    side = max(e["x1"] - e["x0"], e["y1"] - e["y0"]) or 1.0

    def cells(steps: int) -> DataFrame:
        k = lambda v, low: F.least(F.floor((F.col(v) - low) / side * 4.0**steps), F.lit(4**steps - 1)).cast("long")
        return at.withColumn("_cx", k("_nx", e["x0"])).withColumn("_cy", k("_ny", e["y0"]))

    steps = 1
    while steps < 12 and side / 4**steps > cell and (steps == 1 or e["n"] > 64 * 16**steps or cells(steps).groupBy("_cx", "_cy").count().agg(F.max("count")).first()[0] > 64):
        steps += 1
    fine = cells(steps)
    found = plain.select(F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y")).where(placed("_x", "_y")).distinct()
    found = found.withColumn("_px", F.lit(0).cast("long")).withColumn("_py", F.lit(0).cast("long"))
    for step in range(1, steps + 1):
        up = 2 * (steps - step)
        level = fine.groupBy(F.shiftright("_cx", up).alias("_kx"), F.shiftright("_cy", up).alias("_ky")).agg(F.min("_nx").alias("_x0"), F.max("_nx").alias("_x1"), F.min("_ny").alias("_y0"), F.max("_ny").alias("_y1"))
        level = level.withColumn("_px", F.shiftright("_kx", 2)).withColumn("_py", F.shiftright("_ky", 2))
        met = found.join(F.broadcast(level) if step <= 3 else level, ["_px", "_py"])
        # Differences, squares and sums round monotonically, so the bounds hold for the rounded distances too.
        near = lambda v, a, b: F.greatest(F.col(a) - F.col(v), F.col(v) - F.col(b), F.lit(0.0))
        far = lambda v, a, b: F.greatest(F.col(v) - F.col(a), F.col(b) - F.col(v))
        low = near("_x", "_x0", "_x1") * near("_x", "_x0", "_x1") + near("_y", "_y0", "_y1") * near("_y", "_y0", "_y1")
        high = far("_x", "_x0", "_x1") * far("_x", "_x0", "_x1") + far("_y", "_y0", "_y1") * far("_y", "_y0", "_y1")
        bound = met.select("_x", "_y", "_kx", "_ky", low.alias("_low"), F.min(high).over(Window.partitionBy("_x", "_y")).alias("_high"))
        found = bound.where("_low <= _high").select("_x", "_y", F.col("_kx").alias("_px"), F.col("_ky").alias("_py"))
    met = found.join(fine.withColumnsRenamed({"_cx": "_px", "_cy": "_py"}), ["_px", "_py"])
    d2 = (F.col("_nx") - F.col("_x")) * (F.col("_nx") - F.col("_x")) + (F.col("_ny") - F.col("_y")) * (F.col("_ny") - F.col("_y"))
    best = met.groupBy("_x", "_y").agg(F.min(F.struct(d2.alias("d2"), "node")).alias("_b")).select("_x", "_y", "_b.node", "_b.d2")
    return plain.join(best, (F.col("x").cast("double") == F.col("_x")) & (F.col("y").cast("double") == F.col("_y")), "left").drop("_x", "_y")
