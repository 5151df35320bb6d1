"""Stored tables: sinks, load logs, merges and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import DAY, SECOND, timestamp
from ..scratch import kept_table
from .joins import within_intervals

DIGITS = {"Vdir": 4, "inclination": 4, "Pressure": 3}
WIDTHS = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3, "float": 4, "double": 5}


def formatted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K1, the columns: whole-second time (rounded up) as text, rounded values."""
    whole = F.ceil(F.col("t") / SECOND) * SECOND
    return df.select("probe", F.date_format(timestamp(whole), "yyyy-MM-dd HH:mm:ss").alias("Time"), *[F.round(c, DIGITS[c]).alias(c) if c in DIGITS else F.col(c) for c in columns])


def write_tsv(df: DataFrame, path: str, columns: Sequence[str], bin_s: int) -> None:
    """K1: text by probe and day; one file for each, named by Spark inside probe=/day= folders."""
    out = formatted(df.withColumn("_day", F.floor(F.col("t") / DAY)), columns).withColumn("day", F.substring("Time", 1, 10)).withColumn("bin_s", F.lit(bin_s))
    out.repartition("probe", "day").sortWithinPartitions("Time").write.mode("overwrite").partitionBy("bin_s", "probe", "day").option("sep", "\t").option("header", True).csv(path)


def log_rows(df: DataFrame, file: str | Column, changed: int, processed: int) -> DataFrame:
    """K2: a load-log row per probe."""
    return df.groupBy("probe").agg(F.min("t").alias("t_start"), F.max("t").alias("t_end"), F.count(F.lit(1)).alias("rows")).select("probe", "t_start", "t_end", "rows", (F.lit(file) if isinstance(file, str) else file).alias("file"), F.lit(changed).cast("long").alias("changed"), F.lit(processed).cast("long").alias("processed"))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("probe").parquet(path)


def separators(df: DataFrame, freq: float, columns: Sequence[str]) -> DataFrame:
    """K3: a row of NULLs half a step after each probe's end."""
    ends = df.groupBy("probe").agg((F.max("t") + int(SECOND / freq / 2)).alias("t"), (F.max("seq") + 1).alias("seq"))
    return df.unionByName(ends.select("probe", "t", "seq", *[F.lit(None).cast(dict(df.dtypes)[c]).alias(c) for c in columns]), allowMissingColumns=True)


def aligned_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """K4: union with missing columns added (0 for whole numbers, empty text, NULL else) and unequal
    number types widened."""
    x, y = dict(a.dtypes), dict(b.dtypes)

    def fit(df: DataFrame, own: dict, other: dict) -> DataFrame:
        out = {}
        for c, kind in {**own, **other}.items():
            to = max((own.get(c, kind), other.get(c, kind)), key=lambda k: WIDTHS.get(k, -1))
            if c in own:
                out[c] = F.col(c).cast(to)
            else:
                blank = F.lit(0) if to in ("tinyint", "smallint", "int", "bigint") else F.lit("") if to == "string" else F.lit(None)
                out[c] = blank.cast(to)
        return df.select(*[v.alias(c) for c, v in out.items()])

    first, second = fit(a, x, y), fit(b, y, x)
    return first.unionByName(second)


def sorted_store(df: DataFrame, path: str) -> None:
    """K6: rewritten in order of (probe, time), packed."""
    df.repartitionByRange("probe", "t").sortWithinPartitions("probe", "t").write.mode("overwrite").option("compression", "zstd").parquet(path)


def removed_from(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """K7: rows at or after their probe's cut go; probes without a cut stay."""
    return df.join(cuts.select("probe", F.col("t_cut")), "probe", "left").where("t_cut is null or t < t_cut").drop("t_cut")


def shortened_log(log: DataFrame, cuts: DataFrame) -> DataFrame:
    """K7: log rows from the cut on go, the one that holds it ends there."""
    x = log.join(cuts.select("probe", "t_cut"), "probe", "left").where("t_cut is null or t_start < t_cut")
    return x.withColumn("t_end", F.coalesce(F.least("t_end", "t_cut"), "t_end")).drop("t_cut")


def new_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """K8: files that the log does not have with that change time or a later one."""
    seen = log.select(F.col("probe").alias("_p"), F.col("file").alias("_f"), F.col("changed").alias("_c"))
    return files.join(seen, (F.col("probe") == F.col("_p")) & (F.col("file") == F.col("_f")) & (F.col("changed") <= F.col("_c")), "left_anti")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """K9: old rows before their probe's first new time, then the new ones."""
    start = new.groupBy("probe").agg(F.min("t").alias("_t0"))
    return old.join(start, "probe", "left").where("_t0 is null or t < _t0").drop("_t0").unionByName(new, allowMissingColumns=True)


def last_delivery(old: DataFrame, new: DataFrame) -> DataFrame:
    """K9, the seam: the stored rows that stay before new ones. Those from the probe's first new time on go. Where the store has
    that time more than once, it was delivered more than once: only the rows between the last two of them, by their place (seq), stay.
    A probe without new rows stays whole."""
    start = new.groupBy("probe").agg(F.min("t").alias("_t0"))
    x = old.join(start, "probe", "left")
    at = F.when(F.col("t") == F.col("_t0"), F.col("seq"))
    final = x.groupBy("probe").agg(F.max(at).alias("_last"))
    x = x.join(final, "probe", "left")
    again = x.groupBy("probe").agg(F.max(F.when(F.col("seq") < F.col("_last"), at)).alias("_again"))
    x = x.join(again, "probe", "left")
    inside = F.col("_again").isNull() | F.col("seq").between(F.col("_again") + 1, F.col("_last") - 1)
    return x.where(F.col("_t0").isNull() | ((F.col("t") < F.col("_t0")) & inside)).select(*old.columns)


def merged_log(old: DataFrame, new: DataFrame) -> DataFrame:
    """K9, the log: of rows of a probe with one start the first stays: an old one, else the first of a table by its file's change time."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    w = Window.partitionBy("probe", "t_start").orderBy("_new", "changed", "t_end")
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_new")


def merge_into(path: str, new: DataFrame) -> DataFrame:
    """K9: new rows into a store in partitions by probe and day; gives the partitions that were rewritten (probe, day, rows; 0: left empty).

    From the seam's day on a probe's partitions are rewritten by dynamic overwrite (those that lose all rows keep an empty file's
    place by one row that is marked and never read: `dead`). Days before the seam are touched only where a repeated delivery is cut.
    """
    spark = new.sparkSession
    old = spark.read.parquet(path).where(~F.col("dead")).drop("dead")
    day = F.floor(F.col("t") / DAY).cast("long")
    new = kept_table(new.withColumn("day", day))
    stays = last_delivery(old, new)
    before = old.groupBy("probe", "day").agg(F.count(F.lit(1)).alias("_n"))
    after = stays.groupBy("probe", "day").agg(F.count(F.lit(1)).alias("_m"))
    fewer = before.join(after, ["probe", "day"], "left").where("_m is null or _m < _n").select("probe", "day")
    touched = kept_table(fewer.union(new.select("probe", "day")).distinct())
    rows = stays.join(touched, ["probe", "day"], "left_semi").unionByName(new.select(*old.columns)).withColumn("dead", F.lit(False))
    rows = kept_table(rows)
    counts = touched.join(rows.groupBy("probe", "day").agg(F.count(F.lit(1)).alias("rows")), ["probe", "day"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    empty = counts.where("rows = 0").select("probe", "day", F.lit(True).alias("dead"))
    full = rows.unionByName(empty, allowMissingColumns=True)
    write_days(full, path)
    return counts


def write_days(rows: DataFrame, path: str) -> None:
    """Rows (probe, day, dead, ...) to partitions by probe and day; those that rows have take the place of old ones."""
    rows.repartition("probe", "day").sortWithinPartitions("probe", "day", "t", "seq").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("probe", "day").parquet(path)


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    """The rows of such a store."""
    return spark.read.parquet(path).where(~F.col("dead")).drop("dead", "day")


def merged_runs(log: DataFrame, group: str) -> DataFrame:
    """Log rows of a run group as one: start of the first, end of the last, rows summed."""
    return log.groupBy("probe", group).agg(F.min("t_start").alias("t_start"), F.max_by("t_end", "t_start").alias("t_end"), F.sum("rows").alias("rows"))


def staged(spark: SparkSession, path: str, wanted: DataFrame, log: DataFrame, make) -> DataFrame:
    """A stage's table; only what K8 finds new is made and appended."""
    todo = new_files(wanted, log)
    if not todo.isEmpty():
        append(make(todo), path)
    return spark.read.parquet(path)


def upserted(old: DataFrame, new: DataFrame, fields: Sequence[str], stamp: int) -> DataFrame:
    """New finite values replace stored ones; a field's date is stamped only where the value changed."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col("o.probe") == F.col("n.probe"), "full")
    out = [F.coalesce("o.probe", "n.probe").alias("probe")]
    for f in fields:
        v = F.col(f"n.{f}")
        if dict(new.dtypes)[f] in ("double", "float"):
            v = F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)
        changed = v.isNotNull() & ~v.eqNullSafe(F.col(f"o.{f}"))
        out += [F.coalesce(v, F.col(f"o.{f}")).alias(f), F.when(changed, F.lit(stamp).cast("long")).otherwise(F.col(f"o.{f}_date")).alias(f"{f}_date")]
    return joined.select(*out)


def stored_range(df: DataFrame, t_start: int, t_end: int, columns: Sequence[str]) -> DataFrame:
    """Pushed to the Parquet scan."""
    return df.where(F.col("t").between(t_start, t_end)).select(*columns)


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges [t_start, t_end] of each probe with those that meet joined up."""
    w = Window.partitionBy("probe").orderBy("t_start", "t_end")
    far = F.max("t_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    numbered = ranges.withColumn("_far", far).withColumn("_g", F.sum(F.when(F.col("t_start") <= F.col("_far"), 0).otherwise(1)).over(w))
    return numbered.groupBy("probe", "_g").agg(F.min("t_start").alias("t_start"), F.max("t_end").alias("t_end")).drop("_g")


def stored_ranges(df: DataFrame, ranges: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in the union of their probe's ranges, each once: ranges that meet are one before the join."""
    return within_intervals(df, merged_ranges(ranges)).select(*columns)


def logged_between(log: DataFrame, t_start: int | None = None, t_end: int | None = None) -> DataFrame:
    """Log rows as intervals, those that meet [t_start, t_end], cut to it; no limit where None. Pushed to the Parquet scan."""
    x = log if t_start is None else log.where(F.col("t_end") >= t_start).withColumn("t_start", F.greatest("t_start", F.lit(t_start)))
    return x if t_end is None else x.where(F.col("t_start") <= t_end).withColumn("t_end", F.least("t_end", F.lit(t_end)))


def unions_by_columns(parts: Sequence[DataFrame]) -> list[DataFrame]:
    """Parts with the same set of columns as one table, in the order in which the sets first occur."""
    found: dict[frozenset[str], DataFrame] = {}
    for part in parts:
        key = frozenset(part.columns)
        found[key] = found[key].unionByName(part) if key in found else part
    return list(found.values())


def tables_like(probes: DataFrame, pattern: str) -> DataFrame:
    """By substring, or by regular expression where the pattern has a *."""
    hit = F.col("probe").rlike(pattern) if "*" in pattern else F.col("probe").contains(pattern)
    return probes.select("probe").where(hit).distinct()


def day_positions(df: DataFrame, days: int) -> DataFrame:
    """For each N-day mark of a probe, the number of earlier rows: counts per mark, then a running sum."""
    size = days * DAY
    first = df.groupBy("probe").agg((F.floor(F.min("t") / DAY) * DAY).alias("_d0"), F.max("t").alias("_t1"))
    counts = df.join(first, "probe").groupBy("probe", F.floor((F.col("t") - F.col("_d0")) / size).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    marks = first.select("probe", "_d0", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_t1") - F.col("_d0")) / size))).alias("k"))
    w = Window.partitionBy("probe").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return marks.join(counts, ["probe", "k"], "left").select("probe", (F.col("_d0") + F.col("k") * size).alias("t"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("row"))

