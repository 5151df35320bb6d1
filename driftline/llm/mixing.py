"""Mixing sources to target weights.

Rows get hash-random keys. Within a source, rows are cut into equal ranges of that key (their
number is near the square root of all rows, so neither a range nor the list of ranges of one source
grows large), sorted within each range, and word counts are summed by a two-level prefix sum: over
the ranges of a source, then inside each range. A row is taken for as many whole passes as its
source's budget holds, and the last pass is cut at the exact budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, n_words

#: Weights of the sources by code point, repeating.
WEIGHTS = (5.0, 2.0, 1.0)


def _ranked(sizes: DataFrame) -> DataFrame:
    """sizes with rank, from 0 by source, null last: ranges of sources first, then places in a range."""
    ranges = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    # Written once, so that a range stays what it is.
    ranges = materialise(ranges, "sources")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return ranges.withColumn("place", place).join(offsets, "part").select(*sizes.columns, (F.col("offset") + F.col("place") - 1).alias("rank"))


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> the same with target: level x weight, or most x source_size where that is less.

    The level starts where the weights alone share all. Each pass settles the sources that are full at the level and
    raises it by what they leave to the others; it ends when no more are full. A pass is one aggregate over the sources.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(_ranked(sizes).select("source", "source_size", weight.alias("weight")), "weights")
    cap = most * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, None
    while True:
        over = cap <= F.lit(level) * F.col("weight")
        row = ranked.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if row[0] == full or not row[2]:
            break
        full, level = row[0], (share * total - row[1]) / row[2]
    target = F.when(F.lit(row[2] == 0), cap).otherwise(F.least(cap, F.lit(level) * F.col("weight")))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _mixed(docs: DataFrame, keep: list[str], size: Column | None, seed: int, options: dict) -> DataFrame:
    """(row, size, source_size, target, taken): row has the columns to keep, so their names cannot clash with others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Rows with one id are ordered by their texts; rows without id get the text's key.
    content = F.xxhash64(text, F.lit(seed))
    key = F.when(F.col("doc_id").isNull(), content).otherwise(F.xxhash64("doc_id", F.lit(seed)))
    sized = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col("source"), (n_words(F.col("text")) if size is None else size.cast("long")).alias("size"), key.alias("key"), content.alias("content"))
    count = docs.count()
    ranges = max(1, math.isqrt(count))
    unit = F.shiftrightunsigned("key", 11).cast("double") / float(1 << 53)
    cut = sized.withColumn("range", F.floor(unit * ranges).cast("long")).withColumn("unit", unit)
    per_range = materialise(cut.groupBy("source", "range").agg(F.sum("size").alias("held")), "ranges")
    # Ranges are few; the same aggregate serves the sources' sizes and the offsets of the ranges.
    per_source = targets(per_range.groupBy("source").agg(F.sum("held").alias("source_size")), **options)
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.withColumn("offset", F.coalesce(F.sum("held").over(ahead), F.lit(0)))
    s, o = per_source.alias("s"), offsets.alias("o")
    budget = o.join(s, F.col("o.source").eqNullSafe(F.col("s.source"))).select(F.col("o.source").alias("of"), F.col("o.range").alias("at"), "offset", "source_size", "target")
    inside = Window.partitionBy("source", "range").orderBy("unit", "key", "size", "content").rowsBetween(Window.unboundedPreceding, -1)
    run = cut.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = run.join(budget, run["source"].eqNullSafe(budget["of"]) & (run["range"] == budget["at"]))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target")).cast("long") - passes * F.col("source_size")
    last = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("offset") - F.col("before")))
    return joined.select("row", "size", "source_size", "target", (passes * F.col("size") + last).cast("long").alias("taken"))


def mix(docs: DataFrame, *, size: Column | None = None, seed: int = 42, **options) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words of the row in the mix, repeats counted) of each row of docs.

    size defaults to the number of words. Null texts have size 0 and are never taken; null sources
    form one source that comes last. Rows with one id are ordered by size and text, rows without id by their texts; equal
    rows are alike, so reruns give the same rows. Other columns of docs are ignored, whatever their names. An empty table
    gives an empty result.
    """
    return _mixed(docs, ["doc_id", "source"], size, seed, options).select("row.doc_id", "row.source", "size", "source_size", "target", "taken")


def apply_mix(docs: DataFrame, *, size: Column | None = None, seed: int = 42, **options) -> DataFrame:
    """The mix as rows with the columns of docs, under any names: a row for each whole pass over a document, and one
    with its first words where the budget cuts its last pass. n_chars follows a cut text."""
    mixed = _mixed(docs, docs.columns, size, seed, options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    cut = F.when(F.col("size") > 0, F.col("taken") - whole * F.col("size")).otherwise(0).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(cut > 0, F.array(cut)).otherwise(F.array().cast("array<int>")))
    rows = mixed.select("row", F.explode(copies).alias("cut"))
    # A cut text ends with its last taken word; the white space before and between words stays.
    words = F.regexp_extract_all(F.col("row.text"), F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1))
    text = F.when(F.col("cut") > 0, F.array_join(F.slice(words, 1, F.greatest(F.col("cut"), F.lit(1))), "")).otherwise(F.col("row.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("cut") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
