"""Exact dedup by a content sort, in DataFrame functions only.

Sampled splitters over the first characters of the normalised text deal the rows into ranges; an external
sort by the whole text's bytes places equal texts next to each other, and the window over the sorted run compares each
text with its neighbour in full. Its groups are final: equal texts have equal first characters, so no group goes
over a range's border.

Only where more rows than a range should hold have the same first characters, the splitters also see a salt of the id. A
group is then cut into runs of bounded size; the runs, a row each, are sorted and compared with their neighbours once more, and
what came out goes back to the rows of each run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, materialise

#: Characters of a text that the splitters see.
HEAD = 64
#: Rows with the same first characters up to which they stay in one range.
RUN_ROWS = 20_000
#: Heads with more rows that are sent to every task; beyond that they are joined by a shuffle.
SENT_HEADS = 100_000


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", run_rows: int = RUN_ROWS) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. keep says
    whether the largest or the smallest id of equal texts stays. Null ids: they count in group_size
    and stay only where no other id is in the group (keep_id null). Repeated rows with the staying id
    are all marked kept by this table; apply_exact_dedup leaves one. An empty table gives an empty result.
    Other columns of docs are ignored.
    """
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm")).withColumn("head", F.substring("norm", 1, HEAD))
    counted = rows.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > run_rows)
    hot = materialise(counted.select(F.col("head").alias("hot_head"), F.ceil(F.col("n") / run_rows).cast("int").alias("salts")), "heads")
    heads = hot.count()
    if not heads:
        return _groups(rows.withColumn("salt", F.lit(None).cast("int")), keep).select(*_RESULT)
    salted = rows.join(F.broadcast(hot) if heads <= SENT_HEADS else hot, rows["head"] == hot["hot_head"], "left")
    runs = _groups(salted.select("doc_id", "norm", "head", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int").alias("salt")), keep)
    runs = materialise(runs, "runs")
    pieces = runs.where("piece is not null").select("text_sha256", "piece", "salt", F.col("keep_id").alias("best"), F.col("group_size").alias("n"))
    whole = Window.partitionBy("text_sha256", "piece")
    least_or_most = F.max if keep == "max" else F.min
    merged = pieces.repartitionByRange("text_sha256").select(
        F.col("text_sha256").alias("sha"), F.col("salt").alias("part"), least_or_most("best").over(whole).alias("best"), F.sum("n").over(whole).alias("total")
    )
    cut = runs.where("salt is not null")
    joined = cut.join(merged, (cut["text_sha256"] == merged["sha"]) & (cut["salt"] == merged["part"]))
    back = joined.select("doc_id", F.col("best").alias("keep_id"), F.col("total").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("best")).alias("kept"), "text_sha256")
    return runs.where("salt is null").select(*_RESULT).unionByName(back)


_RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _groups(rows: DataFrame, keep: str) -> DataFrame:
    """The result's columns for the rows (doc_id, norm, head, salt) by their neighbours in the sorted runs; the
    first row of a run that a salt cut off has the run's text as piece."""
    order = F.col("doc_id").desc_nulls_last() if keep == "max" else F.col("doc_id").asc_nulls_last()
    equal = Window.partitionBy("head", "salt", "norm")
    place, whole = equal.orderBy(order), equal.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = rows.repartitionByRange("head", "salt").select(
        "doc_id", "salt", "norm", F.row_number().over(place).alias("place"), F.first("doc_id").over(whole).alias("keep_id"), F.count(F.lit(1)).over(whole).alias("group_size")
    )
    piece = F.when(F.col("salt").isNotNull() & (F.col("place") == 1), F.col("norm"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return compared.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "salt", piece.alias("piece"))


def apply_exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, with their columns under any names. Of repeated rows with the staying id one stays."""

    # One key for the join and for repeated rows, so that the texts are shuffled once for both.
    def key(doc_id: Column, sha: Column) -> Column:
        return F.concat_ws(":", sha, doc_id.cast("long").cast("string"))

    name = free_name(docs.columns, "_key")
    sha = F.sha2(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary"), 256)
    staying = exact_dedup(docs, **options).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias(name)).distinct()
    return docs.withColumn(name, key(F.col("doc_id"), sha)).join(staying, name, "left_semi").dropDuplicates([name]).drop(name)


#: DuckDB SQL for the query.
ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""
