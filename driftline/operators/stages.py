"""Raw -> physical -> bins -> wide, as four stored tables that are remade where they are out of date, and no further.

Each table is partitioned by day and, but for the wide one, by probe. A log has a row for each partition that a run
made: (stage, probe, day, run, rows). A partition is out of date where the run that made what it comes from is
later than the run that made it. What is out of date is read, made and put in the place of the old partitions (dynamic
overwrite); nothing else is touched. A run that fails has no log rows, so the next one makes its partitions again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DAY, SECOND
from ..scratch import kept_table
from .joins import wide

STAGES = ("raw", "physical", "bins", "wide")
LOG_SCHEMA = "stage string, probe string, day long, run long, rows long"


def day_of(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.floor(F.col("t") / DAY).cast("long"))


def day_bins(df: DataFrame, seconds: int, columns: Sequence[str]) -> DataFrame:
    """Means and rows per bin of a part of a day. Bins divide the day, so a bin is made from one partition; no rule looks at other days."""
    size = seconds * SECOND
    if DAY % size:
        raise ValueError("bins of a stage divide the day")
    return df.groupBy("probe", "day", (F.floor(F.col("t") / size) * size).alias("t")).agg(F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(c) for c in columns])


@dataclass
class StagedStore:
    """The four tables under one folder.

    physical: raw rows -> physical rows (probe, t, seq and columns). The probes of the wide table are named, as its columns are.
    """

    spark: SparkSession
    path: str
    physical: Callable[[DataFrame], DataFrame]
    columns: Sequence[str]
    probes: Sequence[str]
    bin_s: int = 600

    def _folder(self, stage: str) -> str:
        return f"{self.path}/{stage}"

    def log(self) -> DataFrame:
        """All log rows so far."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(self._folder("log"))
        except Exception as error:  # the first run has no log
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def latest(self, stage: str) -> DataFrame:
        """probe, day and the last run of a stage's partitions."""
        return self.log().where(F.col("stage") == stage).groupBy("probe", "day").agg(F.max("run").alias("run"))

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self._folder(stage))

    def _put(self, stage: str, rows: DataFrame, run: int, wanted: DataFrame | None = None) -> None:
        """Partitions of a stage in the place of old ones, then their log rows. A wanted partition that has no rows is logged
        with 0, so that it isn't out of date for ever."""
        keys = ["day"] if stage == "wide" else ["probe", "day"]
        rows = kept_table(rows)
        rows.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(self._folder(stage))
        made = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        if wanted is not None:
            made = wanted.select(*keys).distinct().join(made, keys, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
        probe = F.col("probe") if "probe" in keys else F.lit(None).cast("string")
        made.select(F.lit(stage).alias("stage"), probe.alias("probe"), "day", F.lit(run).cast("long").alias("run"), "rows").write.mode("append").parquet(self._folder("log"))

    def deliver(self, raw: DataFrame, run: int) -> None:
        """A delivery of raw rows: each (probe, day) that it has takes the place of what was there."""
        self._put("raw", day_of(raw), run)

    def _stale(self, source: str, stage: str) -> DataFrame:
        have = self.latest(stage).withColumnRenamed("run", "made")
        met = self.latest(source).join(have, ["probe", "day"], "left").where("made is null or made < run")
        return kept_table(met.select("probe", "day"))

    def _stale_days(self) -> DataFrame:
        have = self.log().where("stage = 'wide'").groupBy("day").agg(F.max("run").alias("made"))
        need = self.latest("bins").groupBy("day").agg(F.max("run").alias("run"))
        return kept_table(need.join(have, "day", "left").where("made is null or made < run").select("day"))

    def refresh(self, run: int) -> None:
        """Every later stage made where it is out of date. Run numbers grow; a delivery and what follows from it may share one."""
        steps = (("raw", "physical", lambda x: day_of(self.physical(x.drop("day")))), ("physical", "bins", lambda x: day_bins(x, self.bin_s, self.columns)))
        for source, stage, make in steps:
            stale = self._stale(source, stage)
            if not stale.isEmpty():
                # Few rows, and a semi join on partition columns: Spark reads only the partitions that it needs.
                self._put(stage, make(self.read(source).join(stale, ["probe", "day"], "left_semi")), run, stale)
        days = self._stale_days()
        if not days.isEmpty():
            bins = self.read("bins").join(days, "day", "left_semi")
            self._put("wide", day_of(wide(bins, list(self.probes), list(self.columns))), run, days)
