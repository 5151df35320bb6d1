"""Structured Streaming forms (R1-R5). Watermarks bound the state; each takes and returns streams."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.scan import SLICE_ROWS
from ..operators.spectrum import SCHEMA, density
from ..operators.timefix import corrected_times
from ..schema import SECOND, micros, timestamp
from ..scratch import kept_table
from ..sources.text import header_schema


def ingest(spark: SparkSession, path: str, header: str, *, files_per_trigger: int = 100) -> DataFrame:
    """New files only; the checkpoint remembers the rest."""
    return spark.readStream.schema(header_schema(header)).option("maxFilesPerTrigger", files_per_trigger).option("mode", "DROPMALFORMED").csv(path)


def _micros(stream: DataFrame) -> Column:
    """ts as microseconds: a TIMESTAMP is an instant, a TIMESTAMP_NTZ is read as UTC, whatever the session's zone."""
    return F.unix_micros("ts") if dict(stream.dtypes)["ts"] == "timestamp" else micros(F.col("ts"))


def _timed(stream: DataFrame) -> DataFrame:
    """Watermarks need TIMESTAMP."""
    return stream.withColumn("ts", F.timestamp_micros(_micros(stream)))


def _utc(instant: Column) -> Column:
    """A TIMESTAMP as TIMESTAMP_NTZ in UTC."""
    return timestamp(F.unix_micros(instant))


def bins(stream: DataFrame, seconds: int, columns: Sequence[str], late: str = "10 minutes") -> DataFrame:
    """Tumbling means as data arrives. stream(probe, ts TIMESTAMP_NTZ or TIMESTAMP, ...)."""
    w = F.window("ts", f"{seconds} seconds")
    return _timed(stream).withWatermark("ts", late).groupBy("probe", w).agg(F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(c) for c in columns]).select("probe", _utc(F.col("window.start")).alias("ts"), "rows", *columns)


def sliding(stream: DataFrame, length: int, hop: int, column: str, late: str = "10 minutes") -> DataFrame:
    """Sliding windows with their ordered values, for a spectrum of each."""
    w = F.window("ts", f"{length} seconds", f"{hop} seconds")
    out = _timed(stream).withWatermark("ts", late).groupBy("probe", w).agg(F.sort_array(F.collect_list(F.struct("ts", column))).alias("_s"))
    return out.select("probe", _utc(F.col("window.start")).alias("w_start"), F.transform("_s", lambda r: r[column]).alias("values"))


def sliding_spectra(stream: DataFrame, length: int, hop: int, column: str, *, step: int, method: str = "eigen", low: float = 0.0, high: float | None = None, late: str = "10 minutes") -> DataFrame:
    """R4 into X2: the density of each sliding window, when the watermark has passed its end: probe, w_start (microseconds), freq,
    psd. What spectra() gives for the same windows; step: microseconds from row to row. The state holds the rows of open windows."""
    closed = sliding(stream, length, hop, column, late).select("probe", micros(F.col("w_start")).alias("w_start"), "values")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                f, p = density(np.array(r.values, float), step, method=method, low=low, high=high)
                yield pd.DataFrame({"probe": r.probe, "w_start": r.w_start, "freq": f, "psd": p})

    return closed.mapInPandas(run, SCHEMA)


def sessions(stream: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    """Bursts on arrival: rows less than gap apart."""
    w = F.session_window("ts", gap)
    return _timed(stream).withWatermark("ts", late).groupBy("probe", w).agg(F.count(F.lit(1)).alias("rows")).select("probe", _utc(F.col("session_window.start")).alias("t_start"), _utc(F.col("session_window.end")).alias("t_end"), "rows")


def resolved_times(stream: DataFrame, freq: float) -> DataFrame:
    """R2: repeated times of low-resolution clocks spread by 1/freq across chunks. The state of a probe is the
    last raw time and how many rows had it; rows before it are late and go."""
    schema = "probe string, seq long, t long"

    def run(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (-(1 << 62), 0)
        rows = pd.concat(list(chunks)).sort_values(["t", "seq"])
        rows = rows[rows["t"] >= last]
        if not len(rows):
            return
        t = rows["t"].to_numpy()
        first = np.concatenate([[True], t[1:] != t[:-1]])
        k = np.arange(len(t)) - np.maximum.accumulate(np.where(first, np.arange(len(t)), 0))
        k = k + np.where(t == last, n, 0)
        state.update((int(t[-1]), int(k[-1]) + 1))
        yield pd.DataFrame({"probe": key[0], "seq": rows["seq"], "t": t + np.rint(k * SECOND / freq).astype("int64")})

    timed = stream.withColumn("t", _micros(stream)).select("probe", "seq", "t")
    return timed.groupBy("probe").applyInPandasWithState(run, schema, "last long, n long", "append", GroupStateTimeout.NoTimeout)


def _still_open(rows: DataFrame) -> DataFrame:
    """rows with _held: the row is in the run of one time that its probe ends with, or behind it without a time, so that
    rows that are yet to come may belong to it. Two aggregates of a row per probe; no probe's rows meet in one task."""
    end = rows.where("t is not null").groupBy("probe").agg(F.max_by("t", "seq").alias("_end"))
    closed = rows.join(F.broadcast(end), "probe").where("t <> _end").groupBy("probe").agg(F.max("seq").alias("_closed"))
    return rows.join(F.broadcast(closed), "probe", "left").withColumn("_held", F.coalesce(F.col("seq") > F.col("_closed"), F.lit(True))).drop("_closed")


def corrected_to(stream: DataFrame, path: str, checkpoint: str, *, fs: float | None = None, overlap: int | None = None, **options) -> DataFrame:
    """R2: T1 over what is there now, chunk by chunk, to Parquet: probe, seq, t and ok. A later call goes on from the checkpoint.

    How a run of one time is spread depends on all of its rows and on the time behind it. So the run that a probe's rows end with is
    held back, however long it is: its rows are corrected with the next chunk. Each chunk is corrected behind those and the last
    `overlap` (2 * ceil(fs), 50 without fs) uncorrected times before them, which are the state: one table a chunk. Rows held
    by the last chunk so far are in the result as if nothing came behind them (chunk=n/held=1); the next chunk replaces them.
    A chunk that is run again overwrites what it wrote, so each row is there once. stream(probe, seq, ts).
    """
    keep, spark = overlap or (2 * math.ceil(fs) if fs else 50), stream.sparkSession
    plain = stream.select("probe", F.col("seq").cast("long").alias("seq"), _micros(stream).alias("t"))

    def correct(chunk: DataFrame, number: int) -> None:
        # _new: not in the result for good yet.
        chunk = kept_table(chunk.select("probe", "seq", "t", F.lit(True).alias("_new")))
        before = chunk.where("false") if number == 0 else spark.read.schema(chunk.schema).parquet(f"{checkpoint}/tails/{number - 1}")
        both = kept_table(_still_open(before.unionByName(chunk)))
        made = corrected_times(both, fs=fs, **options).where("_new").select("probe", "seq", "t", "ok", F.col("_held").cast("int").alias("held"))
        made.write.mode("overwrite").partitionBy("held").parquet(f"{path}/chunk={number}")
        # The first `keep` of each slice of the source, then of them: no probe's rows meet in one task.
        backwards = F.col("seq").desc()
        part = Window.partitionBy("probe", F.floor(F.col("seq") / SLICE_ROWS)).orderBy(backwards)
        few = both.where("not _held").withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= keep)
        tail = few.withColumn("_rn", F.row_number().over(Window.partitionBy("probe").orderBy(backwards))).where(F.col("_rn") <= keep)
        state = tail.select("probe", "seq", "t", F.lit(False).alias("_new")).unionByName(both.where("_held").select("probe", "seq", "t", "_new"))
        state.write.mode("overwrite").parquet(f"{checkpoint}/tails/{number}")

    plain.writeStream.foreachBatch(correct).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.option("basePath", path).schema("probe string, seq long, t long, ok boolean, chunk long, held int").parquet(path)
    newest = F.broadcast(found.agg(F.max("chunk").alias("_newest")))
    return found.crossJoin(newest).where("held = 0 or chunk = _newest").select("probe", "seq", "t", "ok")


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All that is there now, to Parquet; the next call goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)
