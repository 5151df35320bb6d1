"""K1: text files named by their first time, bin and probe, as a Python data source that writes.

    register(spark)
    rows.write.format("probe_tsv").mode("append").option("bin", 600).option("digits", "%.5g").save(folder)

A task writes each of its files under a name of its own attempt; only the commit on the driver gives them their
names, so a task that runs twice, or a job that fails, leaves no file that looks finished.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.store import DIGITS
from ..schema import SECOND, timestamp

NAME = "probe_tsv"


def file_name(start: str, bin_s: int, probe: str) -> str:
    """`start` (yymmdd_HHMM), the bin's seconds where there is one, and the probe."""
    return f"{start}{f'bin{bin_s}s' if bin_s else ''}@{probe}.tsv"


@dataclass
class Written(WriterCommitMessage):
    """(temporary name, name) of a task's files."""

    files: list[tuple[str, str]] = field(default_factory=list)


class TsvWriter(DataSourceArrowWriter):
    """Rows (probe, period, start, Time and values), sorted by probe, period and Time, to a file for each probe and period."""

    def __init__(self, path: str, bin_s: int, pattern: str, overwrite: bool):
        self.path, self.bin_s, self.pattern, self.overwrite = path, bin_s, pattern, overwrite
        self.attempt = f"_attempt-{uuid.uuid4().hex}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        return store, root

    def _text(self, column: pa.ChunkedArray | pa.Array) -> list[str]:
        if pa.types.is_floating(column.type):
            return ["" if v is None or v != v else self.pattern % v for v in column.to_pylist()]
        return ["" if v is None else str(v) for v in column.to_pylist()]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = self._store()
        store.create_dir(posixpath.join(root, self.attempt))
        done, key, out = Written(), None, None
        task = uuid.uuid4().hex
        for b in iterator:
            if not b.num_rows:
                continue
            names = [c for c in b.schema.names if c not in ("probe", "period", "start")]
            keys = list(zip(b.column("probe").to_pylist(), b.column("period").to_pylist()))
            starts = b.column("start").to_pylist()
            lines = ["\t".join(r) for r in zip(*(self._text(b.column(c)) for c in names))]
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, z in zip(cuts, cuts[1:]):
                if keys[a] != key:
                    if out is not None:
                        out.close()
                    key = keys[a]
                    held = posixpath.join(self.attempt, f"{task}-{len(done.files)}")
                    done.files.append((held, file_name(starts[a], self.bin_s, keys[a][0])))
                    out = store.open_output_stream(posixpath.join(root, held))
                    out.write(("\t".join(names) + "\n").encode())
                out.write(("\n".join(lines[a:z]) + "\n").encode())
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = self._store()
        files = [f for m in messages if m is not None for f in m.files]
        if not self.overwrite:
            there = {i.base_name for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File}
            if taken := sorted(there & {name for _, name in files}):
                store.delete_dir(posixpath.join(root, self.attempt))
                raise FileExistsError(f"{len(taken)} files are there already, {taken[0]} for one")
        for held, name in files:
            store.move(posixpath.join(root, held), posixpath.join(root, name))
        if store.get_file_info(posixpath.join(root, self.attempt)).type != fs.FileType.NotFound:
            store.delete_dir(posixpath.join(root, self.attempt))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = self._store()
        if store.get_file_info(posixpath.join(root, self.attempt)).type != fs.FileType.NotFound:
            store.delete_dir(posixpath.join(root, self.attempt))


class TsvSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> TsvWriter:
        return TsvWriter(self.options["path"], int(self.options.get("bin", "0")), self.options.get("digits", "%.5g"), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TsvSource)


def write_files(df: DataFrame, path: str, columns: list[str], *, bin_s: int = 0, period: int | None = None, overwrite: bool = False) -> None:
    """K1: one file for each probe, or for each probe and period (microseconds), named by its first time: times in whole seconds
    (rounded up), Vdir and inclination with 4 digits and Pressure with 3 at most, all numbers as %.5g, nothing for NULL.

    A file is one task's work, so give long series a period. Existing files are an error unless overwritten.
    """
    spark = df.sparkSession
    register(spark)
    cut = F.lit(0) if period is None else F.floor(F.col("t") / period).cast("long")
    rows = df.withColumn("period", cut)
    first = rows.groupBy("probe", "period").agg(F.date_format(timestamp(F.min("t")), "yyMMdd_HHmm").alias("start"))
    whole = F.ceil(F.col("t") / SECOND) * SECOND
    values = [F.round(c, DIGITS[c]).alias(c) if c in DIGITS else F.col(c) for c in columns]
    out = rows.join(first, ["probe", "period"]).select("probe", "period", "start", F.date_format(timestamp(whole), "yyyy-MM-dd HH:mm:ss").alias("Time"), *values, F.col("t").alias("_t"))
    out = out.repartition("probe", "period").sortWithinPartitions("probe", "period", "_t").drop("_t")
    out.write.format(NAME).mode("overwrite" if overwrite else "append").option("bin", bin_s).save(path)



