"""The data model: one long table of probes, times as whole microseconds.

Columns: probe STRING, t LONG (microseconds since 1970 in UTC), seq LONG (source row), and DOUBLE
channels. Order is always (t, seq) within a probe. NaN never enters: sources turn it to NULL, because
in Spark NaN compares as larger than any number and makes means NaN.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400 * SECOND
VECTORS = ("Ax", "Ay", "Az", "Mx", "My", "Mz")


def ordered(*extra: str) -> WindowSpec:
    return Window.partitionBy("probe", *extra).orderBy("t", "seq")


def per_probe(*extra: str) -> WindowSpec:
    return Window.partitionBy("probe", *extra)


def micros(ts: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC -> microseconds, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def timestamp(t: Column) -> Column:
    return F.timestamp_add("MICROSECOND", t, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    names = [c for c, kind in df.dtypes if kind in ("double", "float")] if columns is None else list(columns)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})


def rounded(x: Column | str, digits: int = 6) -> Column:
    """Rounded for output; adding 0.0 turns -0.0 to 0.0."""
    return F.round(x, digits) + F.lit(0.0)
