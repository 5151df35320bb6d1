"""Raw logger text: line repair, record formats, declared schemas, file discovery."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import nan_to_null

#: Record fields by kind: inclinometer (i, b), with pressure (p, d), wave gauge (w).
DATE = ("year", "month", "day", "hour", "minute", "second")
VECTOR = ("Ax", "Ay", "Az", "Mx", "My", "Mz")
KINDS = {
    "i": (*DATE, *VECTOR, "Temp", "Battery"),
    "b": (*DATE, *VECTOR, "Temp", "Battery"),
    "p": (*DATE, "P_counts", *VECTOR, "Battery", "Temp"),
    "d": (*DATE, "P_counts", *VECTOR, "Battery", "Temp"),
    "w": (*DATE, "P_counts", "Battery", "Temp"),
}
TYPES = {"text": "string", "float": "double", "time": "string", "int": "int"}


def record_pattern(kind: str) -> str:
    """A whole record: six date parts, whole counts, and decimals for temperature and battery."""
    part = {**{c: r"\d{1,4}" for c in DATE}, "Temp": r"-?\d+(?:\.\d+)?", "Battery": r"-?\d+(?:\.\d+)?"}
    return "(" + ",".join(part.get(c, r"-?\d{1,8}") for c in KINDS[kind]) + ")"


def repaired(lines: DataFrame, pattern: str, group: int = 1) -> DataFrame:
    """The part of each line that the pattern's group matches; lines of two characters or less go."""
    return lines.withColumn("value", F.regexp_extract("value", pattern, group)).where(F.length("value") > 2)


def repair_counts(lines: DataFrame, pattern: str, group: int = 1) -> DataFrame:
    """Lines read, kept and dropped."""
    kept = F.length(F.regexp_extract("value", pattern, group)) > 2
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


def parsed(lines: DataFrame, kind: str, text: str = "value") -> DataFrame:
    """Typed columns of one kind; date parts stay text."""
    parts = F.split(text, ",")
    columns = {}
    for k, c in enumerate(KINDS[kind]):
        raw = F.element_at(parts, k + 1)
        columns[c] = raw if c in DATE else raw.try_cast("smallint") if c in VECTOR else raw.try_cast("int") if c == "P_counts" else raw.try_cast("double")
    return lines.withColumns(columns)


def header_schema(header: str, delimiter: str = ",") -> str:
    """S3: "Time(text),Pres,Temp(float),,x" -> a DDL schema; unnamed fields are read as skipped ones."""
    out = []
    for k, name in enumerate(header.split(delimiter)):
        m = re.fullmatch(r"\s*([^()]*?)(?:\((\w+)\))?\s*", name)
        plain, kind = (m[1], m[2]) if m else (name, None)
        out.append(f"`{plain or f'_skip{k}'}` {TYPES.get(kind or 'float', 'double')}")
    return ", ".join(out)


def read_csv(spark: SparkSession, path: str | Sequence[str], header: str, *, delimiter: str = ",", bad_lines: str = "skip", comment: str | None = None, skip_header: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """S3: a declared-schema scan. bad_lines: skip, fail or keep (their bad fields NULL)."""
    mode = {"skip": "DROPMALFORMED", "fail": "FAILFAST", "keep": "PERMISSIVE"}[bad_lines]
    reader = spark.read.schema(header_schema(header, delimiter)).option("sep", delimiter).option("mode", mode).option("header", skip_header)
    df = (reader.option("comment", comment) if comment else reader).csv(path)
    return nan_to_null(df.select(*(columns or [c for c in df.columns if not c.startswith("_skip")])))


def edge_rows(df: DataFrame, file: str | Column, columns: Sequence[str]) -> DataFrame:
    """First and last row of each file, and its rows; df carries seq."""
    row = F.struct(*columns)
    return df.groupBy(F.col(file).alias("file") if isinstance(file, str) else file.alias("file")).agg(F.min_by(row, "seq").alias("first"), F.max_by(row, "seq").alias("last"), F.count(F.lit(1)).alias("rows")).select("file", "rows", *[F.col(f"first.{c}").alias(f"first_{c}") for c in columns], *[F.col(f"last.{c}").alias(f"last_{c}") for c in columns])


def probe_of(name: Column) -> Column:
    """Kind and number in a file name -> probe id of at least two digits, or NULL."""
    stem = F.regexp_extract(name, r"([^/]*?)(?:\.[^./]*)?$", 1)
    kind = F.lower(F.regexp_extract(stem, r"(?i)(?:incl?|^|[^a-z])([ibdpw])[a-z]*_?0*(\d+)", 1))
    number = F.regexp_extract(stem, r"(?i)(?:incl?|^|[^a-z])([ibdpw])[a-z]*_?0*(\d+)", 2)
    return F.when(number != "", F.concat(kind, F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)))


def discovered(files: DataFrame, exclude: Sequence[str] = ("coef", "@")) -> DataFrame:
    """files(path) -> those whose stem does not end as excluded, with their probe."""
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    out = files.withColumn("probe", probe_of(F.col("path"))).where("probe is not null")
    for e in exclude:
        out = out.where(~stem.endswith(e))
    return out


def double_claims(found: DataFrame) -> DataFrame:
    """Paths that two probes claim; the caller fails if there are any."""
    return found.groupBy("path").agg(F.count_distinct("probe").alias("probes")).where("probes > 1")


def list_files(spark: SparkSession, root: str, mask: str = "*") -> DataFrame:
    """path and changed of files under root, by Spark's own listing."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", mask).option("recursiveFileLookup", True).load(root)
    return found.select("path", F.unix_micros("modificationTime").alias("changed"))
