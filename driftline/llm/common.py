"""Helpers shared by the operators: text rules, batches and tables that cut lineage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import shared_root

#: ASCII white space, the word separators of every operator here.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Text bytes that one Python group holds; groups are dealt by hash, so none is much larger.
BATCH_BYTES = 8 << 20
#: Text bytes that numpy works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def free_name(columns: list[str], name: str) -> str:
    """The name, with as many underscores after it as it takes to be none of the columns (case does not count)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """make(), once per Python worker: tasks that follow in it find it again. For what is dear to read and bounded in size."""
    kept = sys.modules.setdefault("_driftline_kept", types.ModuleType("_driftline_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def discard(table: DataFrame) -> None:
    """Delete what materialise() wrote. Only for a table that nothing lazy reads any more."""
    spark = table.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. lower() does it for ASCII-only text; translate() for the rest."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_residue(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo divisor; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def n_words(text: Column) -> Column:
    """Number of words: positions where a word starts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def batched(docs: DataFrame, batch_bytes: int, *keep: Column) -> tuple[DataFrame, int]:
    """(batch, *keep, text) with documents dealt by hash into batches of about batch_bytes text bytes.

    The number of batches follows the input; a null text is empty. Rows of one id (or none) are dealt by their texts, so only
    rows that are equal in both meet. Only one sum goes to the driver.
    """
    total = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    count = max(1, -(-int(total) // batch_bytes))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    batch = F.pmod(F.xxhash64("doc_id", text), F.lit(count)).cast("int").alias("batch")
    return docs.select(batch, *keep, text.alias("text")), count


def slices(batch: pa.RecordBatch, *columns: int, rows: int = 512, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most `rows` rows and about `most` bytes in the given text columns."""
    size = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + most, "right"))))
        yield batch.slice(at, upto - at)
        at = upto


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 1 << 15, most: int | None = None) -> Iterator[pa.Table]:
    """Rows sorted by a number, in tables of about `rows` rows that end where the key changes. With `most`, a key of more
    rows than that comes in several tables, all but the last of at least `most` rows of it alone."""
    held: list[pa.RecordBatch] = []
    count = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        count += b.num_rows
        if count < rows:
            continue
        keys = b.column(key).to_numpy()
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if len(changes):
            cut = int(changes[-1]) + 1
            yield pa.Table.from_batches([*held[:-1], b.slice(0, cut)])
            held = [b.slice(cut)]
        elif len(held) > 1 and held[-2].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held[:-1])
            held = [b]
        elif most is not None and count >= most:
            yield pa.Table.from_batches(held)
            held = []
        count = sum(x.num_rows for x in held)
    if held:
        yield pa.Table.from_batches(held)
