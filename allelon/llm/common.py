"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: An Arrow batch is worked on in parts of about so many bytes of text.
PART_BYTES = 1 << 21


#: What a Python worker keeps between tasks: one model or table, so that a stage's memory is free in the next.
_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]):
    """``make()``, made once in a Python worker for as long as no other key is asked for."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def hidden(df: DataFrame) -> DataFrame:
    """``df`` with all columns under names that no operator uses, so that none of them clashes."""
    return df.select(*(F.col(f"`{c}`").alias(f"__in_{c}") for c in df.columns))


def shown(df: DataFrame, *more: str) -> DataFrame:
    """The columns that ``hidden`` renamed under their own names, and ``more``."""
    return df.select(*(F.col(f"`{c}`").alias(c.removeprefix("__in_")) for c in df.columns if c.startswith("__in_")), *more)


def parts(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in parts of about ``most`` bytes of ``column``, a longer text alone.

    Spark bounds its batches by spark.sql.execution.arrow.maxBytesPerBatch; what an operator makes of a text in
    Python is several times as large, so that it works on less at a time.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch, column: str) -> list[str]:
    """The texts of an Arrow batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def utf8_length(text: str) -> int:
    """Bytes of a text in UTF-8."""
    return len(text) if text.isascii() else len(text.encode())


def by_bytes(items: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Lists of items of about ``limit`` bytes together."""
    part, total = [], 0
    for x in items:
        part.append(x)
        total += utf8_length(x)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part
