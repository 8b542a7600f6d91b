"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when its counted rows need no more than this.
BROADCAST_BYTES = 32 << 20


def read(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{table}.parquet")


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``doc_id`` and ``text`` only, a null text as the empty one."""
    return docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """True for ids whose CRC-32 as text falls in the fold; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """A broadcast hint for a side whose counted size is small, else the plain side,
    which then meets the other one in a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


_held: dict[object, object] = {}


def held(key: object, build: Callable[[], object]) -> object:
    """What a worker keeps from task to task, such as a cache: the object of the last key only. Workers
    outlive a stage, and what one operator leaves behind would add up with what the next one needs."""
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]


def give_back(collect: bool = True) -> None:
    """Return freed memory to the system, at the end of a task. Workers are kept for later stages, and the
    allocators would keep what this one needed at its peak. Without ``collect`` cycles of garbage stay for now."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that their texts hold about ``limit`` bytes; a longer
    text stands alone. This bounds what a worker has in hand at a time."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start = size = 0
        for row, length in enumerate(pa.compute.binary_length(column).to_pylist()):
            if row > start and size + (length or 0) > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length or 0
        if batch.num_rows > start:
            yield batch.slice(start)


@cache
def code_points(group: str) -> list[int]:
    """All code points of a general category group such as "L" or "N"."""
    return [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == group]


@cache
def character_class(group: str) -> str:
    """The inside of a pattern's character class for a general category group."""
    ranges: list[list[int]] = []
    for c in code_points(group):
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
