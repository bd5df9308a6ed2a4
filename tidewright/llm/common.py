"""Column helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space and words, as fixed values: ASCII blank and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(text: str | Column) -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer form of it that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without the columns that an operator is about to add under these names."""
    drop = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def slices(batch: pa.RecordBatch, column: str, rows: int = 256, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `rows` rows and, unless one row alone has more, `size` bytes of `column`."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(batch):
        high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + size, "right"))
        high = max(low + 1, min(high, low + rows))
        yield batch.slice(low, high - low)
        low = high


def columns_of(schema) -> str:
    """The columns of a schema, as Spark's schema strings have them."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def lean(walk: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`walk` over the batches of a task; behind it the worker gives back what memory it no longer needs. Workers are kept for
    further tasks, and an executor would otherwise hold the peaks of all of them at once."""

    @functools.wraps(walk)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from walk(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
