"""Steps in Python over Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def release_memory() -> None:
    """Give freed memory back to the system.

    Python workers outlive their tasks and share the executor's memory with it and with each other,
    so a step calls this at its end; what it held must be free by then.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, other libraries needn't
    if trim is not None:
        trim(0)


def map_rows(df: DataFrame, schema: T.StructType, step: Callable[[Iterable[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` for a step that yields columns as a dict of lists or arrays."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in step(batches):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        columns = arrays = None  # the last batch
        release_memory()

    return df.mapInArrow(run, schema)
