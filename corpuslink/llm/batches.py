"""Arrow batches in and out of tasks, and word tables of a batch's raw bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE = 1_000


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict | None]],
                schema: str) -> DataFrame:
    """Apply `make()`, built once in each task, to every Arrow batch of the frame.

    The function gets a record batch and returns columns by name (or None for no
    rows). Batches are handed on in slices of at most `SLICE` rows, which bounds what a
    task holds at once. Tasks keep no state that a repeated attempt could see twice.
    """
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            if (out := step(batch)) is not None:
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, arrow.field(n).type)
                     for n, x in ((f.name, out[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just the two columns an operator reads, under fixed names; other columns cannot clash."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_groups(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about `most` bytes; a longer row stands alone."""
    at, n = 0, len(bounds) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)
