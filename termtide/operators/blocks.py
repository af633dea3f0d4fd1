"""Rows that meet a table together, some hundred at a time.

What the rows of a block ask for is asked once for all of them, so far less moves than if every row asked for itself, and a
frequent word is asked for no more often than there are blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_ROWS = 1024
# A row that holds more than this goes alone, so that no block is large.
LARGE_ROW = 1 << 16


def block_of(number: str, size: Column) -> Column:
    """The block of a row with a number of its own: its neighbours by number, or itself alone."""
    alone = -F.col(number) - 1
    return F.when(size > LARGE_ROW, alone).otherwise(F.col(number) - F.col(number) % BLOCK_ROWS)


def list_sizes(lists: pa.Array) -> np.ndarray:
    """How many elements each list has; a missing one has none."""
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def lists_of(sizes: np.ndarray, values: pa.Array, missing: pa.Array, kind: pa.DataType | None = None) -> pa.Array:
    """Lists of the given sizes from their elements one after the other, and missing ones."""
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values, type=kind, mask=missing)


def one_array(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks)
