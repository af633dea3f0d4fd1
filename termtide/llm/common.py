"""What the operators on training text share: tables, stored steps, text as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termtide.session import configure, scratch_path

# Rows of one Arrow batch, and bytes of text that are worked on at once (with one more a power of
# two, so that tables of powers need not be twice as long).
BATCH_ROWS = 1024
CHUNK_BYTES = (1 << 20) - 1

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: read back, never computed again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a column in one array, and where each row starts; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)
    starts = starts[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def runs(starts: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    low, n = 0, len(starts) - 1
    while low < n:
        high = int(np.searchsorted(starts, starts[low] + limit, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64, as many as were needed yet."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, (n - 1).bit_length())
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                powers = np.full(size, base, U64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[begin:end]``; equal bytes hash alike wherever they stand."""
    up, down = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=sums[1:])
    value = (sums[end] - sums[begin]) * down[begin]
    return mix(value ^ (end - begin).astype(U64) * U64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space), and at which word each row starts."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    before = np.concatenate(([False], solid))
    first = solid & (~before[:-1] | edge[:-1])
    after = np.concatenate((solid[1:], [False]))
    last = solid & (~after | edge[1:])
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hashes(data, begin, end), np.searchsorted(begin, starts)


def shingles(
    data: np.ndarray, starts: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and at which shingle each row starts.

    A row of fewer words is one shingle of all of them; a row without words has none.
    """
    word, at = words(data, starts)
    n_words = np.diff(at)
    count = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    bounds = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(count)), count)
    begin = np.arange(bounds[-1]) - bounds[row] + at[row]
    end = at[row + 1]
    value = np.zeros(len(row), U64)
    padded = np.concatenate((word, np.zeros(1, U64)))
    for k in range(size):
        index = begin + k
        part = np.where(index < end, padded[np.minimum(index, len(word))], U64(0x5851F42D4C957F2D))
        value = mix(value * U64(0x2545F4914F6CDD1D) + part)
    return value, bounds
