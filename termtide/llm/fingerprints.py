"""Document fingerprints: one-permutation MinHash with optimal densification.

Every shingle of five words is hashed once.  The high part of the hash picks one of
``BINS`` bins, each bin keeps its least hash.  An empty bin borrows from a bin that is
picked by a random sequence of its own (optimal densification), so that the fingerprints
of two texts borrow alike.  ``BITS`` low-order bits of each bin are packed; the likeness
of two fingerprints is the share of equal bins, freed of the 2^-BITS that agree by chance.

Null text is empty.  Texts without words have the fingerprint of zeros only; they are
like each other (1.0) and unlike every other text (0.0).  Texts of fewer than five words
are one shingle.  Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import CHUNK_BYTES, U64, bytes_of, mix, runs, shingles

BINS = 256
BITS = 8
ROWS_PER_PART = 100_000
_EMPTY = U64(0xFFFFFFFFFFFFFFFF)


def densify(bins: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row (row, bin) from bins that are not empty."""
    n = bins.shape[1]
    empty = bins == _EMPTY
    rows, cells = np.nonzero(empty & ~empty.all(axis=1, keepdims=True))
    filled = bins.copy()
    attempt = 0
    while len(rows):
        attempt += 1
        if attempt <= 16 * n:
            donor = (mix(cells.astype(U64) * U64(1_000_003) + U64(attempt)) % U64(n)).astype(int)
        else:  # the sequences are random; step on evenly where one has had no luck
            donor = (cells + attempt) % n
        hit = ~empty[rows, donor]
        filled[rows[hit], cells[hit]] = mix(bins[rows[hit], donor[hit]] + U64(attempt))
        rows, cells = rows[~hit], cells[~hit]
    return filled


def sketch(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text as a row of ``BINS`` small numbers."""
    data, starts = bytes_of(texts)
    value, bounds = shingles(data, starts)
    n = len(starts) - 1
    bins = np.full(n * BINS, _EMPTY, U64)
    row = np.repeat(np.arange(n), np.diff(bounds))
    slot = row * BINS + (value >> U64(40)).astype(np.int64) % BINS
    np.minimum.at(bins, slot, np.minimum(mix(value + U64(1)), _EMPTY - U64(1)))
    bins = densify(bins.reshape(n, BINS))
    low = (bins & U64((1 << BITS) - 1)).astype(np.uint8)
    low[np.diff(bounds) == 0] = 0
    return low


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of rows of fingerprints, from 0 to 1, corrected for chance agreement."""
    chance = 2.0**-BITS
    same = (a == b).mean(axis=1)
    both = a.any(axis=1) & b.any(axis=1)
    neither = ~(a.any(axis=1) | b.any(axis=1))
    corrected = np.clip((same - chance) / (1 - chance), 0.0, 1.0)
    return np.where(both, corrected, neither.astype(float))


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by the start of the one that follows."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Result rows of all but the last of ``rows`` of (doc_id, text, home); each is followed by the next."""
    texts = [r[1] for r in rows]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own, other = sketch(pa.array(texts, pa.string())), sketch(pa.array(changed, pa.string()))
    keep = [i for i in range(len(changed)) if rows[i][2]]
    near_edited, near_next = likeness(own[:-1], other), likeness(own[:-1], own[1:])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][0] for i in keep], pa.int64()),
            pa.array([len(texts[i]) for i in keep], pa.int64()),
            pa.array([hashlib.sha256(changed[i].encode()).hexdigest() for i in keep]),
            pa.array([own[i].tobytes().hex() for i in keep]),
            pa.array([other[i].tobytes().hex() for i in keep]),
            pa.array(near_edited[keep], pa.float64()),
            pa.array(near_next[keep], pa.float64()),
        ],
        schema=_OUT,
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row with the one after it of the same part; the last row of a part is only read."""
    part, held, size = None, [], 0
    for batch in batches:
        parts = batch.column("part").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        homes = batch.column("home").to_pylist()
        texts = batch.column("text")
        for low, high in runs(bytes_of(texts)[1], CHUNK_BYTES // 4):
            for i, text in zip(range(low, high), texts.slice(low, high - low).to_pylist()):
                if parts[i] != part or size > CHUNK_BYTES:
                    if len(held) > 1:
                        yield _compared(held)
                    held = held[-1:] if parts[i] == part else []
                    part, size = parts[i], 0
                held.append((ids[i], text or "", homes[i]))
                size += len(held[-1][1])
    if len(held) > 1:
        yield _compared(held)


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likeness to those that follow.

    Documents follow each other by doc_id (null first), rows of one doc_id by text; the
    first follows the last.  A document that is alone follows itself.

    The order is cut at quantiles of doc_id into parts.  The rows of a boundary doc_id go to
    the part before as well, where they are only looked at, so one shuffle of the texts is
    all that moves.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(-(2**63))).cast("long").alias("rank"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )
    n, least = rows.agg(F.count("*"), F.min("rank")).first()
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_PART))
    if n == 0:
        return spark.createDataFrame([], _OUT_DDL)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    cuts = rows.agg(F.percentile_approx("rank", shares, max(10_000, 10 * parts))).first()[0]
    # Bounded by the number of parts.  The first value opens no part of its own.
    bounds = np.array(sorted({c for c in cuts if c > least}), np.int64)

    @F.pandas_udf("int")
    def part_of(rank):
        at = np.searchsorted(bounds, rank.to_numpy(), "right")
        edge = np.isin(rank.to_numpy(), bounds)
        return rank.__class__(np.where(edge, -at - 1, at).astype(np.int32))

    code, last = F.col("code"), F.lit(len(bounds))
    at = F.when(code < 0, -code - 1).otherwise(code)
    home = F.struct(at.alias("part"), F.lit(True).alias("home"), F.lit(0).alias("lap"))
    halo = F.struct((at - 1).alias("part"), F.lit(False).alias("home"), F.lit(0).alias("lap"))
    wrap = F.struct(last.alias("part"), F.lit(False).alias("home"), F.lit(1).alias("lap"))
    places = F.filter(
        F.array(home, F.when(code < 0, halo), F.when(F.col("rank") == least, wrap)),
        lambda x: x.isNotNull(),
    )
    return (
        rows.withColumn("code", part_of("rank"))
        .select("rank", "doc_id", "text", F.explode(places).alias("place"))
        .select("rank", "doc_id", "text", "place.*")
        .repartition(parts, "part")
        .sortWithinPartitions("part", "lap", "rank", F.coalesce("text", F.lit("")))
        .select("part", "home", "doc_id", "text")
        .mapInArrow(_walk, _OUT_DDL)
    )
