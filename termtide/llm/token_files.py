"""Token ids in files of patched frame-of-reference blocks.

A segment holds the ids of consecutive documents in blocks of ``BLOCK`` ids.  Of each block the
minimum is stored and subtracted; the rest is packed at the width that ``PERCENTILE`` of
the block needs, and values that need more are stored whole in the block's list of exceptions.  An
index of block starts allows to unpack single blocks.  Layout, little-endian:

    magic "PFR1", ids u32, blocks u32
    per block: start u32 (in bytes after this index), minimum u32, width u8, exceptions u16
    per block: packed bits (BLOCK values, most significant bit first), positions u16, values u32

Files are Parquet with a segment a row, so that Spark's own commit and any store that Spark
writes to can be used; their order is that of doc_id, and a row tells where its segment starts.

Null text is empty and has the end id alone.  Documents are ordered by doc_id (null first)
and text; repeated rows are written each.  A segment ends with the document that fills it, so
a long document is one segment.  Further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.common import bytes_of, runs, stored
from termtide.llm.tokens import encoder

BLOCK = 512
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 16
END_ID = 0
PART_BYTES = 256 << 20  # of text in a file, where that is more files than the session's partitions
PREFIX = 64  # characters of the text by which rows of one doc_id, or of none, are dealt to files
ENCODED_BYTES = 2 << 20  # of text at once: the more, the fewer words are looked up again
_HEAD = np.dtype([("start", "<u4"), ("least", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


def _wide(width: int) -> tuple[str, int]:
    """The big-endian type whose bits are cut to ``width``, and its number of bits."""
    return (">u2", 16) if width <= 16 else (">u4", 32)


def pack(ids: np.ndarray) -> bytes:
    """Ids as patched frame-of-reference blocks."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    padded = np.concatenate((ids, np.repeat(ids[-1:], n_blocks * BLOCK - n))).astype(np.uint32)
    rows = padded.reshape(n_blocks, BLOCK)
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    needed = np.ceil(np.log2(rows.astype(np.float64) + 1)).astype(np.uint8)
    kth = int(PERCENTILE * (BLOCK - 1))
    width = np.partition(needed, kth, axis=1)[:, kth] if n_blocks else np.zeros(0, np.uint8)
    odd = needed > width[:, None]
    exceptions = odd.sum(axis=1)
    packed: list[bytes] = [b""] * n_blocks
    low = np.where(odd, 0, rows)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        if w == 0:
            continue
        kind, bits = _wide(int(w))
        raw = np.unpackbits(low[which].astype(kind).view(np.uint8).reshape(-1, bits // 8), axis=1)
        cut = np.packbits(raw[:, bits - w :].reshape(len(which), -1), axis=1)
        for at, row in zip(which.tolist(), cut):
            packed[at] = row.tobytes()
    head = np.zeros(n_blocks, _HEAD)
    head["least"], head["width"], head["exceptions"] = least, width, exceptions
    bodies = []
    for b in range(n_blocks):
        at = np.flatnonzero(odd[b])
        bodies.append(packed[b] + at.astype("<u2").tobytes() + rows[b, at].astype("<u4").tobytes())
    sizes = np.fromiter(map(len, bodies), np.int64, n_blocks)
    head["start"] = np.cumsum(sizes) - sizes
    lead = b"PFR1" + np.array([n, n_blocks], "<u4").tobytes()
    return lead + head.tobytes() + b"".join(bodies)


def unpack(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of the blocks ``first`` to ``last`` (exclusive; all by default)."""
    if data[:4] != b"PFR1":
        raise ValueError("not a segment of token ids")
    n, n_blocks = np.frombuffer(data, "<u4", 2, 4).tolist()
    head = np.frombuffer(data, _HEAD, n_blocks, 12)
    body = np.frombuffer(data, np.uint8, offset=12 + n_blocks * _HEAD.itemsize)
    last = n_blocks if last is None else min(last, n_blocks)
    head = head[first:last]
    out = np.zeros((len(head), BLOCK), np.uint32)
    for w in np.unique(head["width"]).tolist():
        which = np.flatnonzero(head["width"] == w)
        if w == 0:
            continue
        size = BLOCK * w // 8
        index = head["start"][which].astype(np.int64)[:, None] + np.arange(size)
        raw = np.unpackbits(body[index], axis=1).reshape(-1, w)
        kind, bits = _wide(w)
        full = np.zeros((len(raw), bits), np.uint8)
        full[:, bits - w :] = raw
        values = np.packbits(full, axis=1).reshape(-1).view(kind)
        out[which] = values.reshape(len(which), BLOCK)
    for b in np.flatnonzero(head["exceptions"]).tolist():
        count = int(head["exceptions"][b])
        at = int(head["start"][b]) + BLOCK * int(head["width"][b]) // 8
        places = np.frombuffer(body[at : at + 2 * count].tobytes(), "<u2")
        out[b, places] = np.frombuffer(body[at + 2 * count : at + 6 * count].tobytes(), "<u4")
    out += head["least"][:, None]
    return out.reshape(-1)[: n - first * BLOCK]


_SEGMENTS = (
    "part int, seq int, part_start long, n_ids long, doc_ids array<long>, lengths array<long>, data binary"
)


def _writer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The segments of one file, from its documents in order."""
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        encode = encoder(path).encode
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                    pa.array([[len(x) for _, x in held]], pa.list_(pa.int64())),
                    pa.array([pack(ids)], pa.binary()),
                ],
                names=["part", "seq", "part_start", "n_ids", "doc_ids", "lengths", "data"],
            )

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for low, high in runs(bytes_of(texts)[1], ENCODED_BYTES):
                ids, at = encode(texts.slice(low, high - low), ENCODED_BYTES)
                for i in range(high - low):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(END_ID))
                    held.append((doc_ids[low + i], own))
                    size += len(own)
                    if size >= SEGMENT_IDS:
                        yield segment()
                        seq, start = seq + 1, start + size
                        held, size = [], 0
        if held:
            yield segment()

    return run


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["data"]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["part_start"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()),
                ],
                names=["part", "doc_id", "part_at", "n_tokens", "ids_crc32"],
            )


def write_token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; the files as a table of segments.

    The range shuffle is all that moves the texts; a file is what one task of it writes.  Ranges are of doc_id
    and the first characters of the text, so that rows without an id spread over files, in the same order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    octets = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    files = -(-octets // PART_BYTES)
    few = files <= int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    ordered = rows.repartitionByRange(
        *([] if few else [files]), "doc_id", F.substring(text, 1, PREFIX)
    ).sortWithinPartitions("doc_id", text)
    return stored(ordered.mapInArrow(_writer(tokenizer), _SEGMENTS), "token-files")


def read_token_files(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = (  # a row for each file
        segments.groupBy("part")
        .agg(F.sum("n_ids").alias("ids"))
        .select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("file_start"))
    )
    rows = segments.select("part", "part_start", "doc_ids", "lengths", "data").mapInArrow(
        _reader, "part int, doc_id long, part_at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(files, "part").select(
        "doc_id", (F.col("file_start") + F.col("part_at")).alias("start"), "n_tokens", "ids_crc32"
    )
