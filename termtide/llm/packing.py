"""Best-fit packing by bin completion.

Documents are cut into pieces of at most ``CAPACITY`` tokens.  A sequence is begun with the
longest piece that is left and completed by branch and bound: fillings of the remaining space are
enumerated with the longest pieces first and in falling order, so that each is met once and those that
another filling dominates (a longer piece would fit in a shorter one's stead) come after it; a branch
ends where even all that fits cannot beat the incumbent's waste, and the best fit so
far is the incumbent.  No waste ends the search at once.  Pieces of one length are one branch, whatever their number, and the
first filling is always finished; ``STEPS`` bounds the branches that are tried after it.

Pieces are dealt by number into groups of about ``GROUP``, which are packed apart.  The pieces of
sequences that stay below ``FULL`` of the capacity are then dealt and packed again, until
one group holds them or packing again no longer saves a sequence; so groups cost no more than one
badly filled sequence in all.

Null text is empty: its document is its end id alone.  Every row is a document of its own,
repeated ones too; a null doc_id is kept.  Further columns of the input are left out.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import bytes_of, runs, stored
from termtide.llm.tokens import ENCODED_BYTES, encoder

CAPACITY = 4096
END_ID = 1
GROUP = 16_384
FULL = 0.98
STEPS = 400  # branches that may be looked at to better the first filling of one sequence

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for low, high in runs(bytes_of(texts)[1], ENCODED_BYTES):
                ids, at = encode(texts.slice(low, high - low))
                rows = []
                for i in range(high - low):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(END_ID)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        rows.append((doc_ids[low + i], piece, start, len(part), zlib.crc32(part.tobytes())))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


class Left:
    """The lengths of the pieces that are left, with how many there are of each."""

    def __init__(self, lengths: list[int]) -> None:
        self.count: dict[int, int] = {}
        for n in lengths:
            self.count[n] = self.count.get(n, 0) + 1
        self.sorted = sorted(self.count)

    def take(self, n: int, times: int = 1) -> None:
        self.count[n] -= times
        if not self.count[n]:
            del self.count[n]
            del self.sorted[bisect.bisect_left(self.sorted, n)]

    def completion(self, space: int) -> list[tuple[int, int]]:
        """Lengths that fill ``space`` best, and how many of each."""
        best: list[tuple[int, int]] = []
        best_waste, steps = space, 0
        descending = True  # the first, greedy, filling is not limited

        def branch(space: int, below: int, chosen: list[tuple[int, int]]) -> bool:
            nonlocal best, best_waste, steps, descending
            if space < best_waste:
                best, best_waste = list(chosen), space
            if best_waste == 0:
                return True
            at = bisect.bisect_left(self.sorted, min(space + 1, below)) - 1
            shortest = self.sorted[0] if self.sorted else space + 1
            for n in map(self.sorted.__getitem__, range(at, -1, -1)):
                # No more than space // shortest pieces fit, and none is longer than n.
                if space - space // shortest * n >= best_waste:
                    return False
                for times in range(min(self.count[n], space // n), 0, -1):
                    if not descending:
                        steps += 1
                        if steps > STEPS:
                            return True
                    chosen.append((n, times))
                    done = branch(space - times * n, n, chosen)
                    chosen.pop()
                    if done:
                        return True
            descending = False
            return False

        branch(space, space + 1, [])
        return best


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Sequences as lists of positions in ``lengths``."""
    where: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        where.setdefault(n, []).append(i)
    left, sequences = Left(lengths), []
    while left.sorted:
        chosen = [left.sorted[-1]]
        left.take(chosen[0])
        for n, times in left.completion(capacity - chosen[0]):
            left.take(n, times)
            chosen += [n] * times
        sequences.append([where[n].pop() for n in chosen])
    return sequences


def _pack_group(capacity: int):
    def run(key, frame):
        lengths = frame["length"].tolist()
        sequence, offset, load = ([0] * len(lengths) for _ in range(3))
        for s, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = s, at
                at += lengths[i]
            for i in members:
                load[i] = at
        return frame[["uid", "length"]].assign(
            group=int(key[0]), sequence=sequence, offset=offset, load=load
        )

    return run


def _packed(pieces: DataFrame, n: int, level: int, capacity: int) -> DataFrame:
    groups = max(1, -(-n // GROUP))
    return (
        pieces.select("uid", "length")
        .groupBy(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(groups)).alias("group"))
        .applyInPandas(
            _pack_group(capacity),
            "uid long, length long, group long, sequence long, offset long, load long",
        )
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row for each piece."""
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _cutter(tokenizer, capacity), _PIECES
    )
    pieces = stored(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == capacity).select(
        "uid", F.lit(0).alias("level"), F.col("uid").alias("group"), F.lit(0).cast("long").alias("sequence"), F.lit(0).cast("long").alias("offset")
    )
    todo = pieces.where(F.col("length") < capacity).select("uid", "length")
    n, level, done = todo.count(), 0, [whole]
    columns = ("uid", "level", "group", "sequence", "offset")
    before = earlier = None  # how many sequences the pieces took in the round before, and their places there
    while n:
        level += 1
        packed = stored(_packed(todo, n, level, capacity).withColumn("level", F.lit(level)), f"packed-{level}")
        poor, begins = F.col("load") < FULL * capacity, (F.col("offset") == 0).cast("long")
        sequences, again, left = packed.agg(
            F.sum(begins), F.count_if(poor), F.coalesce(F.sum(F.when(poor, begins)), F.lit(0))
        ).first()
        if before is not None and sequences >= before:
            done.append(earlier.select(*columns))
            break
        last = again == 0 or n <= GROUP
        done.append((packed if last else packed.where(~poor)).select(*columns))
        earlier, before = packed.where(poor), left
        todo, n = earlier.select("uid", "length"), 0 if last else again
    places = done[0]
    for other in done[1:]:
        places = places.unionByName(other)
    # Whole pieces have the number of their row, the others numbers below zero.
    number = -(F.col("level") + (1 << 16) * (F.col("sequence") + (1 << 20) * F.col("group")))
    sequence = F.when(F.col("level") == 0, F.col("group")).otherwise(number)
    return pieces.join(places.withColumn("sequence_id", sequence), "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
