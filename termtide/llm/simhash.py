"""SimHash near copies: whole fingerprints compared bit plane by bit plane.

The fingerprint of a text is taken over its three-word shingles (ASCII letters in lower case, words
are what stands between ASCII white space, repeats count; a text of fewer words is one shingle): bit
b is set if it is set in more than half of the shingles' XXH64 values (seed 42).  Fingerprints that
differ in at most ``RADIUS`` bits are linked, and a document's component is named by the least doc_id
that it is connected with.

Copies are one fingerprint from the start, so they never meet each other.  The distinct fingerprints
are dealt out by all pairs of four 16-bit words: two that differ in two bits agree in two of the words.
A place of more than ``PLACE`` fingerprints is dealt out once more, by six of the eight nibbles that
are left; such a place holds at most 256, as all else is equal.  So the work at one place is bounded whatever
the data, a fingerprint goes to 6 places (168 at most), and no link is lost.

Within a place the fingerprints stand vertically: plane b holds bit b of 64 fingerprints in each
word.  A fingerprint is compared with the words of its place after it: for every plane the differing bits
are added to two carry-save counter words and one that says "more than the radius"; after some planes,
words in which every lane is beyond the radius are abandoned.  A place gives a star per connected group,
fewer links than it has fingerprints.

Null and empty texts, and texts of white space alone, have the fingerprint zero, which links like any
other.  A null doc_id is passed on; a component of such rows alone has no id.  Repeated rows are rows of
their own.  No rows give no rows.  Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import stored
from termtide.llm.near_copies import components

RADIUS = 2
SHINGLE = 3
SEED = 42
PLACE = 4096
_SHINGLES_AT_ONCE = 1 << 14
_PAIRS_AT_ONCE = 1 << 17
_PLANES_AT_ONCE = 8
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text in UTF-8."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    last = min(SHINGLE, len(words)) - 1
    begins, ends = begins[: len(words) - last].tolist(), ends[last:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, len(ends), _SHINGLES_AT_ONCE):
        part = slice(low, low + _SHINGLES_AT_ONCE)
        values = np.array([digest(joined[a:b], SEED) for a, b in zip(begins[part], ends[part])], "<u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(ends), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        values = [fingerprint(texts[i].as_py() or b"") for i in range(len(texts))]
        signed = np.array(values, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"])


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit b of fingerprint 64 * w + i as bit i of word [b, w]; lanes beyond the last are zero."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((64, -(-len(fps) // 64) * 64), np.uint8)
    padded[:, : len(fps)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def near_pairs(fps: np.ndarray, place_end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) within the radius, i < j < place_end[i]; places are runs of rows."""
    sliced = planes(fps)
    row = np.arange(len(fps))
    first_word, last_word = (row + 1) >> 6, (place_end - 1) >> 6
    n_words = np.where(place_end > row + 1, last_word - first_word + 1, 0)
    low = 0
    while low < len(fps):
        total = np.cumsum(n_words[low:])
        high = low + max(1, int(np.searchsorted(total, _PAIRS_AT_ONCE, "right")))
        left = np.repeat(row[low:high], n_words[low:high])
        begun = np.cumsum(n_words[low:high]) - n_words[low:high]
        word = np.arange(len(left)) - np.repeat(begun, n_words[low:high]) + first_word[left]
        # Lanes that are not compared count as beyond the radius from the start.
        lanes = np.full(len(left), _ALL)
        after = np.maximum(left + 1 - (word << 6), 0).astype(np.uint64)
        lanes &= _ALL << after
        until = place_end[left] - (word << 6)
        lanes &= np.where(until >= 64, _ALL, (np.uint64(1) << np.minimum(until, 63).astype(np.uint64)) - np.uint64(1))
        beyond, ones, twos = ~lanes, np.zeros_like(lanes), np.zeros_like(lanes)
        value = fps[left]
        for b in range(64):
            differs = sliced[b][word] ^ (np.uint64(0) - ((value >> np.uint64(b)) & np.uint64(1)))
            carry = ones & differs
            ones ^= differs
            beyond |= twos & carry  # 3 + 1
            twos |= carry
            if RADIUS < 3:
                beyond |= twos & ones  # 3
            if b % _PLANES_AT_ONCE == _PLANES_AT_ONCE - 1:
                alive = np.flatnonzero(beyond != _ALL)
                if len(alive) < len(left):
                    left, word, value = left[alive], word[alive], value[alive]
                    beyond, ones, twos = beyond[alive], ones[alive], twos[alive]
                if not len(left):
                    break
        if len(left):
            near = np.unpackbits((~beyond).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(near)
            yield left[pair], (word[pair] << 6) + lane
        low = high


def stars(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links (least member, member) that connect just what the given ones connect."""
    root = np.arange(n)
    for a, b in links:
        while True:
            x, y = root[a], root[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            if (low == high).all():
                break
            np.minimum.at(root, high, low)
            while not np.array_equal(root, up := root[root]):
                root = up
    member = np.flatnonzero(root != np.arange(n))
    return root[member], member


_KEY = ("words", "agreed", "nibbles", "detail")


def _linker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by place; whole places are compared, many small ones at once."""

    def links(part: list[np.ndarray]) -> pa.RecordBatch:
        keys, fps = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
        begins = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        end = np.repeat(np.concatenate((begins[1:], [len(fps)])), np.diff(np.concatenate((begins, [len(fps)]))))
        a, b = stars(len(fps), near_pairs(fps, end))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], names=["a", "b"]
        )

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _KEY], axis=1)
        fps = batch.column("fp").to_numpy().view(np.uint64)
        held.append((keys, fps))
        if sum(len(h[1]) for h in held) < 2 * PLACE:
            continue
        keys, fps = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        cut = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut:
            yield links([(keys[:cut], fps[:cut])])
        held = [(keys[cut:], fps[cut:])]
    if held:
        yield links(held)


def _mask(fp: Column, units: tuple[int, ...], width: int) -> Column:
    """The bits of some units of ``width`` bits, all others zero."""
    mask = sum(((1 << width) - 1) << (u * width) for u in units)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def _places(fps: DataFrame) -> DataFrame:
    fp = F.col("fp")
    pairs = list(combinations(range(4), 2))
    coarse = fps.select(
        "fp",
        F.inline(
            F.array(*(F.struct(F.lit(i).alias("words"), _mask(fp, p, 16).alias("agreed")) for i, p in enumerate(pairs)))
        ),
    )
    crowded = coarse.groupBy("words", "agreed").count().where(F.col("count") > PLACE).select(
        "words", "agreed", F.lit(True).alias("crowded")
    )
    plain = F.array(F.struct(F.lit(-1).alias("nibbles"), F.lit(0).cast("long").alias("detail")))
    fine = None
    for i, pair in enumerate(pairs):
        free = [n for w in range(4) if w not in pair for n in range(4 * w, 4 * w + 4)]
        options = F.array(
            *(
                F.struct(F.lit(k).alias("nibbles"), _mask(fp, kept, 4).alias("detail"))
                for k, kept in enumerate(combinations(free, 6))
            )
        )
        fine = F.when(F.col("words") == i, options) if fine is None else fine.when(F.col("words") == i, options)
    # The rows of crowded places are many, those places themselves few: a join that splits hot keys.
    return coarse.join(crowded, ["words", "agreed"], "left").select(
        "fp", "words", "agreed", F.inline(F.when(F.col("crowded"), fine).otherwise(plain))
    )


def simhash_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each document."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(rows.mapInArrow(_fingerprints, "doc_id long, fp long"), "simhashes")
    distinct = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-values")
    places = _places(distinct.select("fp")).repartition(*_KEY).sortWithinPartitions(*_KEY, "fp").select(*_KEY, "fp")
    roots = components(spark, places.mapInArrow(_linker, "a long, b long"))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("fp", "component_id")
    return found.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
