"""Removal of long repeats by a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
doc_id.  Strings are those of the whole UTF-8 texts as they came; matches do not cross documents.

*Sparse suffixes.*  Of the ``LENGTH - K + 1`` runs of ``K`` bytes in a string the one of least hash (the
leftmost of equals) is its anchor; equal strings have equal anchors at the same place.  The
strings that share an anchor are consecutive and form a stretch, the unit of the index.  Its order
in a suffix array is by the anchor's hash, then by the hash of the whole stretch.

*First scan.*  Stretches are dealt to buckets by anchor.  In a bucket every batch gets a sorted array,
is scanned against the levels that are there, and becomes a level itself; levels of like size are merged, so
n batches make about log n levels.  A level keeps the least doc_id of each stretch.  A stretch
that a smaller document has too goes whole; one whose anchor no smaller document has stays.

*Second scan.*  What is left are stretches that differ from those of smaller documents but have the same anchor
and, on the one or the other side of it, the same ``HALF`` bytes, as all equal strings do.  Their texts are
fetched, every string of ``LENGTH`` bytes in them goes to a suffix array in byte order, and again
batches, in the order of doc_id, are scanned against levels that merge geometrically.

A passage that is in very many documents is reduced to one stretch per batch of texts before it moves.

Null text is empty.  Documents of fewer than ``LENGTH`` bytes lose nothing.  A null doc_id counts as less than
any other.  Every row has a number of its own, by which its places are joined; rows of the same doc_id, or of
none, may have different texts, and lose nothing to each other.
Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import POWERS, U64, bytes_of, mix, runs, stored

LENGTH = 50
K = 16
WINDOW = LENGTH - K + 1
HALF = (LENGTH - K + 1) // 2
NO_SIDE = 4095
ANCHOR_BITS, STRETCH_BITS = 28, 36
BATCH = 1 << 16  # stretches, or strings, of one batch of the index
BUCKET_BYTES = 16 << 20  # of text for each bucket
CHUNK = 2 << 20
_NULL_ID = -(2**63)
_SPAN = np.dtype([("at", "<u4"), ("n", "u1")])
_OPEN = np.dtype([("anchor", "<u8"), ("at", "<u4"), ("n", "u1")])


class Levels:
    """A family of sorted arrays of (key, least number), merged whenever two are of like size."""

    def __init__(self, kind) -> None:
        self.kind = kind
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def sorted(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys in order, with the least number of each."""
        order = np.argsort(keys, kind="stable")
        keys, numbers = keys[order], numbers[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        begin = np.flatnonzero(first)
        return keys[begin], np.minimum.reduceat(numbers, begin) if len(begin) else numbers

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """The least number of each key over all levels, or the largest number there is."""
        least = np.full(len(keys), np.iinfo(np.int64).max)
        for held, numbers in self.levels:
            at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
            hit = held[at] == keys
            least[hit] = np.minimum(least[hit], numbers[at[hit]])
        return least

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Make a batch a level; it takes up all levels that are not larger than it has become."""
        if not len(keys):
            return
        new = self.sorted(keys, numbers)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(new[0]):
            held = self.levels.pop()
            new = self.sorted(*(np.concatenate(pair) for pair in zip(held, new)))
        self.levels.append(new)

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.levels:
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        return self.sorted(*(np.concatenate(pair) for pair in zip(*self.levels)))


class Stretches:
    """The stretches of some texts: row, first string, number of strings, and their hashes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        n = len(data)
        lengths = np.diff(starts)
        strings = np.maximum(lengths - LENGTH + 1, 0)
        if not strings.any():
            self.row = self.at = self.n = np.zeros(0, np.int64)
            self.anchor = self.stretch = np.zeros(0, U64)
            self.left = self.right = np.zeros(0, np.int64)
            return
        up, down = POWERS.upto(n + 1)
        sums = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=sums[1:])

        def span(begin, end):
            return (sums[end] - sums[begin]) * down[begin]

        anchors = mix((sums[K:] - sums[:-K]) * down[: n - K + 1])
        least = (anchors & U64(0xFFFFFFFF00000000)) | np.arange(n - K + 1, dtype=U64)
        size = 1
        while 2 * size <= WINDOW:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if WINDOW > size:
            least = np.minimum(least[: -(WINDOW - size)], least[WINDOW - size :])
        place = (least & U64(0xFFFFFFFF)).astype(np.int64)
        step = np.zeros(n + 1, np.int64)
        some = strings > 0
        np.add.at(step, starts[:-1][some], 1)
        np.add.at(step, (starts[:-1] + strings)[some], -1)
        whole = np.cumsum(step)[: len(place)] > 0
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        new[starts[:-1][some]] = True
        begin = np.flatnonzero(whole & new)
        row = np.searchsorted(starts, begin, "right") - 1
        last = np.minimum(np.append(begin[1:], n) - 1, (starts[:-1] + strings - 1)[row])
        p = place[begin]
        self.row, self.at, self.n = row, begin - starts[row], last - begin + 1
        self.anchor = anchors[p]
        self.stretch = mix(span(begin, last + LENGTH) + (last - begin).astype(U64))
        side = lambda a, b: (mix(span(a, b)) % U64(NO_SIDE)).astype(np.int64)
        lefts, rights = p - begin >= HALF, last + LENGTH - p - K >= HALF
        self.left = np.full(len(p), NO_SIDE)
        self.left[lefts] = side(p[lefts] - HALF, p[lefts])
        self.right = np.full(len(p), NO_SIDE)
        self.right[rights] = side(p[rights] + K, p[rights] + K + HALF)


def _spans_of(ids: np.ndarray, at: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Packed spans by document."""
    order = np.argsort(ids, kind="stable")
    packed = np.zeros(len(ids), _SPAN)
    packed["at"], packed["n"] = at[order], n[order]
    ids = ids[order]
    begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else []
    for low, high in zip(begin, [*begin[1:], len(ids)]):
        yield int(ids[low]), packed[low:high].tobytes()


_ENTRIES = ["key", "sides", "side_high", "doc", "at_low", "at_high", "n"]
_DEALT = "bucket long, uids binary, doc_ids binary, " + ", ".join(f"{c} binary" for c in _ENTRIES)
_DEALT_NAMES = ["bucket", "uids", "doc_ids", *_ENTRIES]


def _dealer(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches by bucket; what a smaller document of the same batch has goes as spans (no entries)."""
        for batch in batches:
            all_ids, all_uids = batch.column("doc_id").to_numpy(), batch.column("uid").to_numpy()
            raws = [_raw(p) for p in batch.column("packed").to_pylist()]
            data, starts = bytes_of(pa.array(raws, pa.large_binary()))
            for low, high in runs(starts, CHUNK):
                ids, uids = all_ids[low:high], all_uids[low:high]
                s = Stretches(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low])
                bucket = (s.anchor >> U64(ANCHOR_BITS)) % U64(buckets)
                key = (s.anchor << U64(STRETCH_BITS)) | (s.stretch >> U64(64 - STRETCH_BITS))
                order = np.lexsort((ids[s.row], key, bucket))
                k, d = key[order], ids[s.row][order]
                same = np.zeros(len(order), bool)
                same[1:] = (k[1:] == k[:-1]) & (bucket[order][1:] == bucket[order][:-1])
                first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
                gone = d > d[first] if len(order) else same
                rows = []
                for uid, spans in _spans_of(uids[s.row[order[gone]]], s.at[order[gone]], s.n[order[gone]]):
                    rows.append((hash(uid) % buckets, uid.to_bytes(8, "little"), None, spans, *[None] * 6))
                order = order[~gone]
                at_bucket = bucket[order]
                begin = np.flatnonzero(np.append(True, at_bucket[1:] != at_bucket[:-1])) if len(order) else []
                for a, b in zip(begin, [*begin[1:], len(order)]):
                    e = order[a:b]
                    docs, doc = np.unique(s.row[e], return_inverse=True)
                    sides = s.left[e] | s.right[e] << 12
                    rows.append(
                        (
                            int(at_bucket[a]),
                            uids[docs].astype("<i8").tobytes(),
                            np.diff(ids[docs], prepend=0).astype("<i8").tobytes(),
                            key[e].tobytes(),
                            (sides & 0xFFFF).astype("<u2").tobytes(),
                            (sides >> 16).astype("u1").tobytes(),
                            doc.astype("<u4").tobytes() if len(docs) > 65535 else doc.astype("<u2").tobytes(),
                            (s.at[e] & 0xFFFF).astype("<u2").tobytes(),
                            (s.at[e] >> 16).astype("<u2").tobytes(),
                            s.n[e].astype("u1").tobytes(),
                        )
                    )
                if rows:
                    kinds = [pa.int64(), *[pa.binary()] * 9]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_DEALT_NAMES
                    )

    return run


def _sides(key: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Whether another stretch has the same anchor and the same bytes on this side."""
    shared = np.zeros(len(key), bool)
    valid = np.flatnonzero(side != NO_SIDE)
    pair = (key[valid] >> U64(STRETCH_BITS)) << U64(12) | side[valid].astype(U64)
    _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
    shared[valid] = count[inverse] > 1
    return shared


class _Bucket:
    def __init__(self, number: int) -> None:
        self.number = number
        self.parts: list[tuple] = []
        self.levels = Levels(U64)
        self.batch: list[tuple] = []
        self.size = 0

    def add(self, row: dict) -> None:
        at = lambda c, t: np.frombuffer(row[c], t)
        key = at("key", "<u8")
        docs = np.cumsum(at("doc_ids", "<i8"))
        doc = at("doc", "<u4" if len(docs) > 65535 else "<u2")
        sides = at("sides", "<u2").astype(np.int64) | at("side_high", "u1").astype(np.int64) << 16
        place = at("at_low", "<u2").astype(np.int64) | at("at_high", "<u2").astype(np.int64) << 16
        part = (key, docs[doc], at("uids", "<i8")[doc], sides, place, at("n", "u1"))
        self.parts.append(part)
        self.batch.append(part[:2])
        self.size += len(key)
        if self.size >= BATCH:
            self.close_batch()

    def close_batch(self) -> None:
        if self.batch:
            self.levels.add(*(np.concatenate(x) for x in zip(*self.batch)))
        self.batch, self.size = [], 0

    def settle(self) -> Iterator[tuple[int, bytes | None, bytes | None]]:
        """(uid, spans that go, stretches to look at) from the finished levels."""
        if not self.parts:
            return
        self.close_batch()
        key, doc, uid, sides, at, n = (np.concatenate(x) for x in zip(*self.parts))
        keys, least = self.levels.whole()
        place = np.searchsorted(keys, key)
        first = np.zeros(len(keys), np.int64)
        first[place[::-1]] = np.arange(len(key))[::-1]
        like = sides == sides[first][place]
        gone = (least[place] < doc) & like
        left, right = sides[first] & 4095, sides[first] >> 12
        look = (_sides(keys, left) | _sides(keys, right))[place] & ~gone | ~like
        for one, spans in _spans_of(uid[gone], at[gone], n[gone]):
            yield one, spans, None
        packed = np.zeros(int(look.sum()), _OPEN)
        anchors = U64(self.number) << U64(ANCHOR_BITS) | key[look] >> U64(STRETCH_BITS)
        packed["anchor"], packed["at"], packed["n"] = anchors, at[look], n[look]
        ids = uid[look]
        order = np.argsort(ids, kind="stable")
        ids, packed = ids[order], packed[order]
        begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else []
        for low, high in zip(begin, [*begin[1:], len(ids)]):
            yield int(ids[low]), None, packed[low:high].tobytes()


def _settler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket."""
    bucket = _Bucket(-1)

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
            names=["uid", "spans", "open"],
        )

    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["n"] is None:
                rows.append((int.from_bytes(row["uids"], "little"), row["key"], None))
                continue
            if row["bucket"] != bucket.number:
                rows += bucket.settle()
                bucket = _Bucket(row["bucket"])
            bucket.add(row)
        if rows:
            yield out(rows)
    rows = list(bucket.settle())
    if rows:
        yield out(rows)


_CODEC = pa.Codec("zstd", 3)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, each after its length; they move more than once."""
    for batch in batches:
        packed, sizes = [], []
        for text in batch.column("text").to_pylist():
            raw = (text or "").encode()
            sizes.append(len(raw))
            packed.append(len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True))
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid"), batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())],
            names=["uid", "doc_id", "packed", "size"],
        )


def _raw(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return _CODEC.decompress(packed[8:], size, asbytes=True) if size else b""


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the stretches that have to be looked at."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            raw = _raw(row["packed"])
            for part in row["open"]:
                for anchor, at, n in np.frombuffer(part, _OPEN).tolist():
                    rows.append((anchor - (1 << 63), row["uid"], row["doc_id"], at, raw[at : at + n - 1 + LENGTH]))
        if rows:
            kinds = (*[pa.int64()] * 4, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["anchor", "uid", "doc_id", "at", "bytes"]
            )


def _matcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of each batch against those of smaller documents; rows come sorted by doc_id."""
    levels = Levels(f"S{LENGTH}")
    held: list[tuple] = []
    size = 0

    def scan() -> Iterator[pa.RecordBatch]:
        raw = np.frombuffer(b"".join(x[3] for x in held), np.uint8)
        lengths = np.array([len(x[3]) for x in held])
        n = lengths - LENGTH + 1
        first = np.repeat(np.cumsum(lengths) - lengths, n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        strings = raw[(first + inner)[:, None] + np.arange(LENGTH)].reshape(-1).view(f"S{LENGTH}")
        uids, docs, at = (np.repeat(np.array([x[i] for x in held], np.int64), n) for i in range(3))
        at = at + inner
        own = Levels.sorted(strings, docs)  # the suffix array of the batch
        smallest = np.minimum(own[1], levels.scan(own[0]))
        gone = smallest[np.searchsorted(own[0], strings)] < docs
        levels.add(*own)
        found = list(_spans_of(uids[gone], at[gone], np.ones(int(gone.sum()), np.uint8)))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())],
                names=["uid", "spans"],
            )

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "at", "bytes"))):
            held.append(row)
            size += len(row[3]) - LENGTH + 1
            if size >= BATCH:
                yield from scan()
                held, size = [], 0
    if held:
        yield from scan()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            raw = _raw(row["packed"])
            removed = runs_removed = 0
            kept = raw
            if row["spans"]:
                step = np.zeros(len(raw) + 1, np.int32)
                for part in row["spans"]:
                    spans = np.frombuffer(part, _SPAN)
                    at = spans["at"].astype(np.int64)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + spans["n"] - 1 + LENGTH, -1)
                gone = np.cumsum(step)[:-1] > 0
                removed = int(gone.sum())
                runs_removed = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows.append((row["doc_id"], len(raw), removed, runs_removed, hashlib.sha256(kept).hexdigest()))
        if rows:
            kinds = (*[pa.int64()] * 4, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(uid, spans): packed places of the strings of each row of ``_rows`` that a smaller document has too."""
    spark = rows.sparkSession
    size = rows.agg(F.sum("size")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-size // BUCKET_BYTES))
    packed = rows.select("uid", "doc_id", "packed")
    first = stored(
        packed.mapInArrow(_dealer(buckets), _DEALT)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_settler, "uid long, spans binary, open binary"),
        "first-scan",
    )
    opened = first.where(F.col("open").isNotNull()).groupBy("uid").agg(F.collect_list("open").alias("open"))
    second = (
        packed.join(opened, "uid")
        .mapInArrow(_fetch, "anchor long, uid long, doc_id long, at long, bytes binary")
        .repartition(buckets, "anchor")
        .sortWithinPartitions("doc_id")
        .mapInArrow(_matcher, "uid long, spans binary")
    )
    return first.where(F.col("spans").isNotNull()).select("uid", "spans").unionByName(second)


def _rows(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, packed, size): every row of the input with a number of its own, stored."""
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))
    rows = docs.select(ident.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    squeezed = rows.mapInArrow(_squeeze, "uid long, doc_id long, packed binary, size long")
    return stored(squeezed, "texts")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each document."""
    rows = _rows(docs)
    spans = repeated_spans(rows).groupBy("uid").agg(F.collect_list("spans").alias("spans"))
    out = rows.select("uid", "doc_id", "packed").join(spans, "uid", "left").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")))
