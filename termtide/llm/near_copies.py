"""Near copies of documents by order MinHash and banded alignment.

The shingles of five words of a text are labelled with their occurrence number, so that each is
unique.  A sketch has ``KEYS`` keys; a key takes the ``LEAST`` labelled shingles of the least hash under a
seed of its own, in text order, so that texts share it only if they share these shingles in
the same order.  Texts that share a key are candidates.

Equal texts are folded into one before anything else.  The texts of a key are compared in one
place: those whose common shingles could be 0.8 of all of theirs are aligned within the band that such a
pair cannot leave (the longest run of common shingles in the order of both, over all shingles of both,
must reach ``SIMILARITY``).  Pairs that are already connected there are not aligned, and a pair is
looked at under its first common key only, so a key of n texts yields less than n links.  Keys of more than
``BLOCK`` texts, or of more than ``BLOCK_BYTES`` of text, are split into blocks, and every pair of blocks is
a place of its own: no pair is left out, and no place holds more than two blocks.  Classes are the connected components of the links.

Null text is empty.  Equal texts, also empty ones, are one class; texts without words are only like
equal texts, those of fewer than five words have one shingle.  Repeated rows are in one class; the
class is named by its least doc_id (null counts as the least possible one).
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termtide.llm.common import U64, bytes_of, mix, runs, shingles, stored

KEYS = 10
LEAST = 2
SIMILARITY = 0.8
BLOCK = 1024
BLOCK_BYTES = 16 << 20
_NULL_ID = -(2**63)
_MOST = U64(0xFFFFFFFFFFFFFFFF)


def labelled_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of occurrence-labelled shingles in text order, and where each row starts."""
    data, starts = bytes_of(texts)
    value, bounds = shingles(data, starts)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(bounds))
    order = np.lexsort((value, row))  # stable: equal shingles of a row stay in text order
    v, r = value[order], row[order]
    new = np.ones(len(order), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    occurrence = np.empty(len(order), np.int64)
    occurrence[order] = np.arange(len(order)) - first
    return mix(value + occurrence.astype(U64) * U64(0x9E3779B97F4A7C15)), bounds


def order_sketch(labelled: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``KEYS`` keys for each row; a row without shingles has zeros."""
    n = len(bounds) - 1
    count = np.diff(bounds)
    some = np.flatnonzero(count)
    row = np.repeat(np.arange(len(some)), count[some])
    begin = bounds[:-1][some]
    out = np.zeros((n, KEYS), U64)
    if not len(some):
        return out
    for k in range(KEYS):
        value = mix(labelled + U64(0xA0761D6478BD642F * (k + 1) % (1 << 64)))
        chosen = np.full((len(some), LEAST), len(value), np.int64)
        for i in range(LEAST):
            least = np.minimum.reduceat(value, begin)
            hits = np.flatnonzero(value == least[row])
            chosen[row[hits[::-1]], i] = hits[::-1]
            value[chosen[:, i]] = _MOST
        chosen[count[some] < LEAST] = np.sort(np.minimum(chosen[count[some] < LEAST], begin[count[some] < LEAST][:, None]), axis=1)
        chosen.sort(axis=1)
        key = np.full(len(some), k, U64)
        for i in range(LEAST):
            key = mix(key * U64(0x2545F4914F6CDD1D) + labelled[chosen[:, i]])
        out[some, k] = key
    return out


def alignment(a: np.ndarray, b: np.ndarray, at_least: float = SIMILARITY) -> float:
    """Similarity of two rows of labelled shingles: common ones in the order of both, over all.

    A pair that reaches ``at_least`` leaves at most (1 - s) / (1 + s) of its shingles
    unmatched, so its matches lie within that band around the diagonal.
    """
    total = len(a) + len(b)
    if not total:
        return 1.0
    band = total * (1 - at_least) / (1 + at_least) + 1e-9
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    tails: list[int] = []  # least end of an increasing run of each length
    for x in i[np.argsort(j)].tolist():
        at = bisect_left(tails, x)
        if at == len(tails):
            tails.append(x)
        else:
            tails[at] = x
    return len(tails) / (total - len(tails))


def _sketcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = []
        starts = bytes_of(batch.column("text"))[1]
        for low, high in runs(starts):
            keys.append(order_sketch(*labelled_shingles(batch.column("text").slice(low, high - low))))
        flat = np.concatenate(keys).view(np.int64) if keys else np.zeros((0, KEYS), np.int64)
        shape = pa.FixedSizeListArray.from_arrays(pa.array(flat.reshape(-1)), KEYS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(np.diff(starts)), shape.cast(pa.list_(pa.int64()))],
            names=["doc_id", "digest", "size", "keys"],
        )


class _Place:
    """The texts that meet under one key (or in one pair of its blocks)."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.keys: list[list[int]] = []
        self.block: list[int] = []
        self.rows: list[np.ndarray] = []

    def links(self, number: int, split: bool) -> list[tuple[int, int]]:
        """Links that connect what is similar; ``number`` is that of the key."""
        n = len(self.rows)
        if n < 2:
            return []
        sizes = np.array([len(r) for r in self.rows])
        group = list(range(n))

        def root(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        labels, inverse = np.unique(np.concatenate(self.rows), return_inverse=True)
        member = np.repeat(np.arange(n), sizes)
        order = np.argsort(inverse, kind="stable")
        sorted_members = member[order]  # postings: members of each label, in their order
        ends = np.cumsum(np.bincount(inverse, minlength=len(labels)))
        begins = np.concatenate(([0], ends[:-1]))
        position = np.empty(len(order), np.int64)
        position[order] = np.arange(len(order))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        keys = np.array(self.keys)
        block = np.array(self.block)
        found = []
        for x in range(1, n):
            at = slice(offsets[x], offsets[x + 1])
            # The postings before x's own are those of earlier members.
            low, high = begins[inverse[at]], position[at]
            length = high - low
            total = int(length.sum())
            if not total:
                continue
            index = np.repeat(high - np.cumsum(length), length) + np.arange(total)
            common = np.bincount(sorted_members[index], minlength=x)[:x]
            able = common >= SIMILARITY * (sizes[x] + sizes[:x] - common) - 1e-9
            if split:
                able &= block[:x] != block[x]
            able &= ~(keys[:x, :number] == keys[x, :number]).any(axis=1)
            for y in np.flatnonzero(able).tolist():
                a, b = root(x), root(y)
                if a != b and alignment(self.rows[x], self.rows[y]) >= SIMILARITY:
                    group[a] = b
                    found.append((self.nodes[y], self.nodes[x]))
        return found


def _linker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by place; a place may go on in the next batch."""
    place, at = _Place(), None
    found: list[tuple[int, int]] = []

    def finish() -> None:
        if at is not None:
            found.extend(place.links(at[1], at[2] != at[3]))

    for batch in batches:
        places = list(zip(*(batch.column(c).to_pylist() for c in ("key", "number", "low", "high"))))
        nodes, keys, block = (batch.column(c).to_pylist() for c in ("node", "keys", "block"))
        texts = batch.column("text")
        for low, high in runs(bytes_of(texts)[1]):
            labelled, bounds = labelled_shingles(texts.slice(low, high - low))
            for i in range(low, high):
                if places[i] != at:
                    finish()
                    place, at = _Place(), places[i]
                if nodes[i] in place.nodes[-1:]:  # a repeated row
                    continue
                place.nodes.append(nodes[i])
                place.keys.append(keys[i])
                place.block.append(block[i])
                place.rows.append(labelled[bounds[i - low] : bounds[i - low + 1]].copy())
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            found.clear()
    finish()
    if found:
        a, b = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node that it is connected with.

    Alternating large and small stars: every node hooks its larger neighbours to the
    least one, then its smaller ones, until only stars are left.
    """
    edges = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        edges = (  # large star: larger neighbours go to the least of all
            both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        )
        edges = stored(edges, "large-star")
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        edges = (  # small star: smaller neighbours, and the node itself, go to the least of them
            edges.join(least, "b")
            .select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(edges, "small-star")
        seen = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == mark:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        mark = seen


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, digest, kept), a row for each document.

    Digest tells equal texts; kept are the rows of the first document of each class.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("digest"),
        "text",
    )
    sketches = stored(
        rows.mapInArrow(_sketcher, "doc_id long, digest binary, size long, keys array<long>"), "sketches"
    )
    ident = F.coalesce(F.col("doc_id"), F.lit(_NULL_ID))
    nodes = stored(
        sketches.groupBy("digest")
        .agg(F.min(ident).alias("least_id"), F.first("size").alias("size"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()),
        "texts",
    )
    keyed = nodes.select(
        "node", "digest", "least_id", "size", "keys", F.posexplode("keys").alias("number", "key")
    ).where(F.col("key") != 0)
    # A text larger than a block counts as one: it can be split no further.
    filled = F.sum(F.least("size", F.lit(BLOCK_BYTES))).alias("filled")
    shared = keyed.groupBy("key", "number").agg(F.count("*").alias("count"), filled).where("count > 1")
    blocks = F.ceil(F.greatest(F.col("count") / BLOCK, F.col("filled") / BLOCK_BYTES)).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    places = F.transform(
        others,
        lambda o: F.struct(
            "key", "number", F.least("block", o).alias("low"), F.greatest("block", o).alias("high"), "block"
        ),
    )
    members = (
        keyed.join(shared, ["key", "number"])
        .withColumn("blocks", blocks)
        .withColumn("block", block)
        .select("node", "digest", "least_id", "keys", F.explode(places).alias("place"))
        .groupBy("node", "digest", "least_id")  # as many places as keys and blocks
        .agg(F.first("keys").alias("keys"), F.collect_list("place").alias("places"))
    )
    texts = (
        rows.withColumn("least_id", ident)
        .join(members, ["digest", "least_id"])
        .select("node", "keys", "text", F.explode("places").alias("place"))
        .select("place.*", "node", "keys", F.coalesce("text", F.lit("")).alias("text"))
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "number", "low", "high", "node")
    )
    links = texts.mapInArrow(_linker, "a long, b long")
    roots = components(spark, links)
    named = nodes.join(roots, "node", "left").select(
        "digest", "least_id", F.coalesce("root", "node").alias("root")
    )
    first = F.min(F.struct("least_id", "digest")).alias("first")
    found = named.join(named.groupBy("root").agg(first), "root").select(
        "digest", "first.least_id", (F.col("digest") == F.col("first.digest")).alias("chosen")
    )
    class_id = F.col("least_id")
    return sketches.select("doc_id", "digest").join(found, "digest").select(
        "doc_id",
        F.when(class_id != _NULL_ID, class_id).alias("class_id"),
        "digest",
        (F.col("chosen") & (ident == class_id)).alias("kept"),
    )


def first_of_classes(docs: DataFrame) -> DataFrame:
    """The documents with one, the first, of each class of near copies."""
    chosen = near_copies(docs).where("kept").select(
        F.coalesce("doc_id", F.lit(_NULL_ID)).alias("_id"), F.col("digest").alias("_digest")
    )
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("_id"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("_digest"),
        F.struct(*docs.columns).alias("_row"),
    )
    once = Window.partitionBy("_id", "_digest").orderBy(F.xxhash64("_row"))
    return (
        rows.join(chosen.distinct(), ["_id", "_digest"])
        .withColumn("_nth", F.row_number().over(once))
        .where("_nth = 1")
        .select("_row.*")
    )
