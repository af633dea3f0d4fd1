"""The trie of conversation prefixes, from padded matrices of turn ids.

Conversations share their beginnings; a node is a distinct sequence of first turns, and it tells how many
conversations start with it and how many words of theirs need to be worked on only once.

Turns get the 128-bit digest of role and text as id.  A conversation becomes segments of ``WIDTH`` turns, each with a
digest of all segments before it, so a conversation of any length is worked on in rows of bounded size; segments of equal content
and equal past are one row with a count, so a conversation that occurs in a third of all rows is one row.  Segments are
range-sharded by (block, past, ids) and come to numpy in chunks of ``CELLS`` cells: a padded matrix of ids is
sorted with one lexsort, the change masks of neighbouring rows, or-accumulated from the first column on, mark where a node
starts at each depth, and ``reduceat`` between the marks gives the sums of every node of that depth.

A node is whole within its chunk unless it holds the chunk's first or last row.  Those are summed over chunks; what two
neighbouring chunks both counted, the common prefix of the rows at their border, is taken off again.  Sums of
a subtree that reaches into later segments come down along the segments of one conversation of it.

Words saved below a node are the words of its conversations from there on less the words of its distinct nodes,
both sums over rows, so no node needs to know its descendants.

A missing role or text is empty.  Turns of equal number are ordered by the MD5 of role and text; repeated rows are turns of
their own.  Rows without a conv_id belong to no conversation.  No rows give no nodes, not even a root.  Further
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.common import U64, mix, stored

WIDTH = 256
CELLS = 1 << 20
SHARD_CELLS = 1 << 21
TURNS_PER_RANGE = 1 << 20
IDS_PER_CHUNK = 1 << 14
SHARED = 20
HEADS = 4
_PAD = -(1 << 63)
_ODD = U64(0x9E3779B97F4A7C15)
EMPTY = hashlib.sha256().hexdigest()


# --- numbering turns ----------------------------------------------------------


def _numberer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each conversation within the range; rows come sorted."""
    last, count = None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        new = np.concatenate(([last is None or ids[0] != last], ids[1:] != ids[:-1]))
        first = np.flatnonzero(new)
        row = np.arange(len(ids))
        begin = np.zeros(len(ids), np.int64)
        begin[first] = first
        begin = np.maximum.accumulate(begin)
        place = row - begin
        place[: first[0] if len(first) else len(ids)] += count
        last, count = ids[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])


def numbered(turns: DataFrame) -> DataFrame:
    """Turns with their place in the conversation, from 0; a conversation may span many ranges."""
    ranges = max(1, -(-turns.count() // TURNS_PER_RANGE))
    order = ["conv_id", F.asc_nulls_first("turn"), "id", "tie"]
    sorted_ = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    local = stored(
        sorted_.select("conv_id", "id", "words", F.spark_partition_id().alias("range")).mapInArrow(
            _numberer, "conv_id long, id string, words long, range int, place long"
        ),
        "trie-turns",
    )
    # A row for each range: the conversation that it begins with may have begun before.
    edges = local.groupBy("range").agg(F.min("conv_id"), F.max(F.struct("conv_id", "place"))).orderBy("range").collect()
    before, conv, count = [], None, 0
    for number, first, (final, place) in edges:
        start = count if first == conv else 0
        if start:
            before.append((number, first, start))
        count = place + 1 + (start if first == final else 0)
        conv = final
    offsets = turns.sparkSession.createDataFrame(before, "range int, conv_id long, start long")
    return local.join(F.broadcast(offsets), ["range", "conv_id"], "left").select(
        "conv_id", "id", "words", (F.col("place") + F.coalesce("start", F.lit(0))).alias("place")
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, place, id, words): the first turns of the shared conversation, then the own ones after as many.

    Conversations without a turn have one row whose place is null.
    """
    base = F.col("conv_id") - F.col("conv_id") % SHARED
    n_heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    heads = (
        turns.where((F.col("place") < HEADS - 1) & (F.col("conv_id") % SHARED == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "words"))).alias("heads"))
    )
    taken = F.when(F.col("heads").isNull(), F.lit(0)).otherwise(F.least(F.size("heads"), n_heads))
    own = (
        turns.withColumn("base", base)
        .join(heads, "base", "left")
        .where(F.col("place") >= n_heads)
        .select("conv_id", (F.col("place") - n_heads + taken).alias("place"), "id", "words")
    )
    convs = turns.where("place = 0").select("conv_id").withColumn("base", base).join(heads, "base", "left")
    nothing = F.array(F.lit(None).cast("struct<place:bigint,id:string,words:bigint>"))
    shared = convs.select(
        "conv_id", F.inline(F.concat(nothing, F.coalesce(F.slice("heads", 1, n_heads), nothing)))
    ).select("conv_id", "place", "id", "words")
    return own.unionByName(shared)


# --- segments -----------------------------------------------------------------


def _half(c: Column, first: int) -> Column:
    """Sixteen hex digits as a signed number, none of them the padding."""
    value = F.conv(F.substring(c, first, 16), 16, -10).cast("long")
    return F.greatest(value, F.lit(_PAD + 1))


def segments(turns: DataFrame) -> DataFrame:
    """A row for each ``WIDTH`` turns of a conversation, with digests of its past and of its past and itself."""
    block = F.coalesce(F.floor(F.col("place") / WIDTH), F.lit(0)).cast("long")
    turn = F.struct("place", _half(F.col("id"), 1).alias("a"), _half(F.col("id"), 17).alias("b"), "words")
    rows = (
        turns.groupBy("conv_id", block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), turn))).alias("turns"))
        .select(
            "conv_id",
            "block",
            F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"]))).alias("ids"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
        )
    )
    own = Window.partitionBy("conv_id").orderBy("block")
    whole = Window.partitionBy("conv_id")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    n_words = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w)
    digest = lambda seed: F.when(F.size("ids") > 0, F.xxhash64(F.lit(seed), "block", "ids").cast("decimal(38,0)"))
    past = lambda seed, over: F.xxhash64(F.lit(seed), F.coalesce(F.sum(f"_{seed}").over(over), F.lit(0).cast("decimal(38,0)")))
    return (
        rows.withColumn("_1", digest(1))
        .withColumn("_2", digest(2))
        .withColumn("_words", n_words)
        .select(
            "*",
            past(1, before).alias("p1"),
            past(2, before).alias("p2"),
            past(1, upto).alias("q1"),
            past(2, upto).alias("q2"),
            (F.sum("_words").over(whole) - F.sum("_words").over(upto)).alias("after"),
            F.lead("block").over(own).isNotNull().cast("long").alias("more"),
        )
        .drop("_1", "_2", "_words")
    )


# --- chunks -------------------------------------------------------------------

_SUMS = ("n_convs", "n_children", "n_leaves", "words", "node_words")
_OUT = (
    "kind int, depth long, a long, b long, pa long, pb long, conv long, parent_conv long, n_convs long, "
    "n_children long, n_leaves long, words long, node_words long, q1 long, q2 long, whole boolean, "
    "chunk long, block long, p1 long, p2 long, ids array<long>, turn_words array<long>, more long"
)
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_TYPES = {"kind": pa.int32(), "whole": pa.bool_(), "ids": pa.list_(pa.int64()), "turn_words": pa.list_(pa.int64())}
NODE, GROUP, FIRST, LAST = range(4)


def _record(n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows; columns that are not given are null, single values hold for all rows."""
    arrays = []
    for name in _NAMES:
        kind, value = _TYPES.get(name, pa.int64()), columns.get(name)
        if value is None:
            arrays.append(pa.nulls(n, kind))
        elif isinstance(value, (int, bool)):
            arrays.append(pa.array([value] * n, kind))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _step(lane: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The digest of a prefix from that of the one before it and the next id."""
    return mix(lane * _ODD + ids.view(U64) + U64(1))


def _roots(block: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple(_step(block.astype(np.int64).view(U64), p) for p in (p1, p2))


def _masked(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values, mask=~known)


class Chunk:
    """Segments of neighbouring ranges as padded matrices, in lexicographic order."""

    def __init__(self, batch: pa.Table) -> None:
        column = lambda name: batch.column(name).to_numpy()
        words = batch.column("words").combine_chunks()
        size = np.asarray(words.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        n, width = len(size), int(size.max(initial=0))
        row = np.repeat(np.arange(n), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        ids = batch.column("ids").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
        matrix = np.full((n, width, 2), _PAD, np.int64)
        matrix[row, place] = ids
        weight = np.zeros((n, width + 1), np.int64)
        weight[row, place] = words.flatten().to_numpy(zero_copy_only=False)
        names = ("block", "p1", "p2", "conv", "copies", "after", "more", "ends", "q1", "q2")
        held = {c: column(c) for c in names}
        flat = matrix.reshape(n, -1)
        keys = [*(flat[:, c] for c in range(flat.shape[1] - 1, -1, -1)), held["p2"], held["p1"], held["block"]]
        order = np.lexsort(keys)
        self.n, self.width, self.size = n, width, size[order]
        self.matrix, self.weight = matrix[order], weight[order]
        for c in names:
            setattr(self, c, held[c][order])
        # Words from each column to the end of the segment.
        self.rest = np.cumsum(self.weight[:, ::-1], axis=1)[:, ::-1]
        self.group = np.ones(n, bool)
        self.group[1:] = np.any([getattr(self, c)[1:] != getattr(self, c)[:-1] for c in ("block", "p1", "p2")], axis=0)
        change = np.ones((n, width), bool)
        change[1:] = (self.matrix[1:] != self.matrix[:-1]).any(axis=2) | self.group[1:, None]
        self.change = np.logical_or.accumulate(change, axis=1)
        self.start = (~self.change).sum(axis=1)
        self.new_words = self.rest[np.arange(n), np.minimum(self.start, self.size)]
        extended = np.zeros(n, bool)
        extended[:-1] = ~self.group[1:] & (self.start[1:] >= self.size[:-1])
        self.leaf = (~extended & (self.more == 0)).astype(np.int64)

    def border(self, row: int, kind: int, number: int) -> pa.RecordBatch:
        size = int(self.size[row])
        return _record(
            1,
            kind=kind,
            chunk=number,
            **{c: int(getattr(self, c)[row]) for c in ("block", "p1", "p2", "more")},
            ids=[self.matrix[row, :size].ravel().tolist()],
            turn_words=[self.weight[row, :size].tolist()],
        )

    def nodes(self, block_width: int) -> Iterator[pa.RecordBatch]:
        """Every depth's nodes; whole ones hold neither the chunk's border nor a later segment."""
        n = self.n
        lanes = _roots(self.block, self.p1, self.p2)
        first = np.flatnonzero(self.group)
        add = lambda v: np.add.reduceat(v, first)
        conv = np.minimum.reduceat(self.conv, first)
        sums = {
            "n_convs": add(self.copies),
            "n_children": add(((self.start == 0) & (self.size > 0)).astype(np.int64)),
            "n_leaves": add(self.leaf),
            "words": add(self.copies * self.rest[:, 0] + self.after),
            "node_words": add(self.new_words),
        }
        root = self.block[first] == 0
        if root.any():  # the one group of block 0 is the trie's root
            ends = self.size[first] == 0
            yield _record(
                int(root.sum()),
                kind=NODE,
                depth=0,
                a=lanes[0].view(np.int64)[first][root],
                b=lanes[1].view(np.int64)[first][root],
                conv=conv[root],
                **{k: v[root] for k, v in sums.items()},
                q1=_masked(self.q1[first][root], ends[root]),
                q2=_masked(self.q2[first][root], ends[root]),
                whole=False,
            )
        if not root.all():
            keep = ~root
            yield _record(
                int(keep.sum()),
                kind=GROUP,
                conv=conv[keep],
                **{k: v[keep] for k, v in sums.items() if k in ("n_children", "n_leaves", "node_words")},
                **{c: getattr(self, c)[first][keep] for c in ("block", "p1", "p2")},
            )
        # The node above each row: its conversation, and whether it is whole.  What is above the first
        # column is the root or a node of the block before, and never whole.
        above_conv, above_whole = np.zeros(n, np.int64), np.zeros(n, bool)
        for j in range(self.width):
            at = np.flatnonzero(self.size > j)
            first = np.flatnonzero(self.change[at, j])
            top = at[first]
            length = np.diff(np.concatenate((first, [len(at)])))
            add = lambda v: np.add.reduceat(v[at], first)  # noqa: E731, B023
            conv = np.minimum.reduceat(self.conv[at], first)
            child = (self.start == j + 1) & (self.size > j + 1)
            sums = {
                "n_convs": add(self.copies),
                "n_children": add(child.astype(np.int64)) - child[top] + (self.size[top] > j + 1),
                "n_leaves": add(self.leaf),
                "words": add(self.copies * self.rest[:, j] + self.after),
                "node_words": add(self.new_words) - self.new_words[top] + self.rest[top, j],
            }
            last = at[first + length - 1]
            whole = (top > 0) & (last < n - 1) & (add(self.more) == 0)
            below = [lane.copy() for lane in lanes]
            for lane in range(2):
                below[lane][at] = _step(lanes[lane][at], self.matrix[at, j, lane])
            # Where conversations end, or go on in the next block, whose past is this one's.
            ends = self.size[top] == j + 1
            yield _record(
                len(top),
                kind=NODE,
                depth=self.block[top] * block_width + j + 1,
                a=below[0].view(np.int64)[top],
                b=below[1].view(np.int64)[top],
                # The node above the first column of a later block goes by the past.
                pa=_masked(lanes[0].view(np.int64)[top], (self.block[top] == 0) | (j > 0)),
                pb=_masked(lanes[1].view(np.int64)[top], (self.block[top] == 0) | (j > 0)),
                p1=_masked(self.p1[top], (self.block[top] > 0) & (j == 0)),
                p2=_masked(self.p2[top], (self.block[top] > 0) & (j == 0)),
                conv=conv,
                parent_conv=_masked(above_conv[top], above_whole[top]),
                **sums,
                q1=_masked(self.q1[top], ends),
                q2=_masked(self.q2[top], ends),
                whole=whole,
            )
            above_conv[at], above_whole[at] = np.repeat(conv, length), np.repeat(whole, length)
            lanes = tuple(below)


def _cutter(block_width: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nodes and borders of chunk after chunk; rows come sorted."""
        held: list[pa.RecordBatch] = []
        rows = width = seen = shard = 0

        def finish():
            nonlocal held, rows, width, seen
            if rows:
                chunk = Chunk(pa.Table.from_batches(held))
                number = (shard << 32) + seen
                yield chunk.border(0, FIRST, number)
                yield chunk.border(chunk.n - 1, LAST, number)
                yield from chunk.nodes(block_width)
            held, rows, width, seen = [], 0, 0, seen + 1

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard")[0].as_py()
            sizes = batch.column("words").value_lengths().to_numpy(zero_copy_only=False)
            low = 0
            for i, size in enumerate(sizes):
                if rows and (rows + 1) * max(width, size, 1) > cells:
                    held.append(batch.slice(low, i - low))
                    yield from finish()
                    low = i
                rows, width = rows + 1, max(width, size)
            held.append(batch.slice(low))
        yield from finish()

    return run


def _path(batch: pa.RecordBatch, row: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Block, the digests of all prefixes of a segment from the empty one on, and the turns' words."""
    block = batch.column("block")[row].as_py()
    ids = np.array(batch.column("ids")[row].as_py(), np.int64).reshape(-1, 2)
    words = np.array(batch.column("turn_words")[row].as_py(), np.int64)
    lanes = [
        [_step(np.array([block], np.int64).view(U64), np.array([batch.column(p)[row].as_py()], np.int64))]
        for p in ("p1", "p2")
    ]
    for turn in ids:
        for lane in range(2):
            lanes[lane].append(_step(lanes[lane][-1], turn[lane : lane + 1]))
    a, b = (np.concatenate(lane).view(np.int64) for lane in lanes)
    return block, a, b, words


def _corrections(batches: Iterator[pa.RecordBatch], block_width: int) -> Iterator[pa.RecordBatch]:
    """What both chunks at a border counted, as negative sums.  A row holds the last segment of one and the first of the next."""
    for batch in batches:
        for row in range(batch.num_rows):
            block, a, b, words = _path(batch, row)
            own = np.array(batch.column("ids")[row].as_py(), np.int64).reshape(-1, 2)
            following = np.array(batch.column("next_ids")[row].as_py(), np.int64).reshape(-1, 2)
            upto = min(len(own), len(following))
            differs = (own[:upto] != following[:upto]).any(axis=1)
            common = int(differs.argmax()) if differs.any() else upto
            rest = np.concatenate((np.cumsum(words[:common][::-1])[::-1], [0]))
            node_words = -np.concatenate((rest[:1], rest[: common]))
            children = -(np.arange(common + 1) < common).astype(np.int64)
            prefix = common == len(own) and batch.column("more")[row].as_py() == 0
            leaves = np.full(common + 1, -1 if prefix else 0, np.int64)
            sums = {"n_children": children, "n_leaves": leaves, "node_words": node_words}
            skip = 0
            if block > 0:
                skip = 1
                place = {c: batch.column(c)[row].as_py() for c in ("block", "p1", "p2")}
                yield _record(1, kind=GROUP, **place, **{k: v[:1] for k, v in sums.items()})
            if common + 1 > skip:
                yield _record(
                    common + 1 - skip,
                    kind=NODE,
                    depth=block * block_width + np.arange(skip, common + 1),
                    a=a[skip : common + 1],
                    b=b[skip : common + 1],
                    **{k: v[skip:] for k, v in sums.items()},
                )


def _descents(batches: Iterator[pa.RecordBatch], block_width: int) -> Iterator[pa.RecordBatch]:
    """Leaves and node words of later segments, for every node along a segment, and the children of its last one."""
    for batch in batches:
        for row in range(batch.num_rows):
            block, a, b, _ = _path(batch, row)
            skip = 1 if block > 0 else 0
            n = len(a) - skip
            children = np.zeros(n, np.int64)
            children[-1] = batch.column("next_children")[row].as_py()
            yield _record(
                n,
                kind=NODE,
                depth=block * block_width + np.arange(skip, len(a)),
                a=a[skip:],
                b=b[skip:],
                n_children=children,
                n_leaves=[batch.column("later_leaves")[row].as_py()] * n,
                node_words=[batch.column("later_words")[row].as_py()] * n,
            )


# --- members that end at a node -------------------------------------------------


def _joiner(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The ids of each end, comma-joined, in pieces of bounded length; rows come sorted by end and id."""
    key, ids, first = None, [], None

    def piece():
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in (*key, first)] + [pa.array([",".join(map(str, ids))])],
            names=["q1", "q2", "first", "piece"],
        )

    for batch in batches:
        for q1, q2, conv in zip(*(batch.column(c).to_pylist() for c in ("q1", "q2", "conv_id"))):
            if key is not None and ((q1, q2) != key or len(ids) >= most):
                yield piece()
                ids = []
            if not ids:
                key, first = (q1, q2), conv
            ids.append(conv)
    if ids:
        yield piece()


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest over the pieces of each end; rows come sorted by end and first id."""
    key, digest = None, None

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]]), pa.array([digest.hexdigest()])], names=["q1", "q2", "sha"]
        )

    for batch in batches:
        for q1, q2, piece in zip(*(batch.column(c).to_pylist() for c in ("q1", "q2", "piece"))):
            if (q1, q2) != key:
                if key is not None:
                    yield done()
                key, digest = (q1, q2), hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if key is not None:
        yield done()


def _many(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _batched(fn, *sizes: int):
    """``fn`` over the batches of a task; sizes travel with it."""
    return lambda batches: _many(fn(batches, *sizes))


def _ends(segs: DataFrame, ranges: int) -> DataFrame:
    """(q1, q2, ends_sha256) of the conversations that end at a node.

    An end that holds many conversations spans ranges; its ids meet as pieces of many ids each.
    """
    ends = segs.where("more = 0").select("q1", "q2", "conv_id")
    order = ["q1", "q2", "conv_id"]
    pieces = (
        ends.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_batched(_joiner, IDS_PER_CHUNK), "q1 long, q2 long, first long, piece string")
    )
    return (
        pieces.repartition("q1", "q2")
        .sortWithinPartitions("q1", "q2", "first")
        .mapInArrow(_batched(_hasher), "q1 long, q2 long, sha string")
    )


# --- the trie -------------------------------------------------------------------


def _borders(found: DataFrame) -> DataFrame:
    """Neighbouring chunks of one group: the last segment of one and the ids of the next one's first."""
    numbers = [r[0] for r in found.where(F.col("kind") == FIRST).select("chunk").orderBy("chunk").collect()]
    spark = found.sparkSession
    following = spark.createDataFrame(list(zip(numbers, numbers[1:])), "chunk long, next_chunk long")
    place = ["block", "p1", "p2"]
    last = found.where(F.col("kind") == LAST).select("chunk", *place, "ids", "turn_words", "more")
    first = found.where(F.col("kind") == FIRST).select(
        F.col("chunk").alias("next_chunk"), *place, F.col("ids").alias("next_ids")
    )
    return last.join(following, "chunk").join(first, ["next_chunk", *place]).select(
        *place, "ids", "turn_words", "more", "next_ids"
    )


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node."""
    text, role = (F.coalesce(c, F.lit("")) for c in ("text", "role"))
    turns = stored(
        conversations.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.md5(F.concat(F.length(role), F.lit(":"), role, text)).alias("id"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "trie-input",
    )
    segs = stored(segments(rebuilt(numbered(turns))), "trie-segments")
    rows = stored(
        segs.groupBy("block", "p1", "p2", "ids", "words", "q1", "q2").agg(
            F.min("conv_id").alias("conv"),
            F.count("*").alias("copies"),
            F.sum("after").alias("after"),
            F.sum("more").alias("more"),
            F.sum(1 - F.col("more")).alias("ends"),
        ),
        "trie-rows",
    )
    cells, blocks, ends = rows.agg(F.sum(F.size("words") + 1), F.max("block"), F.sum("ends")).first()
    shards = max(1, -(-(cells or 0) // SHARD_CELLS))
    order = ["block", "p1", "p2", "ids"]
    found = stored(
        rows.repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .withColumn("shard", F.spark_partition_id())
        .mapInArrow(_batched(_cutter(WIDTH, CELLS)), _OUT),
        "trie-found",
    )
    corrections = stored(_borders(found).mapInArrow(_batched(_corrections, WIDTH), _OUT), "trie-corrections")
    parts = found.where((F.col("kind") == NODE) & ~F.col("whole")).unionByName(corrections.where(F.col("kind") == NODE))
    if blocks:
        groups = found.where(F.col("kind") == GROUP).unionByName(corrections.where(F.col("kind") == GROUP))
        parts = parts.unionByName(_later(segs, groups))
    some = lambda c: F.max(c).alias(c)
    merged = stored(
        parts.groupBy("depth", "a", "b").agg(
            F.min("conv").alias("conv"),
            *(some(c) for c in ("pa", "pb", "p1", "p2", "q1", "q2", "parent_conv")),
            *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS),
        ),
        "trie-merged",
    )
    wholes = found.where((F.col("kind") == NODE) & F.col("whole")).select(*merged.columns)
    nodes = wholes.unionByName(merged)
    above = merged.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("above")
    )
    named = nodes.join(above, ["depth", "pa", "pb"], "left").withColumn("parent", F.coalesce("parent_conv", "above"))
    if blocks:
        pasts = merged.where((F.col("depth") > 0) & (F.col("depth") % WIDTH == 0) & F.col("q1").isNotNull()).select(
            F.col("q1").alias("p1"), F.col("q2").alias("p2"), F.col("conv").alias("past")
        )
        named = named.join(pasts, ["p1", "p2"], "left").withColumn("parent", F.coalesce("parent", "past"))
    return (
        named.join(_ends(segs, max(1, -(-(ends or 0) // TURNS_PER_RANGE))), ["q1", "q2"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("words") - F.col("node_words")).alias("saved_tokens"),
            F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )


def _later(segs: DataFrame, groups: DataFrame) -> DataFrame:
    """What later segments add to the nodes of earlier ones.

    The sums of a past are charged to the least conversation that has it, and come down along its segments.
    """
    charges = groups.groupBy("block", "p1", "p2").agg(
        F.min("conv").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "node_words"))
    )
    own = Window.partitionBy("conv_id").orderBy("block")
    whole = Window.partitionBy("conv_id")
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    later = lambda c: (F.sum(zero(c)).over(whole) - F.sum(zero(c)).over(upto))
    paths = (
        segs.join(charges.select("conv_id").distinct(), "conv_id", "left_semi")
        .join(charges.drop("p1", "p2"), ["conv_id", "block"], "left")
        .select(
            "block", "p1", "p2", "ids", F.col("words").alias("turn_words"), "more",
            later("n_leaves").alias("later_leaves"),
            later("node_words").alias("later_words"),
            zero(F.lead("n_children").over(own)).alias("next_children"),
        )
        .where("more = 1 AND (later_leaves <> 0 OR later_words <> 0 OR next_children <> 0)")
    )
    return paths.mapInArrow(_batched(_descents, WIDTH), _OUT)


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'id': id, 'words': words} ORDER BY turn NULLS FIRST, id) AS t FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, t,
         list_reduce(
           list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT),
           lambda c, x: list_reduce(range(0, 8), lambda r, k: xor(r >> 1, (r & 1) * 3988292384), xor(c, x)),
           4294967295::BIGINT) AS crc
  FROM own),
rebuilt AS (
  SELECT c.conv_id,
         list_concat(coalesce(b.t[1:xor(c.crc, 4294967295) % 4], []), c.t[xor(c.crc, 4294967295) % 4 + 1:]) AS t
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (
  SELECT conv_id, d AS depth, len(t) = d AS ends, list_transform(t[1:d], lambda x: x.id) AS path,
         CASE WHEN d > 0 THEN t[d].words ELSE 0 END AS words
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
up AS (
  SELECT path[1:d] AS path, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes) GROUP BY 1)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN up USING (path) LEFT JOIN nodes p ON f.depth > 0 AND p.path = f.path[1:f.depth - 1]
"""
