"""Hard negatives over a multiway hyperplane tree whose nodes keep distance ranges.

Components become whole numbers, floor(256 x), and the score of two rows is the inner product.  An
anchor's positives are its best other rows of the same label, and the negatives of a positive are the
best rows of another label whose score lies between 30 and 90 percent of the positive's.

Scores are turned into distances: a row x of length |x| gets one more coordinate, sqrt(M^2 - |x|^2) for the
greatest length M, an anchor gets zero; then d(q, x)^2 = |q|^2 + M^2 - 2 <q, x>, and a window of scores is an
annulus.  A node of the tree has several split points; a row belongs to the nearest one.  For every split point
and every sibling subtree the node keeps the least and greatest distance between them, so a subtree
is passed over if the range, carried to the anchor by the triangle inequality, misses the annulus for any one of the split points.

The upper tree is fitted on at most ``SAMPLE`` rows (least hashes of their content) and is therefore small enough to send to
every task; its ranges are the minima and maxima over *all* rows.  The rows of an upper leaf are dealt into pages of about
``PAGE`` rows, each page grows its own lower tree, and its leaves are searched exactly.  The sample also gives every anchor a lower
bound of its last place, which narrows the annulus before anything moves.  Every page yields at most as many rows
for an anchor as are asked for.

Rows with a null label, a null vector, or any null or non-finite component take no part.  A null vec_id is no anchor and
comes last on ties, its label is not shifted.  Rows are told apart by a number of their own, so repeated vec_ids are rows, and anchors,
of their own.  Only vectors of equal length are compared; vectors without components score zero.  A component beyond 2^40 after
scaling counts as 2^40, a score beyond the range of a long as its end.  No rows give no rows.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.common import stored

POSITIVES = 5
NEGATIVES = 10
SAMPLE = 4096
FANOUT = 16
SAMPLE_LEAF = 64
PAGE = 8192
LEAF = 256
ANCHOR_BLOCK = 1024
_ASK = 256
_MOST = float(1 << 40)
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_EXACT = float(1 << 53)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, as longs."""
    bound = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if bound < _EXACT:
        return (a @ b.T).astype(np.int64)
    big = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return np.clip(big, _LOW, _HIGH).astype(np.int64)


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Rows with the coordinate that gives all of them the squared length ``most``."""
    rest = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", x, x), 0))
    return np.concatenate((x, rest[:, None]), axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Tree:
    """A node with split points, ranges[j, i] of the distances from split point j to subtree i, and children."""

    def __init__(self, points: np.ndarray, rows: np.ndarray, leaf: int, names: list[int]) -> None:
        self.rows, self.children, self.name = rows, [], -1
        self.number = names[1]
        names[1] += 1
        split = self._split(points[rows]) if len(rows) > leaf else np.zeros(0, np.int64)
        if len(split) < 2:
            self.name = names[0]
            names[0] += 1
            return
        self.points = points[rows[split]]
        far = distances(points[rows], self.points)
        near = far.argmin(axis=1)
        groups = [np.flatnonzero(near == i) for i in range(len(split))]
        self.low = np.array([far[g].min(axis=0) for g in groups]).T
        self.high = np.array([far[g].max(axis=0) for g in groups]).T
        self.children = [Tree(points, rows[g], leaf, names) for g in groups]
        self.rows = rows[:0]

    @staticmethod
    def _split(x: np.ndarray) -> np.ndarray:
        """Rows far from each other: each is the one farthest from those before."""
        tried = np.linspace(0, len(x) - 1, min(len(x), 32 * FANOUT)).astype(np.int64)
        chosen, least = [0], distances(x[tried], x[tried[:1]])[:, 0]
        while len(chosen) < FANOUT and (far := int(least.argmax())) not in chosen and least[far] > 0:
            chosen.append(far)
            least = np.minimum(least, distances(x[tried], x[tried[far : far + 1]])[:, 0])
        return tried[chosen]

    def leaves(self) -> Iterator[Tree]:
        if not self.children:
            yield self
        for child in self.children:
            yield from child.leaves()

    def route(self, x: np.ndarray, at: np.ndarray, out: np.ndarray, seen: dict | None = None) -> None:
        """Name the leaf of every row ``at``; ``seen`` gathers the ranges of what passes."""
        if not self.children:
            out[at] = self.name
            return
        far = distances(x[at], self.points)
        near = far.argmin(axis=1)
        for i, child in enumerate(self.children):
            if (here := near == i).any():
                if seen is not None:
                    low, high = far[here].min(axis=0), far[here].max(axis=0)
                    if (self.number, i) in seen:
                        low = np.minimum(low, seen[self.number, i][0])
                        high = np.maximum(high, seen[self.number, i][1])
                    seen[self.number, i] = (low, high)
                child.route(x, at[here], out, seen)

    def widen(self, ranges: dict) -> None:
        """Take the ranges of all rows; a subtree without rows keeps an empty range."""
        for i, child in enumerate(self.children):
            self.low[:, i], self.high[:, i] = ranges.get((self.number, i), (np.inf, -np.inf))
            child.widen(ranges)

    def visit(
        self, q: np.ndarray, inner: np.ndarray, outer: np.ndarray, alive: np.ndarray, slack: float
    ) -> Iterator[tuple[Tree, np.ndarray]]:
        """(leaf, anchors whose annulus from ``inner`` to ``outer`` may reach into it)."""
        if not self.children:
            yield self, alive
            return
        d = distances(q[alive], self.points)
        for i, child in enumerate(self.children):
            least = np.maximum(np.maximum(d - self.high[:, i], self.low[:, i] - d), 0).max(axis=1)
            greatest = (d + self.high[:, i]).min(axis=1)
            keep = (least - slack <= outer[alive]) & (greatest + slack >= inner[alive])
            if keep.any():
                yield from child.visit(q, inner, outer, alive[keep], slack)


def annulus(q: np.ndarray, most: float, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances between which all rows lie that score from ``low`` to ``high``."""
    square = np.einsum("ij,ij->i", q, q) + most
    return tuple(np.sqrt(np.maximum(square - 2 * s.astype(np.float64), 0)) for s in (high, low))


class Best:
    """The ``k`` best rows of every list, by score and then by order."""

    def __init__(self, lists: int, k: int, order: np.ndarray) -> None:
        self.k, self.order = k, order
        self.score = np.full((lists, k), _LOW, np.int64)
        self.row = np.full((lists, k), -1, np.int64)

    def least(self) -> np.ndarray:
        """The score that a row needs; the lowest while a list is not full."""
        return np.where(self.row[:, -1] >= 0, self.score[:, -1], _LOW)

    def add(self, at: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(at)
        old = self.row[touched] >= 0
        at = np.concatenate((np.repeat(touched, old.sum(axis=1)), at))
        row = np.concatenate((self.row[touched][old], row))
        score = np.concatenate((self.score[touched][old], score))
        by = np.lexsort((self.order[row], ~score, at))
        at, row, score = at[by], row[by], score[by]
        place = np.arange(len(at)) - np.searchsorted(at, at, "left")
        top = place < self.k
        self.score[at[top], place[top]] = score[top]
        self.row[at[top], place[top]] = row[top]


class Rows:
    """Some rows: their numbers, ids, labels and vectors."""

    def __init__(self, number, ids, labels, vectors) -> None:
        self.number, self.ids, self.labels, self.vectors = number, ids, labels, vectors
        self.order = np.empty(len(ids), np.int64)
        self.order[np.lexsort((number, ids))] = np.arange(len(ids))


def search(
    q: Rows, low: np.ndarray, high: np.ndarray, rows: Rows, most: float, same: bool, k: int, leaf_rows: int
) -> Best:
    """The ``k`` best rows for each anchor and window; list w of anchor a is number a * windows + w."""
    windows = low.shape[1]
    tree = Tree(lifted(rows.vectors, most), np.arange(len(rows.ids)), leaf_rows, [0, 0])
    best = Best(low.size, k, rows.order)
    points = np.concatenate((q.vectors, np.zeros((len(q.ids), 1))), axis=1)
    some = low <= high
    wide_low = np.where(some, low, _HIGH).min(axis=1, initial=_HIGH)
    wide_high = np.where(some, high, _LOW).max(axis=1, initial=_LOW)
    inner, outer = annulus(q.vectors, most, wide_low, wide_high)
    slack = 1e-6 * np.sqrt(most + 1)
    for leaf, anchors in tree.visit(points, inner, outer, np.flatnonzero(some.any(axis=1)), slack):
        score = products(q.vectors[anchors], rows.vectors[leaf.rows])
        fits = (q.labels[anchors, None] == rows.labels[leaf.rows]) == same
        fits &= q.number[anchors, None] != rows.number[leaf.rows]
        needed = np.maximum(low, best.least().reshape(low.shape))
        for w in range(windows):
            a, c = np.nonzero(
                fits & (score >= needed[anchors, w][:, None]) & (score <= high[anchors, w][:, None])
            )
            if len(a):
                best.add(anchors[a] * windows + w, leaf.rows[c], score[a, c])
    return best


def bounds(q: Rows, low: np.ndarray, high: np.ndarray, sample: Rows, same: bool, k: int) -> np.ndarray:
    """Windows without what cannot be among the ``k`` best, as ``k`` rows of the sample are better."""
    if len(sample.ids) <= k:
        return low
    score = products(q.vectors, sample.vectors)
    fits = ((q.labels[:, None] == sample.labels) == same) & (q.number[:, None] != sample.number)
    out = low.copy()
    for w in range(low.shape[1]):
        inside = np.where(fits & (score >= low[:, w][:, None]) & (score <= high[:, w][:, None]), score, _LOW)
        kth = np.partition(inside, -k, axis=1)[:, -k]
        out[:, w] = np.maximum(out[:, w], kth)
    return out


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), dim)


def _rows(batch: pa.RecordBatch, dim: int) -> Rows:
    ids = batch.column("vec_id").fill_null(_HIGH).to_numpy(zero_copy_only=False)
    number, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("number", "label"))
    return Rows(number, ids, labels, _vectors(batch.column("vector"), dim))


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            yield int(dim), batch.take(pa.array(np.flatnonzero(dims == dim)))


class Index:
    """The upper tree of every vector length, from a bounded sample, with the ranges of all rows."""

    def __init__(self, sample: dict[int, Rows], most: dict[int, float]) -> None:
        self.sample, self.most = sample, most
        names = [0, 0]
        self.trees = {
            dim: Tree(lifted(rows.vectors, most[dim]), np.arange(len(rows.ids)), SAMPLE_LEAF, names)
            for dim, rows in sorted(sample.items())
        }
        self.names = names[0]  # the leaf of lengths that the sample does not have

    def router(self):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for dim, part in _by_dim(batches):
                leaf = np.full(part.num_rows, self.names, np.int64)
                if dim in self.trees:
                    x = lifted(_vectors(part.column("vector"), dim), self.most[dim])
                    self.trees[dim].route(x, np.arange(len(x)), leaf)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(leaf.astype(np.int32))], names=[*part.schema.names, "leaf"]
                )

        return run

    def measurer(self):
        """The ranges of the rows of a task, a row for each node, subtree and split point."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = [pa.int32()] * 3 + [pa.float64()] * 2
            seen: dict = {}
            for dim, part in _by_dim(batches):
                if dim in self.trees:
                    x = lifted(_vectors(part.column("vector"), dim), self.most[dim])
                    self.trees[dim].route(x, np.arange(len(x)), np.empty(len(x), np.int64), seen)
            out = [(n, i, j, a, b) for (n, i), (low, high) in seen.items() for j, (a, b) in enumerate(zip(low, high))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["node", "child", "split", "low", "high"]
                )

        return run

    def widen(self, found: list) -> None:
        ranges: dict = {}
        for node, child, split, low, high in sorted(found):
            lows, highs = ranges.setdefault((node, child), ([], []))
            lows.append(low)
            highs.append(high)
        for tree in self.trees.values():
            tree.widen({k: (np.array(a), np.array(b)) for k, (a, b) in ranges.items()})

    def asker(self, same: bool, k: int):
        """Anchors with narrowed windows and the upper leaves that their annuli reach."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for dim, part in _by_dim(b.slice(i, _ASK) for b in batches for i in range(0, b.num_rows, _ASK)):
                q = _rows(part, dim)
                low, high = _longs(part, "low"), _longs(part, "high")
                leaves: list[list[int]] = [[] for _ in q.ids]
                if dim in self.trees:
                    low = bounds(q, low, high, self.sample[dim], same, k)
                    some = low <= high
                    inner, outer = annulus(
                        q.vectors,
                        self.most[dim],
                        np.where(some, low, _HIGH).min(axis=1, initial=_HIGH),
                        np.where(some, high, _LOW).max(axis=1, initial=_LOW),
                    )
                    points = np.concatenate((q.vectors, np.zeros((len(q.ids), 1))), axis=1)
                    slack = 1e-6 * np.sqrt(self.most[dim] + 1)
                    alive = np.flatnonzero(some.any(axis=1))
                    for leaf, anchors in self.trees[dim].visit(points, inner, outer, alive, slack):
                        for a in anchors:
                            leaves[a].append(leaf.name)
                else:
                    leaves = [[self.names] for _ in q.ids]
                columns = dict(zip(part.schema.names, part.columns))
                columns["low"] = pa.array(low.tolist(), pa.list_(pa.int64()))
                columns["leaves"] = pa.array(leaves, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return run


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _searcher(most: dict[int, float], same: bool, k: int, leaf_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by place, its anchors first."""

        def finish():
            if not (parts[True] and parts[False]):
                return
            asked, page = (pa.Table.from_batches(parts[x]).combine_chunks().to_batches()[0] for x in (True, False))
            dim = asked.column("dim")[0].as_py()
            q, rows = _rows(asked, dim), _rows(page, dim)
            low, high = _longs(asked, "low"), _longs(asked, "high")
            best = search(q, low, high, rows, most[dim], same, k, leaf_rows)
            at, place = np.nonzero(best.row >= 0)
            if not len(at):
                return
            row, anchor = best.row[at, place], at // low.shape[1]
            ids = rows.ids[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(q.number[anchor]),
                    pa.array((at % low.shape[1]).astype(np.int32)),
                    pa.array(rows.number[row]),
                    pa.array(ids, mask=ids == _HIGH),
                    pa.array(best.score[at, place]),
                ],
                names=["anchor", "window", "found", "vec_id", "score"],
            )

        at, parts = None, {True: [], False: []}
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("place", "asks"))))
            low = 0
            while low < len(keys):
                high = low
                while high < len(keys) and keys[high] == keys[low]:
                    high += 1
                place, asks = keys[low]
                if place != at:
                    yield from finish()
                    at, parts = place, {True: [], False: []}
                parts[asks].append(batch.slice(low, high - low))
                low = high
        yield from finish()

    return run


_ROW = "number long, vec_id long, label int, dim int, vector array<double>"


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows that take part, with whole components and the label that holds."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    taking = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False))
    vec_id = F.col("vec_id").cast("long")
    shifted = F.when(F.pmod(vec_id, F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))

    def whole(x: Column) -> Column:
        scaled = F.least(F.greatest(x.cast("double") * 256, F.lit(-_MOST)), F.lit(_MOST))
        return F.floor(scaled).cast("double")

    return embeddings.where(taking).select(
        F.monotonically_increasing_id().alias("number"),
        vec_id.alias("vec_id"),
        shifted.cast("int").alias("label"),
        F.size("embedding").alias("dim"),
        F.transform("embedding", whole).alias("vector"),
    )


def build(rows: DataFrame) -> tuple[Index, DataFrame, dict[int, int]]:
    """The index, the rows with their upper leaf and page, and the pages of each leaf."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    most = {r[0]: float(r[1] or 0) for r in rows.groupBy("dim").agg(F.max(square)).collect()}
    chosen = rows.orderBy(F.xxhash64("vector", "vec_id"), "number").limit(SAMPLE).collect()
    sample: dict[int, list] = {}
    for r in chosen:
        sample.setdefault(r["dim"], []).append(r)
    index = Index(
        {
            dim: Rows(
                np.array([r["number"] for r in part]),
                np.array([_HIGH if r["vec_id"] is None else r["vec_id"] for r in part]),
                np.array([r["label"] for r in part]),
                np.array([r["vector"] for r in part], np.float64).reshape(len(part), dim),
            )
            for dim, part in sample.items()
        },
        most,
    )
    placed = stored(rows.mapInArrow(index.router(), f"{_ROW}, leaf int"), "negatives-rows")
    ranges = placed.mapInArrow(index.measurer(), "node int, child int, split int, low double, high double")
    index.widen(
        [tuple(r) for r in ranges.groupBy("node", "child", "split").agg(F.min("low"), F.max("high")).collect()]
    )
    counts = placed.groupBy("dim", "leaf").count().groupBy("leaf").agg(F.max("count")).collect()
    pages = {leaf: max(1, -(-n // PAGE)) for leaf, n in counts}
    return index, placed, pages


def _ask(
    anchors: DataFrame, index: Index, placed: DataFrame, pages: dict[int, int], blocks: int, same: bool, k: int
) -> DataFrame:
    """(anchor, window, rank, found, vec_id, score): the best rows of each anchor in each window."""
    asked = anchors.mapInArrow(
        index.asker(same, k), f"{_ROW}, low array<long>, high array<long>, leaves array<int>"
    )
    spark = placed.sparkSession
    # As many rows as the upper tree has leaves, which the sample bounds.
    n_pages = F.broadcast(spark.createDataFrame(list(pages.items()) or [(0, 1)], "leaf int, pages int"))
    deal = lambda seed, of: F.pmod(F.xxhash64("number", F.lit(seed)), of).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    questions = (
        asked.withColumn("block", deal(2, F.lit(blocks)))
        .withColumn("leaf", F.explode("leaves"))
        .join(n_pages, "leaf")
        .withColumn("page", upto(F.col("pages")))
        .withColumn("asks", F.lit(True))
        .drop("leaves", "pages")
    )
    answers = (
        placed.join(n_pages, "leaf")
        .withColumn("page", deal(1, F.col("pages")))
        .withColumn("block", upto(F.lit(blocks)))
        .withColumn("asks", F.lit(False))
        .drop("pages")
    )
    together = questions.unionByName(answers, allowMissingColumns=True)
    together = together.withColumn("place", F.concat_ws("/", "dim", "leaf", "page", "block"))
    found = (
        together.repartition("place")
        .sortWithinPartitions("place", F.desc("asks"), "number")
        .select("place", "asks", "number", "vec_id", "label", "dim", "vector", "low", "high")
        .mapInArrow(
            _searcher(index.most, same, k, LEAF), "anchor long, window int, found long, vec_id long, score long"
        )
    )
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = stored(usable(embeddings), "negatives-input")
    index, placed, pages = build(rows)
    asks = F.coalesce(F.pmod("vec_id", F.lit(every)) == 0, F.lit(False))
    anchors = placed.where(asks).drop("leaf")
    blocks = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    every_score = anchors.select(
        "*", F.array(F.lit(_LOW).cast("long")).alias("low"), F.array(F.lit(_HIGH).cast("long")).alias("high")
    )
    near = _ask(every_score, index, placed, pages, blocks, True, positives)
    near = stored(near.select("anchor", "rank", "vec_id", "score"), "positives")
    # At most ``positives`` rows of an anchor.
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    # An anchor of fewer positives has windows that hold nothing.
    none = lambda value: F.array_repeat(F.lit(value).cast("long"), F.lit(positives) - F.size("p"))
    windows = anchors.join(listed, anchors["number"] == listed["anchor"]).select(
        *anchors.columns,
        F.concat(F.transform("p", lambda p: -_floor_tenth(-_times(p["score"], 3))), none(_HIGH)).alias("low"),
        F.concat(F.transform("p", lambda p: _floor_tenth(_times(p["score"], 9))), none(_LOW)).alias("high"),
    )
    hard = _ask(windows, index, placed, pages, blocks, False, negatives)
    own = anchors.select(F.col("number").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    chosen = near.select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        hard.join(chosen, ["anchor", "window"])
        .join(own, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def _times(score: Column, n: int) -> Column:
    return score.cast("decimal(38,0)") * n


def _floor_tenth(c: Column) -> Column:
    return F.floor(c / 10).cast("long")


ORACLE = """
WITH usable AS (
  SELECT row_number() OVER () AS number, vec_id, embedding,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (
  SELECT number, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM usable),
scored AS (
  SELECT a.number AS anchor, a.vec_id AS anchor_id, c.number, c.vec_id, a.label = c.label AS same,
         list_reduce(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * c.e[i]), lambda x, y: x + y)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.number <> c.number AND len(a.e) = len(c.e)),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, number) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.number ORDER BY n.score DESC, n.vec_id, n.number)::INT AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
