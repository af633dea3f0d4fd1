"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every candidate is scaled to length one and turned by a random rotation that is fixed by a seed; the
signs of its coordinates are packed into 64-bit words, and two correction scalars are kept: the
length, and the alignment of the unit vector with its code.  This is done once for each row, before
the rows are sent anywhere.  A query is turned too and rounded to ``QUERY_BITS`` bits a dimension, one
bit plane each, so that its inner product with a code is a sum of counts of common bits.

The estimate of the cosine is that product over the alignment ``a``.  Its error is at most ``EPSILON``
times ``sqrt((1 - a^2) / a^2 / (D - 1) + r^2 / a^2 / D)``, ``r`` the length of what rounding took from
the query, but for a small probability (below 0.000004 for ``EPSILON`` 4.5).  Vectors whose estimate plus error
cannot reach the query's present 20th are passed over.  Of the others the product is computed, in single
precision with its margin and, where that leaves the matter open, exactly.  Where few pairs of a step are
left their vectors are gathered; where the bounds leave many, as between vectors without clusters, one
product of matrices serves them all.

Candidates are dealt out in blocks, and every block of queries is sent to every block of
candidates.  A task holds the queries and a step of candidates, whatever the size of the block, and the
20th found so far holds for the steps that follow.  A block pair yields at most ``k`` rows for each
query, and these are merged by query.

Vectors that are null, zero, or hold null or non-finite components take no part, neither as
query nor as candidate; only vectors of equal length are compared.  Repeated vec_ids are
candidates each, except to a query of the same vec_id; a null vec_id is no query, and as a
candidate comes after all others on ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 20
EPSILON = 4.5
QUERY_BITS = 4
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
_CANDIDATES = 2048  # at one step
_QUERIES = 64
_DENSE = 1 / 32  # of the pairs of a step: a product of matrices costs less than gathering that many
_GATHERED = 1 << 20  # components at once
_MARGIN = 1e-5  # more than single precision can be wrong by, for cosines
_SEED = 20240229
_NO_ID = np.iinfo(np.int64).max


def rotation(dim: int) -> np.ndarray:
    """The same random rotation in every task."""
    square = np.random.default_rng(_SEED + dim).standard_normal((dim, dim))
    q, r = np.linalg.qr(square)
    return q * np.sign(np.diag(r))


def unit_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and the lengths they had."""
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / scale
    length = np.linalg.norm(scaled, axis=1, keepdims=True)
    return scaled / length, (length * scale)[:, 0]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, filled up with zeros."""
    filled = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    filled[:, : bits.shape[1]] = bits
    return np.packbits(filled, axis=1, bitorder="little").view("<u8")


def codes_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of sign bits, alignment, length) of each vector."""
    unit, length = unit_of(vectors)
    turned = unit @ rotation(vectors.shape[1])
    return packed(turned > 0), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1]), length


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class Search:
    """The nearest found so far of a block of queries; ``ranked`` counts the products that were computed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        n, self.dim = vectors.shape
        self.ids, self.vectors, self.k = ids, vectors, k
        unit, self.length = unit_of(vectors)
        self.unit = unit.astype(np.float32)
        turned = unit @ rotation(self.dim)
        self.low = turned.min(axis=1)
        self.step = (turned.max(axis=1) - self.low) / (2**QUERY_BITS - 1)
        level = np.rint((turned - self.low[:, None]) / np.where(self.step > 0, self.step, 1)[:, None])
        rounded = level * self.step[:, None] + self.low[:, None]
        self.total = rounded.sum(axis=1)
        self.lost = np.linalg.norm(turned - rounded, axis=1)
        level = level.astype(np.uint8)
        self.planes = [packed(level >> j & 1 == 1) for j in range(QUERY_BITS)]
        self.best = np.full((n, k), -np.inf)
        self.found = np.full((n, k), _NO_ID)
        self.held = np.zeros(n, np.int64)
        self.pairs = self.ranked = 0

    def cosines(self, q: slice, code: np.ndarray, alignment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimates of the cosines of queries and codes, and the largest they may be, by counts of bits."""
        common = np.zeros((len(self.ids[q]), len(code)), np.uint32)
        for plane in reversed(self.planes):  # the highest first, doubled by each that follows
            common += common
            for w in range(code.shape[1]):
                common += np.bitwise_count(plane[q, None, w] & code[None, :, w])
        single = np.float32
        ones = np.bitwise_count(code).sum(axis=1).astype(single)
        estimate = common.astype(single)
        estimate *= self.step[q, None].astype(single)
        estimate += self.low[q, None].astype(single) * ones
        estimate -= self.total[q, None].astype(single) / 2
        estimate *= (2 / (alignment * np.sqrt(self.dim))).astype(single)
        a2 = alignment * alignment
        of_code = np.maximum(1 - a2, 0) / a2 / max(self.dim - 1, 1)
        error = (EPSILON * self.lost[q, None]).astype(single) ** 2 * (1 / (a2 * self.dim)).astype(single)
        error += (EPSILON**2 * of_code).astype(single)
        np.sqrt(error, out=error)
        error += estimate
        error += single(_MARGIN)
        return estimate, error

    def rank(self, q: np.ndarray, c: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Compute the products of pairs exactly and keep each query's nearest."""
        if not len(q):
            return
        score = np.empty(len(q))
        size = max(1, _GATHERED // self.dim)
        for low in range(0, len(q), size):
            at = slice(low, low + size)
            score[at] = exact(self.vectors[q[at]], vectors[c[at]])
        touched = np.unique(q)
        old = np.arange(self.k)[None, :] < self.held[touched, None]
        q = np.concatenate((np.repeat(touched, self.held[touched]), q))
        found = np.concatenate((self.found[touched][old], ids[c]))
        score = np.concatenate((self.best[touched][old], score))
        order = np.lexsort((found, -score, q))
        q, found, score = q[order], found[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, "left")
        top = place < self.k
        self.best[q[top], place[top]] = score[top]
        self.found[q[top], place[top]] = found[top]
        self.held[touched] = np.bincount(q[top], minlength=len(self.held))[touched]

    def close(self, near: np.ndarray, first: int, unit: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs within reach, those that single precision leaves in question."""
        q = slice(first, first + len(near))
        last = self.best[q, -1] / self.length[q]
        n = int(near.sum())
        self.ranked += n
        if n > _DENSE * near.size:
            about = self.unit[q] @ unit.T
            about += np.float32(_MARGIN)
            a, c = np.nonzero(near & (about * length >= last[:, None]))
            return a + first, c
        a, c = np.nonzero(near)
        open_ = np.zeros(n, bool)
        size = max(1, _GATHERED // self.dim)
        for low in range(0, n, size):
            at = slice(low, low + size)
            about = np.einsum("ij,ij->i", self.unit[q][a[at]], unit[c[at]]) + _MARGIN
            open_[at] = about * length[c[at]] >= last[a[at]]
        return a[open_] + first, c[open_]

    def see(self, ids: np.ndarray, vectors: np.ndarray, code: np.ndarray, alignment: np.ndarray, length: np.ndarray) -> None:
        """A step of candidates: estimate all, rank those within reach."""
        unit = (vectors / length[:, None]).astype(np.float32)
        for first in range(0, len(self.ids), _QUERIES):
            q = slice(first, first + _QUERIES)
            estimate, most = self.cosines(q, code, alignment)
            estimate = estimate * length
            most = most * length
            other = self.ids[q, None] != ids[None, :]
            self.pairs += int(other.sum())

            def within() -> np.ndarray:
                return other & (most >= (self.best[q, -1] / self.length[q])[:, None])

            near = within()
            if len(ids) > self.k and near.sum() > 2 * self.k * len(near):
                # The likely ones first: what they reach leaves fewer of the others.
                estimate[~near] = -np.inf
                likely = np.argpartition(estimate, -self.k, axis=1)[:, -self.k :]
                early = np.zeros_like(near)
                np.put_along_axis(early, likely, True, axis=1)
                early &= near
                a, c = np.nonzero(early)
                self.ranked += len(a)
                self.rank(a + first, c, ids, vectors)
                near = within() & ~early
            self.rank(*self.close(near, first, unit, length), ids, vectors)

    def result(self) -> pa.RecordBatch:
        q, place = np.nonzero(np.arange(self.k)[None, :] < self.held[:, None])
        found = self.found[q, place]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[q]), pa.array(found, mask=found == _NO_ID), pa.array(self.best[q, place])],
            names=["query_id", "vec_id", "score"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


_ROW = "dim int, vec_id long, embedding array<double>"
_CODED = f"{_ROW}, code binary, alignment double, length double"
_OUT = "query_id long, vec_id long, score double"


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their codes and correction scalars."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
            code, alignment, length = codes_of(_matrix(rows.column("embedding")))
            words = pa.array([row.tobytes() for row in code], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, words, pa.array(alignment), pa.array(length)],
                names=[*rows.schema.names, "code", "alignment", "length"],
            )


def _searcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block pair, its queries first."""
        at, search, queries = None, None, []
        for batch in batches:
            pairs, kinds = batch.column("pair").to_pylist(), batch.column("is_query").to_pylist()
            low = 0
            while low < len(pairs):
                high = low
                while high < len(pairs) and pairs[high] == pairs[low] and kinds[high] == kinds[low]:
                    high += 1
                if pairs[low] != at:
                    if search is not None:
                        yield search.result()
                    at, search, queries = pairs[low], None, []
                piece = batch.slice(low, high - low)
                ids = piece.column("vec_id").fill_null(_NO_ID).to_numpy()
                vectors = _matrix(piece.column("embedding"))
                if kinds[low]:
                    queries.append((ids, vectors))
                elif queries or search is not None:
                    if search is None:
                        search = Search(*(np.concatenate(x) for x in zip(*queries)), k)
                        queries = []
                    code = b"".join(piece.column("code").to_pylist())
                    code = np.frombuffer(code, "<u8").reshape(len(ids), -1)
                    scalars = [piece.column(c).to_numpy() for c in ("alignment", "length")]
                    for i in range(0, len(ids), _CANDIDATES):
                        step = slice(i, i + _CANDIDATES)
                        search.see(ids[step], vectors[step], code[step], *(x[step] for x in scalars))
                low = high
        if search is not None:
            yield search.result()

    return run


def nearest(embeddings: DataFrame, k: int = NEAREST, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest candidates of the vectors whose id is divisible by ``every``."""
    whole = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.where(F.coalesce(some & ~whole, F.lit(False))).select(
        F.size("embedding").alias("dim"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    asks = F.coalesce(F.pmod("vec_id", F.lit(every)) == 0, F.lit(False))
    n, n_queries = embeddings.agg(F.count("*"), F.count(F.when(asks, 1))).first()
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    blocks = max(1, -(-n // CANDIDATE_BLOCK))
    deal = lambda seed, of: F.pmod(F.xxhash64("vec_id", "embedding", F.lit(seed)), F.lit(of)).cast("int")
    every_block = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    candidates = rows.mapInArrow(encode, _CODED).select(
        "*", every_block(query_blocks).alias("q"), deal(1, blocks).alias("c"), F.lit(False).alias("is_query")
    )
    queries = rows.where(asks).select(
        "*", deal(2, query_blocks).alias("q"), every_block(blocks).alias("c"), F.lit(True).alias("is_query")
    )
    pairs = (
        queries.unionByName(candidates, allowMissingColumns=True)
        .withColumn("pair", F.concat_ws("/", "dim", "q", "c"))
        .repartition("pair")
        .sortWithinPartitions("pair", F.desc("is_query"), "vec_id")
        .select("pair", "is_query", "vec_id", "embedding", "code", "alignment", "length")
    )
    found = pairs.mapInArrow(_searcher(k), _OUT)
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(nearest_first))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


ORACLE = """
WITH v AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_reduce(list_transform(range(1, len(q.embedding) + 1),
           lambda i: q.embedding[i]::DOUBLE * c.embedding[i]::DOUBLE), lambda x, y: x + y) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.embedding) = len(c.embedding)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
