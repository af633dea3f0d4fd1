"""Sharding by a k-d tree over the documents' metadata.

A node that has to become n shards is cut at the weighted quantile of its bytes that
gives floor(n/2) of them to one side, along the dimension in which its points spread most,
until every leaf is one shard.  Dimensions are source, language and length, each as a
fraction of its range over all points; points of equal value are told apart by a hash, so
a hot source or a hot length is cut like anything else.  The quantile is found by counting
bytes in ``BINS`` equal cells of the node's range, twice, the second time within the cell that
holds it: sums per node and cell are all that moves.

Rows of equal text are one point and stay together as long as they are less than
1/``TOGETHER`` of a shard; a larger group is dealt out row by row, by a number that every row gets
when it is stored, so rows without an id, or of one id, are dealt like any other.  Law ``bytes``: the sizes
of the shards are near equal.

Null text has size 8 (no bytes) and the crc32 of empty text; null source and language
are the least of their dimension; a null doc_id is dealt like any other.  Repeated rows
are rows of their own.  Further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.common import stored

SHARDS = 24
BINS = 4096
TOGETHER = 64
ROWS_PER_RANGE = 50_000
_RESOLUTION = 16
_HASH = 30


def _place(text: Column) -> Column:
    """Where a string stands among all strings, by its first six bytes, from 0 to 1."""
    head = F.rpad(F.hex(F.substring(F.coalesce(text, F.lit("")).cast("binary"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double") / float(1 << 48)


def _points(docs: DataFrame, shards: int) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("number"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("group"),
        _place(F.col("source")).alias("x0"),
        _place(F.col("lang")).alias("x1"),
    )
    rows = stored(rows.withColumn("x2", F.log("size")), "shard-points")
    total = rows.agg(F.sum("size")).first()[0] or 0
    most = max(1, total // (shards * TOGETHER))
    large = (
        rows.groupBy("group")
        .agg(F.sum("size").alias("bytes"), *(F.min(f"x{d}").alias(f"g{d}") for d in range(3)))
        .withColumn("apart", F.col("bytes") > most)
    )
    apart = F.xxhash64("group", "number")
    unit = F.when(F.col("apart"), apart).otherwise(F.col("group"))
    rows = rows.join(large, "group").select(
        "number",
        "doc_id",
        "size",
        "text_crc32",
        unit.alias("unit"),
        *(F.when(F.col("apart"), F.col(f"x{d}")).otherwise(F.col(f"g{d}")).alias(f"x{d}") for d in range(3)),
    )
    return stored(rows, "shard-units")


def _keys(points: DataFrame) -> DataFrame:
    """Each dimension as one whole number: the value's cell of the range, then a hash of the unit."""
    ranges = points.agg(*(f(f"x{d}") for d in range(3) for f in (F.min, F.max))).first()
    cells = (1 << _RESOLUTION) - 1
    for d in range(3):
        low, high = ranges[2 * d] or 0.0, ranges[2 * d + 1] or 0.0
        scaled = (F.col(f"x{d}") - low) / (high - low) * cells if high > low else F.lit(0.0)
        bits = F.pmod(F.xxhash64("unit", F.lit(d)), F.lit(1 << _HASH))
        points = points.withColumn(f"k{d}", scaled.cast("long") * (1 << _HASH) + bits)
    return points.drop("x0", "x1", "x2")


def _cuts(points: DataFrame, node: Column, widths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """For each node that has to become several shards: the dimension and the key to cut at.

    What reaches the driver has at most ``BINS`` rows for each of at most ``SHARDS`` nodes.
    """
    wanted = node.isin([n for n, w in widths.items() if w > 1])
    inner = points.where(wanted).withColumn("node", node)
    spans = inner.groupBy("node").agg(
        F.sum("size"), *(f(f"k{d}") for d in range(3) for f in (F.min, F.max))
    )
    goals, dims, lows, highs = {}, {}, {}, {}
    for row in spans.collect():
        n, total, *ends = row
        spread = [ends[2 * d + 1] - ends[2 * d] for d in range(3)]
        dims[n] = d = max(range(3), key=lambda i: (spread[i] >> _HASH, -i))
        lows[n], highs[n] = ends[2 * d], ends[2 * d + 1] + 1
        goals[n] = total * (widths[n] // 2) / widths[n]
    if not goals:
        return {}

    def by_node(values: dict[int, int]) -> Column:
        pairs = [F.lit(v) for kv in values.items() for v in kv]
        return F.element_at(F.create_map(*pairs), F.col("node"))

    key = F.element_at(F.array("k0", "k1", "k2"), by_node({n: d + 1 for n, d in dims.items()}))
    inner = inner.select("node", "size", key.alias("key"))
    below = dict.fromkeys(goals, 0)
    while any(highs[n] - lows[n] > 1 for n in goals):
        step = {n: max(1, -(-(highs[n] - lows[n]) // BINS)) for n in goals}
        low, high = by_node(lows), by_node(highs)
        cell = F.floor((F.col("key") - low) / by_node(step)).cast("long")
        counted = (
            inner.where((F.col("key") >= low) & (F.col("key") < high))
            .groupBy("node", cell.alias("cell"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
            .collect()
        )
        cells: dict[int, list] = {n: [] for n in goals}
        for n, c, size, count in counted:
            cells[n].append((c, size, count))
        single = True
        for n, found in cells.items():
            start, width = lows[n], step[n]
            for c, size, count in sorted(found):
                if below[n] + size >= goals[n]:
                    near_end = goals[n] - below[n] > size / 2
                    lows[n], highs[n] = start + c * width, start + (c + 1) * width
                    if count == 1 or width == 1:
                        edge = highs[n] if near_end else lows[n]
                        lows[n], highs[n] = edge, edge + 1
                    else:
                        single = False
                    break
                below[n] += size
        if single:
            break
    return {n: (dims[n], lows[n]) for n in goals}


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row for each document."""
    points = _keys(_points(docs, shards))
    bounds, tree = {0: (0, shards)}, {}

    def leaf(n: int, depth: int = 0) -> Column:
        """The leaf of a point below the node n: one comparison for each level."""
        if (n, depth) not in tree:
            return F.lit(n)
        d, edge, half = tree[n, depth]
        return F.when(F.col(f"k{d}") >= edge, leaf(half, depth + 1)).otherwise(leaf(n, depth + 1))

    depth = 0
    while any(end - first > 1 for first, end in bounds.values()):
        widths = {n: end - first for n, (first, end) in bounds.items()}
        cuts = _cuts(points, leaf(0), widths)
        if not cuts:  # no rows at all
            break
        for n, (d, edge) in cuts.items():
            first, end = bounds.pop(n)
            half = first + (end - first) // 2
            bounds[first], bounds[half] = (first, half), (half, end)
            tree[n, depth] = (d, edge, half)
        for n, (first, end) in bounds.items():  # the smallest nodes may be empty
            if n not in cuts and n in widths and end - first > 1:
                bounds[n] = (first, first + 1)
        depth += 1
    return _slots(points.withColumn("shard", leaf(0).cast("int")), points.count())


def _slots(rows: DataFrame, n: int) -> DataFrame:
    """A gapless place in each shard: the rows of the ranges before, and the place within the range."""
    ranges = max(1, -(-n // ROWS_PER_RANGE))
    rows = rows.withColumn("range", F.pmod(F.xxhash64("number"), F.lit(ranges)))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "range")
        .agg(F.count("*").alias("rows"))
        .withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    )
    inside = Window.partitionBy("shard", "range").orderBy("number")
    return rows.withColumn("inside", F.row_number().over(inside) - 1).join(
        starts, ["shard", "range"]
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("inside")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
