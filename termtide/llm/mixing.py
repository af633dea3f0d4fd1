"""Mixing sources to target weights.

Every document gets a hash-random key.  Within each source the keys are cut into ranges,
the words of the ranges are summed, and the sums of the ranges before give every document
its place in the source's random order.  The source is cut at its exact budget: documents
before the cut are taken, the one at the cut with the words that are left, and a budget
above the source's size takes every document once for each full epoch first.

Null text has no words.  A null source is a source of its own, the last one; a null doc_id
has a key like any other.  Rows that are repeated are documents of their own.  Sources of
size 0 have the target 0.  Further columns of the input are left out of ``mix_plan`` and
kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termtide.llm.common import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
ROWS_PER_RANGE = 50_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_key(column: Column) -> Column:
    """A number of 52 bits that looks random and is the same on every run."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(column.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target), a row for each source.

    All sources share ``SHARE`` times the total by weight; what would take one above
    ``LIMIT`` times its size goes to the others by weight.  Sources are filled up in the order of
    limit / weight: once the level (budget left / weight left) no longer reaches the next
    source's limit, it holds for all that follow.
    """
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    by_need = Window.partitionBy(F.lit(0)).orderBy("need", F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(0, Window.unboundedFollowing)
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(weights, (F.col("place") - 1) % len(WEIGHTS) + 1))
        .withColumn("most", F.col("source_size") * float(LIMIT))
        .withColumn("need", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * SHARE)
        .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.sum("weight").over(after))
        .withColumn(
            "level", F.max(F.when(F.col("level") <= F.col("need"), F.col("level"))).over(everything)
        )
        .withColumn("target", F.least(F.col("most"), F.col("weight") * F.col("level")))
        .select("source", "source_size", F.coalesce("target", "most").alias("target"))
    )


def mix_plan(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, key), a row for each document."""
    sizes = stored(
        docs.select(
            "doc_id", "source", n_words(F.col("text")).alias("size"), random_key(F.col("doc_id")).alias("key")
        ),
        "mix-sizes",
    )
    # At most a row for each source: joined by what the optimiser knows of its size.
    targets = source_targets(sizes)
    ranges = max(1, -(-sizes.count() // ROWS_PER_RANGE))
    width = -(-(1 << 52) // ranges)
    placed = sizes.withColumn("range", F.floor(F.col("key") / F.lit(width)).cast("int"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source", "range")
        .agg(F.sum("size").alias("words"))
        .withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select(
            F.col("source").alias("of"), F.col("range").alias("at"), "start", "source_size", "target"
        )
    )
    inside = (
        Window.partitionBy("source", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - F.col("epochs") * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("before")))
    return (
        placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")))
        .withColumn("before", F.col("start") + F.col("inside"))
        .withColumn("epochs", epochs)
        .withColumn("taken", (F.col("epochs") * F.col("size") + cut).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "key")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    Documents stay whole: the one at a source's cut counts as taken when at least half of its
    words are.  Documents without words are no part of any budget and stay once.  Copies of
    one row share its doc_id.
    """
    ident = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))  # no null, so that one shuffle serves window and join
    by_id = Window.partitionBy("_id")
    plan = mix_plan(docs).select(
        ident.alias("_id"),
        "source",
        "size",
        F.when(F.col("size") == 0, 1)
        .otherwise(F.floor(F.col("taken") / F.col("size") + 0.5))
        .cast("int")
        .alias("_copies"),
    )
    plan = plan.select(
        "_id", "_copies", F.row_number().over(by_id.orderBy("source", "size", "_copies")).alias("_nth")
    )
    numbered = docs.select(ident.alias("_id"), F.struct(*docs.columns).alias("_row")).withColumn(
        "_nth", F.row_number().over(by_id.orderBy("_row.source", n_words(F.col("_row.text"))))
    )
    copies = F.explode(F.array_repeat(F.lit(1), F.col("_copies")))
    return numbered.join(plan, ["_id", "_nth"]).select("_row", copies).select("_row.*")


ORACLE = rf"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         source_size * 2.0::DOUBLE AS most,
         (sum(source_size) OVER ()) * 1.5::DOUBLE AS total
  FROM sources),
levels AS (
  SELECT *, most / weight AS need,
         (total - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size,
         coalesce(least(most, weight * (max(CASE WHEN level <= need THEN level END) OVER ())), most) AS target
  FROM levels),
ordered AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size,
          floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM ordered
"""
