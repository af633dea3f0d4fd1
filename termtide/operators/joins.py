"""Joins against side tables whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 32
# A key is dealt out over the salts if it holds more facts than this and is one of the largest.
HEAVY_ROWS = 100_000
MAX_HEAVY = 200
SMALL_BYTES = 64 << 20


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether a side table is small enough for every executor to hold.

    Reads at most ``max_rows + 1`` rows and brings back two numbers.
    """
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    rows, octets = (
        df.limit(max_rows + 1)
        .select(size.alias("_size"))
        .agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and octets <= max_bytes


def heavy_keys(facts: DataFrame, on: Sequence[str]) -> list[tuple]:
    """The keys that hold the most facts, if these are more than ``HEAVY_ROWS``.

    Facts are counted by key, before the shuffle already, and at most ``MAX_HEAVY`` keys come back; one
    that is left out holds less than one in ``MAX_HEAVY`` of the facts.  Facts that any one task can hold
    are not counted.
    """
    if facts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < SMALL_BYTES:
        return []
    counts = facts.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > HEAVY_ROWS)
    return [tuple(r)[:-1] for r in counts.orderBy(F.desc("_n")).limit(MAX_HEAVY).collect()]


def _one_of(on: Sequence[str], keys: Sequence[tuple]) -> Column:
    """Whether a row has one of the keys.

    A column meets its values as a set.  A comparison for each of 200 keys would make the generated code of the stage so
    long that the JVM leaves it uncompiled, with everything before the join in it.
    """
    if not keys:
        return F.lit(False)
    found = reduce(and_, (F.col(c).isin(list(dict.fromkeys(values))) for c, values in zip(on, zip(*keys))))
    if len(on) > 1:
        # Few rows have a value of a heavy key in every column; these alone are compared key by key.
        tests = [reduce(and_, (F.col(c) == v for c, v in zip(on, key))) for key in keys]
        found = F.when(found, reduce(or_, tests))
    return F.coalesce(found, F.lit(False))


def lookup_join(
    facts: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
    distinct: bool = False,
) -> DataFrame:
    """Equi-join facts to a side table.

    A side table of proven size is broadcast and the facts do not move.  A larger one is shuffled.  Keys
    that hold a large share of the facts are found in a pass over the key columns; facts of such a key, or
    without a key, are dealt out over the salts, and the side's rows of these keys alone are repeated once per
    salt.  All others join plainly.  ``how`` is one of inner, left, left_semi, left_anti.

    ``distinct`` says that each key holds one fact at most, and none is missing: neither side is looked at before.
    """
    on = list(on)
    if distinct:
        return facts.join(side.hint("merge"), on, how)
    if max_rows > 0 and fits_broadcast(side, max_rows, max_bytes):
        return facts.join(F.broadcast(side), on, how)
    is_heavy = _one_of(on, [k for k in heavy_keys(facts, on) if None not in k])
    missing = F.coalesce(*(F.when(F.col(c).isNull(), True) for c in on), F.lit(False))
    # The number of the partition is the same however often a task is retried.
    dealt = F.when(is_heavy | missing, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(0)
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = side.withColumn("_salt", F.explode(copies)).hint("merge")
    return facts.withColumn("_salt", dealt).join(repeated, [*on, "_salt"], how).drop("_salt")


def with_entries(
    rows: DataFrame, keys: Column, side: DataFrame, key: str, output: str, number: str = "_row", **bounds
) -> DataFrame:
    """Stored rows with the entries of a side table for the keys of each row, as an array of structs.

    Only (row number, key) meets the side table, only what it holds goes back, and the rows themselves
    move once, at the end.  ``rows`` have a number of their own and are read more than once.
    """
    asked = rows.select(number, F.explode(F.array_distinct(keys)).alias(key))
    found = (
        lookup_join(asked, side, [key], "inner", **bounds)
        .groupBy(number)
        .agg(F.collect_list(F.struct(*side.columns)).alias(output))
    )
    return rows.join(found, number, "left")


def join_source_metadata(articles: DataFrame, metadata: DataFrame, **bounds) -> DataFrame:
    """Articles with the metadata of their source, articles without one included.

    ``source.uri`` meets ``Source URL``.  Metadata has one row per source.
    """
    keyed = articles.withColumn("_source", F.col("source.uri"))
    side = metadata.withColumn("_source", F.col("Source URL"))
    return lookup_join(keyed, side, ["_source"], "left", **bounds).drop("_source")


def without_stopwords(
    rows: DataFrame, stopwords: DataFrame, token: str = "token", word: str = "word", **bounds
) -> DataFrame:
    """Token rows whose token is no stop word."""
    side = stopwords.select(F.col(word).alias(token)).distinct()
    return lookup_join(rows, side, [token], "left_anti", **bounds)
