"""Choosing posts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from termtide.operators.normalize import has_field

REGION = "Region (Census)"
DIVISION = "Division (Census)"
STATE = "State"

TWEET_TYPES = ("tweet", "retweet", "quote")


def _choices(values: Sequence[str] | str | None, delimited: bool) -> list[str]:
    values = [values] if isinstance(values, str) else list(values or ())
    if delimited and len(values) == 1:
        values = values[0].split("|")
    return [v for v in values if v]


def _where_in(df: DataFrame, column: str, values, delimited: bool = False) -> DataFrame:
    choices = _choices(values, delimited)
    return df.where(F.col(f"`{column}`").isin(choices)) if choices else df


# An empty choice means no restriction.


def filter_news_region(df: DataFrame, regions) -> DataFrame:
    return _where_in(df, REGION, regions, delimited=True)


def filter_news_division(df: DataFrame, divisions) -> DataFrame:
    return _where_in(df, DIVISION, divisions, delimited=True)


def filter_news_states(df: DataFrame, states) -> DataFrame:
    return _where_in(df, STATE, states)


def filter_news_concepts(df: DataFrame, concepts) -> DataFrame:
    """Articles that carry at least one of the concepts."""
    concepts = _choices(concepts, delimited=False)
    if not concepts:
        return df
    wanted = F.array(*[F.lit(c) for c in concepts])
    return df.where(F.arrays_overlap(F.col("concepts.label.eng"), wanted))


def filter_outlet(df: DataFrame, outlets) -> DataFrame:
    return _where_in(df, "outlet", outlets)


def filter_tweet_types(df: DataFrame, types: Sequence[str] | None) -> DataFrame:
    """Keep the wanted kinds of tweet.

    A missing column counts as never a retweet, or never a quote.  Leaving out
    quotes leaves out tweets of which it is unknown whether they quote.
    """
    if not types:
        return df
    unknown = set(types) - set(TWEET_TYPES)
    if unknown:
        raise ValueError(f"unknown tweet types {sorted(unknown)}")
    has_retweet = has_field(df, "retweeted_status")
    has_quote = has_field(df, "is_quote_status")
    is_retweet = F.col("retweeted_status").isNotNull() if has_retweet else F.lit(False)
    is_quote = F.col("is_quote_status").cast("boolean") if has_quote else F.lit(False)
    if "retweet" not in types and has_retweet:
        df = df.where(~is_retweet)
    if "quote" not in types and has_quote:
        df = df.where(~is_quote)
    if "tweet" not in types:
        df = df.where(is_retweet | is_quote)
    return df


def filter_lang(df: DataFrame, lang: str | None) -> DataFrame:
    """Posts of one language; tables without a language column are left alone."""
    if not lang or not has_field(df, "lang"):
        return df
    return df.where(F.col("lang") == lang)


def filter_dates(
    df: DataFrame, start: str | dt.date | None = None, end: str | dt.date | None = None
) -> DataFrame:
    """Posts from ``start`` to ``end``, both days included."""
    if start:
        df = df.where(F.col("date") >= F.lit(str(start)).cast("date"))
    if end:
        df = df.where(F.col("date") <= F.lit(str(end)).cast("date"))
    return df


def filter_timestamps(
    df: DataFrame, start: str | dt.datetime | None = None, end: str | dt.datetime | None = None
) -> DataFrame:
    """Posts from ``start`` to ``end``, both moments included.

    Without a ``timestamp`` column the days of the two moments decide.
    """
    if not has_field(df, "timestamp"):
        return filter_dates(df, start and str(start)[:10], end and str(end)[:10])
    if start:
        df = df.where(F.col("timestamp") >= F.lit(str(start)).cast("timestamp"))
    if end:
        df = df.where(F.col("timestamp") <= F.lit(str(end)).cast("timestamp"))
    return df


def filter_period(
    df: DataFrame, *, start_date=None, end_date=None, start_datetime=None, end_datetime=None
) -> DataFrame:
    """Each end of the period is given as a day or as a moment, not as both."""
    if start_date and start_datetime or end_date and end_datetime:
        raise ValueError("give each end of the period as a date or as a datetime, not both")
    return filter_timestamps(filter_dates(df, start_date, end_date), start_datetime, end_datetime)


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def dedupe_by_id(df: DataFrame, key: str = "id_str") -> DataFrame:
    """One post per id: the earliest, then the first by text and other columns.

    The survivor is a minimum, so copies are dropped before the shuffle and an id
    with any number of copies never gathers in one task.
    """
    first = [c for c in ("timestamp", "full_text") if c in df.columns and c != key]
    others = [*first, *(c for c in df.columns if c not in (key, *first))]
    ordered = [c for c in others if _orderable(df.schema[c].dataType)]
    carried = [c for c in others if c not in ordered]

    undated = [F.col("timestamp").isNull().alias("_undated")] if "timestamp" in ordered else []
    rank = F.struct(*undated, *[F.col(f"`{c}`") for c in ordered], F.lit(0).alias("_"))
    kept = [F.min(rank).alias("_kept")]
    if carried:
        kept.append(F.min_by(F.struct(*carried), rank).alias("_carried"))

    def column(name: str) -> Column:
        if name == key:
            return F.col(f"`{key}`")
        holder = "_carried" if name in carried else "_kept"
        return F.col(holder)[name].alias(name)

    return df.groupBy(f"`{key}`").agg(*kept).select(*map(column, df.columns))
