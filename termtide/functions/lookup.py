"""Bounded dictionaries as plan literals.

A dictionary of at most ``MAX_LITERAL_ENTRIES`` entries travels inside the plan
as one constant: short lists of keys and values, chosen by a hash of the key.  A
lookup costs the same whether the dictionary has ten entries or fifty thousand,
needs no shuffle and no Python worker.  Larger dictionaries stay DataFrames and
are joined (see ``termtide.operators.joins``).

The constant is made of arrays, not of maps: Spark compares arrays by content, so
two uses of one dictionary are recognised as the same and can share an exchange.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LITERAL_ENTRIES = 50_000

# Above this many values an ``IN`` list is slower to plan than a literal map.
MAX_IN_LIST = 1_000


def literal_array(values: Sequence[Any], element_type: str = "string") -> Column:
    """A constant array, sent to the JVM in one piece and folded by Catalyst."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element_type}>")


def literal_map(
    mapping: Mapping[str, Any], value_type: str = "string"
) -> Callable[[Column], Column]:
    """Return ``key column -> value column`` (NULL where the key is absent)."""
    if len(mapping) > MAX_LITERAL_ENTRIES:
        raise ValueError(
            f"{len(mapping)} entries exceed the literal bound of {MAX_LITERAL_ENTRIES}; "
            "keep the dictionary as a DataFrame and join it"
        )
    n_buckets = max(1, len(mapping) // 2)
    buckets: list[dict[str, list]] = [{"k": [], "v": []} for _ in range(n_buckets)]
    for key, value in mapping.items():
        bucket = buckets[zlib.crc32(key.encode("utf-8")) % n_buckets]
        bucket["k"].append(key)
        bucket["v"].append(value)
    constant = F.from_json(
        F.lit(json.dumps(buckets)), f"array<struct<k:array<string>,v:array<{value_type}>>>"
    )

    def lookup(key: Column) -> Column:
        if n_buckets == 1:
            bucket = constant[F.lit(0)]
        else:
            bucket = constant[F.pmod(F.crc32(key.cast("binary")), F.lit(n_buckets)).cast("int")]
        place = F.array_position(bucket["k"], key).cast("int")
        return F.get(bucket["v"], place - 1)

    return lookup


def member_of(values: Sequence[str]) -> Callable[[Column], Column]:
    """Return ``column -> is it one of the values``."""
    values = list(dict.fromkeys(values))
    if not values:
        return lambda c: F.lit(False)
    if len(values) <= MAX_IN_LIST:
        return lambda c: c.isin(values)
    lookup = literal_map({v: 1 for v in values}, "int")
    return lambda c: lookup(c).isNotNull()
