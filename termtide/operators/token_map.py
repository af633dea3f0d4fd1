"""Replacing single tokens through a dictionary table (stems, lemmas, synonyms)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termtide.functions.lookup import MAX_LITERAL_ENTRIES, literal_map
from termtide.operators.blocks import block_of, list_sizes, lists_of, one_array
from termtide.operators.joins import lookup_join
from termtide.session import numbered_rows, stored
from termtide.sources.lists import bounded_dict

# Words that lemmatising leaves alone.
LEMMA_EXCLUSIONS = ("pence", "chose")


def map_tokens(
    tokens: Column | str, mapping: Mapping[str, str], exclude: Sequence[str] = ()
) -> Column:
    """Map each token, keeping order, duplicates and tokens without an entry."""
    lookup = literal_map({k: v for k, v in mapping.items() if k not in set(exclude)})
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.transform(tokens, lambda t: F.coalesce(lookup(t), t))


def with_mapped_tokens(
    df: DataFrame,
    mapping: DataFrame | Mapping[str, str],
    *,
    tokens: str = "tokens",
    key: str = "synonym",
    value: str = "head",
    exclude: Sequence[str] = (),
    max_literal: int = MAX_LITERAL_ENTRIES,
    number: str | None = None,
    **bounds,
) -> DataFrame:
    """Map the tokens of every row through a dictionary table of any size.

    Up to ``max_literal`` entries the dictionary is a plan constant and nothing is
    shuffled.  Beyond that the rows are stored once, the distinct tokens of a block of
    rows meet the dictionary, and what is found is put in place within the block.

    ``number`` says that the rows are stored already, with such a column, which is dropped.
    """
    kept = df.drop(number) if number else df
    if not isinstance(mapping, DataFrame):
        return kept.withColumn(tokens, map_tokens(tokens, mapping, exclude))
    # One head for each token, whatever the form: the least of those that are listed.
    mapping = (
        mapping.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(key).alias(key))
        .agg(F.min(value).alias(value))
    )
    if exclude:
        mapping = mapping.where(~F.col(key).isin(list(exclude)))
    entries = bounded_dict(mapping, key, value, max_literal)
    if entries is not None:
        return kept.withColumn(tokens, map_tokens(tokens, entries))

    rows = df if number else numbered_rows(df, "token-rows")
    rows = rows.withColumn("_block", block_of(number or "_row", F.size(tokens)))
    side = stored(mapping.select(F.col(key).alias("_token"), F.col(value).alias("_mapped")), "token-map")
    listed = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    asked = rows.select("_block", listed.alias("_tokens")).mapInArrow(_asked, "_block long, _token string")
    found = lookup_join(stored(asked, "token-blocks"), side, ["_token"], "inner", **bounds)
    names = [c for c in df.columns if c != number]

    def placed(rows: pa.Table, found: pa.Table) -> pa.Table:
        at = rows.schema.get_field_index(tokens)
        return rows.set_column(at, rows.schema.field(at), _placed(rows.column(at), found)).select(names)

    schema = StructType([rows.schema[c] for c in names])
    return rows.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(placed, schema)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct tokens of each block; a block that two batches share may ask twice."""
    for batch in batches:
        lists = batch.column("_tokens")
        blocks = batch.column("_block").take(pc.list_parent_indices(lists))
        pairs = pa.table({"_block": blocks, "_token": lists.flatten()})
        yield from pairs.group_by(["_block", "_token"]).aggregate([]).select(["_block", "_token"]).to_batches()


def _placed(column: pa.ChunkedArray, found: pa.Table) -> pa.Array:
    """The token lists of a block with what was found for them."""
    lists = one_array(column)
    flat = lists.flatten()
    heads = one_array(found.column("_mapped")).take(pc.index_in(flat, value_set=one_array(found.column("_token"))))
    return lists_of(list_sizes(lists), pc.coalesce(heads, flat), lists.is_null(), lists.type)
