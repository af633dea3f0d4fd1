"""Replacing phrases of a table of any size."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from termtide.functions.lookup import MAX_LITERAL_ENTRIES
from termtide.functions.text import replace_phrases
from termtide.operators.blocks import lists_of, one_array
from termtide.operators.joins import lookup_join
from termtide.session import stored
from termtide.sources.lists import bounded_dict

# Word characters and others in turns.  A phrase begins and ends where they change, so it is a
# sequence of whole runs.
RUN = r"(?U)\w+|\W+"

# Texts that meet the phrases together, in octets, and how much a row counts besides its text.
BLOCK_OCTETS = 4 << 20
ROW_OCTETS = 64
# A bucket holds about so many phrases, so many octets of them, and sequences of so many octets of text for each kind of phrase.
BUCKET_PHRASES = 1 << 18
BUCKET_OCTETS = 32 << 20
BUCKET_TEXT = 64 << 20

_CODEC = pa.Codec("zstd", 3)
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def phrase_table(phrases: DataFrame | Mapping[str, str], df: DataFrame, lower: bool = False) -> DataFrame:
    """``(synonym, head)`` with one head for each phrase, the least of those that are listed."""
    if not isinstance(phrases, DataFrame):
        rows = list({k.lower() if lower else k: v for k, v in phrases.items()}.items())
        phrases = df.sparkSession.createDataFrame(rows, "synonym string, head string")
    synonym = F.lower("synonym") if lower else F.col("synonym")
    return (
        phrases.where((F.col("synonym") != "") & F.col("head").isNotNull())
        .groupBy(synonym.alias("synonym"))
        .agg(F.min("head").alias("head"))
    )


def with_replaced_phrases(
    df: DataFrame,
    phrases: DataFrame | Mapping[str, str],
    *,
    text: str = "full_text",
    lower: bool = False,
    max_literal: int = MAX_LITERAL_ENTRIES,
    **bounds,
) -> DataFrame:
    """Replace whole-word phrases, the longest of the leftmost first, as ``replace_phrases`` does.

    Up to ``max_literal`` phrases are one pattern in the plan.  Beyond that texts are cut into runs, and phrases are dealt
    out over buckets by their hash.  A block of texts asks each bucket once for the sequences of runs it has, of the
    lengths that phrases have, by a sorted list of hashes.  The phrases found go back to the block, where the texts
    themselves are compared and overlaps are settled.  Texts move once, at the end; all that moves is packed.
    """
    if not isinstance(phrases, DataFrame) and len(phrases) <= max_literal:
        return df.withColumn(text, replace_phrases(text, {k.lower() if lower else k: v for k, v in phrases.items()}))
    phrases = stored(phrase_table(phrases, df, lower), "phrases", "zstd")
    entries = bounded_dict(phrases, "synonym", "head", max_literal)
    if entries is not None:
        return df.withColumn(text, replace_phrases(text, entries))

    changes = _word_changes(df.sparkSession)
    kinds, buckets = _extent(phrases, changes)
    names, kept = df.columns, df.schema
    numbered = StructType([*kept, StructField("_block", LongType())])
    rows = stored(df.mapInArrow(lambda batches: _numbered(batches, text), numbered), "phrase-rows", "zstd")
    # At most one bucket for each part of the text that one may be asked for.
    octets = rows.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = max(buckets, -(-octets * len(kinds) // BUCKET_TEXT))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            yield _asked(block, one_array(rows.column(text)), kinds, buckets, changes)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _dealt(batches, buckets)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            yield pa.RecordBatch.from_pydict({"_block": pa.array([block]), "_rows": pa.array([_pack(rows)], pa.binary())})

    lists = (
        rows.select("_block", text)
        .mapInArrow(asked, "_bucket long, _block long, _keys binary")
        .groupBy("_bucket")
        .agg(F.collect_list(F.struct("_block", "_keys")).alias("_asked"))
    )
    side = phrases.mapInArrow(dealt, "_bucket long, _pack binary").groupBy("_bucket").agg(F.collect_list("_pack").alias("_packs"))
    found = lookup_join(lists, side, ["_bucket"], "inner", distinct=True, **bounds)
    found = found.select("_asked", "_packs").mapInArrow(_answered, "_block long, _found binary")

    def replaced(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows, found = _unpacked(rows.column("_rows")), _unpacked_phrases(found.column("_found"))
        if found is not None:
            at = rows.schema.get_field_index(text)
            rows = rows.set_column(at, rows.schema.field(at), _replaced(one_array(rows.column(at)), found, kinds, changes))
        return rows.select(names)

    moved = rows.mapInArrow(packed, "_block long, _rows binary")
    return moved.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(replaced, kept)


@functools.cache
def _word_changes(spark: SparkSession) -> tuple[int, ...]:
    """The code points where word characters and others change, by the pattern's own class; the first are none."""
    chars = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    runs = F.regexp_extract_all("chars", F.lit(RUN), F.lit(0))
    (sizes,) = spark.createDataFrame([(chars,)], "chars string").select(F.transform(runs, F.length)).collect()
    ends = np.cumsum(sizes[0])[:-1]
    # Surrogates are no characters of a text.
    return tuple(np.where(ends < 0xD800, ends, ends + 0x800).tolist())


@functools.lru_cache(1)
def _word_table(changes: tuple[int, ...]) -> np.ndarray:
    """For each code point whether it is a word character."""
    return np.repeat(np.arange(len(changes) + 1) % 2 == 1, np.diff((0, *changes, 0x110000)))


def _runs(texts: pa.Array, changes: tuple[int, ...]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The runs of all texts one after the other, how many each text has, and whether it begins with a word."""
    whole = "".join(t for t in texts.to_pylist() if t is not None)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    is_word = _word_table(changes)[points]
    lengths = pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts, some = np.cumsum(lengths) - lengths, lengths > 0
    begins = np.zeros(len(lengths), bool)
    begins[some] = is_word[starts[some]]
    edge = np.zeros(len(points), bool)
    edge[1:] = is_word[1:] != is_word[:-1]
    edge[starts[some]] = True
    at = np.flatnonzero(edge)
    sizes = np.diff(np.searchsorted(at, np.append(starts, len(points))))
    octets = np.ones(len(points), np.uint8)
    for most in (0x7F, 0x7FF, 0xFFFF):
        octets += points > most
    ends = np.zeros(len(at) + 1, np.int32)
    if len(at):
        np.cumsum(np.add.reduceat(octets, at, dtype=np.int64), out=ends[1:])
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(whole.encode())), sizes, begins


def _extent(phrases: DataFrame, changes: tuple[int, ...]) -> tuple[list[tuple[int, bool]], int]:
    """The kinds of phrases, by number of runs and what they begin with, and how many buckets hold them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, sizes, begins = _runs(batch.column("synonym"), changes)
            octets = pc.add(pc.binary_length(batch.column("synonym")), pc.binary_length(batch.column("head"))).cast("int64")
            kinds = pa.table({"runs": sizes, "word": begins, "octets": octets}).group_by(["runs", "word"])
            found = kinds.aggregate([("octets", "count"), ("octets", "sum")])
            yield from found.select(["runs", "word", "octets_count", "octets_sum"]).rename_columns(["runs", "word", "n", "octets"]).to_batches()

    found = phrases.mapInArrow(counted, "runs long, word boolean, n long, octets long").groupBy("runs", "word")
    # As many as phrases have lengths, twice at most.
    kinds = found.agg(F.sum("n").alias("n"), F.sum("octets").alias("octets")).collect()
    n, octets = (sum(r[c] for r in kinds) for c in ("n", "octets"))
    return [(r["runs"], r["word"]) for r in kinds], max(-(-n // BUCKET_PHRASES), -(-octets // BUCKET_OCTETS))


def _numbered(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The rows with the number of their block, which holds texts of ``BLOCK_OCTETS`` or one larger text at its end."""
    first, filled = TaskContext.get().partitionId() << 36, 0
    for batch in batches:
        octets = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_OCTETS
        ends = filled + np.cumsum(octets)
        filled = int(ends[-1]) if len(ends) else filled
        yield batch.append_column("_block", pa.array(first + (ends - octets) // BLOCK_OCTETS))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each block; a block that two tasks share comes twice."""
    held, of = [], None
    for batch in batches:
        blocks = batch.column("_block").to_numpy()
        starts = np.flatnonzero(np.diff(blocks, prepend=-1)).tolist()
        for start, end in zip(starts, [*starts[1:], len(blocks)]):
            if blocks[start] != of and held:
                yield of, pa.Table.from_batches(held)
                held = []
            of = int(blocks[start])
            held.append(batch.slice(start, end - start).drop_columns(["_block"]))
    if held:
        yield of, pa.Table.from_batches(held)


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=_CODEC)) as stream:
        stream.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(packs: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(pack.as_buffer()).read_all() for pack in packs]).combine_chunks()


def _pack_phrases(phrases: pa.Table) -> bytes:
    """The lengths of all strings, then synonyms and heads in one piece, since they are often alike."""
    columns = [one_array(phrases.column(c)) for c in ("synonym", "head")]
    sizes = [_planes(pc.binary_length(c).to_numpy(zero_copy_only=False)) for c in columns]
    ends = pa.array([0, phrases.num_rows], pa.int32())
    whole = b"".join([*sizes, *(pc.binary_join(pa.ListArray.from_arrays(ends, c), "")[0].as_buffer() for c in columns)])
    return np.array([phrases.num_rows, len(whole)], "<i8").tobytes() + _CODEC.compress(whole, asbytes=True)


def _unpacked_phrases(packs: pa.ChunkedArray | pa.Array) -> pa.Table | None:
    """The phrases packed, all in one, or None if there are none."""
    tables = []
    for pack in packs:
        octets = pack.as_buffer()
        n, size = np.frombuffer(octets, "<i8", 2).tolist()
        whole = _CODEC.decompress(octets[16:], size)
        columns, at = [], 8 * n
        for i in range(2):
            ends = np.append(0, np.cumsum(_numbers(whole[4 * n * i : 4 * n * (i + 1)]), dtype=np.int64)).astype(np.int32)
            columns.append(pa.StringArray.from_buffers(n, pa.py_buffer(ends), whole[at : at + int(ends[-1])]))
            at += int(ends[-1])
        tables.append(pa.table(columns, ["synonym", "head"]))
    return pa.concat_tables(tables).combine_chunks() if tables else None


def _places(strings: pa.Array, buckets: int) -> np.ndarray:
    """Where phrases are looked for: the bucket in the upper half, by one half of the hash, and the other in the lower."""
    hashes = pd.util.hash_array(strings.to_numpy(zero_copy_only=False), categorize=False)
    return ((hashes >> _HALF) * np.uint64(buckets) & ~_LOW) | (hashes & _LOW)


def _by_bucket(places: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The buckets of sorted places, each with where it begins and ends."""
    buckets = (places >> _HALF).astype(np.int64)
    starts = np.flatnonzero(np.diff(buckets, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], len(buckets)]):
        yield int(buckets[start]), start, end


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers of four octets, the lowest octets of all first: the highest are mostly zeros."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes | pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return _planes(np.diff(keys, prepend=np.uint32(0)))


def _keys(steps: bytes) -> np.ndarray:
    return np.cumsum(_numbers(steps), dtype=np.uint32)


def _sequences(
    runs: pa.Array, sizes: np.ndarray, word: np.ndarray, kinds: list[tuple[int, bool]]
) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """For each kind of phrase its number of runs, and where such sequences begin in the runs of all texts, and what they are.

    A text that begins with something else than a word has no word boundary there, and neither has its end.
    """
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(runs)) - np.repeat(starts, sizes)
    # Runs of word characters and of others take turns.
    is_word = np.repeat(word, sizes) ^ (place % 2 == 1)
    first = np.repeat(np.where(word, 0, 1), sizes)
    ends_in_word = word ^ (sizes % 2 == 0)
    last = np.repeat(np.where(ends_in_word, sizes, sizes - 1), sizes)
    for n, begins in kinds:
        at = np.flatnonzero((place >= first) & (place + n <= last) & (is_word == begins))
        yield n, at, pc.binary_join_element_wise(*(runs.take(pa.array(at + i)) for i in range(n)), "")


def _asked(block: int, texts: pa.Array, kinds: list[tuple[int, bool]], buckets: int, changes: tuple[int, ...]) -> pa.RecordBatch:
    """What a block asks of each bucket: the distinct sequences of runs that may be phrases, by their hashes."""
    runs = _runs(texts, changes)
    places = [_places(pc.unique(sequences), buckets) for _, _, sequences in _sequences(*runs, kinds)]
    places = np.sort(np.concatenate(places))
    places = places[np.diff(places, prepend=~places[:1]) != 0]
    parts = [(bucket, _steps((places[start:end] & _LOW).astype(np.uint32))) for bucket, start, end in _by_bucket(places)]
    return pa.RecordBatch.from_pydict({
        "_bucket": pa.array([bucket for bucket, _ in parts], pa.int64()),
        "_block": pa.array([block] * len(parts), pa.int64()),
        "_keys": pa.array([steps for _, steps in parts], pa.binary()),
    })


def _dealt(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Phrases packed by bucket, as many at a time as one holds."""
    held = []

    def parts() -> pa.RecordBatch:
        phrases = pa.Table.from_batches(held).combine_chunks()
        places = _places(one_array(phrases.column("synonym")), buckets)
        order = np.argsort(places >> _HALF, kind="stable")
        phrases = phrases.take(pa.array(order))
        parts = [(bucket, _pack_phrases(phrases.slice(start, end - start))) for bucket, start, end in _by_bucket(places[order])]
        return pa.RecordBatch.from_pydict({
            "_bucket": pa.array([bucket for bucket, _ in parts], pa.int64()),
            "_pack": pa.array([pack for _, pack in parts], pa.binary()),
        })

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BUCKET_PHRASES or sum(b.nbytes for b in held) >= BUCKET_OCTETS:
            yield parts()
            held = []
    if held:
        yield parts()


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block that asked a bucket the phrases found there, packed."""
    for batch in batches:
        for asked, packs in zip(batch.column("_asked"), batch.column("_packs")):
            phrases = _unpacked_phrases(packs.values).sort_by("synonym")
            keys = (_places(one_array(phrases.column("synonym")), 1) & _LOW).astype(np.uint32)
            order = np.argsort(keys)
            keys = keys[order]
            blocks, found = [], []
            for block, steps in zip(*(asked.values.field(c).to_pylist() for c in ("_block", "_keys"))):
                at = _found(keys, _keys(steps))
                if at.size:
                    blocks.append(block)
                    # In the order of the phrases they take less room.
                    found.append(_pack_phrases(phrases.take(pa.array(np.sort(order[at])))))
            yield pa.RecordBatch.from_pydict({"_block": pa.array(blocks, pa.int64()), "_found": pa.array(found, pa.binary())})


def _found(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where the asked are among sorted keys, all of them if a key repeats."""
    first = np.searchsorted(keys, asked)
    last = np.searchsorted(keys, asked, "right")
    sizes = last - first
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def _replaced(texts: pa.Array, found: pa.Table, kinds: list[tuple[int, bool]], changes: tuple[int, ...]) -> pa.Array:
    """The texts of a block with the phrases replaced that were found for it."""
    runs, sizes, word = _runs(texts, changes)
    synonyms, heads = one_array(found.column("synonym")), one_array(found.column("head"))
    hits = []
    for n, at, sequence in _sequences(runs, sizes, word, kinds):
        hit = pc.index_in(sequence, value_set=synonyms).fill_null(-1).to_numpy(zero_copy_only=False)
        some = np.flatnonzero(hit >= 0)
        hits.append(np.stack([at[some], np.full(len(some), n), hit[some]]))
    places, lengths, entries = np.concatenate(hits, axis=1)
    chosen = _leftmost(places, lengths)
    covered = np.zeros(len(runs) + 1, np.int64)
    covered[places[chosen]] += 1
    covered[places[chosen] + lengths[chosen]] -= 1
    head = np.zeros(len(runs), bool)
    head[places[chosen]] = True
    pieces = pc.if_else(pa.array(np.cumsum(covered[:-1]) > 0), "", runs)
    pieces = pc.replace_with_mask(pieces, pa.array(head), heads.take(pa.array(entries[chosen])))
    return pc.binary_join(lists_of(sizes, pieces, texts.is_null()), "")


def _leftmost(places: np.ndarray, lengths: np.ndarray) -> list[int]:
    """The hits, by place and the longest first, without those that begin before the one chosen last has ended."""
    order, chosen, end = np.lexsort((-lengths, places)), [], 0
    for i, at, n in zip(order.tolist(), places[order].tolist(), lengths[order].tolist()):
        if at >= end:
            chosen.append(i)
            end = at + n
    return chosen
