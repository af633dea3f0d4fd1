"""Which words occur together with the words of a topic, and how often.

A post matches a topic through every topic word among its tokens.  Each matched
word contributes all tokens of the post, except topic words listed no later than
itself.  So a token that is no topic word counts once per matched word of the
topic, and a topic word counts once per matched word listed before it.  That
number, the weight, is all a row needs: rows are (post, token, matched topic) and
the counts are sums of weights.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.functions.intervals import interval_label
from termtide.functions.lookup import literal_array, literal_map
from termtide.operators.blocks import list_sizes
from termtide.operators.joins import fits_broadcast, with_entries
from termtide.session import numbered_rows, stored

# Topic vocabularies up to this size travel inside the plan, larger ones are joined.
MAX_LITERAL_WORDS = 20_000

# ``array_intersect`` is quickest for few words, but goes through all of them for
# every post; from here on every token is looked up by hash instead.
_LOOK_UP_FROM = 64

# Sums that stand side by side where there are many topics.
_COLUMNS = 16

# Posts whose sums are made at once, their counts of topic words, and pairs of a post and a word at a time.
_POSTS, _CELLS, _PAIRS = 8192, 1 << 22, 1 << 14
# Fewer posts if they have more tokens than this.
_TOKENS = 1 << 22

# Bits of the filter of frequent words.
_BITS = 1 << 24


@dataclass(frozen=True)
class TopicSet:
    """Topic words in listing order; a repeated word stays with its first topic."""

    entries: tuple[tuple[str, str], ...]
    n_topics: int

    @classmethod
    def of(cls, topics: Iterable[Mapping]) -> TopicSet:
        topics = [topics] if isinstance(topics, Mapping) else list(topics)
        owner: dict[str, str] = {}
        for topic in topics:
            for word in topic["words"]:
                owner.setdefault(word.lower(), topic["topic"])
        return cls(tuple((t, w) for w, t in owner.items()), len(topics))

    @classmethod
    def from_json(cls, text: str) -> TopicSet:
        return cls.of(json.loads(text))

    @classmethod
    def from_table(cls, table: DataFrame, limit: int = MAX_LITERAL_WORDS) -> TopicSet | None:
        """Collect a ``(topic, word, idx)`` table; None when it is over the limit."""
        rows = table.select("idx", "topic", "word").limit(limit + 1).collect()
        if len(rows) > limit:
            return None
        owner: dict[str, str] = {}
        for row in sorted(rows, key=lambda r: (r["idx"], r["topic"], r["word"])):
            owner.setdefault(row["word"], row["topic"])
        return cls(tuple((t, w) for w, t in owner.items()), len({r["topic"] for r in rows}))

    def __len__(self) -> int:
        return len(self.entries)

    @property
    def words(self) -> list[str]:
        return [w for _, w in self.entries]

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys(t for t, _ in self.entries))


_ENTRY = "struct<idx:bigint,run:int,topic:int,word:string>"


def _topic_hits(entries: Column, runs_are_whole: bool) -> Column:
    """One struct per matched run of topic words from the matched words of a post.

    ``entries`` are the matched words in listing order.  A run is a topic, or a
    stretch of one.  ``n`` is the number of its matched words, listed from
    ``first`` to ``last``.  Words listed in between have their weight in ``own``;
    ``runs_are_whole`` says that these are just the matched words themselves.

    Each step below is a ``transform`` of its own, because what a lambda takes from
    outside is evaluated again for every element.
    """
    runs = F.array_distinct(F.transform(entries, lambda e: e["run"]))
    mine = F.transform(runs, lambda run: F.filter(entries, lambda e: e["run"] == run))
    spans = F.transform(
        mine,
        lambda m: F.struct(
            m[0]["topic"].alias("topic"),
            F.size(m).alias("n"),
            m[0]["idx"].alias("first"),
            F.element_at(m, -1)["idx"].alias("last"),
            m.alias("mine"),
        ),
    )

    def ranked(s: Column) -> Column:
        """Weight of the matched words themselves: how many of them come before."""
        return F.map_from_arrays(s["mine"]["word"], F.sequence(F.lit(0), s["n"] - 1))

    def counted(s: Column) -> Column:
        """The same for every matched word in between, of whatever topic."""
        between = F.filter(entries, lambda e: e["idx"].between(s["first"], s["last"]))
        return F.map_from_entries(
            F.transform(
                between,
                lambda e: F.struct(
                    e["word"], F.size(F.filter(s["mine"], lambda m: m["idx"] < e["idx"]))
                ),
            )
        )

    own = ranked if runs_are_whole else counted
    return F.transform(
        spans, lambda s: F.struct(s["topic"], s["n"], s["first"], s["last"], own(s).alias("own"))
    )


# An explode of a bare column makes Catalyst derive "is not empty" and evaluate
# everything behind the column a second time to test that.  Each explode below is
# therefore of the column under its own condition, which also skips useless rows.


def _token_rows_from_plan(posts: DataFrame, topics: TopicSet) -> DataFrame:
    """``(_label, _copies, _hits, _word, _idx)`` with the vocabulary in the plan.

    Everything happens within the row of the post; nothing is shuffled.  Topics go
    by number here and get their names back once they are counted.
    """
    numbers = {name: n for n, name in enumerate(topics.names)}
    runs = [run for run, (_, words) in enumerate(groupby(t for t, _ in topics.entries)) for _ in words]
    entry = literal_map(
        {
            word: {"idx": idx, "run": run, "topic": numbers[topic], "word": word}
            for idx, (run, (topic, word)) in enumerate(zip(runs, topics.entries))
        },
        _ENTRY,
    )
    place = literal_map({w: i for i, w in enumerate(topics.words)}, "bigint")
    matched = (
        posts.withColumn("_found", F.array_intersect("_tokens", literal_array(topics.words)))
        .withColumn("_entries", F.array_sort(F.transform("_found", entry)))
        .withColumn("_hits", _topic_hits(F.col("_entries"), runs_are_whole=True))
    )
    return matched.select(
        "_label",
        F.lit(1).alias("_copies"),
        "_hits",
        F.explode(F.when(F.size("_hits") > 0, F.col("_tokens"))).alias("_word"),
    ).withColumn("_idx", place(F.col("_word")))


def _pivoted_counts(
    posts: DataFrame, topics: TopicSet, labels: list[Column], word_length: int, least: int
) -> DataFrame:
    """``(label, topic number, word, count)`` above ``least`` for many topics in the plan.

    With many topics a word of a post meets most of them, and a row for each would be the whole cost.  So runs of
    topic words stand side by side, ``_COLUMNS`` in a row, and each has a sum of its own; only what
    is above the limit becomes rows again.  The sums of some posts at a time are made by numpy, those of all by Spark.
    """
    numbers = {name: n for n, name in enumerate(topics.names)}
    runs = [(topic, list(words)) for topic, words in groupby(topics.entries, key=lambda e: e[0])]
    listed = [word for _, words in runs for _, word in words]
    run_of = np.repeat(np.arange(len(runs)), [len(words) for _, words in runs])
    # A topic of one run counts a word at most so often as if its longest run of the post always counted.
    one_run = len(runs) == len(numbers)

    def in_arrow(of: Callable[[_Posts], Iterator[pa.RecordBatch]], wanted: Broadcast | None = None) -> Callable:
        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = pa.array(listed)
            for batch in batches:
                tokens = max(1, len(batch.column("_tokens").flatten()))
                some = max(1, min(_POSTS, _CELLS // len(runs), _TOKENS * batch.num_rows // tokens))
                for at in range(0, batch.num_rows, some):
                    yield from of(_Posts(batch.slice(at, some), words, run_of, word_length, wanted and wanted.value))

        return made

    posts = posts.select(*labels, "_tokens")
    key = "".join(f"`{c}` {kind}, " for c, kind in posts.dtypes if c == "_label") + "word string, "
    columns = ", ".join(f"_{j} long" for j in range(_COLUMNS))
    made = f"{key}group int, {columns}"
    if least > 0:
        bounds = posts.mapInArrow(in_arrow(lambda p: p.bounds(one_run)), f"{key}_bound long")
        frequent = _frequent(bounds, labels, least)
        wanted = posts.sparkSession.sparkContext.broadcast(_bits(frequent))
        rows = _only(posts.mapInArrow(in_arrow(_Posts.sums, wanted), made), frequent, labels)
    else:
        rows = posts.mapInArrow(in_arrow(_Posts.sums), made)
    keys = [c for c in ("_label",) if labels]
    sums = rows.groupBy(*keys, "group", "word").agg(*(F.sum(f"_{j}").alias(f"_{j}") for j in range(_COLUMNS)))
    apart = sums.select(
        *keys, "word", "group", F.posexplode(F.array(*(F.col(f"_{j}") for j in range(_COLUMNS)))).alias("_j", "count")
    )
    topic_of = literal_array([numbers[topic] for topic, _ in runs], "int")
    topic = F.get(topic_of, F.col("group") * _COLUMNS + F.col("_j")).alias("topic")
    counts = apart.where(F.col("count") > 0).select(*keys, topic, "word", "count")
    if len(runs) > len(numbers):  # a topic whose words are not listed together
        counts = counts.groupBy(*keys, "topic", "word").agg(F.sum("count").alias("count"))
    return counts.where(F.col("count") > least)


class _Posts:
    """Some posts: their distinct words, and how many words of each run of topic words each post has."""

    def __init__(self, batch: pa.RecordBatch, listed: pa.Array, run_of: np.ndarray, word_length: int, wanted: np.ndarray | None = None) -> None:
        lists = batch.column("_tokens")
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        post = np.repeat(np.arange(len(lists)), list_sizes(lists))[codes >= 0]
        words, n_runs = coded.dictionary, int(run_of[-1]) + 1
        many = max(1, len(words))
        pairs, copies = np.unique(post * many + codes[codes >= 0], return_counts=True)
        post, word = pairs // many, pairs % many
        place = pc.index_in(words, value_set=listed).fill_null(-1).to_numpy(zero_copy_only=False)
        # Matched words in listing order, and how many of the same run and post come before each.
        matched = np.flatnonzero(place[word] >= 0) if len(words) else np.zeros(0, np.int64)
        matched = matched[np.lexsort((place[word[matched]], post[matched]))]
        cell = post[matched] * n_runs + run_of[place[word[matched]]]
        own = np.zeros(len(pairs), np.int64)
        own[matched] = np.arange(len(cell)) - np.searchsorted(cell, cell)
        self.counts = np.bincount(cell, minlength=len(lists) * n_runs).reshape(len(lists), n_runs)
        # Pairs of a post and a word, those of one label and word together.
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        chosen = length > word_length
        if wanted is not None:
            bit = np.fromiter((zlib.crc32(w.encode()) % _BITS for w in words.to_pylist()), np.int64, len(words))
            chosen = chosen & (wanted[bit // 32] >> (bit % 32) & 1 == 1)
        kept = np.flatnonzero(self.counts.any(axis=1)[post] & chosen[word])
        self.labels = batch.column("_label").dictionary_encode("encode") if "_label" in batch.schema.names else None
        label = self.labels.indices.to_numpy()[post] if self.labels is not None else np.zeros(len(post), np.int64)
        kept = kept[np.argsort(label[kept] * many + word[kept], kind="stable")]
        self.post, self.copies, self.own = post[kept], copies[kept], own[kept]
        key = label[kept] * many + word[kept]
        self.starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        first = kept[self.starts]
        self.words, self.label = words.take(pa.array(word[first])), label[first]
        listed_at = place[word[first]] if len(words) else np.zeros(0, np.int64)
        # The run of a word that is a topic word itself, or the one after the last.
        self.run = np.where(listed_at >= 0, run_of[listed_at], n_runs)

    def _keys(self, some: np.ndarray) -> dict[str, pa.Array]:
        at = pa.array(some)
        label = {} if self.labels is None else {"_label": self.labels.dictionary.take(pa.array(self.label[some]))}
        return label | {"word": self.words.take(at)}

    def bounds(self, one_run: bool) -> Iterator[pa.RecordBatch]:
        """For each word no less than what it counts with any topic."""
        if not len(self.starts):
            return
        most = self.counts.max(axis=1) if one_run else self.counts.sum(axis=1)
        bound = np.add.reduceat(most[self.post] * self.copies, self.starts)
        yield pa.RecordBatch.from_pydict(self._keys(np.arange(len(bound))) | {"_bound": pa.array(bound)})

    def sums(self) -> Iterator[pa.RecordBatch]:
        """For each word and group of runs what the word counts with each of the runs.

        A word that is no topic word counts with every matched word; a topic word with those that are listed before it.
        """
        ends = np.append(self.starts[1:], len(self.post))
        # Words together until they have some thousand pairs.
        cuts = np.flatnonzero(np.diff(self.starts // _PAIRS, prepend=-1))
        for group in range(0, self.counts.shape[1], _COLUMNS):
            counts = np.zeros((len(self.counts), _COLUMNS), np.int64)
            part = self.counts[:, group : group + _COLUMNS]
            counts[:, : part.shape[1]] = part
            for a, b in zip(cuts, [*cuts[1:], len(self.starts)]):
                low, high = self.starts[a], ends[b - 1]
                weighed = counts[self.post[low:high]] * self.copies[low:high, None]
                sums = np.add.reduceat(weighed, self.starts[a:b] - low, axis=0)
                run = self.run[a:b] - group
                sums[np.arange(_COLUMNS) >= run[:, None]] = 0
                own = np.flatnonzero((run >= 0) & (run < part.shape[1]))
                ranked = np.add.reduceat(self.own[low:high] * self.copies[low:high], self.starts[a:b] - low)
                sums[own, run[own]] = ranked[own]
                some = np.flatnonzero(sums.any(axis=1))
                if len(some):
                    number = pa.array(np.full(len(some), group // _COLUMNS, np.int32))
                    beside = {f"_{j}": pa.array(sums[some, j]) for j in range(_COLUMNS)}
                    yield pa.RecordBatch.from_pydict(self._keys(some + a) | {"group": number} | beside)


def _frequent(bounds: DataFrame, labels: list[Column], least: int) -> DataFrame:
    """The words that may come above ``least`` with some topic.

    ``bounds`` says what a word of some posts adds to one topic at most.  Summed by label and word, a number each, it
    leaves out the rare words, of which there are the most, before they get a row of sums.
    """
    keys = [c for c in ("_label",) if labels]
    return stored(
        bounds.groupBy(*keys, "word")
        .agg(F.sum("_bound").alias("_bound"))
        .where(F.col("_bound") > least)
        .select(*(F.col(k).alias("_of") for k in keys), F.col("word").alias("_frequent")),
        "frequent-words",
    )


def _bits(frequent: DataFrame) -> np.ndarray:
    """A filter that all frequent words pass and few others; its size is the same however many words there are."""
    bit = F.crc32(F.col("_frequent").cast("binary")) % _BITS
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))
    found = frequent.groupBy(F.floor(bit / 32).alias("place")).agg(F.bit_or(mask).alias("bits")).toArrow()
    bits = np.zeros(_BITS // 32, np.int64)
    bits[found.column("place").to_numpy()] = found.column("bits").to_numpy()
    return bits


def _only(rows: DataFrame, frequent: DataFrame, labels: list[Column]) -> DataFrame:
    """``rows`` of frequent words; where these are too many to broadcast, those that passed the filter by chance as well."""
    if not fits_broadcast(frequent):
        return rows
    same = F.col("word") == F.col("_frequent")
    if labels:
        same = same & F.col("_label").eqNullSafe(F.col("_of"))
    return rows.join(F.broadcast(frequent), same, "left_semi")


def _token_rows_from_table(posts: DataFrame, topics: DataFrame, **bounds) -> DataFrame:
    """The same by joining, for vocabularies of any size.

    Posts are stored once.  Their distinct words meet the vocabulary with the number of the post alone, those
    that are in it go back to their post, and the others end there.
    """
    first = F.min(F.struct("idx", "topic")).alias("_first")
    vocabulary = (
        topics.groupBy("word")
        .agg(first)
        .select(
            F.struct("_first.idx", "_first.topic", "word").alias("idx"),
            F.col("_first.topic").alias("run"),
            F.col("_first.topic").alias("topic"),
            "word",
        )
    )
    rows = numbered_rows(posts, "posts")
    matched = (
        with_entries(rows, F.col("_tokens"), vocabulary, "word", "_found", **bounds)
        .where(F.col("_found").isNotNull())
        .select("_label", "_tokens", F.array_sort("_found").alias("_entries"))
        .withColumn("_hits", _topic_hits(F.col("_entries"), runs_are_whole=False))
    )
    places = F.map_from_entries(F.transform("_entries", lambda e: F.struct(e["word"], e["idx"])))
    word = F.explode(F.when(F.size("_hits") > 0, F.col("_tokens"))).alias("_word")
    return matched.withColumn("_places", places).select("_label", "_hits", "_places", word).select(
        "_label", F.lit(1).alias("_copies"), "_hits", "_word", F.col("_places")[F.col("_word")].alias("_idx")
    )


def cooccurrence(
    posts: DataFrame,
    topics: TopicSet | DataFrame | Iterable[Mapping],
    *,
    tokens: str = "tokens",
    date: str = "date",
    interval: str | None = None,
    year_qualified: bool = False,
    count_filter: int = 25,
    word_length_filter: int = 2,
    join_bounds: Mapping | None = None,
) -> DataFrame:
    """Count words per interval and topic: ``(date or interval, topic, word, count)``.

    Words longer than ``word_length_filter`` with a count above ``count_filter``
    are kept.  Topics are a list of ``{"topic", "words"}``, a ``TopicSet`` or a
    ``(topic, word, idx)`` table; a table too large for the plan is joined.
    ``join_bounds`` forces that join and sets its broadcast bounds.
    """
    label = interval_label(date, interval, year_qualified) if interval else F.col(date)
    label_name = "interval" if interval else date
    prepared = posts.select(label.alias("_label"), F.col(tokens).alias("_tokens"))

    if isinstance(topics, DataFrame):
        listed = None if join_bounds is not None else TopicSet.from_table(topics)
    else:
        listed = topics if isinstance(topics, TopicSet) else TopicSet.of(topics)
        if len(listed) > MAX_LITERAL_WORDS:  # as a table, like any other of that size
            entries = [(t, w, i) for i, (t, w) in enumerate(listed.entries)]
            spark = posts.sparkSession
            topics = spark.createDataFrame(entries, "topic string, word string, idx long")
            listed = None
    # One label for all rows need not be part of the key.
    labels = [] if interval == "overall" else [F.col("_label").alias(label_name)]
    if listed is not None and len(listed) >= _LOOK_UP_FROM:
        key = [F.col("_label")] if labels else []
        counts = _pivoted_counts(prepared, listed, key, word_length_filter, max(count_filter, 0))
        name = F.get(literal_array(listed.names), F.col("topic")).alias("topic")
        return counts.select(*(labels or [label.alias(label_name)]), name, "word", "count")
    if listed is not None:
        rows = _token_rows_from_plan(prepared, listed)
    else:
        rows = _token_rows_from_table(prepared, topics, **(join_bounds or {}))

    word, idx, hit = F.col("_word"), F.col("_idx"), F.col("_hit")
    weight = (
        F.when(idx.isNull() | (idx > hit["last"]), hit["n"])
        .when(idx < hit["first"], F.lit(0))
        .otherwise(hit["own"][word])
    )
    counts = (
        rows.withColumn(
            "_hit", F.explode(F.when(F.length(word) > word_length_filter, F.col("_hits")))
        )
        .groupBy(*labels, hit["topic"].alias("topic"), word.alias("word"))
        .agg(F.sum(F.col("_copies") * weight).alias("count"))
        .where(F.col("count") > max(count_filter, 0))
    )
    topic = F.col("topic")
    if listed is not None:
        topic = F.get(literal_array(listed.names), topic).alias("topic")
    return counts.select(
        F.col(label_name) if labels else label.alias(label_name), topic, "word", "count"
    )


def count_order(counts: DataFrame) -> list[Column]:
    """Interval and topic ascending, word descending, count ascending."""
    return [F.asc(counts.columns[0]), F.asc("topic"), F.desc("word"), F.asc("count")]


def sort_counts(counts: DataFrame) -> DataFrame:
    return counts.orderBy(*count_order(counts))
