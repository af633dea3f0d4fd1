"""Reading, filtering, preprocessing and counting in one go."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from termtide.operators.cooccurrence import TopicSet, cooccurrence, count_order, sort_counts
from termtide.operators.filters import (
    TWEET_TYPES,
    dedupe_by_id,
    filter_lang,
    filter_news_concepts,
    filter_news_division,
    filter_news_region,
    filter_news_states,
    filter_outlet,
    filter_period,
    filter_tweet_types,
)
from termtide.operators.joins import join_source_metadata
from termtide.operators.normalize import normalize_dataset
from termtide.plans.preprocess import (
    JOB_CHOICES,
    PreprocessOptions,
    preprocess_once,
    text_and_tokens,
    with_job_tokens,
)
from termtide.session import configure, remove_path, scratch_path
from termtide.sinks.writers import (
    observe_records,
    output_name,
    preprocessed_output,
    run_summary,
    write_csv,
    write_json,
)
from termtide.sources.lists import read_source_metadata, read_topics
from termtide.sources.posts import DECLARED_SCHEMAS, read_raw, source_format, split_paths


@dataclass(frozen=True)
class PostSelection:
    """Which posts to read and keep."""

    input: str | Sequence[str]
    dataset: str = "twitter"
    schema: str | StructType | None = None
    csv_options: Mapping[str, str] = field(default_factory=dict)
    skip_unreadable: bool = False
    lang: str | None = None
    start_date: str | None = None
    end_date: str | None = None
    start_datetime: str | None = None
    end_datetime: str | None = None
    drop_duplicates: bool = False
    tweet_types: Sequence[str] = TWEET_TYPES
    news_metadata: str | None = None
    news_region: Sequence[str] = ()
    news_division: Sequence[str] = ()
    news_states: Sequence[str] = ()
    news_concepts: Sequence[str] = ()
    tv_outlet: Sequence[str] = ()


def select_posts(raw: DataFrame, selection: PostSelection, metadata: DataFrame | None = None):
    """Normalise a raw table and apply every filter of the selection."""
    posts = normalize_dataset(raw, selection.dataset)
    if selection.dataset == "event_registry":
        if metadata is not None:
            posts = join_source_metadata(posts, metadata)
            posts = filter_news_region(posts, selection.news_region)
            posts = filter_news_division(posts, selection.news_division)
            posts = filter_news_states(posts, selection.news_states)
        elif selection.news_region or selection.news_division or selection.news_states:
            raise ValueError("filters on the news source need the source metadata")
        posts = filter_news_concepts(posts, selection.news_concepts)
    if selection.dataset == "tv_eyes":
        posts = filter_outlet(posts, selection.tv_outlet)
    if selection.dataset == "twitter":
        posts = filter_tweet_types(posts, selection.tweet_types)
    posts = filter_lang(posts, selection.lang)
    posts = filter_period(
        posts,
        start_date=selection.start_date,
        end_date=selection.end_date,
        start_datetime=selection.start_datetime,
        end_datetime=selection.end_datetime,
    )
    return dedupe_by_id(posts) if selection.drop_duplicates else posts


def read_posts(spark: SparkSession, selection: PostSelection) -> DataFrame:
    # A collection that is known is read as declared, without a pass to infer its schema.
    declared = selection.schema or DECLARED_SCHEMAS.get(selection.dataset)
    as_json = source_format(split_paths(selection.input)) == "json"
    raw = read_raw(
        spark,
        selection.input,
        schema=declared if as_json else selection.schema,
        skip_unreadable=selection.skip_unreadable,
        csv_options=dict(selection.csv_options),
    )
    metadata = selection.news_metadata and read_source_metadata(spark, selection.news_metadata)
    return select_posts(raw, selection, metadata or None)


def topic_cooccurrence(
    posts: DataFrame,
    topics: TopicSet | DataFrame | Sequence[Mapping],
    options: PreprocessOptions | None = None,
    *,
    target: str = "full_text",
    **counting,
) -> DataFrame:
    """Preprocess, tokenise and count; see ``cooccurrence`` for ``counting``."""
    options = options or PreprocessOptions(choices=JOB_CHOICES)
    tokens = with_job_tokens(posts.select("date", target), options, target)
    return cooccurrence(tokens, topics, **counting)


@dataclass(frozen=True)
class JobResult:
    output: str
    preprocessed_output: str | None
    summary: DataFrame


def run_job(
    spark: SparkSession,
    selection: PostSelection,
    topics: str | TopicSet | DataFrame | Sequence[Mapping],
    output: str,
    *,
    options: PreprocessOptions | None = None,
    target: str = "full_text",
    interval: str | None = None,
    count_filter: int = 25,
    word_length_filter: int = 2,
    single_file: bool = False,
    write_uncoalesced: bool = False,
    preprocessed_path: str | None = None,
    summary_file: bool = False,
) -> JobResult:
    """The whole job: read, choose, preprocess, count, write, summarise.

    ``topics`` is a topic collection, inline JSON or the path of a JSON file.  The
    number of posts is counted on the way, not by a scan of its own.  With
    ``preprocessed_path`` the chosen posts are stored once with what the chain makes of
    them; that output and the counts are both made of what was stored, so the input is read and cleaned once.
    """
    started = time.time()
    configure(spark)
    if isinstance(topics, str):
        inline = topics.lstrip().startswith(("[", "{"))
        topics = TopicSet.from_json(topics) if inline else read_topics(spark, topics)
    options = options or PreprocessOptions(choices=JOB_CHOICES, lang=selection.lang or "en")
    posts = read_posts(spark, selection)
    observed, records = observe_records(posts)
    kept = None
    if preprocessed_path:
        shown = "preprocessed_text" if options.is_needed else target
        kept = scratch_path(spark, "preprocessed")
        prepared = preprocess_once(observed.select("id_str", "date", target), options, target)
        prepared.write.option("compression", "zstd").parquet(kept)
        once = spark.read.schema(prepared.schema).parquet(kept)
        tokens = text_and_tokens(once, options, target)
        preprocessed_path = write_json(preprocessed_output(tokens, target, shown), preprocessed_path)
    else:
        tokens = with_job_tokens(observed.select("date", target), options, target)
    counts = cooccurrence(
        tokens,
        topics,
        interval=interval,
        count_filter=count_filter,
        word_length_filter=word_length_filter,
    )
    path = output_name(
        output,
        [selection.start_date, selection.end_date, selection.dataset, "CoOccurrence", interval],
    )
    if write_uncoalesced:
        path = write_json(sort_counts(counts), path)
    else:
        path = write_csv(counts, path, order=count_order(counts), single_file=single_file)
    if kept:
        remove_path(spark, kept)
    summary = run_summary(
        spark,
        {
            "total record count": records.get["record_count"],
            "Run time": time.time() - started,
            "Input": split_paths(selection.input),
            "Output file": path,
            "Start date": selection.start_date,
            "End date": selection.end_date,
            "Filtered lang": selection.lang,
            "Tweet Types": selection.tweet_types if selection.dataset == "twitter" else None,
            "TV Channel": selection.tv_outlet,
            "Newspaper region": selection.news_region,
            "Newspaper division": selection.news_division,
            "Newspaper states": selection.news_states,
            "Newspaper concepts": selection.news_concepts,
        },
    )
    if summary_file:
        write_csv(summary, path.rsplit(".", 1)[0] + "_summary")
    return JobResult(path, preprocessed_path, summary)
