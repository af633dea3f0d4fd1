from termtide.operators.cooccurrence import TopicSet, cooccurrence, sort_counts
from termtide.operators.filters import (
    dedupe_by_id,
    filter_dates,
    filter_lang,
    filter_news_concepts,
    filter_news_division,
    filter_news_region,
    filter_news_states,
    filter_outlet,
    filter_period,
    filter_timestamps,
    filter_tweet_types,
)
from termtide.operators.joins import (
    fits_broadcast,
    join_source_metadata,
    lookup_join,
    without_stopwords,
)
from termtide.operators.normalize import ADAPTERS, normalize_dataset, to_posts
from termtide.operators.saturation import saturating_words
from termtide.operators.token_map import map_tokens, with_mapped_tokens

__all__ = [
    "ADAPTERS",
    "TopicSet",
    "cooccurrence",
    "dedupe_by_id",
    "filter_dates",
    "filter_lang",
    "filter_news_concepts",
    "filter_news_division",
    "filter_news_region",
    "filter_news_states",
    "filter_outlet",
    "filter_period",
    "filter_timestamps",
    "filter_tweet_types",
    "fits_broadcast",
    "join_source_metadata",
    "lookup_join",
    "map_tokens",
    "normalize_dataset",
    "saturating_words",
    "sort_counts",
    "to_posts",
    "with_mapped_tokens",
    "without_stopwords",
]
