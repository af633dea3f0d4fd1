"""Topic and word co-occurrence over large collections of short texts, on Spark."""

from termtide.operators import TopicSet, cooccurrence, saturating_words
from termtide.plans import (
    PostSelection,
    PreprocessOptions,
    preprocess,
    read_posts,
    run_job,
    topic_cooccurrence,
)
from termtide.session import configure

__all__ = [
    "PostSelection",
    "PreprocessOptions",
    "TopicSet",
    "configure",
    "cooccurrence",
    "preprocess",
    "read_posts",
    "run_job",
    "saturating_words",
    "topic_cooccurrence",
]
