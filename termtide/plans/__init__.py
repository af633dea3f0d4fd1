from termtide.plans.job import (
    JobResult,
    PostSelection,
    read_posts,
    run_job,
    select_posts,
    topic_cooccurrence,
)
from termtide.plans.preprocess import (
    JOB_CHOICES,
    PreprocessOptions,
    preprocess,
    preprocess_tokens,
    with_job_tokens,
    with_tokens,
)

__all__ = [
    "JOB_CHOICES",
    "JobResult",
    "PostSelection",
    "PreprocessOptions",
    "preprocess",
    "preprocess_tokens",
    "read_posts",
    "run_job",
    "select_posts",
    "topic_cooccurrence",
    "with_job_tokens",
    "with_tokens",
]
