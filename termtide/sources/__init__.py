from termtide.sources.lists import (
    EXTRA_STOPWORDS,
    bounded_dict,
    default_stopwords,
    parse_mapping,
    parse_topics,
    read_mapping,
    read_source_metadata,
    read_stopwords,
    read_topics,
    topics_from_json,
)
from termtide.sources.posts import (
    DECLARED_SCHEMAS,
    existing_paths,
    read_lines,
    read_raw,
    rows_of_files,
    source_format,
    split_paths,
)

__all__ = [
    "DECLARED_SCHEMAS",
    "EXTRA_STOPWORDS",
    "bounded_dict",
    "default_stopwords",
    "existing_paths",
    "parse_mapping",
    "parse_topics",
    "read_lines",
    "read_mapping",
    "read_raw",
    "read_source_metadata",
    "read_stopwords",
    "read_topics",
    "rows_of_files",
    "source_format",
    "split_paths",
    "topics_from_json",
]
