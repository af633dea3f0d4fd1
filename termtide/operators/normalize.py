"""Bringing the collections to one canonical post schema.

Every adapter adds canonical columns and keeps the others, which the filters
still need.  Which source columns exist is decided from the schema while the
plan is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termtide.sources.posts import file_name

CANONICAL = {
    "id_str": "string",
    "full_text": "string",
    "date": "date",
    "timestamp": "timestamp",
    "lang": "string",
    "handle": "string",
}

# Columns that may hold an attribute, in order of preference.
TEXT_COLUMNS = ("full_text", "text", "tweet", "body")
LANG_COLUMNS = ("lang", "language", "twitter_lang")
HANDLE_COLUMNS = ("user.screen_name", "user.name", "actor.preferredUsername", "username")

# The two ways a post's creation time is written, and dates in file names.
ZONED_CREATED_AT = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} UTC"
NAMED_CREATED_AT = r"\w{3} \w{3} \d{2} \d{2}:\d{2}:\d{2} \+0000 \d{4}"
DATE_IN_PATH = r"(\d{1,4}-\d{1,2}-\d{1,2})"
SHORT_DATE_IN_PATH = r"(\d{1,2}-\d{1,2}-\d{1,2})"


def has_field(df: DataFrame, name: str) -> bool:
    """Whether a (possibly nested, dotted) column exists."""
    node = df.schema
    for part in name.split("."):
        if not isinstance(node, StructType) or part not in node.fieldNames():
            return False
        node = node[part].dataType
    return True


def first_present(df: DataFrame, names: tuple[str, ...]) -> Column | None:
    """First non-null of the columns that exist; None when there are none."""
    present = [F.col(n).cast("string") for n in names if has_field(df, n)]
    return F.coalesce(*present) if present else None


def _with_first_present(df: DataFrame, target: str, names: tuple[str, ...]) -> DataFrame:
    value = first_present(df, names)
    return df if value is None else df.withColumn(target, value)


# --- posts of a social network ----------------------------------------------


def normalize_twitter_text(df: DataFrame) -> DataFrame:
    return _with_first_present(df, "full_text", TEXT_COLUMNS)


def normalize_twitter_created(df: DataFrame) -> DataFrame:
    """``created_at`` in either spelling to ``date`` and ``timestamp``, else NULL."""
    if not has_field(df, "created_at"):
        return df
    created = F.col("created_at")
    zoned, named = created.rlike(ZONED_CREATED_AT), created.rlike(NAMED_CREATED_AT)
    named_text = F.substring(created, 5, 26)
    named_format = "MMM dd HH:mm:ss Z yyyy"
    named_day = F.concat_ws(" ", F.substring(created, 5, 6), F.substring(created, 27, 4))
    return df.withColumns(
        {
            "date": F.when(zoned, F.try_to_date(F.substring(created, 1, 10), "yyyy-MM-dd")).when(
                named, F.try_to_date(named_day, "MMM dd yyyy")
            ),
            "timestamp": F.when(
                zoned,
                F.try_to_timestamp(
                    F.concat(F.substring(created, 1, 19), F.lit(" +0000")),
                    F.lit("yyyy-MM-dd HH:mm:ss Z"),
                ),
            ).when(named, F.try_to_timestamp(named_text, F.lit(named_format))),
        }
    )


def normalize_twitter_posted(df: DataFrame) -> DataFrame:
    """``postedTime``, where given, overrides ``date`` and ``timestamp``."""
    if not has_field(df, "postedTime"):
        return df
    posted = F.col("postedTime").try_cast("timestamp")
    date, timestamp = F.to_date(posted), posted
    if has_field(df, "date"):
        date = F.coalesce(date, F.col("date").try_cast("date"))
    if has_field(df, "timestamp"):
        timestamp = F.coalesce(timestamp, F.col("timestamp").try_cast("timestamp"))
    return df.withColumns({"date": date, "timestamp": timestamp})


def normalize_twitter_id(df: DataFrame) -> DataFrame:
    return _with_first_present(df, "id_str", ("id_str", "id"))


def normalize_twitter_lang(df: DataFrame) -> DataFrame:
    return _with_first_present(df, "lang", LANG_COLUMNS)


def normalize_twitter_handle(df: DataFrame) -> DataFrame:
    return _with_first_present(df, "handle", HANDLE_COLUMNS)


def normalize_twitter(df: DataFrame) -> DataFrame:
    return (
        df.transform(normalize_twitter_text)
        .transform(normalize_twitter_created)
        .transform(normalize_twitter_posted)
        .transform(normalize_twitter_id)
        .transform(normalize_twitter_lang)
        .transform(normalize_twitter_handle)
    )


# --- transcripts, surveys, articles, comments -------------------------------


def path_of_file(df: DataFrame) -> Column:
    """The file a row was read from.

    Right above a scan this is a column of the scan, whose filters choose files before any is opened: a
    period leaves out files by the date in their path.  Elsewhere it is what the running task reads.
    """
    try:
        df.select("_metadata.file_path").schema  # noqa: B018, asks the analyser
    except AnalysisException:
        return F.input_file_name()
    return F.col("_metadata.file_path")


def normalize_radio(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Whole text files; id and date come from the file name."""
    path = path_of_file(df) if path is None else path
    day = F.regexp_extract(path, DATE_IN_PATH, 1)
    return df.withColumnsRenamed({"value": "full_text"}).withColumns(
        {"id_str": file_name(path), "date": F.try_to_date(day, "yyyy-M-d")}
    )


def normalize_cnn_survey_2020(df: DataFrame, path: Column | None = None) -> DataFrame:
    path = path_of_file(df) if path is None else path
    day = F.regexp_extract(path, SHORT_DATE_IN_PATH, 1)
    return df.withColumns(
        {"id_str": F.col("id").cast("string"), "date": F.try_to_date(day, "M-d-yy")}
    )


def normalize_gallup_survey_2016(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "id_str": F.col("case_id").cast("string"),
            "date": F.col("RESPONDENT_DATE").try_cast("date"),
        }
    )


def normalize_event_registry(df: DataFrame) -> DataFrame:
    columns = {"id_str": F.col("uri"), "full_text": F.col("body")}
    if "date" in df.columns:
        columns["date"] = F.col("date").try_cast("date")
    return df.withColumns(columns)


def normalize_reddit_comments(df: DataFrame) -> DataFrame:
    seconds = F.col("created_utc").try_cast("bigint")
    return df.withColumns(
        {
            "id_str": F.col("id").cast("string"),
            "full_text": F.col("body"),
            "date": F.to_date(F.timestamp_seconds(seconds)),
        }
    )


def normalize_tv_eyes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "id_str": F.col("guid").cast("string"),
            "full_text": F.col("body"),
            "date": F.try_to_date(F.col("date"), "yyyy-MM-dd HH:mm:ss"),
        }
    )


ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "twitter": normalize_twitter,
    "radio": normalize_radio,
    "cnn_survey_2020": normalize_cnn_survey_2020,
    "gallup_survey_2016": normalize_gallup_survey_2016,
    "event_registry": normalize_event_registry,
    "reddit_comments": normalize_reddit_comments,
    "tv_eyes": normalize_tv_eyes,
}


def normalize_dataset(df: DataFrame, dataset: str | None) -> DataFrame:
    """Apply the adapter of a collection; unknown collections stay as they are."""
    adapter = ADAPTERS.get(dataset)
    return df if adapter is None else adapter(df)


def to_posts(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The canonical columns with their types, absent ones as NULL."""
    columns = [
        (F.col(name).try_cast(kind) if has_field(df, name) else F.lit(None).cast(kind)).alias(name)
        for name, kind in CANONICAL.items()
    ]
    return df.select(*columns, *extra)
