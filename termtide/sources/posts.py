"""Reading post collections."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# What each collection is known to contain.  Reading JSON with one of these skips
# schema inference, which otherwise scans the whole input once more.  A column
# that is declared but missing in the files reads as NULL.
DECLARED_SCHEMAS = {
    "twitter": (
        "full_text string, text string, tweet string, body string, created_at string, "
        "postedTime string, id string, id_str string, lang string, language string, "
        "twitter_lang string, username string, "
        "user struct<screen_name:string,name:string>, "
        "actor struct<preferredUsername:string>, "
        "retweeted_status struct<id_str:string>, is_quote_status boolean"
    ),
    "event_registry": (
        "uri string, body string, date string, source struct<uri:string>, "
        "concepts array<struct<label:struct<eng:string>>>"
    ),
    "reddit_comments": "id string, body string, created_utc bigint",
    "tv_eyes": "guid string, body string, date string, outlet string",
}


def split_paths(paths: str | Iterable[str]) -> list[str]:
    """Path list from one path, several paths, or one ``|``-delimited string."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if len(paths) == 1:
        paths = paths[0].split("|")
    return [unquote(p) for p in paths if p]


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Keep the paths (or globs) that exist, warn about the rest.

    Asks the file system for names only; no Spark job runs.  Only what the file system says is
    absent is left out: a path that cannot be asked for raises.
    """
    jvm = spark.sparkContext._jvm
    hadoop_conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = []
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        if hadoop_path.getFileSystem(hadoop_conf).globStatus(hadoop_path):
            found.append(path)
        else:
            warnings.warn(f"skipping {path}: nothing there", stacklevel=2)
    return found


def source_format(paths: Iterable[str]) -> str:
    """One format for the whole list, by file extension; JSON unless all agree."""
    paths = list(paths)
    for extension, name in ((".txt", "text"), (".parquet", "parquet"), (".csv", "csv")):
        if paths and all(p.endswith(extension) for p in paths):
            return name
    return "json"


def read_raw(
    spark: SparkSession,
    paths: str | Iterable[str],
    *,
    format: str | None = None,
    schema: str | StructType | None = None,
    skip_missing: bool = True,
    skip_unreadable: bool = False,
    csv_options: dict[str, str] | None = None,
) -> DataFrame:
    """Read files as they are.

    Text files give one row per file, CSV files have a header and string columns,
    JSON is one object per line.  ``schema`` applies to JSON and CSV; without it
    JSON is inferred, which costs a scan of its own.  ``csv_options`` passes
    ``multiLine``, ``quote``, ``escape`` and the like.

    ``skip_unreadable`` passes over files that cannot be read, and over what comes after the
    place where a file breaks off; ``rows_of_files`` says which files gave nothing.  Parquet then has the
    columns of all readable footers.
    """
    paths = split_paths(paths)
    if skip_missing:
        paths = existing_paths(spark, paths)
    if not paths:
        raise FileNotFoundError("none of the input paths can be read")
    format = format or source_format(paths)
    reader = spark.read
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    if format == "text":
        return reader.text(paths, wholetext=True)
    if format == "parquet":
        if skip_unreadable:  # the one file whose footer gives the columns may be the broken one: ask them all
            reader = reader.option("mergeSchema", True)
        return reader.parquet(*paths)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        return reader.options(**(csv_options or {})).csv(paths, header=True)
    return reader.option("multiLine", False).json(paths)


def rows_of_files(
    spark: SparkSession, paths: str | Iterable[str], *, format: str | None = None, **reading
) -> DataFrame:
    """``(path, length, n_rows)`` of every file below the paths, as a read that skips files finds them.

    A file that is not empty but gives no rows either cannot be read or holds none.  The listing
    opens no file.  Counting reads the footers alone of Parquet, and all of a text format, in the
    executors; a file is one sum, made before the shuffle.
    """
    paths = existing_paths(spark, split_paths(paths))
    raw = read_raw(spark, paths, format=format, skip_missing=False, skip_unreadable=True, **reading)
    found = raw.select(F.col("_metadata.file_path").alias("_found")).groupBy("_found").agg(F.count("*").alias("_n"))
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("_metadata.file_path", "length")
    )
    return listed.join(found, F.col("file_path") == F.col("_found"), "left").select(
        F.col("file_path").alias("path"), "length", F.coalesce("_n", F.lit(0)).alias("n_rows")
    )


def read_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``(path, value)``: the lines of all text files below the paths, with the file of each."""
    paths = existing_paths(spark, split_paths(paths))
    if not paths:
        raise FileNotFoundError("none of the input paths can be read")
    raw = spark.read.option("recursiveFileLookup", True).text(paths)
    return raw.select(F.col("_metadata.file_path").alias("path"), "value")


def file_name(path):
    """Last part of a path column."""
    return F.element_at(F.split(path, "/"), -1)
