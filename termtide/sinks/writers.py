"""Writing results, preprocessed text and the summary of a run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fields as they are: quotes are doubled, white space at the ends stays.
_CSV = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def output_name(directory: str, parameters: Iterable[Any], input_path: str | None = None) -> str:
    """``directory/`` and the parameters that have a value, joined by ``_``."""
    parts = list(parameters)
    if input_path:
        name = input_path.rsplit("/", 1)[-1]
        # Wildcards and endings that do not belong in a name.
        for piece in ("_*", "*.json", "*.json.gz", "*", "."):
            name = name.replace(piece, "")
        parts.append(name)
    named = [str(p) for p in parts if p or p == 0]
    return directory.rstrip("/") + "/" + "_".join(named)


def with_extension(path: str, extension: str) -> str:
    return path if path.endswith(extension) else path + extension


def write_csv(
    df: DataFrame,
    path: str,
    *,
    order: Sequence[Column] = (),
    single_file: bool = False,
    mode: str = "errorifexists",
) -> str:
    """Write CSV with a header; returns the path, which ends in ``.csv``.

    Files are written in parallel, in the given order.  For a single file the sorted
    parts are passed on, one after the other, by one task that holds a row at a time.
    """
    path = with_extension(path, ".csv")
    if order:
        df = df.orderBy(*order)
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).options(**_CSV).csv(path)
    return path


def write_json(
    df: DataFrame,
    path: str,
    *,
    partition_by: Iterable[str] = (),
    mode: str = "errorifexists",
) -> str:
    path = with_extension(path, ".json")
    df.write.mode(mode).partitionBy(*partition_by).json(path)
    return path


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    partition_by: Iterable[str] = (),
    mode: str = "errorifexists",
) -> str:
    path = with_extension(path, ".parquet")
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def preprocessed_output(
    df: DataFrame, target: str = "full_text", preprocessed: str = "preprocessed_text"
) -> DataFrame:
    """``(id_str, target, preprocessed_text)`` with trimmed texts."""
    columns = [F.trim(F.col(target)).alias(target)]
    if preprocessed != target:
        columns.append(F.trim(F.col(preprocessed)).alias(preprocessed))
    return df.select("id_str", *columns)


def record_counts(df: DataFrame) -> DataFrame:
    """One row: number of posts, first and last day."""
    return df.agg(
        F.count("*").alias("record_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def observe_records(df: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """Count the posts while they pass through whatever is run next."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("record_count")), observation


def run_summary(spark: SparkSession, values: Mapping[str, Any]) -> DataFrame:
    """One row with a column for every value that is set; lists are joined by spaces."""
    shown = {}
    for name, value in values.items():
        if value is None or value == "" or (isinstance(value, (list, tuple)) and not value):
            continue
        shown[name] = " ".join(map(str, value)) if isinstance(value, (list, tuple)) else value
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in shown.items()])
