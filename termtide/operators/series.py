"""Tables of topic counts over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.functions.lookup import literal_map
from termtide.operators.joins import lookup_join
from termtide.session import stored


def pivot_series(
    series: DataFrame,
    topics: Sequence[str] | None = None,
    *,
    topic: str = "topic",
    value: str = "count",
    date: str = "Date",
    fill: int | None = 0,
) -> DataFrame:
    """Long to wide: one column per topic.  Naming the topics saves a pass."""
    grouped = series.groupBy(date)
    pivoted = grouped.pivot(topic, list(topics)) if topics else grouped.pivot(topic)
    wide = pivoted.agg(F.sum(value))
    return wide if fill is None else wide.na.fill(fill)


def unpivot_series(
    wide: DataFrame,
    topics: Sequence[str] | None = None,
    *,
    topic: str = "topic",
    value: str = "count",
    date: str = "Date",
) -> DataFrame:
    """Wide to long."""
    topics = list(topics) if topics else [c for c in wide.columns if c != date]
    return wide.unpivot([date], topics, topic, value)


def fill_missing_days(
    series: DataFrame, *, topic: str = "topic", value: str = "count", date: str = "Date"
) -> DataFrame:
    """Every topic gets every day from the first to the last of the table, zero where absent.

    A NULL topic is a topic.  Cells without a day stay as they are.
    """
    cells = series.groupBy(topic, date).agg(F.sum(value).alias(value))
    span = cells.select(F.struct(F.min(date).alias("first"), F.max(date).alias("last"))).scalar()
    days = F.sequence(F.col("_span.first"), F.col("_span.last"), F.expr("interval 1 day"))
    spine = (
        cells.where(F.col(date).isNotNull())
        .select(topic)
        .distinct()
        .withColumn("_span", span)
        .select(topic, F.explode(days).alias(date), F.lit(0).alias("_zero"))
    )
    # The spine is summed with the cells, which takes NULL for a key like any other.
    zeros = spine.select(topic, date, F.col("_zero").cast(cells.schema[value].dataType).alias(value))
    return (
        cells.unionByName(zeros)
        .groupBy(topic, date)
        .agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))
        .select(topic, date, value)
    )


def fill_missing_days_wide(wide: DataFrame, *, date: str = "Date") -> DataFrame:
    """The same for a table with one row per day."""
    bounds = wide.agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    spine = bounds.select(
        F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias(date)
    )
    return spine.join(wide, date, "left").na.fill(0).select(*wide.columns)


def tumbling_start(date: Column | str, anchor: Column, days: int) -> Column:
    """First day of the bucket of ``days`` days, counted from ``anchor``, that holds the date."""
    date = F.col(date) if isinstance(date, str) else date
    steps = F.floor(F.datediff(date, anchor) / F.lit(days)).cast("int")
    return F.date_add(anchor, steps * F.lit(days))


def tumbling_sum(
    series: DataFrame,
    days: int = 5,
    *,
    anchor=None,
    topic: str = "topic",
    value: str = "count",
    date: str = "Date",
) -> DataFrame:
    """Sums over buckets of some days, the first bucket starting at the first date."""
    if anchor is None:
        anchor = series.select(F.min(date)).scalar()
    else:
        anchor = F.lit(anchor).cast("date")
    start = tumbling_start(date, anchor, days)
    return series.groupBy(start.alias(date), topic).agg(F.sum(value).alias(value))


def weekly_sum(
    series: DataFrame, *, topic: str = "topic", value: str = "count", date: str = "Date"
) -> DataFrame:
    """Sums per week, the week given by its Monday and its ISO number."""
    monday = F.date_trunc("week", F.col(date)).cast("date")
    return (
        series.groupBy(topic, monday.alias("start_of_week"))
        .agg(F.sum(value).alias(value))
        .withColumn("week", F.weekofyear("start_of_week"))
    )


def roll_up(
    series: DataFrame,
    mapping: DataFrame,
    *,
    topic: str = "topic",
    category: str = "category",
    value: str = "count",
    date: str = "Date",
    **bounds,
) -> DataFrame:
    """Sums per category; topics without one, and cells without a topic, come under NULL.

    A topic that is listed more than once counts under each of its categories.
    """
    cells = series.groupBy(date, topic).agg(F.sum(value).alias(value))
    side = mapping.select(topic, category).distinct()
    return (
        lookup_join(cells, side, [topic], "left", **bounds)
        .groupBy(date, category)
        .agg(F.sum(value).alias(value))
    )


def union_series(
    tables: Sequence[DataFrame], renames: Mapping[str, str] | None = None, fill: int | None = None
) -> DataFrame:
    """Stack tables whose headers drifted: rename, match by name, complete."""
    renamed = [t.withColumnsRenamed(dict(renames or {})) for t in tables]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)
    return stacked if fill is None else stacked.na.fill(fill)


def parse_series_lines(
    lines: DataFrame, topics: Sequence[str], *, line: str = "value", date: str = "Date"
) -> DataFrame:
    """CSV lines to wide rows; lines that do not fit are marked in ``quarantined``.

    A line is quarantined when it has too few or too many fields, a field that is
    no number, or a malformed date.  An empty field is a missing cell.  ``line`` is
    kept so it can be repaired.
    """
    fields = F.split(F.col(line), ",", -1)
    day = F.try_to_date(F.get(fields, F.lit(0)), "yyyy-M-d")
    raw = {t: F.trim(F.get(fields, F.lit(i + 1))) for i, t in enumerate(topics)}
    cells = {t: text.try_cast("bigint") for t, text in raw.items()}
    whole = (F.size(fields) == len(topics) + 1) & day.isNotNull()
    for t, text in raw.items():
        whole = whole & ((text == "") | cells[t].isNotNull())
    whole = F.coalesce(whole, F.lit(False))
    return lines.select(
        F.col(line),
        day.alias(date),
        *[cell.alias(t) for t, cell in cells.items()],
        (~whole).alias("quarantined"),
    )


def parse_series_files(
    lines: DataFrame,
    topics: Sequence[str],
    *,
    path: str = "path",
    line: str = "value",
    date: str = "Date",
    renames: Mapping[str, str] | None = None,
    **bounds,
) -> DataFrame:
    """CSV lines of files with headers of their own to wide rows: ``(path, line, date, topics, quarantined, reason)``.

    The header of a file is its line that names ``date``, after ``renames``, wherever it stands; the same header may
    stand there again.  Columns that are not asked for are passed over, and topics that a file lacks are missing cells.
    A line is quarantined, without a date or cells, for one reason, the first that holds: ``no header`` or
    ``two headers`` in its file, a ``column twice`` in the header, another number of ``fields`` than the
    header has, a malformed ``date``, a cell that is no ``number``.  Names may be quoted, commas in quotes are not told apart.

    Headers are a row for each file, joined to the lines by their path; a null path is a file without header.
    """
    at, of = F.col(path), F.col(line)
    # A file may begin with a byte order mark.
    bare = F.transform(F.split(F.regexp_replace(of, "^\uFEFF", ""), ",", -1), lambda f: F.btrim(F.trim(f), F.lit('"')))
    names = bare
    if renames:
        renamed = literal_map(dict(renames), "string")
        names = F.transform(bare, lambda f: F.coalesce(renamed(f), f))
    is_header = F.coalesce(F.array_contains(names, date), F.lit(False))
    headers = stored(
        lines.where(is_header & at.isNotNull())
        .groupBy(at.alias("_path"))
        .agg(F.min(names).alias("_names"), F.max(names).alias("_other")),
        "series-headers",
    )
    rows = lines.where(~is_header).select(at.alias("_path"), of.alias("_line"))
    rows = lookup_join(rows, headers, ["_path"], "left", **bounds)
    fields = F.split("_line", ",", -1)

    def text(name: str) -> Column:
        place = F.array_position("_names", name).cast("int")
        return F.when(place > 0, F.trim(F.get(fields, place - 1)))

    day = F.try_to_date(text(date), "yyyy-M-d")
    raw = {t: text(t) for t in topics}
    cells = {t: cell.try_cast("bigint") for t, cell in raw.items()}
    wrong = reduce(lambda a, b: a | b, [(raw[t] != "") & cells[t].isNull() for t in topics], F.lit(False))
    reason = (
        F.when(F.col("_names").isNull(), "no header")
        .when(F.col("_names") != F.col("_other"), "two headers")
        .when(F.size(F.array_distinct("_names")) != F.size("_names"), "column twice")
        .when(F.coalesce(F.size(fields) != F.size("_names"), F.lit(True)), "fields")
        .when(day.isNull(), "date")
        .when(F.coalesce(wrong, F.lit(False)), "number")
    )
    fits = F.col("reason").isNull()
    return rows.withColumn("reason", reason).select(
        F.col("_path").alias(path),
        F.col("_line").alias(line),
        F.when(fits, day).alias(date),
        *[F.when(fits, cell).alias(t) for t, cell in cells.items()],
        (~fits).alias("quarantined"),
        "reason",
    )


def diff_series(
    left: DataFrame,
    right: DataFrame,
    *,
    topic: str = "topic",
    value: str = "count",
    date: str = "Date",
) -> DataFrame:
    """Cells in which two versions of a series differ, a missing cell included.

    Each version is summed by cell first.  NULL is a topic and a day like any other.
    """
    keys = [date, topic]
    sides = [
        table.groupBy(*keys).agg(F.sum(value).alias(name), F.lit(1).alias(f"_{name}"))
        for table, name in ((left, "left_count"), (right, "right_count"))
    ]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    names = ("left_count", "right_count")
    cells = both.groupBy(*keys).agg(
        *(F.max(n).alias(n) for n in names), *(F.max(f"_{n}").alias(f"_{n}") for n in names)
    )
    same = F.col("left_count").eqNullSafe(F.col("right_count"))
    there = F.col("_left_count").eqNullSafe(F.col("_right_count"))
    return cells.where(~(same & there)).select(*keys, *names)
