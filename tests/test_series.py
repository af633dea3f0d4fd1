from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from termtide.operators import series
from termtide.sources import read_lines


def day(text):
    return dt.date.fromisoformat(text)


def long(spark, cells):
    df = spark.createDataFrame(cells, "topic string, d string, count long")
    return df.select("topic", F.col("d").cast("date").alias("Date"), "count")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


CELLS = [("a", "2020-05-01", 3), ("b", "2020-05-01", 4), ("a", "2020-05-03", 5), ("a", "2020-05-06", 7)]


def test_pivot_and_back(spark):
    wide = series.pivot_series(long(spark, CELLS), ["a", "b"])
    assert rows(wide, "Date")[1] == (day("2020-05-03"), 5, 0)
    assert rows(series.pivot_series(long(spark, CELLS)), "Date") == rows(wide, "Date")
    empty = series.pivot_series(long(spark, CELLS), ["a", "b"], fill=None)
    assert rows(empty, "Date")[1] == (day("2020-05-03"), 5, None)
    back = series.unpivot_series(wide)
    assert back.columns == ["Date", "topic", "count"] and back.count() == 6


def test_missing_days_become_zero(spark):
    filled = series.fill_missing_days(long(spark, CELLS))
    assert filled.count() == 12
    assert [r[2] for r in rows(filled, "topic", "Date")] == [3, 0, 5, 0, 0, 7, 4, 0, 0, 0, 0, 0]
    wide = series.fill_missing_days_wide(series.pivot_series(long(spark, CELLS), ["a", "b"]))
    assert [r[1] for r in rows(wide, "Date")] == [3, 0, 5, 0, 0, 7]


def test_tumbling_buckets_start_at_the_first_date(spark):
    summed = series.tumbling_sum(long(spark, CELLS), 5)
    assert rows(summed, "topic", "Date") == [
        (day("2020-05-01"), "a", 8), (day("2020-05-06"), "a", 7), (day("2020-05-01"), "b", 4),
    ]
    anchored = series.tumbling_sum(long(spark, CELLS), 5, anchor="2020-05-03")
    assert rows(anchored, "topic", "Date")[0] == (day("2020-04-28"), "a", 3)


def test_weeks_start_on_monday(spark):
    summed = series.weekly_sum(long(spark, CELLS))
    assert rows(summed, "topic", "start_of_week") == [
        ("a", day("2020-04-27"), 8, 18), ("a", day("2020-05-04"), 7, 19), ("b", day("2020-04-27"), 4, 18),
    ]


def test_roll_up(spark):
    mapping = spark.createDataFrame([("a", "all"), ("b", "all"), ("c", "none")], "topic string, category string")
    for bounds in ({}, {"max_rows": 0}):
        summed = series.roll_up(long(spark, CELLS), mapping, **bounds)
        assert rows(summed, "Date")[0] == (day("2020-05-01"), "all", 7)


def test_union_of_drifting_headers(spark):
    a = spark.createDataFrame([("2019", 1, 2)], "Date string, Legal int, Protest int")
    b = spark.createDataFrame([("2020", 3, 4)], "Date string, Protests int, Empathy int")
    stacked = series.union_series([a, b], {"Protest": "Protests"})
    assert stacked.columns == ["Date", "Legal", "Protests", "Empathy"]
    assert rows(stacked, "Date") == [("2019", 1, 2, None), ("2020", None, 3, 4)]
    assert rows(series.union_series([a, b], {"Protest": "Protests"}, fill=0), "Date")[1] == ("2020", 0, 3, 4)


def test_bad_lines_are_quarantined(spark):
    lines = {
        "2020-04-27,587,8572,17620,812,9": False,
        "2020-04-27,587,8572,17620,812": True,
        "2020-04-27,1,2,3,4,5,6": True,
        "15402019-12-15,1,2,3,4,5": True,
        "2020-04-27,1,,3,4,5": False,
        "2020-04-27,1,two,3,4,5": True,
        "": True,
    }
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    parsed = series.parse_series_lines(df, list("abcde"))
    assert {r["value"]: r["quarantined"] for r in parsed.collect()} == lines


def test_differences_between_versions(spark):
    other = [("a", "2020-05-01", 3), ("b", "2020-05-01", 5), ("c", "2020-05-01", 1)]
    diff = series.diff_series(long(spark, CELLS), long(spark, other))
    assert rows(diff, "topic", "Date") == [
        (day("2020-05-03"), "a", 5, None), (day("2020-05-06"), "a", 7, None),
        (day("2020-05-01"), "b", 4, 5), (day("2020-05-01"), "c", None, 1),
    ]


NULLS = [*CELLS, (None, "2020-05-01", 5), (None, "2020-05-02", None), ("a", None, 2), ("a", "2020-05-01", 1)]


def test_a_missing_topic_is_a_topic(spark):
    filled = rows(series.fill_missing_days(long(spark, NULLS)), "topic", "Date")
    assert [r for r in filled if r[0] is None] == [
        (None, day(f"2020-05-0{i}"), 5 if i == 1 else 0) for i in range(1, 7)
    ]
    assert ("a", None, 2) in filled and ("a", day("2020-05-01"), 4) in filled


def test_roll_up_keeps_what_has_no_category(spark):
    mapping = spark.createDataFrame([("a", "all")], "topic string, category string")
    for bounds in ({}, {"max_rows": 0}):
        summed = series.roll_up(long(spark, NULLS), mapping, **bounds)
        on_first = {r["category"]: r["count"] for r in summed.where("Date = '2020-05-01'").collect()}
        assert on_first == {"all": 4, None: 9}
        assert summed.agg(F.sum("count")).first()[0] == sum(c for *_, c in NULLS if c)


def test_a_series_does_not_differ_from_itself(spark):
    assert series.diff_series(long(spark, NULLS), long(spark, NULLS)).count() == 0
    less = series.diff_series(long(spark, NULLS), long(spark, [c for c in NULLS if c[2] is not None]))
    assert rows(less, "Date") == [(day("2020-05-02"), None, None, None)]


def test_headers_of_single_files(spark, tmp_path):
    files = {
        "plain": "Date,a,b\n2020-05-01,1,2\n2020-5-2,,4\n2020-05-03,1\n2020-05-04,x,1\n\n",
        "turned": '\ufeffb,"Date",note\r\n7,2020-05-01,any text\r\nb,Date,note\r\n8,no day,\r\n',
        "late": "2020-05-09,5,6\nday,B,a\n",
        "none": "2020-05-01,1,2\n",
        "both": "Date,a\n2020-05-01,1\nDate,b\n",
        "twice": "Date,a,a\n2020-05-01,1,2\n",
        "alone": "Date,a\n",
        "empty": "",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode())
    lines = read_lines(spark, str(tmp_path))
    for bounds in ({}, {"max_rows": 0}):
        found = series.parse_series_files(lines, ["a", "b"], renames={"day": "Date", "B": "b"}, **bounds)
        assert found.columns == ["path", "value", "Date", "a", "b", "quarantined", "reason"]
        got = {(r[0].split("/")[-1][:-4], r[1]): tuple(r[2:]) for r in found.collect()}
        bad = lambda why: (None, None, None, True, why)
        assert got == {
            ("plain", "2020-05-01,1,2"): (day("2020-05-01"), 1, 2, False, None),
            ("plain", "2020-5-2,,4"): (day("2020-05-02"), None, 4, False, None),
            ("plain", "2020-05-03,1"): bad("fields"),
            ("plain", "2020-05-04,x,1"): bad("number"),
            ("plain", ""): bad("fields"),
            ("turned", "7,2020-05-01,any text"): (day("2020-05-01"), None, 7, False, None),
            ("turned", "8,no day,"): bad("date"),
            ("late", "2020-05-09,5,6"): (day("2020-05-09"), 6, 5, False, None),
            ("none", "2020-05-01,1,2"): bad("no header"),
            ("both", "2020-05-01,1"): bad("two headers"),
            ("twice", "2020-05-01,1,2"): bad("column twice"),
        }


def test_lines_without_file_or_text(spark):
    lines = spark.createDataFrame(
        [(None, "Date,a"), (None, "2020-05-01,1"), ("f", "Date,a"), ("f", None), ("f", "2020-05-01,1")],
        "path string, value string",
    )
    found = series.parse_series_files(lines, ["a"]).collect()
    got = sorted((r["path"] or "", r["value"] or "", r["a"], r["reason"]) for r in found)
    assert got == [("", "2020-05-01,1", None, "no header"), ("f", "", None, "fields"), ("f", "2020-05-01,1", 1, None)]
    assert series.parse_series_files(lines.limit(0), ["a"]).count() == 0
