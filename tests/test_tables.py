"""Adapters, filters, joins, duplicates and token dictionaries."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from termtide.operators import filters, joins
from termtide.operators.normalize import (
    ADAPTERS,
    normalize_cnn_survey_2020,
    normalize_dataset,
    normalize_event_registry,
    normalize_gallup_survey_2016,
    normalize_radio,
    normalize_reddit_comments,
    normalize_tv_eyes,
    normalize_twitter,
    to_posts,
)
from termtide.operators.token_map import map_tokens, with_mapped_tokens
from termtide.sources.lists import parse_mapping, parse_topics

DAY = dt.date(2020, 6, 1)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_created_at_in_both_spellings(spark):
    raw = spark.createDataFrame(
        [("2020-06-01 23:30:00 UTC",), ("Mon Jun 01 23:30:00 +0000 2020",), ("junk",), (None,)],
        "created_at string",
    )
    moment = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    assert rows(normalize_twitter(raw), "date", moment) == [
        (DAY, "2020-06-01 23:30:00"), (DAY, "2020-06-01 23:30:00"), (None, None), (None, None),
    ]


def test_posted_time_wins_and_keeps_the_time_of_day(spark):
    raw = spark.createDataFrame(
        [("2020-06-01 10:00:00 UTC", "2020-06-02T11:12:13.000Z"), ("2020-06-01 10:00:00 UTC", None)],
        "created_at string, postedTime string",
    )
    moment = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    assert rows(normalize_twitter(raw), "date", moment) == [
        (dt.date(2020, 6, 2), "2020-06-02 11:12:13"), (DAY, "2020-06-01 10:00:00"),
    ]
    alone = normalize_twitter(raw.select("postedTime"))
    assert rows(alone, "date") == [(dt.date(2020, 6, 2),), (None,)]


def test_ids_become_strings(spark):
    raw = spark.createDataFrame([("abc", 5), (None, 7)], "id_str string, id long")
    assert rows(normalize_twitter(raw), "id_str") == [("abc",), ("7",)]
    assert rows(normalize_twitter(raw.select("id")), "id_str") == [("5",), ("7",)]


def test_text_lang_and_handle_preferences(spark):
    raw = spark.createDataFrame(
        [(None, "t", "en", None, (None, "name"), "u"), ("f", "t", None, "fr", (None, None), "u")],
        "full_text string, text string, language string, twitter_lang string, "
        "user struct<screen_name:string,name:string>, username string",
    )
    assert rows(normalize_twitter(raw), "full_text", "lang", "handle") == [
        ("t", "en", "name"), ("f", "fr", "u"),
    ]


def test_file_name_dates(spark):
    files = spark.createDataFrame(
        [("x", "/a/radio_2020-6-1.txt"), ("y", "/a/undated.txt")], "value string, path string"
    )
    assert rows(normalize_radio(files, F.col("path")), "id_str", "full_text", "date") == [
        ("radio_2020-6-1.txt", "x", DAY), ("undated.txt", "y", None),
    ]
    survey = spark.createDataFrame([(1, "/a/cnn_10-3-20.csv")], "id int, path string")
    assert rows(normalize_cnn_survey_2020(survey, F.col("path")), "id_str", "date") == [
        ("1", dt.date(2020, 10, 3))
    ]


def test_other_adapters(spark):
    gallup = spark.createDataFrame([(9, "2020-06-01"), (8, "no")], "case_id int, RESPONDENT_DATE string")
    assert rows(normalize_gallup_survey_2016(gallup), "id_str", "date") == [("9", DAY), ("8", None)]
    news = spark.createDataFrame([("u", "b", "2020-06-01")], "uri string, body string, date string")
    assert rows(to_posts(normalize_event_registry(news)), "id_str", "full_text", "date") == [
        ("u", "b", DAY)
    ]
    reddit = spark.createDataFrame([("i", "b", 1590969600)], "id string, body string, created_utc long")
    assert rows(normalize_reddit_comments(reddit), "id_str", "date") == [("i", DAY)]
    tv = spark.createDataFrame([("g", "b", "2020-06-01 05:00:00")], "guid string, body string, date string")
    assert rows(normalize_tv_eyes(tv), "id_str", "full_text", "date") == [("g", "b", DAY)]
    assert len(ADAPTERS) == 7
    assert normalize_dataset(tv, "other") is tv


def test_tweet_types(spark):
    df = spark.createDataFrame(
        [("t", None, False), ("r", ("1",), False), ("q", None, True), ("n", None, None)],
        "k string, retweeted_status struct<id:string>, is_quote_status boolean",
    )

    def kept(frame, *types):
        return "".join(r["k"] for r in filters.filter_tweet_types(frame, types).collect())

    assert kept(df, "tweet", "retweet", "quote") == "trqn"
    assert kept(df, "tweet", "quote") == "tqn"
    assert kept(df, "tweet", "retweet") == "tr"
    assert kept(df, "retweet", "quote") == "rq"
    assert kept(df) == "trqn"
    assert kept(df.drop("is_quote_status"), "retweet") == "r"
    assert kept(df.drop("retweeted_status"), "quote") == "q"
    assert kept(df.select("k"), "quote") == ""
    with pytest.raises(ValueError):
        kept(df, "reply")


def test_news_filters(spark):
    articles = spark.createDataFrame(
        [("a", ("s1",), [(("Joe Biden",),), (("X",),)]), ("b", ("s2",), [(("Y",),)]), ("c", ("s3",), None)],
        "uri string, source struct<uri:string>, concepts array<struct<label:struct<eng:string>>>",
    )
    meta = spark.createDataFrame(
        [("s1", "South", "D1", "TX"), ("s2", "West", "D2", "CA")],
        ["Source URL", "Region (Census)", "Division (Census)", "State"],
    )
    for bounds in ({}, {"max_rows": 0}):
        joined = joins.join_source_metadata(articles, meta, **bounds)
        assert sorted(rows(joined, "uri", "State"), key=str) == [("a", "TX"), ("b", "CA"), ("c", None)]
    assert rows(filters.filter_news_region(joined, ["South|Mid"]), "uri") == [("a",)]
    assert rows(filters.filter_news_division(joined, ["D2", ""]), "uri") == [("b",)]
    assert filters.filter_news_region(joined, ["|"]).count() == 3
    assert rows(filters.filter_news_states(joined, ["CA|TX"]), "uri") == []
    assert rows(filters.filter_news_concepts(articles, ["Joe Biden"]), "uri") == [("a",)]


def test_language_and_period(spark):
    df = spark.createDataFrame(
        [("en", "2020-06-01 10:00:00"), ("fr", "2020-06-03 12:00:00"), (None, None)], "lang string, m string"
    ).select("lang", F.col("m").cast("timestamp").alias("timestamp"), F.col("m").cast("date").alias("date"))
    assert filters.filter_lang(df, "fr").count() == 1
    assert filters.filter_lang(df.drop("lang"), "fr").count() == 3
    assert filters.filter_period(df, start_date="2020-06-01", end_date="2020-06-03").count() == 2
    assert filters.filter_period(df, start_datetime="2020-06-01 10:00:01").count() == 1
    days = df.drop("timestamp")
    assert filters.filter_period(days, start_datetime="2020-06-01 10:00:01").count() == 2
    with pytest.raises(ValueError):
        filters.filter_period(df, start_date="2020-06-01", start_datetime="2020-06-01 10:00:00")


def test_dedupe_keeps_the_earliest(spark):
    posts = spark.createDataFrame(
        [("1", "late", "2020-06-02"), ("1", "b", "2020-06-01"), ("1", "a", "2020-06-01"),
         ("1", "none", None), ("2", "x", None), (None, "n", None), (None, "n", None)],
        "id_str string, full_text string, m string",
    ).select("id_str", "full_text", F.col("m").cast("timestamp").alias("timestamp"))
    kept = filters.dedupe_by_id(posts)
    assert kept.columns == posts.columns
    assert sorted(rows(kept, "id_str", "full_text"), key=str) == [("1", "a"), ("2", "x"), (None, "n")]
    mapped = filters.dedupe_by_id(posts.withColumn("m", F.create_map("id_str", "full_text")).where("id_str = '1'"))
    assert mapped.columns == [*posts.columns, "m"] and mapped.first()["m"] == {"1": "a"}
    assert filters.dedupe_by_id(posts.select("id_str")).count() == 3


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join_with_a_hot_key(spark, how):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    side = spark.createDataFrame([("hot", 1), ("1", 2), ("x", 3), (None, 4)], "k string, v int")
    small = joins.lookup_join(facts, side, ["k"], how)
    salted = joins.lookup_join(facts, side, ["k"], how, max_rows=0, salts=4)
    assert sorted(rows(small), key=str) == sorted(rows(salted), key=str)


def test_broadcast_bounds(spark):
    side = spark.range(10)
    assert joins.fits_broadcast(side)
    assert not joins.fits_broadcast(side, max_rows=9)
    assert not joins.fits_broadcast(side, max_bytes=20)
    assert joins.fits_broadcast(side.where("id < 0"), max_rows=0)


def test_mapping_lines(spark):
    lines = spark.createDataFrame(
        [("car,auto,,vehicle", 1), ("single", 2), ("", 3), ("wagon,auto", 4)], "value string, n int"
    )
    for order in ("n", None):
        got = sorted(rows(parse_mapping(lines.coalesce(1), order=order)))
        assert got == [("auto", "wagon"), ("vehicle", "car")]


def test_topics_keep_the_first_mention(spark):
    json = '[{"topic": "a", "words": ["X", "y"]}, {"topic": "b", "words": ["x", "z"]}]'
    table = parse_topics(spark.createDataFrame([(json,)], "value string")).orderBy("idx")
    assert rows(table, "topic", "word") == [("a", "x"), ("a", "y"), ("b", "z")]


def test_token_dictionaries(spark):
    df = spark.createDataFrame(
        [(1, ["b", "a", "b", "pence"]), (2, []), (3, None), (4, ["b", "a", "b", "pence"])],
        "i int, tokens array<string>",
    )
    entries = [("b", "B"), ("pence", "penny"), ("A", "x")]
    table = spark.createDataFrame(entries, "synonym string, head string")
    expected = [["B", "a", "B", "pence"], [], None, ["B", "a", "B", "pence"]]
    plain = df.withColumn("tokens", map_tokens("tokens", dict(entries), ["pence"]))
    assert [r["tokens"] for r in plain.orderBy("i").collect()] == expected
    for bounds in ({}, {"max_literal": 0}, {"max_literal": 0, "max_rows": 0}):
        mapped = with_mapped_tokens(df, table, exclude=["pence"], **bounds)
        assert [r["tokens"] for r in mapped.orderBy("i").collect()] == expected


def test_stopword_rows(spark):
    tokens = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "token string")
    stop = spark.createDataFrame([("b",), ("b",)], "word string")
    for bounds in ({}, {"max_rows": 0}):
        assert sorted(rows(joins.without_stopwords(tokens, stop, **bounds))) == [("a",), ("a",), ("c",)]


def test_both_forms_of_a_dictionary_agree(spark):
    """Tokens listed twice, entries without a token or head, repeated rows, no tokens."""
    mapping = spark.createDataFrame(
        [("a", "x"), ("a", "w"), (None, "n"), ("b", None), ("c", "a")], "synonym string, head string"
    )
    posts = spark.createDataFrame(
        [(1, ["a", "b", "a"]), (1, ["a", "b", "a"]), (2, []), (3, None), (4, ["z", "c"]), (None, ["a"])],
        "k int, tokens array<string>",
    )
    forms = [{}, {"max_literal": 0}, {"max_literal": 0, "max_rows": 0}]
    got = [
        sorted(((r["k"], r["tokens"]) for r in with_mapped_tokens(posts, mapping, **f).collect()), key=str)
        for f in forms
    ]
    want = [(1, ["w", "b", "w"])] * 2 + [(2, []), (3, None), (4, ["z", "a"]), (None, ["w"])]
    assert got[0] == got[1] == got[2] == sorted(want, key=str)
