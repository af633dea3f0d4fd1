from __future__ import annotations

import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from suite.baseline import emitted
from suite.queries import QUERIES
from termtide import PreprocessOptions, TopicSet, cooccurrence, saturating_words
from termtide.functions import interval_label
from termtide.operators import sort_counts
from termtide.plans.preprocess import with_job_tokens

ALL = dict(count_filter=0, word_length_filter=0, interval="overall")


def bags(spark, lists):
    return spark.createDataFrame([(t,) for t in lists], "tokens array<string>").withColumn(
        "date", F.lit("2020-06-01").cast("date")
    )


def counted(df):
    return {(r["topic"], r["word"]): r["count"] for r in df.collect()}


def topic_frame(spark, topics):
    rows, i = [], 0
    for topic in topics:
        for word in topic["words"]:
            rows.append((topic["topic"], word.lower(), i))
            i += 1
    return spark.createDataFrame(rows, "topic string, word string, idx long")


@pytest.mark.parametrize(
    "tokens, topics, expected",
    [
        (
            ["police", "tonight", "better", "tonight"],
            [{"topic": "police", "words": ["police"]}, {"topic": "time", "words": ["tonight"]}],
            {("police", "tonight"): 2, ("police", "better"): 1, ("time", "better"): 1},
        ),
        (["a", "b", "c"], [{"topic": "t", "words": ["a", "b"]}], {("t", "b"): 1, ("t", "c"): 2}),
        (
            ["a", "z"],
            [{"topic": "t1", "words": ["a"]}, {"topic": "t2", "words": ["A"]}],
            {("t1", "z"): 1},
        ),
        (["wall", "street"], [{"topic": "economy", "words": ["wall street"]}], {}),
        ([], [{"topic": "t", "words": ["a"]}], {}),
        (["a"], [{"topic": "t", "words": []}], {}),
    ],
)
def test_worked_cases(spark, tokens, topics, expected):
    posts = bags(spark, [tokens])
    assert counted(cooccurrence(posts, topics, **ALL)) == expected
    table = topic_frame(spark, topics)
    assert counted(cooccurrence(posts, table, **ALL)) == expected
    assert counted(cooccurrence(posts, table, join_bounds={}, **ALL)) == expected


@pytest.mark.parametrize("seed", range(6))
def test_every_form_equals_the_plain_statement(spark, seed):
    """Topics that share words, come back later and overlap; copies among the posts."""
    rng = random.Random(seed)
    alphabet = [f"w{i}" for i in range(rng.choice([4, 9, 30]))]
    topics = [
        {"topic": rng.choice("xyz"), "words": rng.choices(alphabet, k=rng.randint(1, 6))}
        for _ in range(rng.randint(1, 6))
    ]
    lists = [rng.choices(alphabet, k=rng.randint(0, 12)) for _ in range(40)]
    lists += [lists[0]] * 40
    expected = sum((emitted(tokens, topics) for tokens in lists), Counter())
    posts = bags(spark, lists)
    table = topic_frame(spark, topics)
    assert counted(cooccurrence(posts, topics, **ALL)) == expected
    assert counted(cooccurrence(posts, table, join_bounds={}, **ALL)) == expected
    assert counted(cooccurrence(posts, table, join_bounds={"max_rows": 0}, **ALL)) == expected


def test_length_and_count_limits_are_strict(spark):
    posts = bags(spark, [["t", "ab", "abc"]] * 25 + [["t", "abc", "abd"]])
    topics = [{"topic": "t", "words": ["t"]}]
    assert counted(cooccurrence(posts, topics, interval="overall")) == {("t", "abc"): 26}


def test_unknown_tokens_and_null_dates_are_kept(spark):
    posts = bags(spark, [["a", "bcd"]]).withColumn("date", F.lit(None).cast("date"))
    rows = cooccurrence(posts, [{"topic": "t", "words": ["a"]}], count_filter=0).collect()
    assert [tuple(r) for r in rows] == [(None, "t", "bcd", 1)]
    table = topic_frame(spark, [{"topic": "t", "words": ["a"]}])
    rows = cooccurrence(posts, table, count_filter=0, join_bounds={}).collect()
    assert [tuple(r) for r in rows] == [(None, "t", "bcd", 1)]


def test_interval_labels(spark):
    days = spark.createDataFrame([("2020-04-27",), ("2019-12-30",), ("2021-01-01",)], "d string")
    day = F.col("d").cast("date")

    def labels(interval, **kw):
        return [r[0] for r in days.select(interval_label(day, interval, **kw)).collect()]

    assert labels("weekly") == [18, 1, 53]
    assert labels("monthly") == [4, 12, 1]
    assert labels("yearly") == [2020, 2019, 2021]
    assert labels("overall") == ["OVERALL"] * 3
    assert [str(d) for d in labels("daily")] == ["2020-04-27", "2019-12-30", "2021-01-01"]
    assert [str(d) for d in labels("weekly", year_qualified=True)] == [
        "2020-04-27", "2019-12-30", "2020-12-28",
    ]
    with pytest.raises(ValueError):
        interval_label(day, "hourly")


def test_order(spark):
    rows = [("b", "t", "x", 2), ("a", "u", "x", 1), ("a", "t", "x", 1), ("a", "t", "y", 5)]
    df = spark.createDataFrame(rows, "interval string, topic string, word string, count long")
    assert [tuple(r) for r in sort_counts(df).collect()] == [rows[3], rows[2], rows[1], rows[0]]


def test_saturating_words(spark):
    rows = [("t1", "w", 100), ("t2", "w", 70), ("t1", "v", 60), ("t2", "u", 61)]
    df = spark.createDataFrame(rows, "topic string, word string, count long")
    assert sorted(r["word"] for r in saturating_words(df, 2).collect()) == ["u", "w"]
    assert [r["word"] for r in saturating_words(df, 3).collect()] == ["w"]
    empty = df.where("count < 0")
    assert saturating_words(empty, 2).collect() == []


def test_topic_set_reads_json_with_either_case():
    topics = TopicSet.from_json('[{"topic": "t", "words": ["Market", "market", "fund"]}]')
    assert topics.entries == (("t", "market"), ("t", "fund"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["cooccurrence", "cooccur_daily", "cooccurrence_joined"])
def test_plans_stay_on_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert python_node not in plan


def test_text_is_tokenised_once_and_shuffled_never(spark):
    posts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("text").alias("full_text"), F.lit("2020-01-01").cast("date").alias("date")
    )
    options = PreprocessOptions(choices=("lowercase", "punctuation"))
    df = cooccurrence(with_job_tokens(posts, options), [{"topic": "t", "words": ["the"]}])
    plan = plan_of(df)
    assert plan.count("regexp_extract_all") == 1
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<text:string>" in plan


def test_saturating_words_computes_the_counts_once(spark):
    df = QUERIES["saturating_words"](spark, "/root/testdata/sf0.001")
    df.collect()
    assert "ReusedExchange [_groupingexpression" in plan_of(df)


def test_forms_agree_where_places_are_shared(spark, monkeypatch):
    """Several words in one place, repeated posts, and each way to count."""
    module = sys.modules["termtide.operators.cooccurrence"]
    posts = spark.createDataFrame(
        [("d", ["w", "x", "y", "x", "z"]), ("d", ["w", "x", "y", "x", "z"]), ("e", ["y"]), ("e", []), ("e", None)],
        "date string, tokens array<string>",
    )
    topics = spark.createDataFrame(
        [("b", "w", 0), ("a", "w", 0), ("b", "x", 0), ("a", "y", 0), ("c", "z", 1)],
        "topic string, word string, idx long",
    )
    counting = dict(count_filter=0, word_length_filter=0)

    def counts(**more):
        found = module.cooccurrence(posts, topics, **counting, **more).collect()
        return sorted((r["date"], r["topic"], r["word"], r["count"]) for r in found)

    in_plan = counts()
    assert in_plan and in_plan == counts(join_bounds={}) == counts(join_bounds={"max_rows": 0})
    monkeypatch.setattr(module, "_LOOK_UP_FROM", 1)
    assert counts() == in_plan


@pytest.mark.parametrize("fits", [True, False])
def test_rare_words_are_left_out_only_where_no_topic_can_have_them(spark, monkeypatch, fits):
    module = sys.modules["termtide.operators.cooccurrence"]
    dice = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    posts = spark.createDataFrame(
        [
            (dice.choice(["d", "e", None]), [dice.choice(words) for _ in range(dice.randrange(9))])
            for _ in range(120)
        ],
        "date string, tokens array<string>",
    )
    topics = [  # the words of the first are not listed together
        {"topic": "a", "words": ["w0", "w3"]},
        {"topic": "b", "words": ["w1", "w2", "w5"]},
        {"topic": "a", "words": ["w4"]},
    ]

    def counts(topics, least, **more):
        found = module.cooccurrence(posts, topics, count_filter=least, word_length_filter=0, **more).collect()
        return sorted(map(str, found))

    for chosen, least, more in ((topics, 4, {}), (topics[:2], 8, {}), (topics, 15, {"interval": "overall"})):
        with monkeypatch.context() as patch:
            expected = counts(chosen, least, **more)
            patch.setattr(module, "_LOOK_UP_FROM", 1)
            patch.setattr(module, "fits_broadcast", lambda df: fits)
            assert expected and counts(chosen, least, **more) == expected


def test_topic_lists_of_any_size_and_single_topics(spark):
    posts = spark.createDataFrame([("d", ["w7", "other", "w59999"])], "date string, tokens array<string>")
    many = [{"topic": f"t{i}", "words": [f"w{i}"]} for i in range(60_000)]
    found = cooccurrence(posts, many, count_filter=0).collect()
    assert sorted((r["topic"], r["word"]) for r in found) == [
        ("t59999", "other"), ("t7", "other"), ("t7", "w59999"),
    ]
    assert cooccurrence(posts, {"topic": "t", "words": ["w7"]}, count_filter=0).count() == 2


def test_sums_of_some_posts_at_a_time(spark, monkeypatch):
    """A word that many posts share gets one row of sums from all of them, not one from each."""
    module = sys.modules["termtide.operators.cooccurrence"]
    posts, words = [["w0", "w5", None, "x", "x"], ["w3", "w0", "x"], None, [], ["x", "é"]] * 40, [f"w{i}" for i in range(6)]
    batch = pa.RecordBatch.from_pydict({"_tokens": pa.array(posts, pa.list_(pa.string()))})
    made = module._Posts(batch, pa.array(words), np.array([0, 0, 0, 1, 1, 1]), 0)
    (sums,) = (b.to_pylist() for b in made.sums())
    assert {r["word"]: (r["_0"], r["_1"]) for r in sums} == {"x": (120, 120), "w3": (40, 0), "w5": (40, 0)}
    assert {r["word"]: r["_bound"] for b in made.bounds(True) for r in b.to_pylist()}["x"] == 120

    with monkeypatch.context() as patch:
        patch.setattr(module, "_COLUMNS", 1)
        patch.setattr(module, "_PAIRS", 3)
        parts = [(r["word"], r["group"], r["_0"]) for b in made.sums() for r in b.to_pylist()]
    assert sorted(parts) == [("w3", 0, 40), ("w5", 0, 40), ("x", 0, 120), ("x", 1, 120)]

    dice, names = random.Random(3), [f"w{i}" for i in range(40)]
    some = [[dice.choice([*names, "x", "y", None]) for _ in range(dice.randrange(30))] for _ in range(100)]
    topics = [{"topic": f"t{i}", "words": names[i::7]} for i in range(7)]
    for more in (ALL, ALL | {"count_filter": 6}):
        with monkeypatch.context() as patch:
            expected = counted(cooccurrence(bags(spark, some), topics, **more))
            patch.setattr(module, "_LOOK_UP_FROM", 1)
            patch.setattr(module, "_POSTS", 4)
            assert expected and counted(cooccurrence(bags(spark, some), topics, **more)) == expected
