"""Files in, files out, and the whole job."""

from __future__ import annotations

import csv
import json

import pytest
from pyspark.sql import functions as F

from termtide import PostSelection, PreprocessOptions, preprocess, read_posts, run_job
from termtide.plans.preprocess import JOB_CHOICES, with_job_tokens
from termtide.sinks import (
    output_name,
    preprocessed_output,
    record_counts,
    run_summary,
    write_csv,
    write_json,
    write_parquet,
)
from termtide.sources import (
    DECLARED_SCHEMAS,
    default_stopwords,
    existing_paths,
    read_mapping,
    read_raw,
    read_source_metadata,
    read_stopwords,
    read_topics,
    source_format,
    split_paths,
    topics_from_json,
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def tweets(path, n=40):
    lines = [
        json.dumps(
            {
                "id": i,
                "full_text": f"The Police said tonight: it's better tonight #blm {i}",
                "created_at": f"2020-06-{1 + i % 4:02d} 10:00:00 UTC",
                "lang": "en" if i % 10 else "fr",
            }
        )
        for i in range(n)
    ]
    return write(path, "\n".join(lines + lines[:5]) + "\n")


def test_path_lists():
    assert split_paths("a|b%20c") == ["a", "b c"]
    assert split_paths(["a|b", "c"]) == ["a|b", "c"]
    assert source_format(["a.txt", "b.txt"]) == "text"
    assert source_format(["a.csv", "b.txt"]) == "json"
    assert source_format(["a.parquet"]) == "parquet"


def test_missing_paths_are_skipped(spark, tmp_path):
    there = write(tmp_path / "a.json", '{"x": 1}\n')
    with pytest.warns(UserWarning, match="skipping"):
        assert existing_paths(spark, [there, str(tmp_path / "no.json")]) == [there]
    with pytest.warns(UserWarning), pytest.raises(FileNotFoundError):
        read_raw(spark, str(tmp_path / "no.json"))


def test_formats(spark, tmp_path):
    write(tmp_path / "t" / "radio_2020-6-1.txt", "one\ntwo\n")
    write(tmp_path / "t" / "radio.txt", "three")
    text = read_posts(spark, PostSelection(str(tmp_path / "t" / "*.txt"), dataset="radio"))
    got = sorted((r["id_str"], r["full_text"], str(r["date"])) for r in text.collect())
    assert got == [("radio.txt", "three", "None"), ("radio_2020-6-1.txt", "one\ntwo\n", "2020-06-01")]

    csv = write(tmp_path / "cnn_10-3-20.csv", 'id,answer\n1,"a ""b""\nc"\n')
    options = {"multiLine": "true", "escape": '"'}
    survey = read_posts(spark, PostSelection(csv, dataset="cnn_survey_2020", csv_options=options))
    assert [tuple(r) for r in survey.select("id_str", "answer", "date").collect()] == [
        ("1", 'a "b"\nc', __import__("datetime").date(2020, 10, 3))
    ]

    path = tweets(tmp_path / "tweets.json")
    declared = read_raw(spark, path, schema=DECLARED_SCHEMAS["twitter"])
    assert declared.count() == read_raw(spark, path).count() == 45
    parquet = write_parquet(declared, str(tmp_path / "p"))
    assert read_raw(spark, parquet).count() == 45


def test_lists(spark, tmp_path):
    stop = read_stopwords(spark, write(tmp_path / "stop.txt", "the\nof x\n\n"))
    assert sorted(r["word"] for r in stop.collect()) == ["amp", "of", "rt", "the"]
    mapping = read_mapping(spark, write(tmp_path / "syn.txt", "car,auto\n\nvan,truck,auto\n"))
    assert sorted(tuple(r) for r in mapping.collect()) == [("auto", "van"), ("truck", "van")]
    text = '[\n {"topic": "t",\n "words": ["A", "b"]}\n]'
    for topics in (read_topics(spark, write(tmp_path / "t.json", text)), topics_from_json(spark, text)):
        assert [tuple(r) for r in topics.orderBy("idx").select("topic", "word").collect()] == [
            ("t", "a"), ("t", "b"),
        ]
    meta = read_source_metadata(spark, write(tmp_path / "m.csv", "Source URL,Region (Census)\ns,South\n"))
    assert meta.columns == ["Source URL", "Region (Census)"]


def test_default_stopwords(spark):
    assert {"the", "rt", "amp"} <= set(default_stopwords("en"))
    assert "los" in default_stopwords("es") and "les" in default_stopwords("fr")
    assert default_stopwords("ar") == ["rt", "amp"]


def test_topics_of_several_files_are_in_the_order_of_their_paths(spark, tmp_path):
    write(tmp_path / "topics" / "b.json", '[{"topic": "y", "words": ["w", "v"]}]')
    write(tmp_path / "topics" / "a.json", '{"topic": "x", "words": ["W", "u"]}')
    rows = read_topics(spark, str(tmp_path / "topics")).orderBy("idx").collect()
    assert [(r["topic"], r["word"]) for r in rows] == [("x", "w"), ("x", "u"), ("y", "v")]


def test_malformed_topics_raise(spark):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        topics_from_json(spark, '[{"topic": ').collect()


def test_a_bad_date_of_the_news_is_no_date(spark, tmp_path):
    lines = [
        {"uri": "a", "body": "police here", "date": "n/a", "source": {"uri": "s"}},
        {"uri": "b", "body": "police there", "date": "2020-06-02", "source": {"uri": "s"}},
    ]
    path = write(tmp_path / "news.json", "\n".join(map(json.dumps, lines)) + "\n")
    selection = PostSelection(path, dataset="event_registry")
    posts = read_posts(spark, selection)
    assert sorted((r["id_str"], str(r["date"])) for r in posts.collect()) == [("a", "None"), ("b", "2020-06-02")]
    dated = PostSelection(path, dataset="event_registry", start_date="2020-06-01")
    assert [r["id_str"] for r in read_posts(spark, dated).collect()] == ["b"]


def test_csv_keeps_fields_as_they_are(spark, tmp_path):
    values = [' a ', 'say "so"', "x,y", "back\\slash"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    path = write_csv(df, str(tmp_path / "fields"), order=[F.asc("i")], single_file=True)
    (part,) = (tmp_path / "fields.csv").glob("part-*.csv")
    with part.open(newline="") as lines:
        assert [r["v"] for r in csv.DictReader(lines)] == values
    assert path.endswith("fields.csv")


def test_one_file_is_in_order_whatever_the_number_of_parts(spark, tmp_path):
    df = spark.range(0, 5000, 1, 16).select((F.hash("id") % 10_000).alias("v"))
    write_csv(df, str(tmp_path / "sorted"), order=[F.asc("v")], single_file=True)
    (part,) = (tmp_path / "sorted.csv").glob("part-*.csv")
    found = [int(v) for v in part.read_text().split()[1:]]
    assert found == sorted(found) and len(found) == 5000


def test_output_names():
    assert output_name("out", ["2020-01-01", None, "", 0, "x"]) == "out/2020-01-01_0_x"
    assert output_name("out/", ["a"], "/in/tweets_*.json.gz") == "out/a_tweetsjsongz"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", None)], "k string, v int")
    order = [F.desc("k")]
    path = write_csv(df, str(tmp_path / "one"), order=order, single_file=True)
    files = list((tmp_path / "one.csv").glob("part-*.csv"))
    assert path.endswith("one.csv") and len(files) == 1
    assert files[0].read_text().splitlines() == ["k,v", "c,", "b,2", "a,1"]
    parts = write_csv(df, str(tmp_path / "many.csv"), order=order)
    assert spark.read.csv(parts, header=True).count() == 3
    js = write_json(df, str(tmp_path / "j"), partition_by=["k"])
    assert (tmp_path / "j.json" / "k=a").exists() and read_raw(spark, js).count() == 3


def test_summary_rows(spark):
    summary = run_summary(spark, {"n": 0, "Input": ["a", "b"], "none": None, "empty": []})
    assert summary.columns == ["n", "Input"] and tuple(summary.first()) == (0, "a b")
    posts = spark.createDataFrame([("1", "2020-06-01")], "id string, d string")
    posts = posts.withColumn("date", F.col("d").cast("date"))
    assert record_counts(posts).first()["record_count"] == 1


def test_preprocess_chain(column, spark):
    df = spark.createDataFrame([("The DOGS can't # run.\nhttp://x.y 😀 #tag rt",), (None,)], "full_text string")

    def texts(**options):
        result = preprocess(df, PreprocessOptions(**options))
        return [r["preprocessed_text"] for r in result.collect()]

    assert preprocess(df, PreprocessOptions()) is df
    assert texts(choices=["lowercase"]) == ["the dogs can't #run. http://x.y 😀 #tag rt", ""]
    assert texts(choices=["punctuation"]) == ["The DOGS cant #run http://x.y  #tag rt", ""]
    assert texts(choices=JOB_CHOICES, stopwords=["the", "rt"]) == [
        "dogs cannot #run http://x.y #tag", "",
    ]
    assert texts(choices=["hashtags", "emojis", "urls"]) == ["the dogs can't . rt", ""]
    assert texts(synonyms={"Dogs": "cats"}) == ["the cats cannot #run . http://x.y 😀 #tag rt", ""]
    assert texts(choices=["lowercase", "lemmatize", "stopwords"], stopwords=["dog", "rt"],
                 lemma_tokens={"dogs": "dog", "the": "pence"}) == [
        "pence can't #run . http://x.y 😀 #tag", "",
    ]
    assert texts(choices=["stemmed"], stems={"dogs": "dog"})[0].startswith("the dog can't")
    assert texts(lemmas={"DOGS": "dog"})[0].startswith("The dog can't")
    table = spark.createDataFrame([("dogs", "cats")], "synonym string, head string")
    stop = spark.createDataFrame([("rt",), ("the",)], "word string")
    assert texts(synonyms=table, stopwords=stop) == [
        "cats cannot #run . http://x.y 😀 #tag", "",
    ]
    for wrong in ("upper", "lemmatize"):
        with pytest.raises(ValueError):
            PreprocessOptions(choices=[wrong])
    many = spark.range(50_001).select(F.concat(F.lit("w"), F.col("id")).alias("synonym"), F.lit("x").alias("head"))
    posts = spark.createDataFrame([("a w7 and w50001",)], "full_text string")
    assert preprocess(posts, PreprocessOptions(synonyms=many)).first()["preprocessed_text"] == "a x and w50001"


def test_stop_words_of_any_number(spark):
    words = spark.range(60_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    posts = spark.createDataFrame(
        [("1", "W1 stays w59999 and w60000"), ("2", None), ("3", "w5 w5"), ("3", "w5 w5"), ("4", "none of them")],
        "id_str string, full_text string",
    )
    out = preprocess(posts, PreprocessOptions(choices=("lowercase",), stopwords=words))
    assert sorted((r["id_str"], r["preprocessed_text"]) for r in out.collect()) == [
        ("1", "stays and w60000"), ("2", ""), ("3", ""), ("3", ""), ("4", "none of them"),
    ]


def test_tokens_used_directly_equal_tokens_of_the_text(spark):
    posts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("text").alias("full_text")
    )
    for lang in ("en", "es"):
        options = PreprocessOptions(choices=JOB_CHOICES, lang=lang)
        direct = with_job_tokens(posts, options).select("tokens")
        text = preprocess(posts, options)
        from termtide.functions import tokenize

        again = text.select(tokenize("preprocessed_text", lang).alias("tokens"))
        assert direct.exceptAll(again).count() == again.exceptAll(direct).count() == 0


@pytest.mark.parametrize("single_file", [True, False])
def test_whole_job(spark, tmp_path, single_file):
    topics = '[{"topic": "police", "words": ["Police"]}, {"topic": "time", "words": ["tonight"]}]'
    result = run_job(
        spark,
        PostSelection(
            tweets(tmp_path / "tweets.json"), lang="en", drop_duplicates=True,
            start_date="2020-06-01", end_date="2020-06-03",
        ),
        topics,
        str(tmp_path / "out"),
        interval="monthly",
        options=PreprocessOptions(choices=JOB_CHOICES, stopwords=["the", "it", "is"]),
        single_file=single_file,
        preprocessed_path=str(tmp_path / "pre"),
        summary_file=True,
    )
    assert result.output.endswith("2020-06-01_2020-06-03_twitter_CoOccurrence_monthly.csv")
    got = [tuple(r) for r in read_raw(spark, result.output).collect()]
    assert sorted(got) == sorted(
        [("6", "police", "said", "26"), ("6", "police", "tonight", "52"), ("6", "police", "better", "26"),
         ("6", "police", "#blm", "26"), ("6", "time", "said", "26"), ("6", "time", "better", "26"),
         ("6", "time", "#blm", "26")]
    )
    summary = result.summary.first().asDict()
    assert spark.read.csv(result.output[:-4] + "_summary.csv", header=True).first()["End date"] == "2020-06-03"
    assert summary["total record count"] == 26
    assert summary["Filtered lang"] == "en" and summary["Tweet Types"] == "tweet retweet quote"
    written = spark.read.json(result.preprocessed_output)
    assert written.columns == ["full_text", "id_str", "preprocessed_text"]
    assert written.where("preprocessed_text like 'police said tonight%'").count() == 26


def test_job_as_json(spark, tmp_path):
    result = run_job(
        spark, PostSelection(tweets(tmp_path / "t.json")), [{"topic": "p", "words": ["police"]}],
        str(tmp_path / "o"), write_uncoalesced=True, count_filter=1,
    )
    assert result.output.endswith("twitter_CoOccurrence.json")
    assert set(spark.read.json(result.output).columns) == {"date", "topic", "word", "count"}


def test_preprocessed_output_of_plain_text(spark):
    df = spark.createDataFrame([("1", " a ")], "id_str string, full_text string")
    assert tuple(preprocessed_output(df, preprocessed="full_text").first()) == ("1", "a")


def test_no_step_of_the_chain_is_inlined_into_the_next(spark):
    posts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    options = PreprocessOptions(
        choices=JOB_CHOICES, synonyms={"the": "that"}, lemmas={"that": "this"}
    )
    df = preprocess(posts.select(F.col("text").alias("full_text")), options)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Contractions, synonyms and lemmas cut and search the text once each.
    assert plan.count("zip_with(") == 3
    assert plan.count("regexp_replace(") == 1
