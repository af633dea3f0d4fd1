"""Unreadable files, files left out by the date in their path, the job in one pass."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from termtide import PostSelection, PreprocessOptions, read_posts, run_job
from termtide.plans.preprocess import JOB_CHOICES, preprocess, preprocess_once, text_and_tokens, with_job_tokens
from termtide.session import shared_folder
from termtide.sources import read_raw, rows_of_files


def files_read(df) -> int:
    """Files that the scan of an executed plan was left with."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    plan.execute().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def transcripts(folder, days):
    folder.mkdir()
    for day in days:
        (folder / f"radio_{day}.txt").write_text(f"said on {day}")
    (folder / "radio.txt").write_text("said some day")
    return str(folder / "*.txt")


def test_files_outside_the_period_are_not_opened(spark, tmp_path):
    paths = transcripts(tmp_path / "radio", [f"2020-6-{d}" for d in range(1, 21)])
    chosen = read_posts(
        spark, PostSelection(paths, dataset="radio", start_date="2020-06-03", end_date="2020-06-05")
    )
    assert sorted(r["id_str"] for r in chosen.collect()) == [f"radio_2020-6-{d}.txt" for d in (3, 4, 5)]
    assert files_read(chosen) == 3
    everything = read_posts(spark, PostSelection(paths, dataset="radio"))
    assert everything.count() == 21 and files_read(everything) == 21


def test_a_table_that_is_no_scan_keeps_the_path_of_the_task(spark, tmp_path):
    from termtide.operators.normalize import normalize_radio

    paths = transcripts(tmp_path / "radio", ["2020-6-1"])
    raw = read_raw(spark, paths, format="text").select("value")
    got = sorted((r["id_str"], str(r["date"])) for r in normalize_radio(raw).collect())
    assert got == [("radio.txt", "None"), ("radio_2020-6-1.txt", "2020-06-01")]
    made = normalize_radio(spark.createDataFrame([("x",)], "value string")).first()
    assert made["date"] is None and made["full_text"] == "x"


def broken(tmp_path, spark):
    """Two good files and three bad ones of each kind that can break."""
    for kind in ("parquet", "json"):
        rows = spark.range(40).select("id", F.repeat(F.lit("text "), 50).alias("full_text"))
        rows.coalesce(2).write.format(kind).option("compression", "gzip").save(str(tmp_path / kind))
    good = next((tmp_path / "parquet").glob("part-*")).read_bytes()
    (tmp_path / "parquet" / "cut.parquet").write_bytes(good[: len(good) // 2])
    (tmp_path / "parquet" / "empty.parquet").write_bytes(b"")
    (tmp_path / "json" / "plain.json.gz").write_text('{"id": 1}')
    (tmp_path / "json" / "empty.json.gz").write_bytes(gzip.compress(b""))


def test_unreadable_files_are_named_and_the_rest_is_read(spark, tmp_path):
    broken(tmp_path, spark)
    schema = "id long, full_text string"
    for kind, bad in (("parquet", {"cut.parquet"}), ("json", {"plain.json.gz", "empty.json.gz"})):
        path = str(tmp_path / kind)
        reading = {"format": kind, "schema": schema if kind == "json" else None}
        assert read_raw(spark, path, skip_unreadable=True, **reading).count() == 40
        with pytest.raises(Exception):  # noqa: B017, which one depends on the format
            read_raw(spark, path, **reading).collect()
        rows = [r for r in rows_of_files(spark, path, **reading).collect() if r["length"]]
        assert sum(r["n_rows"] for r in rows) == 40
        assert {r["path"].rsplit("/", 1)[-1] for r in rows if not r["n_rows"]} == bad


def test_a_file_that_breaks_off_gives_what_comes_before(spark, tmp_path):
    lines = "".join(json.dumps({"id": i, "full_text": f"{i * 7919 % 104729} words"}) + "\n" for i in range(50_000))
    whole = gzip.compress(lines.encode())
    (tmp_path / "cut.json.gz").write_bytes(whole[: len(whole) // 2])
    path = str(tmp_path / "cut.json.gz")
    rows = read_raw(spark, path, schema="id long, full_text string", skip_unreadable=True)
    ids = sorted(r["id"] for r in rows.where("full_text is not null").collect())
    assert 1000 < len(ids) < 50_000 and ids == list(range(len(ids)))


@pytest.mark.parametrize(
    "options",
    [
        PreprocessOptions(choices=()),
        PreprocessOptions(choices=("lowercase", "punctuation")),
        PreprocessOptions(choices=JOB_CHOICES, stopwords=["the"]),
        PreprocessOptions(choices=(*JOB_CHOICES, "stemmed")),
    ],
)
def test_text_and_tokens_in_one_go(spark, options):
    posts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.col("text").alias("full_text")
    )
    both = text_and_tokens(preprocess_once(posts, options), options)
    tokens = with_job_tokens(posts, options).select("doc_id", "tokens")
    assert both.select("doc_id", "tokens").exceptAll(tokens).isEmpty()
    assert both.count() == tokens.count()
    if options.is_needed:
        text = preprocess(posts, options).select("doc_id", "preprocessed_text")
        assert both.select("doc_id", "preprocessed_text").exceptAll(text).isEmpty()


def test_the_job_reads_its_input_once(spark, tmp_path):
    """Each line of the input passes an accumulator once, and nothing of the way is left behind."""
    lines = [
        json.dumps({"id": i, "full_text": f"the police said tonight {i}", "lang": "en",
                    "created_at": f"2020-06-{1 + i % 4:02d} 10:00:00 UTC"})
        for i in range(40)
    ]
    (tmp_path / "t.json").write_text("\n".join(lines))
    scratch = Path(shared_folder(spark))
    before = set(scratch.glob("*"))
    reads = spark.sparkContext.accumulator(0)

    from termtide.plans import job

    def counted(*args, **kwargs):
        def count(batches):
            for batch in batches:
                reads.add(batch.num_rows)
                yield batch

        posts = read_posts(*args, **kwargs).select("id_str", "date", "full_text")
        return posts.mapInArrow(count, posts.schema)

    patch = pytest.MonkeyPatch()
    patch.setattr(job, "read_posts", counted)
    try:
        done = run_job(
            spark, PostSelection(str(tmp_path / "t.json")), [{"topic": "p", "words": ["police"]}],
            str(tmp_path / "o"), preprocessed_path=str(tmp_path / "pre"), count_filter=1,
        )
    finally:
        patch.undo()
    assert reads.value == 40
    assert done.summary.first()["total record count"] == 40
    assert read_raw(spark, done.output).count() > 0
    assert read_raw(spark, done.preprocessed_output, schema="id_str string").count() == 40
    assert set(scratch.glob("*")) == before
