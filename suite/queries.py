"""One query per operator, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import inputs as src
from suite.inputs import TOPICS, spread
from termtide.functions.stems import word_stems
from termtide.functions.text import (
    clean_text,
    expand_contractions,
    remove_punctuation,
    replace_phrases,
    url_decode,
)
from termtide.functions.tokens import (
    clean_and_tokenize,
    filter_tokens,
    join_tokens,
    split_emojis,
    tokenize,
)
from termtide.operators import filters, joins, normalize, series
from termtide.operators.cooccurrence import TopicSet, cooccurrence, sort_counts
from termtide.operators.lemmas import lemma_table
from termtide.operators.phrases import with_replaced_phrases
from termtide.operators.saturation import saturating_words
from termtide.operators.token_map import with_mapped_tokens
from termtide.plans.job import PostSelection, read_posts, run_job, topic_cooccurrence
from termtide.plans.preprocess import (
    JOB_CHOICES,
    PreprocessOptions,
    preprocess,
    preprocess_tokens,
    with_job_tokens,
    without_listed,
)
from termtide.session import scratch_path
from termtide.sinks import preprocessed_output, record_counts, write_csv, write_json
from termtide.sources.lists import parse_mapping, parse_topics
from termtide.sources.posts import file_name, read_lines, read_raw, rows_of_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

PLAIN = PreprocessOptions(choices=("lowercase", "punctuation"))
JOB = PreprocessOptions(choices=JOB_CHOICES, stopwords=src.STOPWORDS)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_q")] = fn
    return fn




def _tokens(c) -> list:
    """Token lists in a form that every engine compares alike."""
    return [join_tokens(c).alias("tokens"), F.size(c).alias("n_tokens")]


def _day_text(name: str) -> Column:
    """A day that may be missing, as text."""
    return F.col(name).cast("string").alias(name)


def _posts(df: DataFrame) -> DataFrame:
    """Canonical posts with the moment as text and the text by its length."""
    return df.select(
        "id_str",
        F.length("full_text").alias("n_chars"),
        F.md5("full_text").alias("text_md5"),
        _day_text("date"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        "lang",
        "handle",
    )


# --- sources ----------------------------------------------------------------


@query
def src_parquet(spark, sf):
    src.configure(spark)
    raw = read_raw(spark, f"{sf}/documents.parquet")
    return raw.select(
        F.col("doc_id").cast("string").alias("id_str"),
        F.length("text").alias("n_chars"),
        "lang",
        "source",
    )


@query
def src_csv(spark, sf):
    path = scratch_path(spark, "posts") + ".csv"
    rows = src.posts(spark, sf).select("id_str", "full_text", "lang")
    rows.write.option("header", True).option("escape", '"').csv(path)
    options = {"multiLine": "true", "quote": '"', "escape": '"'}
    return read_raw(spark, path, csv_options=options).select(
        "id_str", F.md5("full_text").alias("text_md5"), "lang"
    )


@query
def src_json(spark, sf):
    path = write_json(src.replies(spark, sf), scratch_path(spark, "replies"))
    schema = (
        "id_str string, full_text string, retweeted_status struct<id_str:string>, "
        "is_quote_status boolean"
    )
    return read_raw(spark, path, schema=schema).select(
        "id_str",
        F.md5("full_text").alias("text_md5"),
        F.col("retweeted_status.id_str").alias("retweeted"),
        F.col("is_quote_status").cast("string").alias("is_quote_status"),
    )


@query
def src_text(spark, sf):
    """Text files read whole, one row each, with the date of their path."""
    path = scratch_path(spark, "radio")
    roles = src.table(spark, sf, "conversations").select(
        F.concat_ws("_", "role", F.lit("2020-6-1")).alias("role"),
        F.regexp_replace("text", r"\s", " ").alias("value"),
    )
    roles.write.partitionBy("role").text(path)
    files = read_raw(spark, f"{path}/*/*.txt", format="text")
    posts = normalize.normalize_radio(files)
    return posts.select("date", F.explode(F.split("full_text", "\n")).alias("line")).where(
        F.col("line") != ""
    ).groupBy("date").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query
def src_text_period(spark, sf):
    """Text files of a period: those of other days are never opened."""
    path = scratch_path(spark, "radio")
    lines = src.posts(spark, sf).select(
        F.concat_ws("-", F.year("date"), F.month("date"), F.day("date")).alias("day"),
        F.regexp_replace("full_text", r"\s", " ").alias("value"),
    )
    lines.repartition("day").write.partitionBy("day").text(path)
    period = PostSelection(
        f"{path}/*/*.txt", dataset="radio", start_date="2024-01-20", end_date="2024-02-03"
    )
    files = read_posts(spark, period)
    return files.select(_day_text("date"), F.explode(F.split("full_text", "\n")).alias("line")).where(
        F.col("line") != ""
    ).groupBy("date").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def _misnamed(spark, rows: DataFrame, folder: str, name: str) -> None:
    """A text file under the name of another kind."""
    path = scratch_path(spark, "misnamed")
    rows.coalesce(1).write.text(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    part = system.globStatus(hadoop.Path(f"{path}/part-*"))[0].getPath()
    system.rename(part, hadoop.Path(f"{folder}/{name}"))


@query
def src_unreadable(spark, sf):
    """Posts in two formats, each with a file that cannot be read: the others are read, that one is named."""
    rows = src.posts(spark, sf).select("id_str", "full_text")
    broken = src.table(spark, sf, "region").select(F.col("r_name").alias("value"))
    found = []
    for kind, name in (("parquet", "broken.parquet"), ("json", "broken.json.gz")):
        path = scratch_path(spark, f"posts_{kind}")
        rows.write.format(kind).option("compression", "gzip").save(path)
        _misnamed(spark, broken, path, name)
        schema = "id_str string, full_text string" if kind == "json" else None
        raw = read_raw(spark, path, format=kind, schema=schema, skip_unreadable=True)
        read = raw.agg(F.count("*").alias("n_posts"), F.sum(F.length("full_text")).alias("n_chars"))
        files = rows_of_files(spark, path, format=kind, schema=schema).where("length > 0 and n_rows = 0")
        named = files.agg(F.min(file_name("path")).alias("unreadable"), F.count("*").alias("n_unreadable"))
        found += [part.withColumn("kind", F.lit(kind)) for part in (read, named)]
    parts = found[0]
    for part in found[1:]:
        parts = parts.unionByName(part, allowMissingColumns=True)
    return parts.groupBy("kind").agg(
        *(F.max(c).alias(c) for c in ("n_posts", "n_chars", "unreadable", "n_unreadable"))
    )


@query
def job_outputs(spark, sf):
    """The whole job on raw comments: its preprocessed posts, the number of posts, the name of the counts."""
    comments = src.posts(spark, sf).select(
        F.concat(F.lit("c"), "id_str").alias("id"),
        F.col("full_text").alias("body"),
        F.unix_timestamp("timestamp").alias("created_utc"),
    )
    raw = scratch_path(spark, "comments") + ".json"
    comments.write.option("compression", "gzip").json(raw)
    done = run_job(
        spark, PostSelection(raw, dataset="reddit_comments"), TOPICS, scratch_path(spark, "job"),
        options=JOB, interval="weekly", preprocessed_path=scratch_path(spark, "preprocessed_posts"),
    )
    schema = "id_str string, full_text string, preprocessed_text string"
    posts = read_raw(spark, done.preprocessed_output, schema=schema)
    return posts.select(
        "id_str",
        F.md5("full_text").alias("text_md5"),
        "preprocessed_text",
        F.lit(done.summary.first()["total record count"]).cast("long").alias("n_posts"),
        file_name(F.lit(done.output)).alias("counts_name"),
    )


@query
def job_counts(spark, sf):
    """What the whole job writes, with preprocessed output on the way."""
    comments = src.posts(spark, sf).select(
        F.col("id_str").alias("id"),
        F.col("full_text").alias("body"),
        F.unix_timestamp("timestamp").alias("created_utc"),
    )
    raw = scratch_path(spark, "comments") + ".json"
    comments.write.option("compression", "gzip").json(raw)
    done = run_job(
        spark, PostSelection(raw, dataset="reddit_comments"), TOPICS, scratch_path(spark, "job"),
        options=JOB, interval="weekly", preprocessed_path=scratch_path(spark, "preprocessed_posts"),
    )
    return read_raw(spark, done.output).select(
        F.col("interval").cast("int"), "topic", "word", F.col("count").cast("bigint")
    )


@query
def map_file_rows(spark, sf):
    parts = src.table(spark, sf, "part").select(
        "p_partkey", F.concat_ws(",", "p_brand", F.replace("p_name", F.lit(" "), F.lit(",,"))).alias("value")
    )
    return parse_mapping(parts, order="p_partkey")


@query
def topic_table(spark, sf):
    words = F.split(F.regexp_replace("text", r"[\s.,]+", " "), " ")
    topic = F.struct(
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("topic"), words.alias("words")
    )
    documents = src.table(spark, sf, "benchmark").select(
        "item_id", F.to_json(F.array(topic)).alias("value")
    )
    topics = parse_topics(documents, order="item_id")
    return topics.select("topic", "word", F.col("idx").cast("string").alias("idx"))


# --- adapters ---------------------------------------------------------------


@query
def norm_twitter_text(spark, sf):
    df = normalize.normalize_twitter_text(src.tweets(spark, sf))
    return df.select("id", F.md5("full_text").alias("text_md5"))


@query
def norm_created_at(spark, sf):
    df = normalize.normalize_twitter_created(src.tweets(spark, sf))
    moment = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("moment")
    return df.select("id", "created_at", _day_text("date"), moment)


@query
def norm_posted_time(spark, sf):
    df = src.tweets(spark, sf).transform(normalize.normalize_twitter_created)
    df = normalize.normalize_twitter_posted(df)
    moment = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("moment")
    return df.select("id", "postedTime", _day_text("date"), moment)


@query
def norm_id(spark, sf):
    return normalize.normalize_twitter_id(src.tweets(spark, sf)).select("id", "id_str")


@query
def norm_lang(spark, sf):
    return normalize.normalize_twitter_lang(src.tweets(spark, sf)).select("id", "lang")


@query
def norm_handle(spark, sf):
    return normalize.normalize_twitter_handle(src.tweets(spark, sf)).select("id", "handle")


@query
def norm_twitter(spark, sf):
    return _posts(normalize.to_posts(normalize.normalize_dataset(src.tweets(spark, sf), "twitter")))


def _files(spark, sf, pattern) -> DataFrame:
    """Documents with the path of the file they might have come from."""
    day = F.date_format(src._day("doc_id"), pattern)
    name = F.when(F.col("doc_id") % 9 == 0, F.lit("undated")).otherwise(day)
    number = F.col("doc_id").cast("string")
    return src.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("value"),
        F.concat(F.lit("/data/in/"), name, F.lit("_n"), number, F.lit(".txt")).alias("path"),
    )


@query
def norm_radio(spark, sf):
    df = normalize.normalize_radio(_files(spark, sf, "yyyy-M-d"), F.col("path"))
    return df.select("id_str", _day_text("date"), F.md5("full_text").alias("text_md5"))


@query
def norm_cnn(spark, sf):
    df = normalize.normalize_cnn_survey_2020(_files(spark, sf, "M-d-yy"), F.col("path"))
    return df.select("id_str", _day_text("date"))


@query
def norm_gallup(spark, sf):
    raw = src.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("case_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("RESPONDENT_DATE"),
    )
    return normalize.normalize_gallup_survey_2016(raw).select("id_str", "date")


@query
def norm_news(spark, sf):
    posts = normalize.to_posts(normalize.normalize_event_registry(src.articles(spark, sf)))
    return posts.select("id_str", "date", F.md5("full_text").alias("text_md5"))


@query
def norm_reddit(spark, sf):
    posts = normalize.to_posts(normalize.normalize_reddit_comments(src.comments(spark, sf)))
    return posts.select("id_str", "date", F.md5("full_text").alias("text_md5"))


@query
def norm_tv(spark, sf):
    posts = normalize.to_posts(normalize.normalize_tv_eyes(src.broadcasts(spark, sf)))
    return posts.select("id_str", "date", F.md5("full_text").alias("text_md5"))


# --- filters ----------------------------------------------------------------


def _articles_with_source(spark, sf):
    return joins.join_source_metadata(src.articles(spark, sf), src.source_metadata(spark, sf))


@query
def join_source_meta(spark, sf):
    return _articles_with_source(spark, sf).select(
        "uri",
        F.col("Region (Census)").alias("region"),
        F.col("Division (Census)").alias("division"),
        F.col("State").alias("state"),
    )


@query
def join_source_meta_salted(spark, sf):
    joined = joins.join_source_metadata(
        src.articles(spark, sf), src.source_metadata(spark, sf), max_rows=0
    )
    return joined.select(
        "uri",
        F.col("Region (Census)").alias("region"),
        F.col("Division (Census)").alias("division"),
        F.col("State").alias("state"),
    )


@query
def filter_region(spark, sf):
    kept = filters.filter_news_region(
        _articles_with_source(spark, sf), ["|".join(src.NEWS_REGIONS) + "|"]
    )
    return kept.select("uri", F.col("Region (Census)").alias("region"))


@query
def filter_division(spark, sf):
    kept = filters.filter_news_division(
        _articles_with_source(spark, sf), ["division 1", "", "division 3"]
    )
    return kept.select("uri", F.col("Division (Census)").alias("division"))


@query
def filter_states(spark, sf):
    kept = filters.filter_news_states(_articles_with_source(spark, sf), ["NATION_4", "NATION_7"])
    return kept.select("uri", F.col("State").alias("state"))


@query
def filter_concepts(spark, sf):
    kept = filters.filter_news_concepts(src.articles(spark, sf), src.CONCEPTS)
    return kept.select("uri", F.array_join("concepts.label.eng", "|").alias("concepts"))


@query
def filter_outlet(spark, sf):
    kept = filters.filter_outlet(src.broadcasts(spark, sf), ["user", "system"])
    return kept.select("guid", "outlet")


@query
def filter_tweet_types(spark, sf):
    """Every single type, labelled with the type asked for."""
    replies = src.replies(spark, sf)
    kept = [
        filters.filter_tweet_types(replies, [kind]).select(F.lit(kind).alias("kind"), "id_str")
        for kind in filters.TWEET_TYPES
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query
def filter_lang(spark, sf):
    return filters.filter_lang(src.posts(spark, sf), "fr").select("id_str", "lang")


@query
def filter_date_range(spark, sf):
    kept = filters.filter_period(
        src.posts(spark, sf), start_date="2024-01-10", end_date="2024-02-05"
    )
    return kept.select("id_str", "date")


@query
def filter_ts_range(spark, sf):
    kept = filters.filter_period(
        src.posts(spark, sf),
        start_datetime="2024-01-10 06:00:00",
        end_datetime="2024-02-05 18:00:00",
    )
    return kept.select("id_str", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query
def dedupe_by_id(spark, sf):
    """Posts with their text as id, so copies of a text are copies of a post."""
    posts = src.posts(spark, sf).withColumn("id_str", F.md5("full_text"))
    return _posts(filters.dedupe_by_id(posts))


# --- text -------------------------------------------------------------------


@query
def text_clean(spark, sf):
    posts = src.posts(spark, sf)
    return posts.select("id_str", F.lower(clean_text("full_text")).alias("text"))


@query
def text_punct(spark, sf):
    pages = spread(src.table(spark, sf, "pages"))
    text = F.concat_ws(" ", "url", "html")
    return pages.select("page_id", remove_punctuation(text).alias("text"))


@query
def text_punct_all(spark, sf):
    pages = spread(src.table(spark, sf, "pages"))
    text = F.concat_ws(" ", "url", "html")
    return pages.select("page_id", remove_punctuation(text, keep_urls=False).alias("text"))


def _contracted(c) -> Column:
    """Write some word pairs of the documents in their short form."""
    text = F.lower(c)
    for long, short in ((" is ", "'s "), (" was ", " wasn't "), (" in ", " can't've ")):
        text = F.replace(text, F.lit(long), F.lit(short))
    return text


@query
def expand_contractions_q(spark, sf):
    posts = src.posts(spark, sf)
    text = _contracted("full_text")
    return posts.select(
        "id_str",
        expand_contractions(text).alias("text"),
        expand_contractions(text, drop_ownership=True).alias("text_dropped"),
    )


@query
def replace_phrases_q(spark, sf):
    posts = src.posts(spark, sf)
    return posts.select("id_str", replace_phrases(F.lower("full_text"), src.PHRASES).alias("text"))


@query
def phrases_large(spark, sf):
    """Every pair of neighbouring words of the pages is a phrase, looked for by joining."""
    posts = src.posts(spark, sf).select("id_str", F.lower("full_text").alias("text"))
    return with_replaced_phrases(posts, src.page_pairs(spark, sf), text="text", max_literal=0)


@query
def url_decode_q(spark, sf):
    escaped = F.col("full_text")
    for plain, code in ((" ", "%20"), ("é", "%C3%A9"), (",", "%2c"), (".", "+%2B")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(code))
    return src.posts(spark, sf).select("id_str", url_decode(escaped).alias("text"))


# --- tokens -----------------------------------------------------------------


@query
def tokens_tweet(spark, sf):
    pages = spread(src.table(spark, sf, "pages"))
    return pages.select("page_id", *_tokens(tokenize(F.concat_ws(" ", "url", "html"))))


@query
def tokens_long(spark, sf):
    """Texts without white space: their tokens are as long as they are."""
    mark = F.when(F.col("doc_id") % 2 == 0, "-").otherwise(",")
    text = F.regexp_replace("text", F.lit(r"\s+"), mark)
    documents = spread(src.table(spark, sf, "documents"))
    return documents.select("doc_id", *_tokens(tokenize(text)))


@query
def tokens_multilang(spark, sf):
    posts = src.posts(spark, sf)
    return posts.select("id_str", *_tokens(tokenize("full_text", F.col("lang"))))


@query
def tokens_composite(spark, sf):
    posts = src.posts(spark, sf)
    return posts.select("id_str", *_tokens(clean_and_tokenize("full_text")))


def _decorated(c) -> Column:
    """Turn the junk marks of the documents into emojis, tags and links."""
    text = F.col(c)
    for mark, other in (("%%%", " 😀"), ("###", " #tag"), ("&&&", " http://a.b/c"), ("$$$", "👍🏽"), (",", " :")):
        text = F.replace(text, F.lit(mark), F.lit(other))
    return text


@query
def tokens_emoji_split(spark, sf):
    return src.posts(spark, sf).select("id_str", *_tokens(split_emojis(_decorated("full_text"))))


@query
def token_filter(spark, sf):
    tokens = F.split(_decorated("full_text"), " ")
    kept = filter_tokens(tokens, urls=True, emojis=True, hashtags=True)
    return src.posts(spark, sf).select("id_str", *_tokens(kept))


@query
def stopword_filter(spark, sf):
    kept = filter_tokens(tokenize("full_text"), src.STOPWORDS)
    return src.posts(spark, sf).select("id_str", *_tokens(kept))


def _token_rows(spark, sf):
    return src.posts(spark, sf).select("id_str", F.explode(tokenize("full_text")).alias("token"))


@query
def stopword_anti(spark, sf):
    """Tokens that are no benchmark word, counted."""
    kept = joins.without_stopwords(_token_rows(spark, sf), src.benchmark_words(spark, sf))
    return kept.groupBy("token").agg(F.count("*").alias("n"))


@query
def stopword_anti_salted(spark, sf):
    kept = joins.without_stopwords(
        _token_rows(spark, sf), src.benchmark_words(spark, sf), max_rows=0
    )
    return kept.groupBy("token").agg(F.count("*").alias("n"))


@query
def stopwords_large(spark, sf):
    """Tokens of the documents that are no token of any page."""
    pages = src.table(spark, sf, "pages")
    words = pages.select(F.explode(tokenize(F.concat_ws(" ", "url", "html"))).alias("word"))
    kept = without_listed(_tokenized(spark, sf), words.distinct())
    return kept.select("id_str", *_tokens(F.col("tokens")))


def _tokenized(spark, sf):
    return src.posts(spark, sf).select("id_str", tokenize("full_text").alias("tokens"))


@query
def token_map(spark, sf):
    mapped = with_mapped_tokens(_tokenized(spark, sf), src.stems(spark, sf))
    return mapped.select("id_str", *_tokens(F.col("tokens")))


@query
def token_map_joined(spark, sf):
    mapped = with_mapped_tokens(
        _tokenized(spark, sf), src.stems(spark, sf), max_literal=0, max_rows=0
    )
    return mapped.select("id_str", *_tokens(F.col("tokens")))


def _words_of(spark, sf, lang: str) -> DataFrame:
    posts = src.posts(spark, sf).where(F.col("lang") == lang)
    return posts.select(F.explode(tokenize("full_text", lang)).alias("word"))


@query
def stem_en(spark, sf):
    return word_stems(_words_of(spark, sf, "en"), "en")


@query
def stem_es(spark, sf):
    return word_stems(_words_of(spark, sf, "es"), "es")


@query
def stem_posts(spark, sf):
    """The chain with stems made of the posts' own words."""
    options = PreprocessOptions(choices=("lowercase", "stopwords", "stemmed"), stopwords=src.STOPWORDS)
    tokens = preprocess_tokens(src.posts(spark, sf), options)
    return tokens.select("id_str", *_tokens(F.col("tokens")))


@query
def lemmatize_rules(spark, sf):
    """Words of the documents that some rule takes to a word of the pages."""
    words = src.posts(spark, sf).select(F.explode(tokenize("full_text")).alias("word"))
    lemmas = lemma_table(words, src.page_words(spark, sf), classes=("n", "v", "a"))
    return lemmas.select(F.col("synonym").alias("word"), F.col("head").alias("lemma"))


@query
def token_map_excl(spark, sf):
    """Lemmas with exclusions, and the stop words taken out once more afterwards."""
    options = PreprocessOptions(
        choices=("lowercase", "stopwords", "lemmatize"),
        stopwords=[*src.STOPWORDS, "ther", "thin"],
        lemma_tokens=src.stems(spark, sf),
        lemma_exclusions=("hein", "therble", "thin"),
    )
    tokens = preprocess_tokens(src.posts(spark, sf), options)
    return tokens.select("id_str", *_tokens(F.col("tokens")))


# --- preprocessing ----------------------------------------------------------


@query
def preprocess_default(spark, sf):
    return preprocess(src.posts(spark, sf), JOB).select("id_str", "preprocessed_text")


@query
def preprocess_synonyms(spark, sf):
    options = PreprocessOptions(choices=("punctuation",), synonyms=src.PHRASES)
    return preprocess(src.posts(spark, sf), options).select("id_str", "preprocessed_text")


@query
def preprocessed_output_q(spark, sf):
    """Written as JSON lines and read back."""
    rows = preprocessed_output(preprocess(src.posts(spark, sf), JOB))
    path = write_json(rows, scratch_path(spark, "preprocessed"))
    schema = "id_str string, full_text string, preprocessed_text string"
    return read_raw(spark, path, schema=schema).select(
        "id_str", F.md5("full_text").alias("text_md5"), "preprocessed_text"
    )


# --- co-occurrence ----------------------------------------------------------


@query
def cooccurrence_q(spark, sf):
    return topic_cooccurrence(src.posts(spark, sf), TOPICS, PLAIN)


@query
def cooccurrence_joined(spark, sf):
    """The topics as a table, joined with salted keys."""
    rows = [(t, w, i) for i, (t, w) in enumerate(TopicSet.of(TOPICS).entries)]
    topics = spark.createDataFrame(rows, "topic string, word string, idx long")
    tokens = with_job_tokens(src.posts(spark, sf), PLAIN)
    return cooccurrence(tokens, topics, join_bounds={"max_rows": 0})


@query
def cooccurrence_many_topics(spark, sf):
    """Every benchmark text is a topic, so the vocabulary has hundreds of words."""
    documents = src.table(spark, sf, "benchmark").select(
        "item_id",
        F.to_json(
            F.array(
                F.struct(
                    F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("topic"),
                    tokenize(remove_punctuation(clean_text("text"))).alias("words"),
                )
            )
        ).alias("value"),
    )
    topics = parse_topics(documents, order="item_id")
    return topic_cooccurrence(
        src.posts(spark, sf), topics, JOB, interval="overall", count_filter=100
    )


def _by(interval: str, count_filter: int = 25) -> Query:
    def run(spark, sf):
        return topic_cooccurrence(
            src.posts(spark, sf), TOPICS, JOB, interval=interval, count_filter=count_filter
        )

    return run


for _interval in ("daily", "weekly", "monthly", "yearly", "overall"):
    QUERIES[f"cooccur_{_interval}"] = _by(_interval)


@query
def cooccur_week_starts(spark, sf):
    return topic_cooccurrence(
        src.posts(spark, sf), TOPICS, JOB, interval="weekly", year_qualified=True
    )


@query
def cooccur_sorted(spark, sf):
    return sort_counts(_by("weekly")(spark, sf))


@query
def cooccur_csv(spark, sf):
    """Weekly counts written as CSV in order and read back."""
    path = write_csv(sort_counts(_by("weekly")(spark, sf)), scratch_path(spark, "counts"))
    return read_raw(spark, path).select(
        F.col("interval").cast("int"), "topic", "word", F.col("count").cast("bigint")
    )


@query
def saturating_words_q(spark, sf):
    counts = _by("overall")(spark, sf)
    return saturating_words(counts, len(TOPICS), count_share=0.10)


@query
def run_summary_q(spark, sf):
    return record_counts(src.posts(spark, sf))


# --- series -----------------------------------------------------------------

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query
def series_pivot(spark, sf):
    return series.pivot_series(src.event_series(spark, sf), EVENT_TYPES)


@query
def series_unpivot(spark, sf):
    wide = series.pivot_series(src.event_series(spark, sf), EVENT_TYPES)
    return series.unpivot_series(wide, EVENT_TYPES)


@query
def series_gapfill(spark, sf):
    return series.fill_missing_days(src.order_series(spark, sf))


def _without_low(df: DataFrame) -> DataFrame:
    """The series with the lowest priority unnamed."""
    return df.withColumn("topic", F.when(F.col("topic") != "5-LOW", F.col("topic")))


@query
def series_gapfill_null(spark, sf):
    return series.fill_missing_days(_without_low(src.order_series(spark, sf)))


@query
def series_rollup_null(spark, sf):
    """Priorities rolled up by urgency; some are in no category, one has no name."""
    mapping = spark.createDataFrame(
        [("1-URGENT", "soon"), ("2-HIGH", "soon"), ("3-MEDIUM", "later")], "topic string, category string"
    )
    return series.roll_up(_without_low(src.order_series(spark, sf)), mapping)


@query
def series_diff_null(spark, sf):
    """The series against itself with the urgent orders left out."""
    orders = _without_low(src.order_series(spark, sf))
    others = orders.where(~F.col("topic").eqNullSafe("1-URGENT"))
    return series.diff_series(orders, others)


@query
def series_gapfill_wide(spark, sf):
    orders = src.order_series(spark, sf)
    topics = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = series.fill_missing_days_wide(series.pivot_series(orders, topics))
    return wide.select(
        "Date", *[F.col(f"`{t}`").alias(t[2:].lower().replace(" ", "_")) for t in topics]
    )


@query
def series_tumbling5(spark, sf):
    return series.tumbling_sum(src.order_series(spark, sf), 5)


@query
def series_weekly(spark, sf):
    return series.weekly_sum(src.order_series(spark, sf))


@query
def series_rollup(spark, sf):
    """Orders per customer nation and day, rolled up to regions."""
    orders, customers = (src.table(spark, sf, t) for t in ("orders", "customer"))
    nations, regions = (src.table(spark, sf, t) for t in ("nation", "region"))
    by_nation = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.col("c_nationkey").alias("topic"), F.col("o_orderdate").cast("date").alias("Date")
        )
        .agg(F.count("*").alias("count"))
    )
    mapping = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("topic"), F.col("r_name").alias("category")
    )
    return series.roll_up(by_nation, mapping)


@query
def series_union(spark, sf):
    """Order states and line states per day, with headers that drifted."""
    orders = (
        src.table(spark, sf, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("Date"))
        .pivot("o_orderstatus", ["P", "O", "F"])
        .agg(F.count(F.lit(1)))
    )
    lines = (
        src.table(spark, sf, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("Date"))
        .pivot("l_linestatus", ["F", "O"])
        .agg(F.count(F.lit(1)))
        .withColumnsRenamed({"F": "Finished", "O": "Opened"})
    )
    tables = [orders.withColumnsRenamed({"F": "Finish", "O": "Open"}), lines]
    stacked = series.union_series(tables, {"Finish": "Finished", "Open": "Opened"}, fill=0)
    return stacked.select("Date", "Finished", "Opened", F.col("P").alias("Pending"))


@query
def series_quarantine(spark, sf):
    """Event lines of which errors lack a field, sign-ups a valid date, views a number."""
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    events = src.table(spark, sf, "events").select(
        F.concat_ws(
            ",",
            F.when(kind == "signup", F.concat(F.lit("1540"), day)).otherwise(day),
            F.col("event_id").cast("string"),
            F.when(kind == "view", F.lit("")).when(kind == "purchase", F.lit("x")).when(
                kind != "error", F.col("user_id").cast("string")
            ),
        ).alias("value")
    )
    rows = series.parse_series_lines(events, ["event", "user"])
    user = F.col("user").cast("string").alias("user")
    return rows.select("value", _day_text("Date"), "event", user, "quarantined")


@query
def series_headers(spark, sf):
    """Event lines in one folder, in three layouts that their headers tell and in one without header."""
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    day = F.when(kind == "signup", F.concat(F.lit("1540"), day)).otherwise(day)
    user = F.when(kind == "view", F.lit("")).when(kind == "purchase", F.lit("x")).when(
        kind != "error", F.col("user_id").cast("string")
    )
    event = F.col("event_id").cast("string")
    layouts = {
        "Date,event,user": (day, event, user),
        "user,Date,event": (user, day, event),
        "Date,kind,User ID,event": (day, kind, user, event),
        "": (day, event, user),
    }
    folder = scratch_path(spark, "series")
    for k, (header, fields) in enumerate(layouts.items()):
        events = src.table(spark, sf, "events").where(F.col("event_id") % len(layouts) == k)
        # A single column, named by the header: a file of it begins with that line.
        lines = events.select(F.concat_ws(",", *fields).alias(header or "value"))
        lines.write.csv(f"{folder}/{k}", header=bool(header), sep="\t")
    rows = series.parse_series_files(read_lines(spark, folder), ["event", "user"], renames={"User ID": "user"})
    user = F.col("user").cast("string").alias("user")
    return rows.select("value", _day_text("Date"), "event", user, "quarantined", "reason")


@query
def series_diff(spark, sf):
    """Events against distinct users per type and day."""
    users = (
        src.table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("topic"), F.col("ts").cast("date").alias("Date"))
        .agg(F.count_distinct("user_id").alias("count"))
    )
    return series.diff_series(src.event_series(spark, sf), users)
