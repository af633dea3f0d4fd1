"""Raw collections as Spark derives them from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.functions.tokens import tokenize
from termtide.operators.phrases import RUN
from termtide.session import configure

TOPICS = [
    {"topic": "alpha", "words": ["rewh", "thatin"]},
    {"topic": "beta", "words": ["orre", "ing"]},
    {"topic": "gamma", "words": ["The", "ononst"]},
]

# Frequent words of the four languages, in the role of a stop-word list.
STOPWORDS = (
    "the of and to in a is that it for was on with be as by this are at from "
    "der die und den das von mit le la les des et un en que el los por rt amp"
).split()

PHRASES = {
    "the": "THE",
    "of the": "OFTHE",
    "in the": "INTHE",
    "that": "which",
    "rewh": "re wh",
    "la elle": "LAELLE",
}

NEWS_REGIONS = ["AFRICA", "ASIA"]
CONCEPTS = ["fr", "src3"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The test tables are one small file each: give every core a part of it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df.rdd.getNumPartitions() < cores and len(df.inputFiles()) == 1
    return df.repartition(cores) if few else df


def _day(number) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col(number) % 60).cast("int"))


def _moment(number) -> Column:
    return F.timestamp_seconds(
        F.lit(1704067200) + (F.col(number) % 60) * 86400 + (F.col(number) % 24) * 3600
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as canonical posts."""
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("string").alias("id_str"),
        F.col("text").alias("full_text"),
        _day("doc_id").alias("date"),
        _moment("doc_id").alias("timestamp"),
        "lang",
        F.col("source").alias("handle"),
    )


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the raw shapes of a social network, mixed."""
    n = F.col("doc_id")
    moment = _moment("doc_id")
    return spread(table(spark, sf_dir, "documents")).select(
        n.alias("id"),
        F.when(n % 3 != 0, F.concat(F.lit("t"), n.cast("string"))).alias("id_str"),
        F.when(n % 4 == 0, F.col("text")).alias("full_text"),
        F.when(n % 4 == 1, F.col("text")).alias("text"),
        F.when(n % 4 == 2, F.col("text")).alias("tweet"),
        F.when(n % 4 != 2, F.concat(F.lit("body of "), "text")).alias("body"),
        F.when(n % 5 == 0, F.lit("junk"))
        .when(n % 2 == 0, F.date_format(moment, "yyyy-MM-dd HH:mm:ss 'UTC'"))
        .otherwise(F.date_format(moment, "EEE MMM dd HH:mm:ss '+0000' yyyy"))
        .alias("created_at"),
        F.when(n % 7 == 0, F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'.000Z'")).alias(
            "postedTime"
        ),
        F.when(n % 3 == 0, F.col("lang")).alias("lang"),
        F.when(n % 3 == 1, F.col("lang")).alias("language"),
        F.when(n % 2 == 0, F.concat(F.lit("x-"), "lang")).alias("twitter_lang"),
        F.struct(
            F.when(n % 4 == 0, F.col("source")).alias("screen_name"),
            F.when(n % 4 == 1, F.upper("source")).alias("name"),
        ).alias("user"),
        F.struct(F.when(n % 4 == 2, F.col("source")).alias("preferredUsername")).alias("actor"),
        F.concat(F.lit("u_"), "source").alias("username"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as tweets, retweets and quotes."""
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id_str"),
        F.col("text").alias("full_text"),
        F.when(
            F.col("role") == "assistant", F.struct(F.col("conv_id").cast("string").alias("id_str"))
        ).alias("retweeted_status"),
        F.when(F.col("role") != "system", F.col("turn") > 2).alias("is_quote_status"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news articles with concepts."""
    concept = lambda c: F.struct(F.struct(F.col(c).alias("eng")).alias("label"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("art-"), F.col("doc_id").cast("string")).alias("uri"),
        F.col("text").alias("body"),
        _day("doc_id").cast("string").alias("date"),
        F.struct(F.col("source").alias("uri")).alias("source"),
        F.array(concept("lang"), concept("source")).alias("concepts"),
    )


def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the census data of news sources."""
    nation, region = (table(spark, sf_dir, t) for t in ("nation", "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("Source URL"),
        F.col("r_name").alias("Region (Census)"),
        F.concat(F.lit("division "), F.col("r_regionkey").cast("string")).alias(
            "Division (Census)"
        ),
        F.col("n_name").alias("State"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("id"),
        F.col("text").alias("body"),
        F.unix_seconds(_moment("doc_id")).alias("created_utc"),
    )


def broadcasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as television transcripts."""
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("guid"),
        F.col("text").alias("body"),
        F.date_format(_moment("conv_id"), "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.col("role").alias("outlet"),
    )


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("topic"), F.col("ts").cast("date").alias("Date"))
        .agg(F.count("*").alias("count"))
    )


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per priority and day."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("topic"),
            F.col("o_orderdate").cast("date").alias("Date"),
        )
        .agg(F.count("*").alias("count"))
    )


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct tokens of the benchmark texts."""
    return (
        table(spark, sf_dir, "benchmark").select(F.explode(tokenize("text")).alias("word")).distinct()
    )


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words with their first four characters as stem."""
    return benchmark_words(spark, sf_dir).select(
        F.col("word").alias("synonym"), F.substring("word", 1, 4).alias("head")
    )


def page_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every two words of the pages with one space between, and the same with an underscore."""
    runs = F.regexp_extract_all(F.lower(F.concat_ws(" ", "url", "html")), F.lit(RUN), F.lit(0))
    pages = spread(table(spark, sf_dir, "pages")).select(runs.alias("runs"))
    places = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size("runs") - 2, F.lit(1))),
        lambda i: (F.get("runs", i) == " ") & F.get("runs", i + 1).isNotNull(),
    )
    pair = F.transform(places, lambda i: F.concat_ws(" ", F.get("runs", i - 1), F.get("runs", i + 1)))
    # Words hold no space, so the pair tells its words; distinct by it alone, it meets the phrases without moving again.
    return pages.select(F.explode(pair).alias("synonym")).distinct().select(
        "synonym", F.translate("synonym", " ", "_").alias("head")
    )


def page_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct tokens of the pages."""
    text = F.concat_ws(" ", "url", "html")
    return spread(table(spark, sf_dir, "pages")).select(F.explode(tokenize(text)).alias("word")).distinct()
