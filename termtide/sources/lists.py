"""Reading topics, dictionaries, stop words and source metadata."""

from __future__ import annotations


from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termtide.functions.lookup import MAX_LITERAL_ENTRIES

TOPIC_JSON = "array<struct<topic:string,words:array<string>>>"

# Always treated as stop words, whatever list is in use.
EXTRA_STOPWORDS = ("rt", "amp")

_STOPWORD_LANGUAGES = {"en": "english", "es": "spanish", "fr": "french"}


def bounded_dict(df: DataFrame, key: str, value: str, limit: int = MAX_LITERAL_ENTRIES):
    """The table as a ``dict``, or None when it has more than ``limit`` rows."""
    rows = df.select(key, value).limit(limit + 1).collect()
    return None if len(rows) > limit else {r[0]: r[1] for r in rows}


# --- dictionaries -----------------------------------------------------------


def parse_mapping(lines: DataFrame, line: str = "value", order: str | None = None) -> DataFrame:
    """``(synonym, head)`` rows from lines ``head,synonym,synonym,...``.

    Empty synonyms are skipped; a synonym listed twice takes the head of the last
    line.  ``order`` names the column that puts the lines in order.
    """
    at = F.col(order) if order else F.monotonically_increasing_id()
    parts = F.split(F.col(line), ",", -1)
    return (
        lines.select(at.alias("_line"), parts.alias("_parts"))
        .select(
            "_line",
            F.element_at("_parts", 1).alias("head"),
            F.posexplode(F.slice("_parts", 2, F.greatest(F.size("_parts") - 1, F.lit(0)))).alias(
                "_pos", "synonym"
            ),
        )
        .where(F.col("synonym") != "")
        .groupBy("synonym")
        .agg(F.max_by("head", F.struct("_line", "_pos")).alias("head"))
    )


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    return parse_mapping(spark.read.text(path))


# --- stop words -------------------------------------------------------------


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One-column table ``word``: the first word of every line, and the extras."""
    first = F.split(F.col("value"), " ")[0]
    listed = spark.read.text(path).select(first.alias("word")).where(F.col("word") != "")
    extras = spark.createDataFrame([(w,) for w in EXTRA_STOPWORDS], "word string")
    return listed.union(extras).distinct()


def default_stopwords(lang: str = "en") -> list[str]:
    """Spark's own list for the language, and the extras.

    Spark has no Arabic list; Arabic has the extras alone, and more from a file.
    """
    if lang == "ar":
        return list(EXTRA_STOPWORDS)
    language = _STOPWORD_LANGUAGES.get(lang, "english")
    return [*StopWordsRemover.loadDefaultStopWords(language), *EXTRA_STOPWORDS]


# --- topics -----------------------------------------------------------------


def parse_topics(documents: DataFrame, json: str = "value", order: str | None = None) -> DataFrame:
    """``(topic, word, idx)`` from JSON ``[{"topic": ..., "words": [...]}, ...]`` or one such object.

    Words are lower-cased.  ``idx`` puts all words of all topics in listing order: by
    the number of the document (``order``, not below zero), of the topic and of the word, ten digits each
    for the last two.  A word listed more than once stays with its first mention,
    because a word that has been matched is out of the running for everything after it.
    Malformed JSON raises.
    """
    parsed = F.from_json(F.col(json), TOPIC_JSON, {"mode": "FAILFAST"})
    topics = documents.select(
        (F.col(order) if order else F.lit(0)).cast("decimal(18,0)").alias("_doc"),
        F.posexplode(parsed).alias("_topic_pos", "_topic"),
    )
    ten = F.lit(10**10).cast("decimal(11,0)")
    place = (F.col("_doc") * ten + F.col("_topic_pos")).cast("decimal(28,0)") * ten
    words = topics.select(
        "_doc",
        "_topic_pos",
        F.col("_topic.topic").alias("topic"),
        F.posexplode("_topic.words").alias("_word_pos", "_word"),
    ).select(
        "topic",
        F.lower("_word").alias("word"),
        (place.cast("decimal(38,0)") + F.col("_word_pos")).cast("decimal(38,0)").alias("idx"),
    )
    return (
        words.where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.min(F.struct("idx", "topic")).alias("_first"))
        .select("_first.topic", "word", "_first.idx")
    )


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """Topics of all files of a path; files are in the order of their paths."""
    files = spark.read.text(path, wholetext=True).withColumn("_path", F.col("_metadata.file_path"))
    numbers = files.select("_path").distinct().select(
        "_path", (F.row_number().over(Window.orderBy("_path")) - 1).alias("_number")
    )
    return parse_topics(files.join(numbers, "_path"), order="_number")


def topics_from_json(spark: SparkSession, json: str) -> DataFrame:
    return parse_topics(spark.createDataFrame([(json,)], "value string"))


# --- source metadata --------------------------------------------------------


def read_source_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)
