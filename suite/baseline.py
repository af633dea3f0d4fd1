"""The daily job as row-at-a-time Python functions, to measure against.

Also the plain statement of what counts as a co-occurrence, which the tests use.
"""

from __future__ import annotations

from collections import Counter

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import inputs
from termtide.functions.contractions import CONTRACTIONS
from termtide.functions.text import PUNCTUATION_OUTSIDE_URLS
from termtide.functions.tokens import POST_TOKEN


def _for_python(pattern: str) -> str:
    """Code points written as Python writes them."""
    return regex.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", pattern)


def emitted(tokens: list[str], topics: list[dict]) -> Counter:
    """How often each ``(topic, word)`` co-occurs in one post.

    The topic words are called out in listing order.  One that is in the bag leaves
    it for good, and its topic is credited with everything still inside.
    """
    bag, credit = Counter(tokens), Counter()
    for name, called in ((t["topic"], w) for t in topics for w in t["words"]):
        if bag.pop(called, 0):
            credit.update({(name, other): n for other, n in bag.items()})
    return credit


def cooccur_daily_in_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = regex.compile(_for_python(POST_TOKEN))
    marks = regex.compile(_for_python(PUNCTUATION_OUTSIDE_URLS))
    short = regex.compile(r"\b(?:" + "|".join(CONTRACTIONS) + r")\b")
    stopwords = list(inputs.STOPWORDS)
    topics = [
        {"topic": t["topic"], "words": [w.lower() for w in t["words"]]} for t in inputs.TOPICS
    ]

    @F.udf("string")
    def cleaned(text):
        text = (text or "").lower().replace("# ", "#").replace("\n", " ")
        text = short.sub(lambda m: CONTRACTIONS[m.group()], text)
        text = marks.sub(lambda m: m.group(1) or "", text)
        return " ".join(t for t in token.findall(text) if t not in stopwords)

    @F.udf("array<string>")
    def tokenized(text):
        return token.findall(text.lower())

    @F.udf("array<struct<topic:string,word:string,n:int>>")
    def hits(tokens):
        return [(topic, word, n) for (topic, word), n in emitted(tokens, topics).items()]

    return (
        inputs.posts(spark, sf_dir)
        .withColumn("_pairs", hits(tokenized(cleaned("full_text"))))
        .select("date", F.explode("_pairs").alias("_pair"))
        .where(F.length("_pair.word") > 2)
        .groupBy(F.col("date").alias("interval"), "_pair.topic", "_pair.word")
        .agg(F.sum("_pair.n").alias("count"))
        .where(F.col("count") > 25)
    )
