"""Words that are frequent in most topics and so tell the topics apart badly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Share of the highest count, and share of the topics, to be reached.
COUNT_SHARE = 0.60
TOPIC_SHARE = 0.50


def saturating_words(
    counts: DataFrame,
    n_topics: int,
    count_share: float = COUNT_SHARE,
    topic_share: float = TOPIC_SHARE,
) -> DataFrame:
    """Words above a share of the highest count in at least a share of the topics.

    The cutoff is a scalar subquery, so this stays one plan.
    """
    cutoff = counts.select(F.floor(F.lit(count_share) * F.max("count"))).scalar()
    return (
        counts.where(F.col("count") > cutoff)
        .groupBy("word")
        .agg(F.count_distinct("topic").alias("n_topics"))
        .where(F.col("n_topics") >= topic_share * n_topics)
        .select("word")
    )
