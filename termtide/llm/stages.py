"""The stages of the corpus pipeline: each takes documents and, but for the last, returns documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm import language, private
from termtide.llm.common import prepare
from termtide.llm.mixing import mixed
from termtide.llm.near_copies import first_of_classes
from termtide.llm.packing import pack_documents


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, whatever was learnt; null texts and those without a letter go."""
    prepare(spark)
    found = language.identify(docs, language.learn(docs), docs.columns)
    return found.where("has_letter").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    prepare(spark)
    return first_of_classes(docs)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    prepare(spark)
    return private.redacted(docs, private.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut if most of it is taken."""
    prepare(spark)
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    prepare(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
