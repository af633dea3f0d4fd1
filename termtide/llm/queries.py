"""The queries of the operators on training text, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm import hard_negatives, mixing, neighbours, prefix_trie, private
from termtide.llm.common import table
from termtide.llm.fingerprints import fingerprint_neighbours
from termtide.llm.language import held_out, identify, learn
from termtide.llm.mixing import mix_plan
from termtide.llm.near_copies import near_copies
from termtide.llm.neighbours import nearest
from termtide.llm.packing import pack_documents
from termtide.llm.sharding import shard
from termtide.llm.simhash import simhash_copies
from termtide.llm.suffix_index import remove_repeats
from termtide.llm.token_files import read_token_files, write_token_files


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer)


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs), ["doc_id"])
    doc_id = F.col("row.doc_id")
    return found.select(doc_id, held_out(doc_id).alias("held_out"), "lang_pred", "score")


def op6_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return private.find_private(docs, private.learn(docs))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), tokenizer))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_copies(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_repeats": op1_suffix_repeats,
    "op2_packing": op2_packing,
    "op3_near_copies": op3_near_copies,
    "op4_mixing": op4_mixing,
    "op5_language": op5_language,
    "op6_private": op6_private,
    "op7_sharding": op7_sharding,
    "op8_nearest": op8_nearest,
    "op9_token_files": op9_token_files,
    "op10_fingerprints": op10_fingerprints,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_simhash": op12_simhash,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op4_mixing": mixing.ORACLE,
    "op8_nearest": neighbours.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
