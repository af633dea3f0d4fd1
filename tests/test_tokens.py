from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termtide.functions import (
    clean_and_tokenize,
    filter_tokens,
    join_tokens,
    split_emojis,
    tokenize,
)
from termtide.functions.tokens import EMOJI_OR_WORD

ONCE = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_post_tokens(column):
    text = "RT @Joe_1: don't #BLM-now! see https://t.co/Ab1. wait... well-known 10:30 a@b.org 😀 x"
    assert column([text, "", None], tokenize("c")) == [
        ["rt", "@joe_1", ":", "don't", "#blm-now", "!", "see", "https://t.co/ab1", ".", "wait",
         "...", "well-known", "10:30", "a@b.org", "😀", "x"],
        [],
        [],
    ]


def test_spanish_tokens_keep_case_and_inner_marks(column):
    assert column(["¿Qué tal, señor 3.5? Fin."], tokenize("c", "es")) == [
        ["¿", "Qué", "tal", ",", "señor", "3.5", "?", "Fin", "."]
    ]


def test_language_may_be_a_column(spark):
    rows = spark.createDataFrame([("es", "Sí. No"), ("en", "Yes. No"), (None, "A")], "l string, c string")
    got = [r[0] for r in rows.select(tokenize("c", F.col("l"))).collect()]
    assert got == [["Sí", ".", "No"], ["yes", ".", "no"], ["a"]]


def test_filter_tokens_keeps_order_and_duplicates(column):
    tokens = [["a", "a", "b", "", "'", ":", "::", "c"]]
    assert column(tokens, filter_tokens("c"), "array<string>") == [["a", "a", "b", "::", "c"]]
    assert column([["a", "a", "b"]], filter_tokens("c", ["b"]), "array<string>") == [["a", "a"]]


def test_filter_tokens_switches(column):
    tokens = [["http://x", "httpx", "#tag", "😀", "👍🏽", "🇫🇷", "1️⃣", "a😀", "word", "1"]]
    kinds = "array<string>"
    assert column(tokens, filter_tokens("c", urls=True), kinds)[0][:1] == ["#tag"]
    assert "#tag" not in column(tokens, filter_tokens("c", hashtags=True), kinds)[0]
    assert column(tokens, filter_tokens("c", emojis=True), kinds) == [
        ["http://x", "httpx", "#tag", "a😀", "word", "1"]
    ]


def test_split_emojis(column):
    assert column(["good😀morning 👩‍👩‍👧 x"], split_emojis("c")) == [
        ["good", "😀", "morning", "👩‍👩‍👧", "x"]
    ]


def test_clean_and_tokenize(column):
    assert column(["I CAN'T # stop: it's 5'", None], clean_and_tokenize("c")) == [
        ["i", "cannot", "#stop", "it", "is", "5"],
        [],
    ]


@ONCE
@given(st.lists(st.text(st.sampled_from("aB9é_.-+@#':/ \nhttps😀，"), max_size=40), min_size=1, max_size=30))
def test_tokenising_joined_tokens_changes_nothing(column, texts):
    for lang in ("en", "es"):
        tokens = tokenize("c", lang)
        once = column(texts, tokens)
        again = column(texts, tokenize(join_tokens(tokens), lang))
        assert once == again


@ONCE
@given(st.lists(st.text(st.sampled_from("a1#é \n ©®→↔😀👍🏽🇫🇷️⃣‍x中…"), max_size=30), min_size=1, max_size=30))
def test_quick_emoji_pattern_equals_the_portable_one(column, texts):
    portable = F.regexp_extract_all("c", F.lit(EMOJI_OR_WORD), F.lit(0))
    assert column(texts, split_emojis("c")) == column(texts, portable)


def test_tokens_of_a_hundred_thousand_parts(spark):
    """None of the patterns may recurse for every part of a token."""
    n = 100_000
    shapes = {
        "en": ["1" + ",1" * n, "a" + "-a" * n, "x@a" + ".b" * n, "#" + "a-" * n + "a"],
        "es": ["a" + ".b" * n],
        "emoji": ["\U0001F468" + "\u200d\U0001F468" * n],
    }
    for kind, texts in shapes.items():
        df = spark.createDataFrame([(t,) for t in texts], "c string")
        tokens = split_emojis("c") if kind == "emoji" else tokenize("c", kind)
        assert [r[0] for r in df.select(F.size(tokens)).collect()] == [1] * len(texts)
    df = spark.createDataFrame([(shapes["emoji"][0],)], "c string")
    assert df.select(F.size(filter_tokens(F.array("c"), emojis=True))).first()[0] == 0


def test_white_space_of_any_script_separates(column):
    for space in "\u00a0\u2003\u3000\u1680\u0085\u202f\x1c":
        text = f"foo{space}bar!{space}http://a.b/c{space}next"
        assert column([text], tokenize("c")) == [["foo", "bar", "!", "http://a.b/c", "next"]]
        assert column([f"uno{space}dos,{space}tres"], tokenize("c", "es")) == [["uno", "dos", ",", "tres"]]
        assert column([f"a{space}b\U0001F600c"], split_emojis("c")) == [["a", "b", "\U0001F600", "c"]]
