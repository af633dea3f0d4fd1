from __future__ import annotations

import re
from urllib.parse import unquote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termtide.functions import (
    CONTRACTIONS,
    clean_text,
    expand_contractions,
    literal_map,
    lower_text,
    member_of,
    remove_punctuation,
    replace_phrases,
    url_decode,
)
from termtide.functions.lookup import MAX_LITERAL_ENTRIES

ONCE = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_lower_text_leaves_arabic_alone(column):
    assert column(["AbC"], lower_text("c")) == ["abc"]
    assert column(["AbC"], lower_text("c", "ar")) == ["AbC"]


def test_clean_text(column):
    assert column(["# blm\nnow", None], clean_text("c")) == ["#blm now", None]


def test_remove_punctuation_keeps_urls_handles_and_tags(column):
    text = "It's #blm, @joe! see https://t.co/e626KBczSM. $5 a_b"
    kept = "Its #blm @joe see https://t.co/e626KBczSM. 5 ab"
    assert column([text, "«¡Hola!» 5€"], remove_punctuation("c")) == [kept, "Hola 5"]


def test_remove_punctuation_everywhere_keeps_apostrophes(column):
    text = "It's #blm, @joe! see https://t.co/x."
    assert column([text], remove_punctuation("c", keep_urls=False)) == [
        "It's #blm @joe see httpstcox"
    ]


def test_url_decode_matches_the_usual_rules(column):
    texts = ["a%20b", "caf%C3%A9 100%", "1+1", "%E2%82%ACx%zz", "", "%ff|", "é%C3%A9"]
    assert column(texts, url_decode("c")) == [unquote(t) for t in texts]


def test_contractions(column):
    cases = {
        "i can't've": "i cannot've",
        "i won't, they're": "i will not, they are",
        "don't've": "do not've",
        "you'll've": "you will've",
        "'cause x'cause": "'cause xbecause",
        "joe's it's": "joe's it is",
        "no apostrophe": "no apostrophe",
    }
    assert column(list(cases), expand_contractions("c")) == list(cases.values())
    assert column(["joe's it's"], expand_contractions("c", True)) == ["joe it is"]


def test_every_contraction_equals_a_single_regex_pass(column):
    pattern = re.compile(r"\b(" + "|".join(CONTRACTIONS) + r")\b")
    texts = [f"x {k} y" for k in CONTRACTIONS] + ["x" + k for k in CONTRACTIONS]
    expected = [pattern.sub(lambda m: CONTRACTIONS[m.group()], t) for t in texts]
    assert column(texts, expand_contractions("c")) == expected


def test_longest_phrase_wins(column):
    mapping = {"barack obama": "obama", "barack": "obama"}
    text = ["the president, barack obama", "Barack barackx barack"]
    assert column(text, replace_phrases("c", mapping)) == [
        "the president, obama",
        "Barack barackx obama",
    ]


def test_phrases_are_taken_literally_and_once(column):
    mapping = {"a.c": "x", "b": "a.c", "é": "e", "": "never"}
    assert column(["a.c abc b éa é"], replace_phrases("c", mapping)) == ["x abc a.c éa e"]
    assert column(["same"], replace_phrases("c", {})) == ["same"]


@ONCE
@given(
    st.lists(st.text("ab' c", min_size=1, max_size=5), min_size=1, max_size=12, unique=True),
    st.lists(st.text("ab' c", max_size=30), min_size=1, max_size=20),
    st.booleans(),
)
def test_replace_phrases_equals_one_regex_pass(column, keys, texts, longest_first):
    mapping = {k: f"<{i}>" for i, k in enumerate(keys)}
    ordered = sorted(keys, key=len, reverse=True) if longest_first else keys
    pattern = re.compile(r"\b(?:" + "|".join(map(re.escape, ordered)) + r")\b")
    expected = [pattern.sub(lambda m: mapping[m.group()], t) for t in texts]
    assert column(texts, replace_phrases("c", mapping, longest_first)) == expected


def test_literal_map_finds_every_key(column):
    mapping = {f"k{i}é": f"v{i}" for i in range(500)}
    keys = [*mapping, "absent", None]
    assert column(keys, literal_map(mapping)(F.col("c"))) == [*mapping.values(), None, None]
    assert column(["a"], literal_map({})(F.col("c"))) == [None]


def test_literal_map_is_bounded():
    with pytest.raises(ValueError):
        literal_map({str(i): "" for i in range(MAX_LITERAL_ENTRIES + 1)})


def test_member_of_long_lists(column):
    words = [f"w{i}" for i in range(1500)]
    assert column(["w0", "w1499", "x"], member_of(words)(F.col("c"))) == [True, True, False]
