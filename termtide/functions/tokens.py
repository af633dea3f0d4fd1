"""Tokenisers and token filters as native array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from termtide.functions.lookup import member_of
from termtide.functions.text import (
    SPACE,
    _col,
    clean_text,
    expand_contractions,
    remove_punctuation,
)

_WORD = r"[\p{L}\p{M}\p{N}_]"
_LETTER = r"[\p{L}\p{M}]"


def _post_token(more: str) -> str:
    """What counts as one token of a post, most specific form first.

    No alternative looks ahead, looks behind or crosses white space, so tokenising the
    tokens joined by spaces gives the same tokens again.  ``more`` repeats a group.
    """
    return "|".join(
        [
            rf"https?://[^{SPACE}]*[\p{{L}}\p{{N}}/]",  # URL
            rf"[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+){more}",  # mail address
            rf"@{_WORD}+",  # handle
            rf"#+{_WORD}(?:[{_WORD[1:-1]}'-]*{_WORD})?",  # hashtag
            rf"{_LETTER}+(?:['_-]+{_LETTER}+){more}",  # word with inner ' - _
            rf"[+-]?\p{{N}}+(?:[,/.:-]\p{{N}}+){more}",  # number, date, time
            rf"{_WORD}+",  # plain word
            r"\.{2,}",  # ellipsis
            rf"[^{SPACE}]",  # any other character
        ]
    )


# Java takes a repeated group for a recursion unless it is possessive, and a token of some thousand
# parts would exhaust its stack.  Nothing follows these groups, so the matches are the same.
POST_TOKEN, _POST_TOKEN_JAVA = _post_token("+"), _post_token("++")

# A text of nothing but letters, digits and white space needs no pattern: its
# tokens are what white space separates.
_NOT_PLAIN = rf"[^\p{{L}}\p{{M}}\p{{N}}{SPACE}]"

# Spanish: words keep their inner dots and commas, brackets and marks stand alone.
_ES_MARK = rf"{SPACE}!\"$%&'(),.:;?\[\]{{|}}~¡¿«»‘’“”°…"


def _spanish_token(more: str) -> str:
    return "|".join(
        [
            rf"https?://[^{SPACE}]*[\p{{L}}\p{{N}}/]",
            r"\.{2,}|,{2,}|-{2,}",
            rf"[^{_ES_MARK}]+(?:[.,:][^{_ES_MARK}]+){more}",
            rf"[^{SPACE}]",
        ]
    )


SPANISH_TOKEN, _SPANISH_TOKEN_JAVA = _spanish_token("*"), _spanish_token("*+")

# Code points that Unicode lists as emoji, and the marks that join
# or colour them.
_EMOJI_BASE = (
    r"\x{00A9}\x{00AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}\x{21AA}"
    r"\x{231A}\x{231B}\x{2328}\x{23CF}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{24C2}"
    r"\x{25AA}\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2600}-\x{2604}\x{260E}\x{2611}"
    r"\x{2614}\x{2615}\x{2618}\x{261D}\x{2620}\x{2622}\x{2623}\x{2626}\x{262A}\x{262E}"
    r"\x{262F}\x{2638}-\x{263A}\x{2640}\x{2642}\x{2648}-\x{2653}\x{265F}\x{2660}\x{2663}"
    r"\x{2665}\x{2666}\x{2668}\x{267B}\x{267E}\x{267F}\x{2692}-\x{2697}\x{2699}\x{269B}"
    r"\x{269C}\x{26A0}\x{26A1}\x{26A7}\x{26AA}\x{26AB}\x{26B0}\x{26B1}\x{26BD}\x{26BE}"
    r"\x{26C4}\x{26C5}\x{26C8}\x{26CE}\x{26CF}\x{26D1}\x{26D3}\x{26D4}\x{26E9}\x{26EA}"
    r"\x{26F0}-\x{26F5}\x{26F7}-\x{26FA}\x{26FD}\x{2702}\x{2705}\x{2708}-\x{270D}\x{270F}"
    r"\x{2712}\x{2714}\x{2716}\x{271D}\x{2721}\x{2728}\x{2733}\x{2734}\x{2744}\x{2747}"
    r"\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2763}\x{2764}\x{2795}-\x{2797}\x{27A1}"
    r"\x{27B0}\x{27BF}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}"
    r"\x{3030}\x{303D}\x{3297}\x{3299}\x{1F004}\x{1F0CF}\x{1F170}\x{1F171}\x{1F17E}"
    r"\x{1F17F}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F1E6}-\x{1F1FF}\x{1F201}\x{1F202}\x{1F21A}"
    r"\x{1F22F}\x{1F232}-\x{1F23A}\x{1F250}\x{1F251}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}"
    r"\x{1F7E0}-\x{1F7EB}\x{1F90C}-\x{1F9FF}\x{1FA70}-\x{1FAFF}"
)
_EMOJI_MARK = r"\x{FE0F}\x{20E3}\x{1F3FB}-\x{1F3FF}\x{E0020}-\x{E007F}"



def _emoji(more: str) -> str:
    return (
        r"(?:[0-9#*]\x{FE0F}?\x{20E3}"
        r"|[\x{1F1E6}-\x{1F1FF}]{2}"
        rf"|[{_EMOJI_BASE}][{_EMOJI_MARK}]*(?:\x{{200D}}[{_EMOJI_BASE}][{_EMOJI_MARK}]*){more})"
    )


EMOJI, _EMOJI_JAVA = _emoji("*"), _emoji("*+")
EMOJI_OR_WORD = rf"{EMOJI}|[^{SPACE}{_EMOJI_BASE}]+"

# The same for Java, which goes through a class from left to right: the ranges below
# the first emojis settle most characters at once.
_EMOJI_OR_WORD_FAST = (
    rf"{_EMOJI_JAVA}|[\x21-\x{{84}}\x{{86}}-\x{{9F}}\x{{A1}}-\x{{A8}}\x{{AA}}-\x{{AD}}\x{{AF}}-\x{{167F}}"
    rf"[^{SPACE}{_EMOJI_BASE}]]+"
)


# Tokens that are never wanted.
_STRAY = ("", "'", ":")


def _tokenize_post(c: Column) -> Column:
    text = F.lower(c)
    return F.when(
        F.regexp_like(text, F.lit(_NOT_PLAIN)),
        F.regexp_extract_all(text, F.lit(_POST_TOKEN_JAVA), F.lit(0)),
    ).otherwise(F.array_remove(F.split(text, f"[{SPACE}]+"), ""))


def _tokenize_spanish(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(_SPANISH_TOKEN_JAVA), F.lit(0))


def tokenize(c: Column | str, lang: Column | str = "en") -> Column:
    """Tokens of a text, in order; NULL and empty texts have none.

    ``lang`` is one language for the whole table, or a column of languages.
    Spanish has a tokeniser of its own, every other language uses the one for
    posts, which lower-cases.
    """
    text = _col(c)
    if isinstance(lang, str):
        tokens = _tokenize_spanish(text) if lang == "es" else _tokenize_post(text)
    else:
        tokens = F.when(lang == "es", _tokenize_spanish(text)).otherwise(_tokenize_post(text))
    return F.coalesce(tokens, F.array().cast("array<string>"))


def filter_tokens(
    tokens: Column | str,
    stopwords: Sequence[str] = (),
    urls: bool = False,
    emojis: bool = False,
    hashtags: bool = False,
) -> Column:
    """Drop empty tokens and stray ``'`` and ``:``, then whatever is switched on.

    Order and duplicates of the remaining tokens are kept.
    """
    if not (stopwords or urls or emojis or hashtags):
        kept = _col(tokens)
        for stray in _STRAY:
            kept = F.array_remove(kept, stray)
        return kept
    is_stopword = member_of(stopwords)

    def keep(token: Column) -> Column:
        kept = ~token.isin(*_STRAY)
        if stopwords:
            kept = kept & ~is_stopword(token)
        if urls:
            kept = kept & ~token.startswith("http")
        if emojis:
            # As many bytes as characters: plain ASCII, which is never an emoji.
            plain = F.octet_length(token) == F.length(token)
            kept = kept & (plain | (F.regexp_replace(token, _EMOJI_JAVA, "") != ""))
        if hashtags:
            kept = kept & ~token.startswith("#")
        return kept

    return F.filter(_col(tokens), keep)


def join_tokens(tokens: Column | str) -> Column:
    return F.array_join(_col(tokens), " ")


def clean_and_tokenize(c: Column | str) -> Column:
    """Lower-case, clean, write out contractions, strip punctuation, tokenise."""
    text = clean_text(F.lower(F.coalesce(_col(c), F.lit(""))))
    text = remove_punctuation(expand_contractions(text))
    return filter_tokens(tokenize(text))


def split_emojis(c: Column | str) -> Column:
    """Split at white space and around every emoji."""
    return F.coalesce(
        F.regexp_extract_all(_col(c), F.lit(_EMOJI_OR_WORD_FAST), F.lit(0)),
        F.array().cast("array<string>"),
    )
