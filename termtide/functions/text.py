"""Text clean-up as native string columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from termtide.functions.contractions import CONTRACTIONS
from termtide.functions.lookup import literal_map

# What Unicode counts as white space, for the inside of a class; ``\s`` means ASCII only.
SPACE = (
    r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Everything matched by the first group survives the removal of punctuation.
# No look-around, so the same patterns run on any RE2-style engine.
PUNCTUATION_OUTSIDE_URLS = rf"(https?://[^{SPACE}]*|[@#])|[\p{{P}}\p{{S}}]"
PUNCTUATION_EVERYWHERE = r"([@#'])|[\p{P}\p{S}]"

PERCENT_RUN = r"(?:%[0-9A-Fa-f]{2})+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_text(c: Column | str, lang: str = "en") -> Column:
    """Lower-case, except for Arabic, which has no capital letters."""
    return _col(c) if lang == "ar" else F.lower(_col(c))


def clean_text(c: Column | str) -> Column:
    """Close up ``"# tag"`` to ``"#tag"`` and turn line breaks into spaces."""
    closed = F.replace(_col(c), F.lit("# "), F.lit("#"))
    return F.replace(closed, F.lit("\n"), F.lit(" "))


def remove_punctuation(c: Column | str, keep_urls: bool = True) -> Column:
    """Delete punctuation and symbols but ``@`` and ``#``.

    With ``keep_urls`` a URL stays as it is; without, URLs are stripped as well
    and the apostrophe is kept instead.
    """
    pattern = PUNCTUATION_OUTSIDE_URLS if keep_urls else PUNCTUATION_EVERYWHERE
    return F.regexp_replace(_col(c), pattern, "$1")


def url_decode(c: Column | str) -> Column:
    """Decode percent escapes; ``+`` and malformed escapes stay as they are."""
    return _replace_matches(
        _col(c),
        PERCENT_RUN,
        lambda run: F.make_valid_utf8(
            F.unhex(F.replace(run, F.lit("%"), F.lit(""))).cast("string")
        ),
    )


def _replace_matches(c: Column, pattern: str, replacement) -> Column:
    """Rewrite every match once: cut the text at the matches and sew it together."""
    gaps = F.split(c, pattern, -1)
    hits = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return F.array_join(
        F.zip_with(
            gaps, hits, lambda gap, hit: F.concat(gap, F.coalesce(replacement(hit), F.lit("")))
        ),
        "",
    )


def _quote(text: str) -> str:
    return "".join(ch if ch.isalnum() or ord(ch) > 127 else "\\" + ch for ch in text)


def _ordered_alternation(words: Sequence[str]) -> str:
    """A pattern matching any of the words, earlier words preferred.

    Shared prefixes are factored out, so a position in the text is tested against
    one branch per next character and not against the whole list.  Words that
    differ in their next character never compete; only a word ending here
    competes with the longer ones, so it keeps its place between them.
    """
    runs: list[list[str] | None] = [[]]
    for word in words:
        if word:
            if runs[-1] is None:
                runs.append([])
            runs[-1].append(word)
        elif None not in runs:
            runs.append(None)

    branches: list[str] = []
    for run in runs:
        if run is None:
            branches.append("")
            continue
        by_head: dict[str, list[str]] = {}
        for word in run:
            by_head.setdefault(word[0], []).append(word[1:])
        for head, tails in by_head.items():
            if len(tails) == 1:
                branches.append(_quote(head + tails[0]))
            else:
                branches.append(_quote(head) + _ordered_alternation(tails))
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def phrase_pattern(phrases: Sequence[str]) -> str:
    """Word-bounded pattern for the phrases, in the given order of preference."""
    return r"(?U)\b" + _ordered_alternation(list(phrases)) + r"\b"


def replace_phrases(
    c: Column | str, mapping: Mapping[str, str], longest_first: bool = True
) -> Column:
    """Replace whole-word phrases in a single pass.

    Replacements are not looked at again, and where phrases overlap the longest
    wins (or the first listed, with ``longest_first=False``).
    """
    mapping = {k: v for k, v in mapping.items() if k}
    if not mapping:
        return _col(c)
    phrases = list(mapping)
    if longest_first:
        phrases.sort(key=len, reverse=True)
    return _replace_matches(_col(c), phrase_pattern(phrases), literal_map(mapping))


def expand_contractions(c: Column | str, drop_ownership: bool = False) -> Column:
    """Write out English contractions, optionally dropping every other ``'s``."""
    text = _col(c)
    apostrophe = F.contains(text, F.lit("'"))
    expanded = F.when(
        apostrophe, replace_phrases(text, CONTRACTIONS, longest_first=False)
    ).otherwise(text)
    if drop_ownership:
        expanded = F.replace(expanded, F.lit("'s"), F.lit(""))
    return expanded
