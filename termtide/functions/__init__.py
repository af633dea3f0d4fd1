from termtide.functions.contractions import CONTRACTIONS
from termtide.functions.intervals import INTERVALS, interval_label
from termtide.functions.lookup import literal_array, literal_map, member_of
from termtide.functions.text import (
    clean_text,
    expand_contractions,
    lower_text,
    remove_punctuation,
    replace_phrases,
    url_decode,
)
from termtide.functions.tokens import (
    clean_and_tokenize,
    filter_tokens,
    join_tokens,
    split_emojis,
    tokenize,
)

__all__ = [
    "CONTRACTIONS",
    "INTERVALS",
    "clean_and_tokenize",
    "clean_text",
    "expand_contractions",
    "filter_tokens",
    "interval_label",
    "join_tokens",
    "literal_array",
    "literal_map",
    "lower_text",
    "member_of",
    "remove_punctuation",
    "replace_phrases",
    "split_emojis",
    "tokenize",
    "url_decode",
]
