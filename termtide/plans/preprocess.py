"""The ordered, switchable chain from raw to preprocessed text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.functions.lookup import MAX_LITERAL_ENTRIES
from termtide.functions.stems import STEMMED_LANGUAGES, stem_table
from termtide.functions.text import (
    clean_text,
    expand_contractions,
    lower_text,
    remove_punctuation,
)
from termtide.functions.tokens import filter_tokens, join_tokens, tokenize
from termtide.operators.lemmas import lemma_table
from termtide.operators.phrases import with_replaced_phrases
from termtide.operators.token_map import LEMMA_EXCLUSIONS, with_mapped_tokens
from termtide.session import numbered_rows
from termtide.sources.lists import bounded_dict, default_stopwords

CHOICES = (
    "stopwords",
    "punctuation",
    "lemmatize",
    "stemmed",
    "lowercase",
    "contractions",
    "hashtags",
    "emojis",
    "urls",
)

# What the co-occurrence job switches on by itself.
JOB_CHOICES = ("lowercase", "punctuation", "stopwords", "contractions")


@dataclass(frozen=True)
class PreprocessOptions:
    """Choices and dictionaries of the chain.

    ``stopwords`` of None with the choice ``stopwords`` means the built-in list of
    the language.  ``synonyms`` and ``lemmas`` replace phrases in the text and
    ``stems`` and ``lemma_tokens`` single tokens; all of them, and stop words ``(word)``, may be
    lists or tables ``(synonym, head)`` of any size.  The choice ``stemmed`` without ``stems`` makes
    the stems of the texts' own words by the rules of the language; ``lemmatize`` without ``lemma_tokens``
    takes them to base forms that ``lemma_vocabulary``, a table ``(word)`` or ``(word, word_class)``, holds.
    """

    choices: Sequence[str] = ()
    lang: str = "en"
    stopwords: DataFrame | Sequence[str] | None = None
    synonyms: DataFrame | Mapping[str, str] = field(default_factory=dict)
    lemmas: DataFrame | Mapping[str, str] = field(default_factory=dict)
    stems: DataFrame | Mapping[str, str] | None = None
    lemma_tokens: DataFrame | Mapping[str, str] | None = None
    lemma_vocabulary: DataFrame | None = None
    lemma_exclusions: Sequence[str] = LEMMA_EXCLUSIONS
    drop_contraction_ownership: bool = False

    def __post_init__(self):
        unknown = set(self.choices) - set(CHOICES)
        if unknown:
            raise ValueError(f"unknown preprocessing choices {sorted(unknown)}")
        if "stemmed" in self.choices and self.stems is None and self.lang not in STEMMED_LANGUAGES:
            raise ValueError(f"the choice 'stemmed' needs the dictionary 'stems' for {self.lang!r}")
        if "lemmatize" in self.choices and self.lemma_tokens is None and self.lemma_vocabulary is None:
            raise ValueError("the choice 'lemmatize' needs 'lemma_tokens' or 'lemma_vocabulary'")
        if isinstance(self.stopwords, DataFrame):
            entries = bounded_dict(self.stopwords, "word", "word")
            if entries is not None:  # else taken out by a join
                object.__setattr__(self, "stopwords", list(entries))

    @property
    def stopword_list(self) -> list[str]:
        """Stop words that are few enough for the plan."""
        if isinstance(self.stopwords, DataFrame):
            return []
        if self.stopwords is not None:
            listed = list(self.stopwords)
            return listed if len(listed) <= MAX_LITERAL_ENTRIES else []
        return default_stopwords(self.lang) if "stopwords" in self.choices else []

    def stopword_table(self, df: DataFrame) -> DataFrame | None:
        """Stop words ``(word)`` that are too many for a list."""
        if self.stopwords is None or isinstance(self.stopwords, DataFrame):
            return self.stopwords
        if self.stopword_list or not self.stopwords:
            return None
        return df.sparkSession.createDataFrame([(w,) for w in set(self.stopwords)], "word string")

    @property
    def has_stopwords(self) -> bool:
        return isinstance(self.stopwords, DataFrame) or bool(self.stopwords) or bool(self.stopword_list)

    @property
    def is_needed(self) -> bool:
        return bool(self.choices or self.synonyms or self.lemmas or self.has_stopwords)

    @property
    def ends_in_tokens(self) -> bool:
        """Whether the text is its tokens joined; a dictionary may put anything in place of a token."""
        return self.works_on_tokens and not {"stemmed", "lemmatize"} & set(self.choices)

    @property
    def works_on_tokens(self) -> bool:
        token_choices = {"stopwords", "lemmatize", "stemmed", "hashtags", "emojis", "urls"}
        return bool(token_choices & set(self.choices) or self.synonyms or self.has_stopwords)


def preprocess_text(
    df: DataFrame, options: PreprocessOptions, target: str, output: str
) -> DataFrame:
    """The part of the chain that works on the text as a whole.

    Replacing phrases reads the text twice, so every step gets a column to read
    from; inlined, the steps before it would run twice as well.
    """
    choices = set(options.choices)
    text = F.coalesce(F.col(target), F.lit(""))
    if "lowercase" in choices or options.synonyms:
        text = lower_text(text, options.lang)
    df = df.withColumn(output, clean_text(text))
    if ("contractions" in choices or options.synonyms) and options.lang == "en":
        df = df.withColumn(output, expand_contractions(output, options.drop_contraction_ownership))
    if options.synonyms:
        # The text is in lower case by now, so the keys have to be as well.
        df = with_replaced_phrases(df, options.synonyms, text=output, lower=True)
    if options.lemmas:
        df = with_replaced_phrases(df, options.lemmas, text=output)
    if "punctuation" in choices:
        df = df.withColumn(output, remove_punctuation(output))
    return df


def preprocess_tokens(
    df: DataFrame, options: PreprocessOptions, target: str = "full_text", tokens: str = "tokens"
) -> DataFrame:
    """Add the tokens that the chain leaves of the target column."""
    choices = set(options.choices)
    stopwords = options.stopword_list
    switches = dict(
        urls="urls" in choices, emojis="emojis" in choices, hashtags="hashtags" in choices
    )
    # The tokens and their filter are columns of their own as well: a lambda takes
    # everything below it out of generated code.
    df = preprocess_text(df, options, target, "_text")
    df = df.withColumn(tokens, tokenize("_text", options.lang)).drop("_text")
    if stopwords or any(switches.values()):
        kept = filter_tokens(tokens, stopwords, **switches)
        df = df.withColumn(tokens, F.when(F.size(tokens) > 0, kept).otherwise(F.col(tokens)))
    listed = options.stopword_table(df)
    df = without_listed(df, listed, tokens)
    if "stemmed" in choices:
        stems = options.stems
        if stems is None:
            df, words = with_own_words(df, tokens)
            stems = stem_table(words, options.lang)
        df = with_mapped_tokens(df, stems, tokens=tokens, number="_row" if options.stems is None else None)
    if "lemmatize" in choices:
        lemmas = options.lemma_tokens
        if lemmas is None:
            df, words = with_own_words(df, tokens)
            lemmas = lemma_table(words, options.lemma_vocabulary)
        number = "_row" if options.lemma_tokens is None else None
        df = with_mapped_tokens(df, lemmas, tokens=tokens, exclude=options.lemma_exclusions, number=number)
        if "stopwords" in choices:
            # A lemma may be a stop word although the token was none.
            df = df.withColumn(tokens, filter_tokens(tokens, stopwords, **switches))
            df = without_listed(df, listed, tokens)
    return df


def with_own_words(df: DataFrame, tokens: str = "tokens") -> tuple[DataFrame, DataFrame]:
    """The rows stored once, with their numbers as ``_row``, and their distinct tokens as a table ``(word)``."""
    rows = numbered_rows(df, "tokenized")
    return rows, rows.select(F.explode(tokens).alias("word")).distinct()


def without_listed(df: DataFrame, words: DataFrame | None, tokens: str = "tokens", **bounds) -> DataFrame:
    """Rows without the tokens of a table ``(word)`` of any size, and without empty ones."""
    if words is None:
        return df
    nothing = words.select(F.col("word").alias("synonym"), F.lit("").alias("head"))
    df = with_mapped_tokens(df, nothing, tokens=tokens, max_literal=0, **bounds)
    return df.withColumn(tokens, filter_tokens(tokens))


def preprocess(
    df: DataFrame,
    options: PreprocessOptions,
    target: str = "full_text",
    output: str = "preprocessed_text",
) -> DataFrame:
    """Add the preprocessed text; without any choice the table stays as it is."""
    if not options.is_needed:
        return df
    if not options.works_on_tokens:
        return preprocess_text(df, options, target, output)
    with_tokens = preprocess_tokens(df, options, target, "_tokens")
    return with_tokens.withColumn(output, join_tokens("_tokens")).drop("_tokens")


def preprocess_once(
    df: DataFrame,
    options: PreprocessOptions,
    target: str = "full_text",
    output: str = "preprocessed_text",
    tokens: str = "tokens",
) -> DataFrame:
    """Add what the chain ends in, tokens or text, of which ``text_and_tokens`` makes the other."""
    if options.ends_in_tokens:
        return preprocess_tokens(df, options, target, tokens)
    return preprocess(df, options, target, output)


def text_and_tokens(
    df: DataFrame,
    options: PreprocessOptions,
    target: str = "full_text",
    output: str = "preprocessed_text",
    tokens: str = "tokens",
) -> DataFrame:
    """The text of ``preprocess`` and the tokens of ``with_job_tokens`` from ``preprocess_once``."""
    if options.ends_in_tokens:
        return df.withColumn(output, join_tokens(tokens))
    return with_tokens(df, output if options.is_needed else target, options.lang, tokens)


def with_tokens(
    df: DataFrame, target: str = "full_text", lang: str = "en", tokens: str = "tokens"
) -> DataFrame:
    return df.withColumn(tokens, tokenize(target, lang))


def with_job_tokens(
    df: DataFrame, options: PreprocessOptions, target: str = "full_text", tokens: str = "tokens"
) -> DataFrame:
    """Tokens of the preprocessed text.

    Joining tokens with spaces and tokenising the result gives the same tokens, so
    where the chain already ends in tokens of the text they are used directly.  A
    dictionary may put anything in place of a token; then the text is tokenised
    again.
    """
    if not options.is_needed:
        return with_tokens(df, target, options.lang, tokens)
    if options.ends_in_tokens:
        return preprocess_tokens(df, options, target, tokens)
    return with_tokens(
        preprocess(df, options, target, "_preprocessed"), "_preprocessed", options.lang, tokens
    ).drop("_preprocessed")
