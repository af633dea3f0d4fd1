"""Base forms by detachment rules that a vocabulary confirms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.operators.joins import lookup_join
from termtide.session import stored

# Endings and what stands for them, by word class.
DETACHMENT: dict[str, tuple[tuple[str, str], ...]] = {
    "n": (
        ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
        ("men", "man"), ("ies", "y"),
    ),
    "v": (
        ("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
    ),
    "a": (("er", ""), ("est", ""), ("er", "e"), ("est", "e")),
    "r": (),
}

# Frequent irregular forms; longer lists come as a parameter.
IRREGULAR: dict[str, dict[str, str]] = {
    "n": {
        "men": "man", "women": "woman", "children": "child", "feet": "foot", "teeth": "tooth", "geese": "goose",
        "mice": "mouse", "oxen": "ox", "lives": "life", "wives": "wife", "knives": "knife", "people": "people",
    },
    "v": {
        "am": "be", "are": "be", "is": "be", "was": "be", "were": "be", "been": "be", "being": "be", "has": "have",
        "had": "have", "does": "do", "did": "do", "done": "do", "went": "go", "gone": "go", "goes": "go", "said": "say",
        "made": "make", "took": "take", "taken": "take", "came": "come", "saw": "see", "seen": "see", "knew": "know",
        "known": "know", "got": "get", "gave": "give", "given": "give", "found": "find", "thought": "think",
        "told": "tell", "became": "become", "left": "leave", "felt": "feel", "put": "put", "brought": "bring",
        "began": "begin", "begun": "begin", "kept": "keep", "held": "hold", "wrote": "write", "written": "write",
        "stood": "stand", "heard": "hear", "let": "let", "meant": "mean", "set": "set", "met": "meet", "ran": "run",
        "paid": "pay", "sat": "sit", "spoke": "speak", "spoken": "speak", "led": "lead", "grew": "grow",
        "grown": "grow", "lost": "lose", "fell": "fall", "fallen": "fall", "sent": "send", "built": "build",
    },
    "a": {"better": "good", "best": "good", "worse": "bad", "worst": "bad", "further": "far", "furthest": "far"},
    "r": {"better": "well", "best": "well", "worse": "badly", "further": "far"},
}


def lemma_candidates(words: DataFrame, classes: Sequence[str], word: str = "word") -> DataFrame:
    """``(word, word_class, lemma)``: the word itself and what every rule makes of it.

    A rule that would leave nothing makes nothing.
    """
    rules = [(c, end, head) for c in classes for end, head in DETACHMENT[c]]
    own = [F.struct(F.lit(c).alias("word_class"), F.col(word).alias("lemma")) for c in classes]
    made = []
    for c, end, head in rules:
        stem = F.substring(word, F.lit(1), F.length(word) - len(end))
        fits = F.endswith(word, F.lit(end)) & (F.length(word) > len(end))
        made.append(F.when(fits, F.struct(F.lit(c).alias("word_class"), F.concat(stem, F.lit(head)).alias("lemma"))))
    candidates = F.array_distinct(F.array_compact(F.array(*own, *made)))
    return words.select(F.col(word).alias("word"), F.inline(candidates))


def lemma_table(
    words: DataFrame,
    vocabulary: DataFrame,
    *,
    classes: Sequence[str] = ("n",),
    irregular: Mapping[str, Mapping[str, str]] | DataFrame = IRREGULAR,
    word: str = "word",
    **bounds,
) -> DataFrame:
    """``(synonym, head)`` of the distinct words whose base form differs, for ``with_mapped_tokens``.

    ``vocabulary`` lists base forms ``(word)``, or ``(word, word_class)`` with the classes n, v, a, r.  An irregular form
    of one of the classes goes to its base form.  For any other word the candidates, the word itself
    among them, that the vocabulary holds are compared, and the shortest is taken, of equal length the least.  Without
    any the word stays as it is, and so does a missing one.

    ``irregular`` is a mapping by class, or a table ``(word, lemma, word_class)`` of any size.
    """
    unknown = set(classes) - set(DETACHMENT)
    if unknown:
        raise ValueError(f"unknown word classes {sorted(unknown)}")
    # Both tables of words are stored, as each is read several times and may be made of whole texts.
    words = stored(words.select(F.col(word).alias("word")).where(F.col("word") != "").distinct(), "lemma-words")
    if not isinstance(irregular, DataFrame):
        rows = [(w, lemma, c) for c, forms in irregular.items() for w, lemma in forms.items()]
        irregular = words.sparkSession.createDataFrame(rows, "word string, lemma string, word_class string")
    listed = (
        irregular.where(F.col("word_class").isin(list(classes)))
        .groupBy("word")
        .agg(F.min(F.struct(F.length("lemma").alias("n"), "lemma")).alias("irregular"))
    )
    marked = lookup_join(words, listed, ["word"], "left", **bounds)
    regular = marked.where(F.col("irregular").isNull()).select("word")
    on = ["lemma"] + [c for c in vocabulary.columns if c == "word_class"]
    known = stored(vocabulary.withColumnRenamed("word", "lemma").select(*on).distinct(), "lemma-vocabulary")
    confirmed = (
        lookup_join(lemma_candidates(regular, classes), known, on, "left_semi", **bounds)
        .groupBy("word")
        .agg(F.min(F.struct(F.length("lemma").alias("n"), "lemma")).alias("best"))
        .select(F.col("word").alias("synonym"), F.col("best.lemma").alias("head"))
    )
    exceptions = marked.where(F.col("irregular").isNotNull()).select(
        F.col("word").alias("synonym"), F.col("irregular.lemma").alias("head")
    )
    return exceptions.unionByName(confirmed).where("synonym <> head")
