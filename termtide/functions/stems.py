"""Stems by suffix rules, as native columns over a table of distinct words.

The rules are those of the Snowball stemmers for English and Spanish.  A word goes through ordered steps; a step
takes the longest ending of its list that the word has and changes it if it lies within a region of the word.
Regions are given by where they begin, which no step changes, as only the end of the word is rewritten.  Every step
is a column of its own, so no expression grows with the number of steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.session import stored

STEMMED_LANGUAGES = ("en", "es")

# The published rules of the English stemmer.
_EN_WHOLE = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_EN_KEPT = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
_EN_STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
_EN_STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
    "ative": "",
}
_EN_STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion"
).split()

# The published rules of the Spanish stemmer.
_ES_PRONOUNS = "me se sela selo selas selos la le lo las les los nos".split()
_ES_DELETED = (
    "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas "
    "amiento amientos imiento imientos"
).split()
_ES_AFTER_IC = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
_ES_Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
_ES_VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos "
    "eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id "
    "ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas "
    "ías aras ieras ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos "
    "imos áramos iéramos iésemos ásemos"
).split()
_ES_GU_VERBS = "en es éis emos".split()


def _ending(word: Column, endings: Iterable[str]) -> Column:
    """The longest of the endings that the word has, or nothing: the match that begins first."""
    return F.regexp_extract(word, f"(?:{'|'.join(endings)})$", 0)


def _stem_of(word: Column, ending: Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.length(ending))


def _region(word: Column, pattern: str, skipped: int = 0) -> Column:
    """Where the part after the first match, some letters skipped, begins; the word's length if there is none."""
    head = F.regexp_extract(word, f"^(?s:.){{{skipped}}}(?s:.)*?{pattern}", 0)
    return F.when(head != "", F.length(head)).otherwise(F.length(word))


def _within(word: str, ending: str, region: str) -> Column:
    """Whether the ending lies in the region; no ending lies in none."""
    return (F.col(ending) != "") & (F.length(word) - F.length(ending) >= F.col(region))


def _second(word: Column, first: Column, pattern: str) -> Column:
    rest = F.substring(word, first + 1, F.length(word))
    return first + _region(rest, pattern)


def _cases(ending: Column, outcomes: Sequence[tuple[Sequence[str], Column]], otherwise: Column) -> Column:
    """The outcome of the list that holds the ending."""
    out = None
    for endings, value in outcomes:
        test = ending.isin(list(endings))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(otherwise)


def _rewritten(rules: dict[str, str], ending: Column, stem: Column) -> Column:
    heads: dict[str, list[str]] = {}
    for tail, head in rules.items():
        heads.setdefault(head, []).append(tail)
    return _cases(ending, [(tails, F.concat(stem, F.lit(head))) for head, tails in heads.items()], stem)


# --- English --------------------------------------------------------------------

_V = "[aeiouy]"
_C = "[^aeiouy]"
_SHORT_SYLLABLE = rf"(?:{_C}{_V}[^aeiouwxyY]|^{_V}{_C})$"


def _english(df: DataFrame) -> DataFrame:
    w, e, s = F.col("_w"), F.col("_e"), F.col("_s")

    def ending(df: DataFrame, endings: Iterable[str]) -> DataFrame:
        return df.withColumn("_e", _ending(w, endings)).withColumn("_s", _stem_of(w, e))

    word = F.regexp_replace(F.translate(F.col("_word"), "‘’‛", "'''"), "^'", "")
    df = df.withColumn("_w", F.regexp_replace(word, rf"(^|{_V})y", "$1Y"))
    # After a y that became a consonant another one may stand after a vowel no longer: the first pass is enough but
    # for "yy", whose second y follows a consonant then.
    special = F.regexp_extract(w, "^(?:gener|commun|arsen)", 0)
    df = df.withColumn("_r1", F.when(special != "", F.length(special)).otherwise(_region(w, _V + _C)))
    df = df.withColumn("_r2", _second(w, F.col("_r1"), _V + _C))

    df = ending(df, ["'", "'s", "'s'"]).withColumn("_w", s)  # step 0

    df = ending(df, ["sses", "ied", "ies", "us", "ss", "s"])  # step 1a
    short_ie = F.when(F.length(s) > 1, F.concat(s, F.lit("i"))).otherwise(F.concat(s, F.lit("ie")))
    plural = F.when(F.regexp_like(s, F.lit(rf"{_V}(?s:.)+$")), s).otherwise(w)
    df = df.withColumn(
        "_w",
        _cases(e, [(["sses"], F.concat(s, F.lit("ss"))), (["ied", "ies"], short_ie), (["s"], plural)], w),
    )
    df = df.withColumn("_kept", F.when(w.isin(list(_EN_KEPT)), w))

    df = ending(df, ["eed", "eedly", "ed", "edly", "ing", "ingly"])  # step 1b
    has_vowel = F.regexp_like(s, F.lit(_V))
    length = F.length(s)
    mended = (
        F.when(F.regexp_like(s, F.lit("(?:at|bl|iz)$")), F.concat(s, F.lit("e")))
        .when(F.regexp_like(s, F.lit("(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$")), F.substring(s, F.lit(1), length - 1))
        .when((length <= F.col("_r1")) & F.regexp_like(s, F.lit(_SHORT_SYLLABLE)), F.concat(s, F.lit("e")))
        .otherwise(s)
    )
    eed = F.when(_within("_w", "_e", "_r1"), F.concat(s, F.lit("ee"))).otherwise(w)
    gone = F.when(has_vowel, mended).otherwise(w)
    df = df.withColumn("_w", _cases(e, [(["eed", "eedly"], eed), (["ed", "edly", "ing", "ingly"], gone)], w))

    df = df.withColumn("_w", F.regexp_replace(w, rf"(?<=.{_C})[yY]$", "i"))  # step 1c

    df = ending(df, _EN_STEP_2)
    allowed = (
        F.when(e == "ogi", F.endswith(s, F.lit("l")))
        .when(e == "li", F.regexp_like(s, F.lit("[cdeghkmnrt]$")))
        .otherwise(True)
    )
    df = df.withColumn(
        "_w", F.when(_within("_w", "_e", "_r1") & allowed, _rewritten(_EN_STEP_2, e, s)).otherwise(w)
    )

    df = ending(df, _EN_STEP_3)
    allowed = (e != "ative") | _within("_w", "_e", "_r2")
    df = df.withColumn(
        "_w", F.when(_within("_w", "_e", "_r1") & allowed, _rewritten(_EN_STEP_3, e, s)).otherwise(w)
    )

    df = ending(df, _EN_STEP_4)
    allowed = (e != "ion") | F.regexp_like(s, F.lit("[st]$"))
    df = df.withColumn("_w", F.when(_within("_w", "_e", "_r2") & allowed, s).otherwise(w))

    df = ending(df, ["e", "l"])  # step 5
    e_goes = _within("_w", "_e", "_r2") | (
        _within("_w", "_e", "_r1") & ~F.regexp_like(s, F.lit(_SHORT_SYLLABLE))
    )
    l_goes = _within("_w", "_e", "_r2") & F.endswith(s, F.lit("l"))
    df = df.withColumn("_w", F.when(((e == "e") & e_goes) | ((e == "l") & l_goes), s).otherwise(w))

    whole = F.create_map(*(F.lit(x) for pair in _EN_WHOLE.items() for x in pair))
    stem = F.when(F.length("_word") <= 2, F.col("_word")).otherwise(
        F.coalesce(whole[F.col("_word")], F.translate(F.coalesce("_kept", w), "Y", "y"))
    )
    return df.withColumn("_stem", stem)


# --- Spanish --------------------------------------------------------------------

_EV = "[aeiouáéíóúü]"
_EC = "[^aeiouáéíóúü]"


def _spanish(df: DataFrame) -> DataFrame:
    w, e, s = F.col("_w"), F.col("_e"), F.col("_s")

    def ending(df: DataFrame, endings: Iterable[str]) -> DataFrame:
        return df.withColumn("_e", _ending(w, endings)).withColumn("_s", _stem_of(w, e))

    def ending_in_rv(df: DataFrame, endings: Iterable[str]) -> DataFrame:
        """The longest ending that lies within the region RV."""
        tail = F.substring(w, F.col("_rv") + 1, F.length(w))
        return df.withColumn("_e", _ending(tail, endings)).withColumn("_s", _stem_of(w, e))

    def without(word: Column, endings: Sequence[str], region: str) -> Column:
        """The word without the first of the endings that it has, if that lies in the region."""
        found = _ending(word, endings)
        inside = (found != "") & (F.length(word) - F.length(found) >= F.col(region))
        return F.when(inside, _stem_of(word, found)).otherwise(word)

    df = df.withColumn("_w", F.col("_word"))
    region = (
        F.when(F.regexp_like(w, F.lit(f"^(?s:.){_EC}")), _region(w, _EV, 2))
        .when(F.regexp_like(w, F.lit(f"^{_EV}{_EV}")), _region(w, _EC, 2))
        .otherwise(F.least(F.lit(3), F.length(w)))
    )
    df = df.withColumn("_rv", region)
    df = df.withColumn("_r1", _region(w, _EV + _EC))
    df = df.withColumn("_r2", _second(w, F.col("_r1"), _EV + _EC))

    df = ending(df, _ES_PRONOUNS)  # step 0
    gerund = F.regexp_extract(s, "(?:i[ée]ndo|[áa]ndo|[áaéeíi]r|yendo)$", 0)
    inside = (gerund != "") & (F.length(s) - F.length(gerund) >= F.col("_rv"))
    after_u = (gerund != "yendo") | F.regexp_like(s, F.lit("uyendo$"))
    plain = F.concat(_stem_of(s, gerund), F.translate(gerund, "áéí", "aei"))
    df = df.withColumn("_w", F.when((e != "") & inside & after_u, plain).otherwise(w))

    df = df.withColumn("_before", w)  # step 1
    df = ending(
        df,
        [*_ES_DELETED, *_ES_AFTER_IC, "logía", "logías", "ución", "uciones", "encia", "encias", "amente", "mente"]
        + ["idad", "idades", "iva", "ivo", "ivas", "ivos"],
    )
    in_r1, in_r2 = _within("_w", "_e", "_r1"), _within("_w", "_e", "_r2")
    and_at = F.when(F.endswith(s, F.lit("iv")), without(without(s, ["iv"], "_r2"), ["at"], "_r2"))
    and_at = F.when(F.endswith(s, F.lit("iv")) & (F.length(s) - 2 < F.col("_r2")), s).otherwise(and_at)
    adverb = F.when(F.endswith(s, F.lit("iv")), and_at).otherwise(without(s, ["os", "ic", "ad"], "_r2"))
    df = df.withColumn(
        "_w",
        F.when(e == "amente", F.when(in_r1, adverb).otherwise(w))
        .when(~in_r2, w)
        .otherwise(
            _cases(
                e,
                [
                    (_ES_DELETED, s),
                    (_ES_AFTER_IC, without(s, ["ic"], "_r2")),
                    (["logía", "logías"], F.concat(s, F.lit("log"))),
                    (["ución", "uciones"], F.concat(s, F.lit("u"))),
                    (["encia", "encias"], F.concat(s, F.lit("ente"))),
                    (["mente"], without(s, ["ante", "able", "ible"], "_r2")),
                    (["idad", "idades"], without(s, ["abil", "ic", "iv"], "_r2")),
                    (["iva", "ivo", "ivas", "ivos"], without(s, ["at"], "_r2")),
                ],
                w,
            )
        ),
    )
    df = df.withColumn("_done", w != F.col("_before"))

    df = ending_in_rv(df, _ES_Y_VERBS)  # step 2a
    goes = ~F.col("_done") & (e != "") & F.endswith(s, F.lit("u"))
    df = df.withColumn("_w", F.when(goes, s).otherwise(w)).withColumn("_done", F.col("_done") | goes)

    df = ending_in_rv(df, [*_ES_VERBS, *_ES_GU_VERBS])  # step 2b
    after_gu = F.when(F.endswith(s, F.lit("gu")), F.substring(s, F.lit(1), F.length(s) - 1)).otherwise(s)
    verb = F.when(e.isin(_ES_GU_VERBS), after_gu).otherwise(s)
    df = df.withColumn("_w", F.when(~F.col("_done") & (e != ""), verb).otherwise(w))

    df = ending(df, ["os", "a", "o", "á", "í", "ó", "e", "é"])  # step 3
    u_goes = e.isin("e", "é") & F.endswith(s, F.lit("gu")) & (F.length(s) - 1 >= F.col("_rv"))
    rest = F.when(u_goes, F.substring(s, F.lit(1), F.length(s) - 1)).otherwise(s)
    df = df.withColumn("_w", F.when(_within("_w", "_e", "_rv"), rest).otherwise(w))
    return df.withColumn("_stem", F.translate(w, "áéíóú", "aeiou"))


def word_stems(words: DataFrame, lang: str = "en", word: str = "word") -> DataFrame:
    """``(word, stem)`` of the distinct words, taken in lower case.

    Stored: a predicate on the stem, pushed below all steps, would hold every step many times over.
    """
    if lang not in STEMMED_LANGUAGES:
        raise ValueError(f"no rules for {lang!r}; there are some for {', '.join(STEMMED_LANGUAGES)}")
    rules = _spanish if lang == "es" else _english
    distinct = words.select(F.col(word).alias("word")).where(F.col("word").isNotNull()).distinct()
    stemmed = rules(distinct.withColumn("_word", F.lower("word")))
    return stored(stemmed.select("word", F.col("_stem").alias("stem")), "stems")


def stem_table(words: DataFrame, lang: str = "en", word: str = "word") -> DataFrame:
    """``(synonym, head)`` of the distinct words whose stem differs, for ``with_mapped_tokens``."""
    stems = word_stems(words, lang, word)
    return stems.select(F.col("word").alias("synonym"), F.col("stem").alias("head")).where("synonym <> head")
