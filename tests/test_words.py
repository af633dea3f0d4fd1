"""Phrases of any number, stems and lemmas by rules, joins with measured heavy keys."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from suite.inputs import page_pairs
from termtide.functions.lookup import MAX_LITERAL_ENTRIES
from termtide.functions.stems import stem_table, word_stems
from termtide.operators import blocks, joins, token_map
from termtide.operators import phrases as phrase_module
from termtide.operators.lemmas import lemma_table
from termtide.operators.phrases import with_replaced_phrases
from termtide.operators.token_map import with_mapped_tokens
from termtide.plans.preprocess import PreprocessOptions, preprocess, preprocess_tokens, with_own_words

PHRASES = {
    "the": "THE", "of the": "OFTHE", "cat of the end": "X", "a b": "AB", "-b": "DASHB", "a-b a": "Q", "été": "E",
    "the  cat": "2", ". the": "n", "the cat.": "dot", "#tag": "T", "a": "", "日本": "JP", "b": "a",
}


def texts() -> list[str | None]:
    rng = random.Random(1)
    parts = ["the", "of", "cat", "end", "a", "b", "été", " ", " ", "  ", "-", ".", "#tag", "日本", "\n", "é́"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    return [*out, None, "", "the", ".the.", " ".join(["the cat of the end a b"] * 400)]


def replaced(spark, phrases, **bounds):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "n int, full_text string").repartition(3)
    out = with_replaced_phrases(rows, phrases, **bounds)
    assert out.columns == ["n", "full_text"]
    return [r[1] for r in out.orderBy("n").collect()]


def test_joined_phrases_are_the_literal_ones(spark):
    literal = replaced(spark, PHRASES)
    table = spark.createDataFrame(list(PHRASES.items()), "synonym string, head string")
    assert replaced(spark, table) == literal
    assert replaced(spark, table, max_literal=0) == literal
    assert replaced(spark, PHRASES, max_literal=3, max_rows=0) == literal


def test_phrases_on_both_sides_of_the_literal_bound(spark):
    """The same results from a pattern in the plan and from a table beyond its bound."""
    few = {f"word{i} more{i % 7}": f"<{i}>" for i in range(200)}
    many = few | {f"other{i} phrase": "x" for i in range(MAX_LITERAL_ENTRIES)}
    rows = spark.createDataFrame([(f"a word{i} more{i % 7} word{i + 1} end",) for i in range(0, 250, 3)], "full_text string")
    options = [PreprocessOptions(choices=("punctuation",), synonyms=m) for m in (few, many)]
    left, right = (
        sorted(r[0] for r in preprocess(rows, o).select("preprocessed_text").collect()) for o in options
    )
    assert left == right and any("<" not in t and "200" not in t for t in left)


def test_many_stop_words_as_a_list_or_a_table(spark):
    words = ["cat", *(f"w{i}" for i in range(MAX_LITERAL_ENTRIES + 1))]
    rows = spark.createDataFrame([("the cat w7 sat",), ("",), (None,)], "full_text string")
    table = spark.createDataFrame([(w,) for w in words], "word string")
    for stopwords in (words, table):
        tokens = preprocess_tokens(rows, PreprocessOptions(choices=("stopwords",), stopwords=stopwords))
        assert sorted(r["tokens"] for r in tokens.collect()) == [[], [], ["the", "sat"]]


# Word and stem, as published with the rules or worked out by hand.
ENGLISH = """consigned consign consistency consist consolatory consolatori conspiracy conspiraci conspirators conspir
constables constabl constancy constanc knackeries knackeri knacks knack kneeling kneel knightly knight knitted knit
knives knive knockers knocker generally general generate generat generously generous communism communism skies sky
dying die ties tie cries cri gas gas this this gaps gap kiwis kiwi happy happi say say by by enjoy enjoy youth youth
hopping hop hoping hope hoped hope luxuriated luxuri national nation relational relat replacement replac adjustment
adjust adoption adopt revival reviv controlling control probate probat rate rate agreed agre feed feed proceeding
proceed innings inning is is naïve naïv Running run adding ad bed bed shedding shed yy yy""".split()

SPANISH = """chicharrones chicharron chichimecas chichimec chicos chic chilena chilen torácico torac toreado tor
toreándolo tor torneos torne torpeza torpez torrencial torrencial torturado tortur haciéndola hac lógicamente logic
rápidamente rapid nacionalidad nacional constituyendo constitu publicaciones public pague pag biología biolog
solución solucion existencia existent ciudades ciudad activamente activ amablemente amabl y y él el""".split()


@pytest.mark.parametrize("lang, pairs", [("en", ENGLISH), ("es", SPANISH)])
def test_stems(spark, lang, pairs):
    expected = dict(zip(pairs[::2], pairs[1::2]))
    expected["yy"] = "yy"
    words = spark.createDataFrame([(w,) for w in [*expected, *list(expected)[:3], None, ""]], "word string")
    found = {r["word"]: r["stem"] for r in word_stems(words, lang).collect()}
    assert found == expected | {"": ""}
    table = {r["synonym"]: r["head"] for r in stem_table(words, lang).collect()}
    assert table == {w: s for w, s in expected.items() if w != s}


def test_no_stems_for_other_languages(spark):
    with pytest.raises(ValueError):
        PreprocessOptions(choices=("stemmed",), lang="fr")
    with pytest.raises(ValueError):
        word_stems(spark.createDataFrame([], "word string"), "xx")


def test_lemmas(spark):
    words = "dogs churches wolves men cities running ran bass s is better boxes unknowns dogs es".split()
    words = spark.createDataFrame([(w,) for w in [*words, None, ""]], "word string")
    vocabulary = spark.createDataFrame([(w,) for w in "dog church wolf man city run bass box good e".split()], "word string")
    nouns = {"dogs": "dog", "churches": "church", "wolves": "wolf", "men": "man", "cities": "city", "boxes": "box", "es": "e"}
    for bounds in ({}, {"max_rows": 0}):
        found = {r["synonym"]: r["head"] for r in lemma_table(words, vocabulary, **bounds).collect()}
        assert found == nouns
    found = {r["synonym"]: r["head"] for r in lemma_table(words, vocabulary, classes=("n", "v", "a")).collect()}
    assert found == nouns | {"ran": "run", "is": "be", "better": "good"}
    by_class = spark.createDataFrame([("dog", "v"), ("box", "n")], "word string, word_class string")
    found = {r["synonym"]: r["head"] for r in lemma_table(words, by_class).collect()}
    assert found == {"boxes": "box", "men": "man"}


def test_lemmas_read_each_table_of_words_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def words_of(rows):
        for batch in rows:
            reads.add(batch.num_rows)
            yield batch

    words, vocabulary = (
        spark.createDataFrame([(w,) for w in listed], "word string").mapInArrow(words_of, "word string")
        for listed in (["dogs", "ran", "s"], ["dog", "run"])
    )
    found = lemma_table(words, vocabulary, classes=("n", "v"), max_rows=0).collect()
    assert sorted(tuple(r) for r in found) == [("dogs", "dog"), ("ran", "run")]
    assert reads.value == 5


def test_chain_with_made_stems_and_lemmas(spark):
    rows = spark.createDataFrame([("the dogs were running to churches",), (None,)], "full_text string")
    options = PreprocessOptions(choices=("lowercase", "stemmed"))
    tokens = preprocess_tokens(rows, options).where("size(tokens) > 0").first()["tokens"]
    assert tokens == ["the", "dog", "were", "run", "to", "church"]
    vocabulary = spark.createDataFrame([("dog",), ("church",)], "word string")
    options = PreprocessOptions(choices=("lowercase", "lemmatize"), lemma_vocabulary=vocabulary)
    tokens = preprocess_tokens(rows, options).where("size(tokens) > 0").first()["tokens"]
    assert tokens == ["the", "dog", "were", "running", "to", "church"]


def test_heavy_keys_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_ROWS", 100)
    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
    keys = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 1, F.concat(F.lit("k"), F.col("id") % 97))
    facts = spark.range(0, 3000, 1, 6).select("id", keys.alias("k"))
    side = spark.createDataFrame([("hot", 1), ("k5", 2), ("k7", 3), ("k7", 4), (None, 5)], "k string, v int")
    assert joins.heavy_keys(facts, ["k"]) == [("hot",)]
    for how in ("inner", "left", "left_semi", "left_anti"):
        found = joins.lookup_join(facts, side, ["k"], how, max_rows=0)
        expected = facts.join(side, ["k"], how)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().toString()
    repeated = [r for r in joins.lookup_join(facts, side, ["k"], "left", max_rows=0).collect() if r["k"] == "hot"]
    assert len(repeated) == 1000


def test_many_heavy_keys_are_looked_up_as_a_set(spark, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_ROWS", 5)
    monkeypatch.setattr(joins, "SMALL_BYTES", 0)
    facts = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 100).cast("string").alias("k"), (F.col("id") % 4).alias("m"))
    side = spark.createDataFrame([("7", 3, 1), ("8", 0, 2), ("8", 1, 3), (None, 1, 4)], "k string, m long, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        found = joins.lookup_join(facts, side.drop("m"), ["k"], how, max_rows=0)
        expected = facts.join(side.drop("m"), ["k"], how)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
        # One comparison for each key made the generated code too long to be compiled.
        assert found._jdf.queryExecution().optimizedPlan().toString().count(" OR ") < 10
        found, expected = joins.lookup_join(facts, side, ["k", "m"], how, max_rows=0), facts.join(side, ["k", "m"], how)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_equal_rows_stay_as_many_as_they_are(spark):
    rows = spark.createDataFrame([("a b",)] * 500 + [("c",), (None,)], "text string")
    tokens = rows.withColumn("tokens", F.split("text", " "))
    table = spark.createDataFrame([("b", "B"), ("x", "X")], "synonym string, head string")
    found = with_mapped_tokens(tokens, table, max_literal=0, max_rows=0)
    assert found.columns == ["text", "tokens"]
    assert sorted((str(r["tokens"]) for r in found.collect())) == ["None"] + ["['a', 'B']"] * 500 + ["['c']"]


def _asked_rows(monkeypatch, module):
    """Collects how many rows meet the side table."""
    asked, join = [], joins.lookup_join

    def counted(facts, *args, **bounds):
        asked.append(facts.count())
        return join(facts, *args, **bounds)

    for m in (joins, module):
        monkeypatch.setattr(m, "lookup_join", counted)
    return asked


def test_phrases_are_asked_for_once_a_block(spark, monkeypatch):
    asked = _asked_rows(monkeypatch, phrase_module)
    texts = ["a b c", "x a b, b c", None, "", " a b "] * 100
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, full_text string").coalesce(1)
    phrases = spark.createDataFrame([("a b", "A"), ("b c", "B"), ("a b c", "C"), (", ", "-")], "synonym string, head string")
    found = with_replaced_phrases(rows, phrases, max_literal=0, max_rows=0)
    assert [r["full_text"] for r in found.orderBy("i").collect()] == ["C", "x A-B", None, "", " A "] * 100
    assert asked[0] < 10


def test_phrases_are_asked_for_in_lists(spark, monkeypatch):
    """A row for each bucket, however many sequences there are, of four octets each; one bucket or many find the same."""
    lists, join = [], joins.lookup_join

    def listed(facts, *args, **bounds):
        lists.append(facts.collect())
        return join(facts, *args, **bounds)

    monkeypatch.setattr(phrase_module, "lookup_join", listed)
    rows = spark.createDataFrame([(i, f"a{i} b{i} {i}") for i in range(2000)], "i int, full_text string").coalesce(1)
    phrases = spark.createDataFrame([(f"a{i} b{i}", f"<{i}>") for i in range(0, 3000, 2)], "synonym string, head string")
    for most, buckets in ((phrase_module.BUCKET_PHRASES, 1), (100, 15)):
        monkeypatch.setattr(phrase_module, "BUCKET_PHRASES", most)
        found = with_replaced_phrases(rows, phrases, max_literal=0, max_rows=0)
        texts = [r["full_text"] for r in found.orderBy("i").collect()]
        assert texts == [f"a{i} b{i} {i}" if i % 2 else f"<{i}> {i}" for i in range(2000)]
        assert len(lists[-1]) == buckets
        # Of three words a text, two pairs.
        assert sum(len(asked["_keys"]) for r in lists[-1] for asked in r["_asked"]) <= 4 * 2 * 2000


def test_runs_are_those_of_the_pattern(spark):
    rng = random.Random(2)
    parts = [0x20, 0x61, 0x5F, 0x2D, 0x301, 0xE9, 0x200D, 0x203F, 0x2160, 0x24B6, 0x65E5, 0x1F600, 0x1D7D9, 0xE0100, 0]
    chars = [*parts, *(rng.choice((rng.randrange(0xD800), rng.randrange(0xE000, 0x110000))) for _ in range(20000))]
    values = ["".join(map(chr, rng.choices(chars, k=rng.randint(0, 60)))) for _ in range(1000)] + [None, "", "x"]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string").orderBy("i")
    expected = [r[0] or [] for r in rows.select(F.regexp_extract_all("c", F.lit(phrase_module.RUN), F.lit(0))).collect()]
    begins = [bool(r[0]) for r in rows.select(F.regexp_like("c", F.lit(r"(?U)^\w"))).collect()]
    for some in (slice(None), slice(-2, -1)):
        runs, sizes, word = phrase_module._runs(pa.array(values[some], pa.string()), phrase_module._word_changes(spark))
        assert runs.to_pylist() == [run for runs in expected[some] for run in runs]
        assert sizes.tolist() == [len(runs) for runs in expected[some]]
        assert word.tolist() == begins[some]


def test_lists_of_keys_are_packed_and_found():
    keys = np.array([0, 1, 1 << 20, (1 << 32) - 1], np.uint32)
    assert phrase_module._keys(phrase_module._steps(keys)).tolist() == keys.tolist()
    assert phrase_module._keys(phrase_module._steps(keys[:0])).tolist() == []
    # Two phrases may have the same key; both are found, for their texts to be compared.
    assert phrase_module._found(np.array([1, 3, 3, 7], np.uint32), np.array([0, 3, 7, 9], np.uint32)).tolist() == [1, 2, 3]


def test_phrases_are_packed():
    """By their lengths and texts; a head that is like its synonym takes little room."""
    phrases = pa.table({"synonym": ["é b", "a", "x" * 300], "head": ["", "日本", "y"]})
    packs = [phrase_module._pack_phrases(p) for p in (phrases, phrases.slice(1, 1))]
    expected = [*phrases.to_pylist(), phrases.to_pylist()[1]]
    assert phrase_module._unpacked_phrases(pa.array(packs, pa.binary())).to_pylist() == expected
    assert phrase_module._unpacked_phrases(pa.chunked_array([], pa.binary())) is None
    rng = random.Random(3)
    words = sorted({f"{rng.randrange(1 << 40):x} {rng.randrange(1 << 40):x}" for _ in range(20000)})
    one, both = (pa.table({"synonym": words, "head": heads}) for heads in ([""] * len(words), [w.replace(" ", "_") for w in words]))
    assert len(phrase_module._pack_phrases(both)) < 1.5 * len(phrase_module._pack_phrases(one))


def test_blocks_span_batches():
    batches = [pa.record_batch({"_block": pa.array(b, pa.int64()), "t": b}) for b in ([0, 0, 1], [], [1, 1], [1, 4, 5], [5])]
    assert [(block, rows["t"].to_pylist()) for block, rows in phrase_module._blocks(iter(batches))] == [
        (0, [0, 0]), (1, [1] * 4), (4, [4]), (5, [5, 5])
    ]


def test_page_pairs_move_once(spark, tmp_path):
    pages = [("http://X.y/a b", "<p>The  end. É é_1 a b</p>"), (None, "the end"), ("a b", None), (None, None)]
    spark.createDataFrame(pages, "url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    pairs = page_pairs(spark, str(tmp_path))
    assert sorted(map(tuple, pairs.collect())) == [
        ("a b", "a_b"), ("the end", "the_end"), ("é é_1", "é_é_1"), ("é_1 a", "é_1_a")
    ]
    plan = phrase_module.phrase_table(pairs, pairs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_long_texts_are_blocks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(blocks, "LARGE_ROW", 3)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 2)
    rows = spark.createDataFrame([(i, "é b" + " é b" * (i % 3)) for i in range(9)], "i int, full_text string").coalesce(1)
    phrases = spark.createDataFrame([("é b", "A"), ("b é", "B")], "synonym string, head string")
    found = with_replaced_phrases(rows, phrases, max_literal=0)
    assert [r["full_text"] for r in found.orderBy("i").collect()] == ["A", "A A", "A A A"] * 3
    tokens = rows.withColumn("tokens", F.split("full_text", " "))
    found = with_mapped_tokens(tokens, phrases.selectExpr("split(synonym, ' ')[0] synonym", "head"), max_literal=0)
    assert [r["tokens"] for r in found.orderBy("i").collect()] == [["A", "B"] * n for n in (1, 2, 3)] * 3


def test_tokens_are_asked_for_once_a_block(spark, monkeypatch):
    asked = _asked_rows(monkeypatch, token_map)
    rows = spark.createDataFrame([(i, ["a", "b", None, "a"] if i % 2 else None) for i in range(100)], "i int, tokens array<string>")
    table = spark.createDataFrame([("b", "B"), ("x", "X")], "synonym string, head string")
    found = with_mapped_tokens(rows.coalesce(1), table, max_literal=0, max_rows=0)
    assert [r["tokens"] for r in found.orderBy("i").collect()] == [None, ["a", "B", None, "a"]] * 50
    assert asked[0] < 10


def test_rows_with_own_words_are_stored_once(spark, monkeypatch):
    written = []
    store = token_map.numbered_rows
    monkeypatch.setattr(token_map, "numbered_rows", lambda *a: written.append(a[1]) or store(*a))
    rows = spark.createDataFrame([("dogs run", 1), (None, 2)], "full_text string, n int")
    rows = rows.withColumn("tokens", F.split("full_text", " "))
    rows, words = with_own_words(rows)
    table = words.select(F.col("word").alias("synonym"), F.upper("word").alias("head"))
    found = with_mapped_tokens(rows, table, max_literal=0, number="_row")
    assert found.columns == ["full_text", "n", "tokens"]
    assert sorted((r["n"], r["tokens"]) for r in found.collect()) == [(1, ["DOGS", "RUN"]), (2, None)]
    assert written == []
