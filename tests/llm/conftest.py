from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, row int, part int, size double, digest string, shard int, _id long"
)


def words(seed: int, n: int, syllables: str = "ba be bi lo lu mo na ne sti tra", most: int = 4) -> list[str]:
    rng, parts = random.Random(seed), syllables.split()
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, most))) for _ in range(n)]


def _texts() -> list[str | None]:
    base = words(1, 150)
    passage = " ".join(words(2, 30))
    near = list(base)
    near[70] = "changed"
    far = list(base)
    far[10:140:9] = ["other"] * len(far[10:140:9])
    french = " ".join(words(3, 120, "é ai eau eux tion le que vi"))
    out: list[str | None] = [
        " ".join(base),
        None,
        "",
        " \n\t ",
        "one two",
        "one two",
        " ".join(near),
        " ".join(base),
        " ".join(far),
        french,
        french + " fin",
        "x" * 120_000,
        "12-" * 40_000,
        " ".join(words(4, 20_000)),
        " ".join(words(5, 60)) + " " + passage,
        passage + " " + " ".join(words(6, 60)),
        " ".join(words(7, 40)) + " " + passage + " " + " ".join(words(8, 40)),
        "Mail ann.lee@site.example.com or call +1 (209) 555-2713, again 555-2713 and 209 5552713.",
        "host 10.0.0.255 not 10.0.0.256 card 4539 1488 0343 6467 and 4539148803436468",
        "!!! ... ???",
        "日本語のテキスト と 空白　です",
        "a b c\r\nd\te  f",
        "nul \x00 inside \x01 and \x02",
    ]
    out += [" ".join(words(100 + i, 30 + 7 * i)) for i in range(30)]
    return out


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Documents with nulls, empty and very long texts, ties, repeated rows."""
    rows = []
    for i, text in enumerate(_texts()):
        lang = None if i % 7 == 3 else ("fr" if text and "é" in text else "en")
        source = None if i % 11 == 5 else f"s{i % 5}"
        n = None if i % 13 == 4 else len(text or "")
        rows.append((i * 3, text, lang, source, n, "k", i, None, 0.5, "d", 1, None))
    rows.append((None, "a row without a number, of its own text", "en", "s1", 3, *[None] * 7))
    rows += [rows[0], rows[14]]  # repeated rows
    random.Random(3).shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows as a table with columns whose names the operators use themselves."""
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
