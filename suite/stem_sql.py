"""The stemmers' steps as SQL: a chain of tables (word, w, regions), one for each step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from termtide.functions import stems as rules


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values: Sequence[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


class Chain:
    """Steps that each read the one before."""

    def __init__(self, first: str) -> None:
        self.parts = [f"s0 AS ({first})"]

    def add(self, columns: str) -> None:
        n = len(self.parts)
        self.parts.append(f"s{n} AS (SELECT {columns} FROM s{n - 1})")

    def ending(self, endings: Sequence[str], of: str = "w") -> None:
        pattern = q("(?:" + "|".join(endings) + ")$")
        self.add(f"* EXCLUDE (e, s), regexp_extract({of}, {pattern}) AS e, w AS s")
        self.add("* EXCLUDE (s), left(w, length(w) - length(e)) AS s")

    def becomes(self, w: str) -> None:
        self.add(f"* EXCLUDE (w), {w} AS w")

    def select(self, columns: str) -> str:
        return ", ".join(self.parts) + f" SELECT {columns} FROM s{len(self.parts) - 1}"


def within(region: str, word: str = "w", ending: str = "e") -> str:
    return f"({ending} <> '' AND length({word}) - length({ending}) >= {region})"


def region(word: str, pattern: str, skipped: int = 0) -> str:
    found = f"regexp_extract({word}, {q('^' + '.' * skipped + '.*?' + pattern)})"
    return f"CASE WHEN {found} <> '' THEN length({found}) ELSE length({word}) END"


def rewritten(table: Mapping[str, str]) -> str:
    return "CASE e " + " ".join(f"WHEN {q(a)} THEN s || {q(b)}" for a, b in table.items()) + " ELSE w END"


V, C = "[aeiouy]", "[^aeiouy]"
SHORT = q(rf"(?:{C}{V}[^aeiouwxyY]|^{V}{C})$")


def english(words: str) -> str:
    """From a table expression with a column ``word``."""
    plain = "regexp_replace(translate(lower(word), '‘’‛', repeat(chr(39), 3)), '^' || chr(39), '')"
    chain = Chain(
        rf"SELECT word, regexp_replace({plain}, '(^|{V})y', '\1Y', 'g') AS w, '' AS e, '' AS s FROM {words}"
    )
    special = "regexp_extract(w, '^(?:gener|commun|arsen)')"
    chain.add(f"*, CASE WHEN {special} <> '' THEN length({special}) ELSE {region('w', V + C)} END AS r1")
    chain.add("*, substr(w, r1 + 1) AS rest")
    chain.add(f"* EXCLUDE (rest), r1 + {region('rest', V + C)} AS r2")
    chain.ending(["'", "'s", "'s'"])
    chain.becomes("s")
    chain.ending(["sses", "ied", "ies", "us", "ss", "s"])
    chain.becomes(
        f"""CASE e WHEN 'sses' THEN s || 'ss'
        WHEN 'ied' THEN s || CASE WHEN length(s) > 1 THEN 'i' ELSE 'ie' END
        WHEN 'ies' THEN s || CASE WHEN length(s) > 1 THEN 'i' ELSE 'ie' END
        WHEN 's' THEN CASE WHEN regexp_matches(s, '{V}.+$') THEN s ELSE w END ELSE w END"""
    )
    chain.add(f"*, CASE WHEN w IN {listed(rules._EN_KEPT)} THEN w END AS kept")
    chain.ending(["eed", "eedly", "ed", "edly", "ing", "ingly"])
    chain.becomes(
        f"""CASE WHEN e IN ('eed', 'eedly') THEN CASE WHEN {within('r1')} THEN s || 'ee' ELSE w END
        WHEN e = '' OR NOT regexp_matches(s, '{V}') THEN w
        WHEN regexp_matches(s, '(?:at|bl|iz)$') THEN s || 'e'
        WHEN regexp_matches(s, '(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(s, length(s) - 1)
        WHEN length(s) <= r1 AND regexp_matches(s, {SHORT}) THEN s || 'e' ELSE s END"""
    )
    chain.becomes(rf"regexp_replace(w, '(.{C})[yY]$', '\1i')")
    chain.ending(list(rules._EN_STEP_2))
    chain.becomes(
        f"""CASE WHEN NOT {within('r1')} OR (e = 'ogi' AND NOT ends_with(s, 'l'))
        OR (e = 'li' AND NOT regexp_matches(s, '[cdeghkmnrt]$')) THEN w ELSE {rewritten(rules._EN_STEP_2)} END"""
    )
    chain.ending(list(rules._EN_STEP_3))
    chain.becomes(
        f"CASE WHEN NOT {within('r1')} OR (e = 'ative' AND NOT {within('r2')}) THEN w ELSE {rewritten(rules._EN_STEP_3)} END"
    )
    chain.ending(rules._EN_STEP_4)
    chain.becomes(f"CASE WHEN {within('r2')} AND (e <> 'ion' OR regexp_matches(s, '[st]$')) THEN s ELSE w END")
    chain.ending(["e", "l"])
    chain.becomes(
        f"""CASE WHEN e = 'e' AND ({within('r2')} OR ({within('r1')} AND NOT regexp_matches(s, {SHORT}))) THEN s
        WHEN e = 'l' AND {within('r2')} AND ends_with(s, 'l') THEN s ELSE w END"""
    )
    whole = "CASE lower(word) " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in rules._EN_WHOLE.items()) + " END"
    return chain.select(
        f"word, CASE WHEN length(word) <= 2 THEN lower(word) "
        f"ELSE coalesce({whole}, translate(coalesce(kept, w), 'Y', 'y')) END AS stem"
    )


EV, EC = "[aeiouáéíóúü]", "[^aeiouáéíóúü]"


def without(word: str, endings: Sequence[str], region: str) -> str:
    found = f"regexp_extract({word}, {q('(?:' + '|'.join(endings) + ')$')})"
    return (
        f"CASE WHEN {found} <> '' AND length({word}) - length({found}) >= {region} "
        f"THEN left({word}, length({word}) - length({found})) ELSE {word} END"
    )


def spanish(words: str) -> str:
    chain = Chain(f"SELECT word, lower(word) AS w, '' AS e, '' AS s FROM {words}")
    chain.add(
        f"""*, CASE WHEN regexp_matches(w, '^.{EC}') THEN {region('w', EV, 2)}
        WHEN regexp_matches(w, '^{EV}{EV}') THEN {region('w', EC, 2)} ELSE least(3, length(w)) END AS rv,
        {region('w', EV + EC)} AS r1"""
    )
    chain.add("*, substr(w, r1 + 1) AS rest")
    chain.add(f"* EXCLUDE (rest), r1 + {region('rest', EV + EC)} AS r2")
    chain.ending(rules._ES_PRONOUNS)
    chain.add("*, regexp_extract(s, '(?:i[ée]ndo|[áa]ndo|[áaéeíi]r|yendo)$') AS g")
    chain.becomes(
        f"""CASE WHEN e <> '' AND {within('rv', 's', 'g')} AND (g <> 'yendo' OR ends_with(s, 'uyendo'))
        THEN left(s, length(s) - length(g)) || translate(g, 'áéí', 'aei') ELSE w END"""
    )
    chain.add("*, w AS before")
    chain.ending(
        [*rules._ES_DELETED, *rules._ES_AFTER_IC]
        + "logía logías ución uciones encia encias amente mente idad idades iva ivo ivas ivos".split()
    )
    chain.add(f"*, {without('s', ['iv'], 'r2')} AS no_iv")
    chain.becomes(
        f"""CASE WHEN e = 'amente' THEN CASE WHEN NOT {within('r1')} THEN w
          WHEN ends_with(s, 'iv') THEN CASE WHEN no_iv = s THEN s ELSE {without('no_iv', ['at'], 'r2')} END
          ELSE {without('s', ['os', 'ic', 'ad'], 'r2')} END
        WHEN NOT {within('r2')} THEN w
        WHEN e IN {listed(rules._ES_DELETED)} THEN s
        WHEN e IN {listed(rules._ES_AFTER_IC)} THEN {without('s', ['ic'], 'r2')}
        WHEN e IN ('logía', 'logías') THEN s || 'log'
        WHEN e IN ('ución', 'uciones') THEN s || 'u'
        WHEN e IN ('encia', 'encias') THEN s || 'ente'
        WHEN e = 'mente' THEN {without('s', ['ante', 'able', 'ible'], 'r2')}
        WHEN e IN ('idad', 'idades') THEN {without('s', ['abil', 'ic', 'iv'], 'r2')}
        ELSE {without('s', ['at'], 'r2')} END"""
    )
    chain.add("*, w <> before AS done")
    chain.ending(rules._ES_Y_VERBS, "substr(w, rv + 1)")
    chain.add(
        "* EXCLUDE (w, done), CASE WHEN NOT done AND e <> '' AND ends_with(s, 'u') THEN s ELSE w END AS w, "
        "done OR (e <> '' AND ends_with(s, 'u')) AS done"
    )
    chain.ending([*rules._ES_VERBS, *rules._ES_GU_VERBS], "substr(w, rv + 1)")
    chain.becomes(
        f"""CASE WHEN done OR e = '' THEN w
        WHEN e IN {listed(rules._ES_GU_VERBS)} AND ends_with(s, 'gu') THEN left(s, length(s) - 1) ELSE s END"""
    )
    chain.ending(["os", "a", "o", "á", "í", "ó", "e", "é"])
    chain.becomes(
        f"""CASE WHEN NOT {within('rv')} THEN w
        WHEN e IN ('e', 'é') AND ends_with(s, 'gu') AND length(s) - 1 >= rv THEN left(s, length(s) - 1) ELSE s END"""
    )
    return chain.select("word, translate(w, 'áéíóú', 'aeiou') AS stem")
