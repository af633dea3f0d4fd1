"""Language identification by cross-parsing entropy.

For every language one automaton holds all substrings of a bounded sample of its labelled
text.  A text is parsed by each automaton from left to right into the longest phrases that
occur in the sample; the fewer phrases, the closer the languages.  Counts are multiplied by
the logarithm of the sample's length, the cost of naming a phrase in it, so that samples of
different length can be compared, and the language of the least cost wins; ties go to the
first language by name.  Only letters count: case is folded, and whatever lies between two words is one
blank.

Whole texts are parsed, in blocks of ``BLOCK`` symbols that all end their last phrase, many blocks at once.
The score is the winner's margin over the next language, 0 (a tie) to 1.  Null text and text
without a letter are ``und`` with score 0; so is every text when nothing was learnt.

The sample of a language is bounded: from each of ``SLICES`` hash classes of its documents it takes the document
of the least hash, and of that ``SNIPPET`` characters.  The sample of one language does not depend on the others.  Every
label is learnt; ``LANGUAGES`` of them make one model, and each model is a pass over the documents.  An automaton
whose table of transitions would take more than ``TABLE_BYTES`` (many thousand characters, as Chinese has) is searched in
the sorted list of its transitions instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termtide.llm.common import stored

SLICES = 256
SNIPPET = 128
LANGUAGES = 32
TABLE_BYTES = 16 << 20
BLOCK = 512
UNKNOWN = "und"
CHUNK_CHARS = 1 << 20
_POINTS = 0x110000


def symbols(text: str) -> np.ndarray:
    """Code points of a text: letters in lower case, all else 32, with single blanks."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_LETTER[points], points, 32)
    blank = points == 32
    keep = ~(blank & np.concatenate(([True], blank[:-1])))
    return points[keep]


_LETTER = np.fromiter((chr(i).isalpha() for i in range(_POINTS)), bool, _POINTS)


@dataclass
class Transitions:
    """The transitions of an automaton in order, over the symbols of its own sample."""

    local: np.ndarray  # own symbol of each symbol of the model, 0: not in the sample
    width: int
    moves: np.ndarray  # state * width + symbol
    target: np.ndarray

    def table(self) -> np.ndarray | None:
        """All transitions as a flat table (-1: none), if it is small."""
        size = (int(self.moves[-1]) // self.width + 2) * self.width  # the last state has no transition
        if 4 * size > TABLE_BYTES:
            return None
        table = np.full(size, -1, np.int32)
        table[self.moves] = self.target
        return table

    def of(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        move = state * self.width + symbol
        at = np.minimum(np.searchsorted(self.moves, move), len(self.moves) - 1)
        return np.where(self.moves[at] == move, self.target[at], -1)


class SuffixAutomaton:
    """All substrings of a sequence of small numbers, as the transitions of its states."""

    def __init__(self, sequence: np.ndarray, alphabet: int) -> None:
        moves: list[dict[int, int]] = [{}]
        link, longest, last = [-1], [0], 0
        for symbol in sequence.tolist():
            current = len(moves)
            moves.append({})
            longest.append(longest[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and symbol not in moves[state]:
                moves[state][symbol] = current
                state = link[state]
            if state >= 0:
                target = moves[state][symbol]
                if longest[target] == longest[state] + 1:
                    link[current] = target
                else:  # split off the shorter strings of the target
                    clone = len(moves)
                    moves.append(dict(moves[target]))
                    longest.append(longest[state] + 1)
                    link.append(link[target])
                    while state >= 0 and moves[state].get(symbol) == target:
                        moves[state][symbol] = clone
                        state = link[state]
                    link[target] = link[current] = clone
            last = current
        self.moves, self.alphabet = moves, alphabet

    @property
    def next(self) -> np.ndarray:
        """A table of transitions (-1: none), for a small alphabet."""
        table = np.full((len(self.moves), self.alphabet), -1, np.int32)
        for state, row in enumerate(self.moves):
            for symbol, target in row.items():
                table[state, symbol] = target
        return table

    def transitions(self, local: np.ndarray) -> Transitions:
        move = [s * self.alphabet + x for s, row in enumerate(self.moves) for x in row]
        target = [to for row in self.moves for to in row.values()]
        move, target = np.array(move, np.int64), np.array(target, np.int32)
        order = np.argsort(move)
        return Transitions(local, self.alphabet, move[order], target[order])


@dataclass
class LanguageModel:
    """Automata of the learnt languages over one alphabet."""

    names: list[str]
    alphabet: np.ndarray  # symbol of each code point, 0: not learnt
    tables: list[Transitions | np.ndarray]
    weights: np.ndarray
    flat: dict[int, np.ndarray | None] = field(default_factory=dict)  # made where they are used

    @classmethod
    def fit(cls, samples: dict[str, list[str]]) -> LanguageModel:
        parsed = {
            name: np.concatenate([symbols(" " + t) for t in sorted(texts)] or [np.zeros(0, np.uint32)])
            for name, texts in sorted(samples.items())
        }
        parsed = {name: s for name, s in parsed.items() if (s != 32).any()}
        known = np.unique(np.concatenate(list(parsed.values()))) if parsed else np.zeros(0, np.uint32)
        alphabet = np.zeros(_POINTS, np.int32)
        alphabet[known] = np.arange(1, len(known) + 1)
        tables = []
        for sequence in parsed.values():
            # Symbol 0, what was not learnt, is in no sample, so it is no part of any phrase.
            own = np.unique(alphabet[sequence])
            local = np.zeros(len(known) + 1, np.int32)
            local[own] = np.arange(1, len(own) + 1)
            tables.append(SuffixAutomaton(local[alphabet[sequence]], len(own) + 1).transitions(local))
        weights = np.array([np.log2(len(s) + 1) for s in parsed.values()])
        return cls(list(parsed), alphabet, tables, weights)

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each block (rows of symbols, longest first) by each language."""
        out = np.zeros((len(self.tables), len(blocks)), np.int64)
        alive = np.searchsorted(-lengths, -np.arange(blocks.shape[1]), "left")
        for i, count in enumerate(out):
            columns, flat, width, of = self._table(i, blocks)
            state = np.full(len(blocks), -1, np.int64)
            for j in range(blocks.shape[1]):
                n = alive[j]
                if not n:
                    break
                symbol = columns[j, :n]
                here = state[:n]
                # A state of -1 is behind an unknown symbol: the next phrase begins anew.
                behind = np.maximum(here, 0)
                to = np.where(here >= 0, of(behind, symbol) if flat is None else flat[behind * width + symbol], -1)
                miss = to < 0
                count[:n] += miss
                if flat is None:
                    to[miss] = of(np.zeros(int(miss.sum()), np.int64), symbol[miss])
                    state[:n] = to
                else:
                    state[:n] = np.where(miss, flat[symbol], to)
        return out

    def _table(self, i: int, blocks: np.ndarray):
        """The blocks by column in the symbols of a language; its transitions as a flat table, or a function."""
        table = self.tables[i]
        if isinstance(table, np.ndarray):  # over the symbols of the model
            return np.ascontiguousarray(blocks.T), table.reshape(-1), table.shape[1], None
        if i not in self.flat:
            self.flat[i] = table.table()
        return np.ascontiguousarray(table.local[blocks].T), self.flat[i], table.width, table.of

    def costs(self, texts: list[str | None]) -> np.ndarray:
        """The cost of each text (column) by each language."""
        rows = [self.alphabet[symbols(t or "")] for t in texts]
        n = len(self.names)
        sizes = np.array([len(r) for r in rows])
        n_blocks = -(-sizes // BLOCK)
        flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
        first = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(rows)), n_blocks)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        begin = first[row] + at * BLOCK
        length = np.minimum(BLOCK, first[row] + sizes[row] - begin)
        order = np.argsort(-length, kind="stable")
        index = begin[order][:, None] + np.arange(BLOCK)
        blocks = flat[np.minimum(index, max(len(flat) - 1, 0))] if len(flat) else np.zeros((0, BLOCK), np.int32)
        counts = self.phrases(blocks, length[order])
        cost = np.zeros((n, len(rows)))
        for i in range(n):
            cost[i] = np.bincount(row[order], counts[i], len(rows)) * self.weights[i]
        return cost

    def best(self, texts: list[str | None], before: Best | None = None) -> Best:
        """The two least costs of each text and the language of the least, those of other models included."""
        costs = self.costs(texts) if self.names else np.zeros((0, len(texts)))
        names = np.array([UNKNOWN, *self.names], object)
        first = before or Best([UNKNOWN] * len(texts), *np.full((2, len(texts)), np.inf))
        costs = np.concatenate(([first.cost, first.second], costs))
        at = np.argmin(costs, axis=0)  # of equal costs the first, as names are in order
        ranked = np.sort(costs, axis=0)
        chosen = [first.names[i] if k < 2 else names[k - 1] for i, k in enumerate(at.tolist())]
        return Best(chosen, ranked[0], ranked[1])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.best(texts).judged(texts)


@dataclass
class Best:
    """The least and the second cost of texts over some languages; infinite where there is none."""

    names: list[str]
    cost: np.ndarray
    second: np.ndarray

    def judged(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        known = np.isfinite(self.cost) & np.array([has_letter(t) for t in texts], bool)
        names = [n if ok else UNKNOWN for n, ok in zip(self.names, known)]
        cost = np.where(known, self.cost, 0.0)
        score = np.where(self.second > 0, 1 - cost / np.maximum(self.second, 1e-9), 0.0)
        return names, np.where(known, np.clip(score, 0.0, 1.0), 0.0)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text) if text else False


def held_out(doc_id):
    """Every third document by checksum is kept from learning; a null doc_id is not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def learn(docs: DataFrame) -> list[LanguageModel]:
    """Models of at most ``LANGUAGES`` languages each, by name.

    They are learnt from the labelled documents that are not held out; the sample of a language is bounded by the
    parameters above.
    """
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64("doc_id", "text")
    rows = (
        labelled.groupBy("lang", F.pmod(order, F.lit(SLICES)).alias("slice"))
        .agg(F.min_by(F.substring("text", 1, SNIPPET), order).alias("text"))
        .collect()
    )
    samples: dict[str, list[str]] = {}
    for lang, _, text in rows:
        samples.setdefault(lang, []).append(text)
    names = sorted(samples)
    groups = [names[i : i + LANGUAGES] for i in range(0, len(names), LANGUAGES)]
    return [LanguageModel.fit({n: samples[n] for n in group}) for group in groups]


def identify(docs: DataFrame, models: list[LanguageModel], keep: list[str]) -> DataFrame:
    """(row, lang_pred, score, has_letter) of every document; row holds its columns ``keep``."""
    text = [] if "text" in keep else ["text"]
    rows = docs.select(F.struct(*keep).alias("row"), *text)
    plain = rows.schema
    running = "name string, cost double, second double"
    models = models or [LanguageModel.fit({})]
    for i, model in enumerate(models):
        shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded as the sample is
        last = i + 1 == len(models)
        if last:
            schema = StructType([plain["row"]]).add("lang_pred", "string").add("score", "double").add("has_letter", "boolean")
        else:
            schema = StructType(list(plain.fields) + list(StructType.fromDDL(running).fields))
        rows = rows.mapInArrow(_scorer(shared, "text" in keep, i == 0, last), schema)
        if not last:  # a pass over the documents for each model, so that a worker holds one of them
            rows = stored(rows, f"languages-{i}")
    return rows


def _scorer(shared, inside: bool, first: bool, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            row = batch.column("row")
            texts = row.field("text") if inside else batch.column("text")
            before = None
            if not first:
                names, costs = batch.column("name").to_pylist(), [batch.column(c).to_numpy() for c in ("cost", "second")]
            columns: list[list] = [[], [], [], []]
            held, size = [], 0
            for i, text in enumerate(texts.to_pylist()):
                held.append(text)
                size += len(text or "")
                if size > CHUNK_CHARS or i + 1 == len(texts):
                    if not first:
                        part = slice(i + 1 - len(held), i + 1)
                        before = Best(names[part], *(c[part] for c in costs))
                    best = model.best(held, before)
                    if last:
                        name, score = best.judged(held)
                        done = (name, score.tolist(), [has_letter(t) for t in held])
                    else:
                        done = (best.names, best.cost.tolist(), best.second.tolist())
                    for column, part in zip(columns, done):
                        column += part
                    held, size = [], 0
            kinds = (pa.string(), pa.float64(), pa.bool_() if last else pa.float64())
            found = [pa.array(c, k) for c, k in zip(columns, kinds)]
            if last:
                kept, labels = [row], ["row", "lang_pred", "score", "has_letter"]
            else:
                kept = [row] if inside else [row, texts]
                labels = ["row", *([] if inside else ["text"]), "name", "cost", "second"]
            yield pa.RecordBatch.from_arrays([*kept, *found], names=labels)

    return run
