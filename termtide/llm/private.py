"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns find mail addresses, IP addresses, card numbers and phone numbers.  The field then
labels every token with a digit or an at sign, whether or not they found any in the document.  Its
potentials are those of the token's shape, of neighbouring tokens, and of *skip links* between distant tokens
that are repeated or similar: of equal letters and digits, of the same last seven digits, or
of the same name before the at sign.  Each is linked to its last such token, so links grow with the
text.  Loopy messages are passed over all links; tokens in a pattern's span keep their
label.  A token outside becomes a span of its own if a label's probability is at least ``SURE``.

The weights of shapes are fitted by softmax regression, those of neighbours and links by counting, on the first
``SAMPLE_CHARS`` characters of the documents of least hash of ``SLICES`` hash classes, of those with a digit or an at
sign; labels are those of the patterns.

Null and empty text has no spans.  Repeated rows are judged each.  Spans are in code points,
ends exclusive.  Further columns of the input are kept by ``with_spans``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import CHUNK_BYTES, bytes_of, runs

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
SURE = 0.9
ROUNDS = 8
EDGES = 8192  # messages that are worked out at once
SLICES = 512
SAMPLE_CHARS = 8192

# The fixed patterns, with the same matches but without going back: a match can only begin where its
# first run of characters does.
_LOCAL = "A-Za-z0-9._%+-"
_MAIL = rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_EMAIL_HERE = re.compile(_MAIL)
_EMAIL = re.compile(rf"(?<![{_LOCAL}]){_MAIL}")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
_DIGIT = re.compile("[0-9]")
_NO_DIGIT = re.compile("[^0-9]")
_EDGES = re.compile(r"^[^\w+(@]+|[^\w)]+$")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        # What follows a match may begin one in the midst of a run.
        found = (at and _EMAIL_HERE.match(text, at)) or _EMAIL.search(text, at)
        if not found:
            return
        yield found.span()
        at = found.end()


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by start and then kind."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m[0].split("."))):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = _NO_DIGIT.sub("", m[0]) if len(m[0]) <= 40 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                    found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


@dataclass
class Tokens:
    """The tokens of one document that may be personal data."""

    spans: list[tuple[int, int]]
    place: list[int]  # number of the token in the text
    label: np.ndarray  # of the pattern's span it is in, or 0
    features: np.ndarray
    links: list[tuple[int, int]]


_N_FEATURES = 16


def _features(token: str, before: str) -> list[float]:
    n_digits = sum(c.isdigit() for c in token)
    n_letters = sum(c.isalpha() for c in token)
    size = max(1, len(token))
    return [
        1.0,
        "@" in token,
        token.count(".") >= 3,
        token.count(".") == 1,
        token.startswith("+"),
        "(" in token,
        "-" in token,
        n_digits <= 2,
        3 <= n_digits <= 6,
        7 <= n_digits <= 13,
        14 <= n_digits <= 19,
        n_digits > 19,
        n_letters == 0,
        "=" in token or ":" in token,
        n_letters / size > 0.3,
        before.startswith("+") or before.endswith(")"),
    ]


def _keys(token: str) -> list[str]:
    plain = re.sub(r"[\W_]+", "", token).lower()
    digits = _NO_DIGIT.sub("", token)
    keys = ["w" + plain] if len(plain) >= 4 else []
    if len(digits) >= 7:
        keys.append("d" + digits[-7:])
    if "@" in token and len(token.split("@")[0]) >= 4:
        keys.append("m" + re.sub(r"[\W_]+", "", token.split("@")[0]).lower())
    return keys


def tokens_of(text: str, base: list[Span]) -> Tokens:
    spans, place, rows, labels, links = [], [], [], [], []
    last: dict[str, int] = {}
    before, at = "", 0
    for number, m in enumerate(_TOKEN.finditer(text)):
        token = m[0]
        if "@" in token or _DIGIT.search(token):
            a, b = m.span()
            while at < len(base) and base[at][1] <= a:
                at += 1
            inside = next((k for x, y, k in base[at : at + 4] if x < b and y > a), "")
            i = len(spans)
            spans.append((a, b))
            place.append(number)
            rows.append(_features(token, before))
            labels.append(LABELS.index(inside))
            for key in _keys(token) + (["m" + re.sub(r"[\W_]+", "", token).lower()] if "@" not in token else []):
                if key in last and last[key] != i:
                    links.append((last[key], i))
                last[key] = i
        before = token
    return Tokens(
        spans,
        place,
        np.array(labels, np.int64),
        np.array(rows, float).reshape(-1, _N_FEATURES),
        sorted(set(links)),
    )


@dataclass
class SkipChain:
    """A skip-chain conditional random field over the labels of tokens."""

    shape: np.ndarray  # feature x label
    neighbour: np.ndarray  # label x label, log
    skip: np.ndarray

    @classmethod
    def fit(cls, texts: list[str]) -> SkipChain:
        docs = [tokens_of(t, base_spans(t)) for t in sorted(texts)]
        n = len(LABELS)
        x = np.concatenate([np.zeros((0, _N_FEATURES)), *(d.features for d in docs)])
        y = np.concatenate([np.zeros(0, np.int64), *(d.label for d in docs)])
        shape = np.zeros((_N_FEATURES, n))
        wanted = np.eye(n)[y]
        for _ in range(300):
            p = _softmax(x @ shape)
            shape += 2.0 * (x.T @ (wanted - p) / max(1, len(x)) - 1e-4 * shape)
        pairs = {"neighbour": np.ones((n, n)), "skip": np.ones((n, n)) + np.eye(n)}
        for d in docs:
            for i in range(len(d.place) - 1):
                if d.place[i + 1] == d.place[i] + 1:
                    pairs["neighbour"][d.label[i], d.label[i + 1]] += 1
            for i, j in d.links:
                pairs["skip"][d.label[i], d.label[j]] += 1
                pairs["skip"][d.label[j], d.label[i]] += 1
        ratio = lambda c: np.log(c * c.sum() / c.sum(1, keepdims=True) / c.sum(0, keepdims=True))
        # Links bind: equal labels are never less likely than e times the independent case.
        skip = ratio(pairs["skip"])
        np.fill_diagonal(skip, np.maximum(np.diag(skip), 1.0) + 2.0)
        return cls(shape, ratio(pairs["neighbour"]), skip)

    def probabilities(self, docs: list[Tokens]) -> np.ndarray:
        """Label probabilities of the tokens of all documents, by loopy message passing."""
        n = len(LABELS)
        first = np.cumsum([0] + [len(d.spans) for d in docs])
        own = np.concatenate([np.zeros((0, n)), *(d.features @ self.shape for d in docs)])
        label = np.concatenate([np.zeros(0, np.int64), *(d.label for d in docs)])
        own = own - own.max(axis=1, keepdims=True) if len(own) else own
        own[label > 0] = -50.0
        own[label > 0, label[label > 0]] = 0.0
        ends, kind = [], []
        for d, start in zip(docs, first):
            near = [i for i in range(len(d.place) - 1) if d.place[i + 1] == d.place[i] + 1]
            ends += [(start + i, start + i + 1) for i in near]
            ends += [(start + i, start + j) for i, j in d.links]
            kind += [0] * len(near) + [1] * len(d.links)
        if not ends:
            return _softmax(own)
        pairs, kind = np.array(ends), np.array(kind)
        source = np.concatenate((pairs[:, 0], pairs[:, 1]))
        target = np.concatenate((pairs[:, 1], pairs[:, 0]))
        table = np.stack((self.neighbour, self.skip, self.neighbour.T, self.skip.T))
        kind = np.concatenate((kind, kind + 2))
        back = np.concatenate((np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))))
        message = np.zeros((len(source), n))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, message)
            new = np.empty_like(message)
            for low in range(0, len(source), EDGES):
                part = slice(low, low + EDGES)
                out = (belief[source[part]] - message[back[part]])[:, :, None] + table[kind[part]]
                top = out.max(axis=1)
                new[part] = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            message = 0.5 * message + 0.5 * (new - new.max(axis=1, keepdims=True))
        belief = own.copy()
        np.add.at(belief, target, message)
        return _softmax(belief)

    def spans(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """All spans of each text: those of the patterns and those of the field."""
        out = [list(b) for b in base]
        docs = [tokens_of(t, b) for t, b in zip(texts, base)]
        p = self.probabilities(docs)
        start = 0
        for i, d in enumerate(docs):
            own = p[start : start + len(d.spans), 1:]
            start += len(d.spans)
            for t in np.flatnonzero((d.label == 0) & (own.max(axis=1, initial=0.0) >= SURE)).tolist():
                kind = KINDS[int(own[t].argmax())]
                a, b = d.spans[t]
                token = texts[i][a:b]
                bare = _EDGES.sub("", token)
                a += token.find(bare)
                if bare:
                    out[i].append((a, a + len(bare), kind))
            out[i].sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if len(x) else x
    return e / e.sum(axis=1, keepdims=True) if len(x) else x


def learn(docs: DataFrame) -> SkipChain:
    """Fit the field on a sample bounded by ``SLICES`` times ``SAMPLE_CHARS`` characters."""
    order = F.xxhash64("doc_id", "text")
    rows = (
        docs.select("doc_id", "text")
        .where(F.col("text").rlike("[0-9@]"))
        .groupBy(F.pmod(order, F.lit(SLICES)).alias("slice"))
        .agg(F.min_by(F.substring("text", 1, SAMPLE_CHARS), order).alias("text"))
        .collect()
    )
    return SkipChain.fit([r["text"] for r in rows])


def _held(texts: pa.Array) -> list[int]:
    """Rows with a digit or an at sign, the only ones with spans."""
    data, starts = bytes_of(texts)
    total = np.concatenate(([0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))))
    return np.flatnonzero(total[starts[1:]] > total[starts[:-1]]).tolist()


def _found(texts: pa.Array, model: SkipChain) -> tuple[list[list[Span]], list[list[Span]]]:
    base: list[list[Span]] = [[] for _ in range(len(texts))]
    spans = list(base)
    for low, high in runs(bytes_of(texts)[1], CHUNK_BYTES // 4):
        held = [low + i for i in _held(texts.slice(low, high - low))]
        some = [texts[i].as_py() for i in held]
        found = [base_spans(t) for t in some]
        for i, b, s in zip(held, found, model.spans(some, found)):
            base[i], spans[i] = b, s
    return base, spans


def find_private(docs: DataFrame, model: SkipChain) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); counts are of the patterns' spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans = _found(batch.column("text"), shared.value)
            counts = [[sum(s[2] == kind for s in b) for b in base] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string()),
                    pa.array([listed(s) for s in spans], pa.string()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, {counts}, base_sha256 string, spans string"
    )


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span, or run of overlapping spans, replaced by the first one's kind."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: SkipChain) -> DataFrame:
    """The documents with their personal data replaced by its kind, and ``n_chars`` to match."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            _, spans = _found(texts, shared.value)
            new = [redact(t, s) if s else t for t, s in zip(texts.to_pylist(), spans)]
            columns = list(batch.columns)
            names = batch.schema.names
            columns[names.index("text")] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars")).cast(kind))
    return out
