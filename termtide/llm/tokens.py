"""Token ids of whole texts by a tokenizer file, with the words of a batch encoded once.

Both tokenizers first cut a text into pieces that the merges never cross.  A batch is cut
into such pieces as arrays: runs of Latin letters and runs of ASCII punctuation, each
with the blank before it where the vocabulary keeps blanks.  Distinct pieces go to the
tokenizer's merge model once, and the ids are put together again.  Words with any other character,
and for vocabularies that keep white space every text with unusual white space, are encoded by the
tokenizer as they stand.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from termtide.llm.common import CHUNK_BYTES, bytes_of, runs, span_hashes

# Pieces kept between batches; further ones are encoded again when they come.
CACHE_PIECES = 500_000
CACHED_BYTES = 48
ENCODED_BYTES = CHUNK_BYTES

# Classes of bytes: white space, letters, ASCII punctuation, and what needs the tokenizer itself.
_SPACE, _LETTER, _MARK, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = _MARK
_CLASS[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_CLASS[[0xC3, 0xC4, 0xC5, *range(0x80, 0xC0)]] = _LETTER  # the letters from U+00C0 to U+017F
_NO_LETTERS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))  # two signs, and a capital of two characters
_PLAIN = re.compile(r" ?(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+|[!-&(-/:-@\[-`{-~]+)|[ \n]")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTER_OF = _byte_letters()
_SHOWN = {b: _LETTER_OF[b] for b in (10, 32)}


def shown(text: str) -> str:
    """A text's bytes in the letters of the vocabulary."""
    return "".join(map(_LETTER_OF.__getitem__, text.encode()))


class Encoder:
    """Encodes columns of text by one tokenizer file."""

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.whole.model
        # A tokenizer that normalises drops white space; the other one keeps it with the words.
        self.spaced = self.whole.normalizer is None
        self.known: dict[int, bytes] = {}

    def _piece(self, raw: bytes) -> bytes:
        text = raw.decode()
        if _PLAIN.fullmatch(text):
            text = text if self.spaced else text.lower()
            ids = [t.id for t in self.model.tokenize(text.translate(_SHOWN) if text.isascii() else shown(text))]
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _unusual(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows with white space other than single blanks and line ends between words."""
        blank = (data == 32) | (data == 10)
        odd = (data < 32) & (data != 10)
        # Bytes that may be part of white space beyond ASCII count as such.
        wide = np.isin(data, np.array([0xC2, 0xE1, 0xE2, 0xE3], np.uint8))
        before = blank.copy()
        for back in (1, 2):
            before[back:] |= wide[:-back]
        before[2:] |= wide[:-2]
        touching = blank[1:] & before[:-1] | blank[:-1] & wide[1:]
        row_end = starts[1:-1] - 1
        touching[row_end[(row_end >= 0) & (row_end < len(touching))]] = False
        odd[1:] |= touching
        total = np.concatenate(([0], np.cumsum(odd)))
        return total[starts[1:]] > total[starts[:-1]]

    def _pieces(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of all rows begin and end, in order."""
        kind = _CLASS[data]
        for lead, trail in _NO_LETTERS:
            kind[:-1][(data[:-1] == lead) & (data[1:] == trail)] = _OTHER
        if self.spaced:
            for row in np.flatnonzero(self._unusual(data, starts)):
                kind[starts[row] : starts[row + 1]] = _OTHER
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = True
        solid = kind != _SPACE
        # Words that hold anything unusual are one piece.
        first = solid & np.concatenate(([True], ~solid[:-1])) | solid & edge[:-1]
        word = np.cumsum(first) - 1
        odd = np.zeros(int(word[-1]) + 2 if len(word) else 1, bool)
        odd[word[kind == _OTHER]] = True
        kind = np.where(solid & odd[word], _OTHER, kind)
        change = np.concatenate(([True], kind[1:] != kind[:-1])) | edge[:-1]
        if self.spaced:
            change |= ~solid
        begin = np.flatnonzero(change)
        end = np.concatenate((begin[1:], [len(data)])).astype(np.int64)
        space = ~solid[begin]
        if not self.spaced:
            return begin[~space], end[~space]
        # A blank goes with what follows it in the same row.
        joins = space & (data[begin] == 32)
        joins[:-1] &= ~space[1:] & ~edge[begin[1:]]
        joins[-1:] = False
        begin[1:][joins[:-1]] -= 1
        return begin[~joins], end[~joins]

    def _encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
        begin, end = self._pieces(data, starts)
        hashes, at, code = np.unique(
            span_hashes(data, begin, end), return_index=True, return_inverse=True
        )
        raw, values = data.tobytes(), []
        for key, low, high in zip(hashes.tolist(), begin[at].tolist(), end[at].tolist()):
            ids = self.known.get(key)
            if ids is None:
                ids = self._piece(raw[low:high])
                if high - low <= CACHED_BYTES and len(self.known) < CACHE_PIECES:
                    self.known[key] = ids
            values.append(ids)
        pool = np.frombuffer(b"".join(values), np.uint32)
        length = np.fromiter(map(len, values), np.int64, len(values)) // 4
        n = length[code]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat((np.cumsum(length) - length)[code] - (ends - n), n) + np.arange(total)]
        return ids, np.concatenate(([0], ends))[np.searchsorted(begin, starts)]

    def encode(self, texts: pa.Array, at_once: int = ENCODED_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each row starts; null is empty."""
        data, starts = bytes_of(texts)
        parts, bounds, so_far = [], [np.zeros(1, np.int64)], 0
        for low, high in runs(starts, at_once):
            ids, at = self._encode(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low])
            parts.append(ids)
            bounds.append(at[1:] + so_far)
            so_far += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.concatenate(bounds)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, with what it has learnt of words, kept for the life of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
