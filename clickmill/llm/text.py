"""Word, line and character counts of Arrow text batches, as whole-batch array work.

A word is a run of characters other than the ASCII white space 0x20 and 0x09 to 0x0D. Texts
are handled as UTF-8 bytes: all these separators are single bytes, so word borders, equality
and lengths can be read from the bytes. Nothing here loops over words in Python.

Null texts count as empty. Identity of words, lines and shingles is that of a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes that one round of array work takes, unless one text alone is longer.
CHUNK_BYTES = 1 << 19

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
NEWLINE = 0x0A

_RNG = np.random.default_rng(20240229)
_BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SEQUENCE_CODE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers = np.ones(1, dtype=np.uint64)
_inverse_powers = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        bases = np.full(size, _BASE, dtype=np.uint64)
        inverses = np.full(size, _BASE_INVERSE, dtype=np.uint64)
        bases[0] = inverses[0] = 1
        _powers, _inverse_powers = np.cumprod(bases), np.cumprod(inverses)
    return _powers, _inverse_powers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the offsets of each; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[slice, Texts]]:
    """Rows of a column in pieces of bounded bytes; a longer text is a piece of its own.

    Only the rows of a piece are copied, not the column.
    """
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(column) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield slice(first, last), Texts(*utf8(column.slice(first, last - first)))
        first = last


def run_sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive borders; empty runs give 0."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[borders[1:]] - total[borders[:-1]]


class Texts:
    """Words and lines of a few texts that lie one after another in a byte array."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        self.n = len(offsets) - 1
        inside = ~SEPARATOR[self.data]
        border = np.zeros(len(self.data) + 1, dtype=bool)
        border[offsets] = True
        self.inside = inside
        before = np.empty_like(inside)
        before[:1] = True
        before[1:] = ~inside[:-1]
        after = np.empty_like(inside)
        after[-1:] = True
        after[:-1] = ~inside[1:]
        self.starts = np.flatnonzero(inside & (before | border[:-1]))
        self.ends = np.flatnonzero(inside & (after | border[1:])) + 1
        # Word borders of each text: its words are first_word[i] to first_word[i + 1].
        self.first_word = np.searchsorted(self.starts, offsets)
        self.n_words = np.diff(self.first_word)
        self._prefix: np.ndarray | None = None
        self._words: np.ndarray | None = None

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each span."""
        powers, inverse = _power_tables(len(self.data) + 1)
        if self._prefix is None:
            self._prefix = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODE[self.data] * powers[: len(self.data)], out=self._prefix[1:])
        value = (self._prefix[ends] - self._prefix[starts]) * inverse[starts]
        return mix(value + (ends - starts).astype(np.uint64))

    @property
    def words(self) -> np.ndarray:
        if self._words is None:
            self._words = self.spans(self.starts, self.ends)
        return self._words

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of ``size`` consecutive words from each word, and whether they are one text's."""
        words = self.words
        n = max(len(words) - size + 1, 0)
        value = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            value += words[i : i + n] * _SEQUENCE_CODE[i]
        text = self.text_of_word()
        return mix(value), text[:n] == text[size - 1 : size - 1 + n]

    def shingle_sets(self, size: int) -> list[np.ndarray]:
        """Sorted distinct ``size``-word shingles of each text.

        A text of fewer words has its whole word sequence as its only shingle; one without
        words has none.
        """
        values, _ = self.windows(size)
        empty = np.zeros(0, dtype=np.uint64)
        sets = []
        for first, n in zip(self.first_word[:-1].tolist(), self.n_words.tolist(), strict=True):
            if n >= size:
                run = np.sort(values[first : first + n - size + 1])
                keep = np.empty(len(run), dtype=bool)
                keep[0] = True
                np.not_equal(run[1:], run[:-1], out=keep[1:])
                sets.append(run[keep])
            elif n:
                own = self.words[first : first + n] * _SEQUENCE_CODE[:n]
                own[:1] += _SEQUENCE_CODE[32 + n]
                sets.append(mix(own.sum(dtype=np.uint64, keepdims=True)))
            else:
                sets.append(empty)
        return sets

    def count(self, table: np.ndarray) -> np.ndarray:
        """Bytes of each text that a 256-entry table marks."""
        return run_sums(table[self.data], self.offsets)

    def word_chars(self) -> np.ndarray:
        """Code points inside words: bytes of words that do not continue a character."""
        return run_sums(self.inside & ((self.data & 0xC0) != 0x80), self.offsets)

    def repeated_words(self, size: int = 3) -> np.ndarray:
        """Words that lie in a ``size``-word window found twice or more in their text."""
        values, whole = self.windows(size)
        n_words = len(self.words)
        if not whole.any():
            return np.zeros(self.n, dtype=np.int64)
        text = self.text_of_word()
        at = np.flatnonzero(whole)
        keys = mix(values[at] ^ mix(text[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(keys)
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        hits = at[twice]
        opened = np.bincount(hits, minlength=n_words + 1)
        closed = np.bincount(hits + size, minlength=n_words + 1)
        return run_sums(np.cumsum(opened - closed)[:n_words] > 0, self.first_word)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the newline-split lines that hold a word, and their texts."""
        cuts = np.flatnonzero(self.data == NEWLINE)
        starts = np.unique(np.concatenate([self.offsets[:-1], cuts + 1]))
        starts = starts[starts < len(self.data)]
        ends = np.append(starts, len(self.data))[1:]
        # A line ends before its newline, unless the text ends it.
        ends = ends - (self.data[ends - 1] == NEWLINE)
        worded = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        starts, ends = starts[worded], ends[worded]
        return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1

    def duplicate_lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those among them that equal an earlier line, per text."""
        starts, ends, text = self.lines()
        lines = np.bincount(text, minlength=self.n)
        keys = mix(self.spans(starts, ends) ^ mix(text.astype(np.uint64) + np.uint64(1)))
        _, first = np.unique(keys, return_index=True)
        distinct = np.bincount(text[first], minlength=self.n)
        return lines, lines - distinct

    def code_points(self) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all texts and the offsets of each text among them."""
        points = np.frombuffer(
            self.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"),
            dtype=np.uint32,
        )
        lead = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=lead[1:])
        return points, lead[self.offsets]
