"""Words of whole Arrow text columns as numpy arrays: where they stand, and 64-bit hashes.

Texts are taken as their UTF-8 bytes. A class of bytes makes up words; every byte of a non-ASCII
character is above 0x7F, so a class that treats all non-ASCII characters alike can be told byte
by byte. Hashes are polynomials modulo 2**64, mixed; equal words have equal hashes, different
words differ but for a chance of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text that are turned into arrays at a time; a longer text is taken alone.
PIECE = 1 << 20

_U = np.uint64


def _class(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


# Words as runs of anything but ASCII white space.
SPACED = _class([0x20, *range(0x09, 0x0E)])
# Words as runs of ASCII letters and digits and everything beyond ASCII.
LETTERS = _class([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_KEEP = np.arange(256, dtype=np.uint8)

# For bytes.translate: lower case, and a blank for every byte that is in no word.
LETTERS_BLANKED = bytes(int(_FOLD[b]) if LETTERS[b] else 0x20 for b in range(256))

_BYTE, _BYTE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_WORD, _WORD_INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)


class Words(NamedTuple):
    """Words of some texts in order: hash, first byte, end; text i has words first[i]:first[i+1]."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


class _Powers:
    """Powers of a multiplier and of its inverse, as many as were ever asked for."""

    def __init__(self, base: int, inverse: int):
        self.base, self.inverse = base, inverse
        self.up = self.down = np.ones(1, dtype=_U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                row = np.full(n + n // 4, base, dtype=_U)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up[:n], self.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all their bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, and where each text starts; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes each, one text at least."""
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = max(high, low + 1)
        yield low, high
        low = high


class Splitter:
    """Cuts texts into words; keeps the tables it needs from one piece to the next."""

    def __init__(self, kind: np.ndarray, fold: bool):
        self.kind, self.letters = kind, _FOLD if fold else _KEEP
        self.bytes, self.words = _Powers(_BYTE, _BYTE_INVERSE), _Powers(_WORD, _WORD_INVERSE)

    def split(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """Words of texts that lie one behind the other in ``data``, from ``offsets[0]`` on."""
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        n = len(data)
        inside = self.kind[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[(offsets < n) & (offsets >= 0)]
        begins[edges] = inside[edges]  # a text starts afresh
        edges = edges[edges > 0] - 1
        ends[edges] = inside[edges]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = self.bytes(n + 1)
        sums = np.zeros(n + 1, dtype=_U)
        np.cumsum((self.letters[data].astype(_U) + _U(1)) * up[:n], out=sums[1:])
        return Words(mix((sums[end] - sums[start]) * down[start]), start, end, np.searchsorted(start, offsets))

    def grams(self, words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every k words in a row of one text, and the number of each first word."""
        n = len(words.hash)
        if n < k:
            return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
        up, down = self.words(n + 1)
        sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(words.hash * up[:n], out=sums[1:])
        text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        at = np.flatnonzero(text[k - 1 :] == text[: n - k + 1])
        return mix((sums[at + k] - sums[at]) * down[at]), at


def fast_split(text: str | None) -> list[bytes]:
    """Words of letters and digits of one text, lower case, as bytes."""
    return [] if text is None else text.encode().translate(LETTERS_BLANKED).split()
