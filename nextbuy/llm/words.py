"""Words and word hashes of whole Arrow text columns, as NumPy arrays.

Several operators look at the same words, ``[^\\x20\\x09-\\x0D]+``.  In UTF-8
that class never cuts a character, so words are found on the bytes of the
Arrow buffer, without a Python string per word.  Texts are worked off in
blocks of a few MB; a longer text is cut between words, so memory stays
bounded by the block (or by one word, should a word be longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def _base_powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 64), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown)
    return _powers


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of documents ``first`` .. ``first + n_docs - 1`` of a column, in text order.

    ``bounds[d] .. bounds[d + 1]`` are the words of the d-th of them;
    ``starts`` and ``ends`` point into ``data``, the column's UTF-8 bytes.
    """

    first: int
    n_docs: int
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset:] \
        if offsets is not None and offsets.size else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs


def _cut(data: np.ndarray, lo: int, hi: int) -> int:
    """Where to end a block that begins at ``lo`` inside a text that ends at ``hi``."""
    at = lo + BLOCK_BYTES
    while at < hi:
        white = np.flatnonzero(_WHITE[data[at:min(at + 65536, hi)]])
        if len(white):
            return at + int(white[0]) + 1
        at += 65536
    return hi


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(first text, one past the last, byte ranges): several texts in one range, or one text in several."""
    d, n = 0, len(offsets) - 1
    while d < n:
        end = int(np.searchsorted(offsets, offsets[d] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, d + 1), n)
        lo, hi = int(offsets[d]), int(offsets[end])
        ranges = []
        while end == d + 1 and hi - lo > BLOCK_BYTES:
            cut = _cut(data, lo, hi)
            ranges.append((lo, cut))
            lo = cut
        ranges.append((lo, hi))
        yield d, end, ranges
        d = end


def split_words(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Words of every text of the column, block by block; ``lower`` folds A-Z before hashing."""
    data, offsets = text_bytes(column)
    for d, end, ranges in _blocks(data, offsets):
        hashes, starts, ends = [], [], []
        inner = offsets[d:end]
        for lo, hi in ranges:
            part = data[lo:hi]
            word = ~_WHITE[part]
            before = np.empty_like(word)
            before[:1] = False
            before[1:] = word[:-1]
            cuts = inner[(inner > lo) & (inner < hi)] - lo
            before[cuts] = False
            first = np.flatnonzero(word & ~before)
            if not len(first):
                continue
            inside = np.flatnonzero(word)
            at = np.searchsorted(inside, first)
            length = np.diff(np.append(at, len(inside)))
            pos = np.arange(len(inside)) - np.repeat(at, length)
            text = _FOLD[part[inside]] if lower else part[inside]
            terms = _BYTE[text]
            terms *= _base_powers(int(length.max()))[pos]
            hashes.append(mix64(np.add.reduceat(terms, at) + length.astype(np.uint64)))
            starts.append(first + lo)
            ends.append(first + length + lo)
        empty = np.zeros(0, np.int64)
        s = np.concatenate(starts) if starts else empty
        yield Words(d, end - d, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), s,
                    np.concatenate(ends) if ends else empty,
                    np.searchsorted(s, np.append(inner, offsets[end])), data, offsets)


_MULT = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(hashes: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes (at most 64), by first word; of those at ``at`` if given."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n if at is None else len(at), width, np.uint64)
    for k in range(width):
        total += mix64((hashes[k:k + n] if at is None else hashes[at + k]) + _MULT[k]) * _MULT[k]
    return mix64(total)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of non-empty byte spans, in any order; a word's span hashes as ``split_words`` hashes it."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    at = np.concatenate([[0], np.cumsum(length)[:-1]])
    pos = np.arange(int(length.sum())) - np.repeat(at, length)
    text = data[np.repeat(starts, length) + pos]
    terms = _BYTE[_FOLD[text] if lower else text]
    terms *= _base_powers(int(length.max()))[pos]
    return mix64(np.add.reduceat(terms, at) + length.astype(np.uint64))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    ranked = np.sort(values)
    return ranked[np.append(True, ranked[1:] != ranked[:-1])] if len(ranked) else ranked


def count_words(column: pa.Array) -> np.ndarray:
    """Words of each text of a column."""
    data, offsets = text_bytes(column)
    out = np.zeros(len(offsets) - 1, np.int64)
    for d, end, ranges in _blocks(data, offsets):
        for lo, hi in ranges:
            word = ~_WHITE[data[lo:hi]]
            first = word.copy()
            first[1:] &= ~word[:-1]
            starts = offsets[d:end]
            inside = starts[(starts >= lo) & (starts < hi)] - lo
            first[inside] = word[inside]
            at = np.flatnonzero(first) + lo
            out[d:end] += np.diff(np.searchsorted(at, offsets[d:end + 1]))
    return out
