"""Words and word shingles of many texts at once, as 64-bit numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from almanac.llm.common import mixed

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Bytes of text worked on at once: their signatures take some fifty times as much for a moment.
GROUP_BYTES = 1 << 18
WIDTH = 4


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a batch of texts with about `most` bytes; a longer text is a slice of its own."""
    sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield first, texts.slice(first, i - first)
            first, total = i, 0
        total += int(size)
    if len(texts) > first:
        yield first, texts.slice(first)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts one after the other, and where each begins; nulls are empty."""
    texts = pa.concat_arrays([texts.fill_null("").cast(pa.string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, with A-Z lowered, and the number of words of each text."""
    data, offsets = raw(texts)
    n = len(data)
    counts = np.zeros(len(texts), np.int64)
    if not n:
        return np.zeros(0, np.uint64), counts
    space = _SPACE[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | border[:n]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    ends = np.flatnonzero(~space & (after | border[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * powers(n, _BASE)[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(n, _INVERSE)[starts]
    value = mixed(value + (ends - starts).astype(np.uint64) * _PLACES[0])
    text = np.searchsorted(offsets, starts, side="right") - 1
    return value, np.bincount(text, minlength=len(texts))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its word shingles.

    A text with fewer words than `width` has one shingle of all its words; one without has none.
    """
    hashes, counts = word_hashes(texts)
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64) * _PLACES[1]) | _U(1)
    at = 0
    for n in counts:
        own = hashes[at : at + n]
        at += n
        if n == 0:
            yield own
            continue
        take = min(width, int(n))
        total = np.full(n - take + 1, _U(take * int(_PLACES[2]) & (1 << 64) - 1), np.uint64)
        for k in range(take):
            total += own[k : n - take + 1 + k] * factors[k]
        yield np.unique(mixed(total))
