"""Words, windows and hashes of whole texts, one slice of Arrow rows at a time.

Words are runs of anything but the six ASCII blanks.  Memory follows the slice (a few MB of text, or
one text where that is longer), never the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
FACTOR = np.uint64(0x9E3779B97F4A7C15)  # an odd constant for multiplicative hashing


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each piece holds about ``limit`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(piece, prepend=-1))
        for first, last in zip(cuts, [*cuts[1:], batch.num_rows]):
            yield batch.slice(first, last - first)


class Words(NamedTuple):
    """``ids`` into ``distinct`` for every word; text ``i`` has the words ``starts[i]:starts[i + 1]``."""

    ids: np.ndarray
    distinct: pa.Array
    starts: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts())


def words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of each text; a null has none.  ``lower`` maps A-Z only."""
    filled = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(filled) if lower else filled)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    encoded = flat.filter(real).dictionary_encode()
    counts = np.bincount(parents.filter(real).to_numpy(zero_copy_only=False), minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return Words(encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary, starts)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all 64 bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(29))
    return values * FACTOR


def hash_strings(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    if not len(strings):
        return np.empty(0, np.uint64)
    return mix(pd.util.hash_array(np.array(strings.to_pylist(), dtype=object), categorize=False))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` neighbouring values."""
    if len(values) < width:
        return np.empty(0, np.uint64)
    count = len(values) - width + 1
    total, done = np.zeros(count, np.uint64), 0
    runs, size, factor = values, 1, int(FACTOR)  # of runs of twice the size each time, those that add up to the width
    while size <= width:
        if width & size:
            total = total * np.uint64(factor) + runs[done : done + count]
            done += size
        if 2 * size <= width:
            runs = runs[:-size] * np.uint64(factor) + runs[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """The values, sorted, each once.  ``np.unique`` hashes before it sorts, which takes many times as long."""
    ordered = np.sort(values)
    fresh = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    return ordered[fresh]


def word_shingles(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its lower-cased word windows.

    A text with fewer words than ``width`` has its whole sequence as its one window; one without
    words has none.
    """
    found = words(texts, lower=True)
    hashed = hash_strings(found.distinct)[found.ids] if len(found.ids) else np.empty(0, np.uint64)
    windows = window_hashes(hashed, width)
    sets = []
    for first, last in zip(found.starts[:-1], found.starts[1:]):
        if last - first >= width:
            sets.append(distinct(windows[first : last - width + 1]))
        elif last > first:
            sets.append(window_hashes(hashed[first:last], last - first) ^ np.uint64(last - first))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def one_permutation(shingles: np.ndarray, bins: int) -> np.ndarray:
    """MinHash values from one pass: the least hash of each bin, a power of two of them; empty bins take
    the value of the next filled one."""
    if not len(shingles):
        return np.zeros(bins, np.uint64)
    spread = np.sort(mix(shingles))
    of_bin = (spread >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(of_bin, prepend=-1))
    filled = of_bin[first]
    at = np.searchsorted(filled, np.arange(bins))
    return spread[first[at % len(filled)]]


def one_permutation_rows(shingles: np.ndarray, sizes: np.ndarray, bins: int) -> np.ndarray:
    """``one_permutation`` of many small sets that lie one after the other: a row of ``bins`` values for each."""
    spread = mix(shingles)
    of_bin = (spread >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    least = np.full(len(sizes) * bins, _EMPTY, np.uint64)
    np.minimum.at(least, np.repeat(np.arange(len(sizes)) * bins, sizes) + of_bin, spread)
    least = least.reshape(-1, bins)
    places = np.where(least == _EMPTY, 2 * bins, np.arange(bins))
    after = np.minimum.accumulate(places[:, ::-1], axis=1)[:, ::-1]
    after = np.where(after == 2 * bins, places.min(axis=1, keepdims=True), after)  # past the last filled bin: the first
    after[np.asarray(sizes) == 0] = 0
    found = np.take_along_axis(least, after, axis=1)
    found[np.asarray(sizes) == 0] = 0
    return found


def odd_sketch(elements: np.ndarray, of_row: np.ndarray, rows: int, longs: int) -> np.ndarray:
    """For each row, which of ``64 * longs`` places an odd number of its distinct elements fall on, as longs."""
    bits = 64 * longs
    at = (mix(elements) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(of_row * bits + at, minlength=rows * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(rows, bits), axis=1).view(np.int64)


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, nulls as empty, and where each begins."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    filled = pa.concat_arrays([filled])
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def sums_between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between neighbouring offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])
