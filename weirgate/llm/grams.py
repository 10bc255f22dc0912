"""Presence of character n-grams, hashed into a fixed number of buckets."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from weirgate.llm import text as tx

BITS = 18
BUCKETS = 1 << BITS
SLICE_BYTES = 2 << 20
_DOCS = 32


class Presence(NamedTuple):
    """Text ``i`` holds the distinct buckets ``buckets[starts[i]:starts[i + 1]]``."""

    buckets: np.ndarray
    starts: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def product(self, weights: np.ndarray) -> np.ndarray:
        """The product of the presence matrix with a matrix of one row per bucket."""
        rows = np.zeros((len(self.starts) - 1, weights.shape[1]))
        for first in range(0, len(rows), _DOCS):  # a block's gathered rows fit in cache and memory
            starts = self.starts[first : first + _DOCS + 1]
            filled = np.flatnonzero(np.diff(starts))
            if len(filled):
                gathered = weights[self.buckets[starts[0] : starts[-1]]]
                rows[first + filled] = np.add.reduceat(gathered, starts[filled] - starts[0], axis=0, dtype=np.float64)
        return rows


def presence(texts: pa.Array, orders: tuple[int, ...]) -> Presence:
    """The n-gram buckets of each text: lower-cased, blanks as one space, a space at both ends.

    Null and blank texts have none.
    """
    plain = [" ".join((t or "").lower().split()) for t in texts.to_pylist()]
    plain = [f" {t} " if t else "" for t in plain]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in plain])]).astype(np.int64)
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    keys = [(tx.window_hashes(codes, n) + np.uint64(n)) >> np.uint64(64 - BITS) for n in orders]
    parts, sizes = [], []
    for first in range(0, len(plain), _DOCS):
        docs = min(_DOCS, len(plain) - first)
        seen = np.zeros(docs << BITS, bool)
        for at in range(docs):
            begin, end = bounds[first + at], bounds[first + at + 1]
            for n, hashed in zip(orders, keys):
                if end - begin >= n:
                    seen[hashed[begin : end - n + 1] + np.uint64(at << BITS)] = True
        found = np.flatnonzero(seen)
        parts.append((found & (BUCKETS - 1)).astype(np.int32))
        sizes.append(np.bincount(found >> BITS, minlength=docs))
    counts = np.concatenate([np.empty(0, np.int64), *sizes])
    return Presence(
        np.concatenate([np.empty(0, np.int32), *parts]), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    )
