"""Benchmark decontamination: passages of a document within a small edit distance of a benchmark item.

Items are embedded by random walks: each step writes a character and a coin, drawn from step and character, says
whether the walk moves on, so walks over an item and over a passage with few edits soon run side by side (CGK).  Of
each of ``WALKS`` walks, which cover the whole item, ``TABLES`` samples of ``BITS`` steps are keys; a place in a text
whose walk has an item's key is a candidate, confirmed by its exact edit distance, at most ``EDITS`` of the item's
length.

What the walks part is found exactly.  An item that may suffer ``k`` edits is cut into ``k + 1`` pieces; a passage
within ``k`` edits holds at least one of them unchanged, moved by ``k`` characters at most.  Wherever a text holds a
piece, at any character, the stretch that a passage around it can cover is confirmed likewise.  Where only clean
documents are wanted, this is asked of the texts in which the walks found nothing.

Two counts that lose nothing keep most stretches from that: a passage of an item of ``n`` characters holds at least
n - q + 1 - kq of its q-grams, so a stretch with fewer grams, first of any item and then of this one, holds none.

Texts and items are compared lower-cased, blanks as one space.  Items of fewer than ``SHORTEST`` characters, and null
ones, are too short to tell and are not looked for; null and empty texts hold nothing.  Rows repeated under one id
are searched one by one; an item found twice in a text is reported once, at its nearest and then first place.  Empty
tables give empty results.  Other columns pass through.  Texts are searched whole.  Items are taken in blocks of
bounded size, each against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm import text as tx

EDITS = 0.05
SHORTEST = 32
GRAM = 12  # no piece is shorter: 13 at least, of items of 40 characters
BLOCK_CHARS = 4 << 20
SLICE_BYTES = 2 << 20
PAIRS = 1 << 20
WALKS = 4
TABLES = 8
BITS = 8
STARTS = 1 << 16
_MESH_BITS = 24


class Hit(NamedTuple):
    """``start`` and ``end`` count characters of the text with its blanks as one space."""

    item_id: int
    start: int
    end: int
    distance: int


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def best_match(item: str, text: str, limit: int) -> tuple[int, int] | None:
    """The least edit distance of the item to any stretch of the text, if within the limit, and where that ends.

    Columns of the dynamic programme are kept as bit vectors of vertical differences.
    """
    size = len(item)
    ones, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = {}
    for at, character in enumerate(item):
        where[character] = where.get(character, 0) | 1 << at
    rising, falling, score, best = ones, 0, size, (limit + 1, 0)
    for at, character in enumerate(text):
        equal = where.get(character, 0)
        diagonal = (((equal & rising) + rising) ^ rising) | equal | falling
        up, down = falling | ~(diagonal | rising) & ones, rising & diagonal
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & ones, (down << 1) & ones
        rising, falling = down | ~(diagonal | up) & ones, up & diagonal
        if score < best[0]:
            best = (score, at + 1)
            if not score:
                break
    return best if best[0] <= limit else None


def walked(codes: np.ndarray, starts: np.ndarray, walk: int, samples: np.ndarray) -> np.ndarray:
    """For each sample of steps and each start the key of the characters that a walk over ``codes`` has there."""
    at, last = starts.copy(), len(codes) - 1
    keys = np.zeros((len(samples), len(starts)), np.uint64)
    asked: dict[int, list[int]] = {}
    for sample, steps in enumerate(samples.tolist()):
        for step in steps:
            asked.setdefault(step, []).append(sample)
    coins = tx.mix(np.arange(1, samples.max() + 2, dtype=np.uint64) + (np.uint64(walk + 1) << np.uint64(32))) | np.uint64(1)
    for step, coin in enumerate(coins):
        here = codes[np.minimum(at, last)]
        for sample in asked.get(step, []):
            keys[sample] = keys[sample] * tx.FACTOR + here
        at += ((here + np.uint64(1)) * coin >> np.uint64(63)).astype(np.int64)
    return tx.mix(keys)


class Finder:
    """Looks a block of items up in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, t) for i, t in ((i, plain(t)) for i, t in items) if len(t) >= SHORTEST]
        self.lengths = np.array([len(t) for _, t in self.items], np.int64)
        self.limits = np.array([int(EDITS * len(t)) for _, t in self.items], np.int64)
        self.least = np.maximum(1, self.lengths - GRAM + 1 - GRAM * self.limits)
        codes = [codes_of(t).astype(np.uint64) for _, t in self.items]
        self.grams = [np.unique(tx.window_hashes(c, GRAM)) for c in codes]
        self.mesh = np.zeros(1 << _MESH_BITS, bool)
        for hashed in self.grams:
            self.mesh[hashed >> np.uint64(64 - _MESH_BITS)] = True
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for member, (code, limit) in enumerate(zip(codes, self.limits)):
            width = len(code) // (limit + 1)
            hashed = tx.window_hashes(code, width)
            for offset in (np.arange(limit + 1) * len(code) // (limit + 1)).tolist():
                pieces.setdefault(int(width), []).append((int(hashed[offset]), member, offset))
        # of each width the pieces' hashes in order, the items that they are of and where they begin there
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width, some in pieces.items():
            hashed, members, offsets = zip(*sorted(some))
            self.pieces[width] = np.array(hashed, np.uint64), np.array(members, np.int64), np.array(offsets, np.int64)

        # of each walk over items of like length the samples, and of each sample the keys in order and their items
        self.walks: list[tuple[np.ndarray, int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]] = []
        like = np.floor(np.log(self.lengths) / np.log(1.25)).astype(np.int64)
        for size in np.unique(like).tolist():
            of = np.flatnonzero(like == size)
            shortest, longest = int(self.lengths[of].min()), int(self.lengths[of].max())
            padded = [np.concatenate([codes[i], np.zeros(2 * longest - len(codes[i]), np.uint64)]) for i in of]
            for walk in range(WALKS):
                random = np.random.default_rng([size, walk])
                samples = np.sort(random.integers(0, 2 * shortest, (TABLES, BITS)), axis=1)
                keys = walked(np.concatenate(padded), np.arange(len(of)) * 2 * longest, walk, samples)
                orders = np.argsort(keys, axis=1, kind="stable")
                self.walks.append((of, walk, samples, [(k[o], of[o]) for k, o in zip(keys, orders)]))

    def find(self, texts: list[str | None]) -> list[list[Hit]]:
        """All items that each text holds."""
        return self._found(texts, [self._alike, self._stretches])

    def clean(self, texts: list[str | None]) -> list[bool]:
        """Whether each text holds no item.  Only where the walks find none it is asked for pieces."""
        hits = self._found(texts, [self._alike])
        open_ = [at for at, some in enumerate(hits) if not some]
        none = [not some for some in hits]
        for at, some in zip(open_, self._found([texts[at] for at in open_], [self._stretches])):
            none[at] = not some
        return none

    def _found(self, texts: list[str | None], searches: list[Callable[..., Iterator[np.ndarray]]]) -> list[list[Hit]]:
        shapes = [plain(t) for t in texts]
        found: list[list[Hit]] = [[] for _ in texts]
        codes = codes_of("\x00".join(shapes)).astype(np.uint64)
        if not self.items or len(codes) < GRAM:
            return found
        bounds = np.cumsum([0, *[len(s) + 1 for s in shapes]])
        grams = tx.window_hashes(codes, GRAM)
        held = self.mesh[grams >> np.uint64(64 - _MESH_BITS)]
        upto = np.concatenate([[0], np.cumsum(held, dtype=np.int64), np.full(GRAM - 1, held.sum())])
        places = np.flatnonzero(held)
        stretches = [s for search in searches for s in search(codes, places, bounds, upto)] if len(places) else []
        if not stretches:
            return found
        row, member, low, high = np.concatenate(stretches, axis=1)
        order = np.lexsort((low, member, row))
        best: dict[tuple[int, int], Hit] = {}
        for at, of, first, last in joined(row[order], member[order], low[order], high[order]):
            known = best.get((at, of))
            limit = known.distance - 1 if known else int(self.limits[of])
            if limit < 0 or np.isin(grams[first:last], self.grams[of]).sum() < self.least[of]:
                continue
            begin = int(bounds[at])
            item_id, item = self.items[of]
            stretch = shapes[at][first - begin : last - begin]
            if (match := best_match(item, stretch, limit)) is None:
                continue
            distance, end = match
            before = stretch[max(0, end - len(item) - distance) : end]
            back = best_match(item[::-1], before[::-1], distance) or (distance, len(before))
            best[at, of] = Hit(item_id, first - begin + end - back[1], first - begin + end, distance)
        for (at, _), hit in best.items():
            if hit.item_id not in [h.item_id for h in found[at]]:
                found[at].append(hit)
                continue
            found[at] = [min(h, hit, key=lambda x: (x.distance, x.start)) if h.item_id == hit.item_id else h for h in found[at]]
        return found

    def _alike(self, codes: np.ndarray, places: np.ndarray, bounds: np.ndarray, upto: np.ndarray) -> Iterator[np.ndarray]:
        """Text, item, begin and end of the stretches where a walk has an item's key and grams enough of any item.

        Walks start up to two grams before a held one, where not all grams just before are held.
        """
        near = np.unique(np.maximum(places[:, None] - np.arange(2 * GRAM), 0).ravel()) if len(places) < STARTS else np.arange(len(codes))
        inside = upto[near] - upto[np.maximum(near - GRAM, 0)] == GRAM
        near = near[~inside & (upto[np.minimum(near + 2 * GRAM, len(upto) - 1)] > upto[near])]
        for of, walk, samples, tables in self.walks:
            reach = int((self.lengths[of] + self.limits[of]).max())
            begins = near[upto[np.minimum(near + reach, len(upto) - 1)] - upto[near] >= self.least[of].min()]
            for first in range(0, len(begins), STARTS):
                starts = begins[first : first + STARTS]
                for key, (known, members) in zip(walked(codes, starts, walk, samples), tables):
                    left, right = np.searchsorted(known, key, "left"), np.searchsorted(known, key, "right")
                    hit = np.flatnonzero(right > left)
                    n = right[hit] - left[hit]
                    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    yield self._around(np.repeat(starts[hit], n), members[np.repeat(left[hit], n) + within], bounds, upto)

    def _around(self, start: np.ndarray, member: np.ndarray, bounds: np.ndarray, upto: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
        """What a passage of the item that begins about ``start``, in the text of ``place``, can cover, if it has grams
        enough of any item."""
        row = np.searchsorted(bounds, start if place is None else place, "right") - 1
        low = np.maximum(start - self.limits[member], bounds[row])
        high = np.minimum(start + self.lengths[member] + self.limits[member], bounds[row + 1] - 1)
        high = np.maximum(high, low)
        enough = upto[high] - upto[low] >= self.least[member]
        return np.stack([row, member, low, high])[:, enough]

    def _stretches(self, codes: np.ndarray, places: np.ndarray, bounds: np.ndarray, upto: np.ndarray) -> Iterator[np.ndarray]:
        """Text, item, begin and end of the stretches around pieces that have grams enough of any item."""
        total = np.zeros(len(places), np.uint64)
        for at in range(max(self.pieces)):
            total = total * tx.FACTOR + codes[np.minimum(places + at, len(codes) - 1)]
            if at + 1 not in self.pieces:
                continue
            known, members, offsets = self.pieces[at + 1]
            hashed = tx.mix(total)
            left, right = np.searchsorted(known, hashed, "left"), np.searchsorted(known, hashed, "right")
            some = np.flatnonzero((right > left) & (places + at < len(codes)))
            counts = right[some] - left[some]
            block = np.cumsum(counts) // PAIRS
            for part in np.split(np.arange(len(some)), np.flatnonzero(np.diff(block)) + 1):
                n = counts[part]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                piece, place = np.repeat(left[some[part]], n) + within, np.repeat(places[some[part]], n)
                member, start = members[piece], place - offsets[piece]
                yield self._around(start, member, bounds, upto, place)


def joined(row: np.ndarray, member: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The stretches, ordered by text, item and begin, with those that overlap made one."""
    merged: list[tuple[int, int, int, int]] = []
    for at, of, first, last in zip(row.tolist(), member.tolist(), low.tolist(), high.tolist()):
        if merged and merged[-1][:2] == (at, of) and first <= merged[-1][3]:
            merged[-1] = (at, of, merged[-1][2], max(last, merged[-1][3]))
        else:
            merged.append((at, of, first, last))
    return merged


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``BLOCK_CHARS`` characters."""
    some = benchmark.where("text IS NOT NULL").select("item_id", "text")
    total = some.agg(F.sum(F.length("text"))).first()[0] or 0
    count = math.ceil(total / BLOCK_CHARS)
    for block in range(count):
        rows = some.where(F.pmod(F.xxhash64("text"), F.lit(count)) == block).orderBy("item_id", "text").collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item that it holds: doc_id, item_id, start, end, distance."""
    ddl = "doc_id long, item_id long, start long, end long, distance long"
    names = ["doc_id", *Hit._fields]
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    found = docs.sparkSession.createDataFrame([], ddl)
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value)
            for piece in tx.slices(batches, "text", SLICE_BYTES):
                ids, hits = piece.column("doc_id").to_pylist(), finder.find(piece.column("text").to_pylist())
                rows = [(doc_id, *hit) for doc_id, of_doc in zip(ids, hits) for hit in of_doc]
                columns = zip(*rows) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)

        found = found.union(narrow.mapInArrow(search, ddl))
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    column, schema = docs.columns.index("text"), docs.schema
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = Finder(shared.value)
            for batch in batches:
                numbered = batch.rename_columns([str(i) for i in range(batch.num_columns)])
                for piece in tx.slices([numbered], str(column), SLICE_BYTES):
                    clean = finder.clean(piece.column(column).to_pylist())
                    yield piece.filter(pa.array(clean, pa.bool_())).rename_columns(batch.schema.names)

        docs = docs.mapInArrow(keep, schema)
    return docs
