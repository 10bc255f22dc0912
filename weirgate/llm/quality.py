"""Quality rules as a cascade that stops at the first rule a text fails.

What a rule costs and how many texts it rejects are measured on a sample; rules run in order of
rejections per second.  The order changes the cost alone, never a verdict: a text is kept when it passes
all rules.  The sample (``SAMPLE`` texts, the first by hash of their id) serves the order only.

Null and empty texts have no words, so they fail ``few_words``.  Repeated rows are judged alike.  An empty
table gives an empty result.  Other columns pass through unread, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm import text as tx
from weirgate.llm.sampling import first_by_hash

SAMPLE = 512
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


class View:
    """Texts with measures that are computed when first asked for, and kept for the texts that remain."""

    def __init__(self, texts: pa.Array, known: dict[str, np.ndarray] | None = None):
        self.texts, self._known = texts, known or {}

    def __len__(self) -> int:
        return len(self.texts)

    def __getitem__(self, measure: str) -> np.ndarray:
        if measure not in self._known:
            self._known |= MEASURES[measure](self.texts)
        return self._known[measure]

    def take(self, mask: np.ndarray) -> "View":
        return View(self.texts.filter(pa.array(mask)), {k: v[mask] for k, v in self._known.items()})


def _occurrences(texts: pa.Array, characters: str) -> np.ndarray:
    total = np.zeros(len(texts), np.int64)
    for character in characters:
        total += pc.count_substring(texts, character).to_numpy(zero_copy_only=False)
    return total


def _word_chars(texts: pa.Array) -> dict[str, np.ndarray]:
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return {"word_chars": length - _occurrences(texts, BLANKS)}


def _lines(texts: pa.Array) -> dict[str, np.ndarray]:
    lists = pc.split_pattern(texts, "\n")
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    real = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of_text = parents[real].astype(np.int64)
    distinct = np.unique((of_text << 32) | ids[real]) >> 32
    total = np.bincount(of_text, minlength=len(texts))
    return {"n_lines": total, "n_dup_lines": total - np.bincount(distinct, minlength=len(texts))}


def _words(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words, and words inside windows that occur twice or more in their text."""
    found = tx.words(texts)
    repeated = np.zeros(len(found.ids), bool)
    if len(found.ids) >= WINDOW:
        of_text = found.text_of()
        windows = tx.window_hashes(tx.hash_strings(found.distinct)[found.ids], WINDOW)
        inside = of_text[: len(windows)] == of_text[WINDOW - 1 :]
        at = np.flatnonzero(inside)
        keys = tx.mix(windows[at] + of_text[at].astype(np.uint64) * tx.FACTOR)
        ordered = np.sort(keys)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
            hits = at[twice[place] == keys]
            edges = np.zeros(len(found.ids) + 1, np.int64)
            np.add.at(edges, hits, 1)
            np.add.at(edges, hits + WINDOW, -1)
            repeated = np.cumsum(edges[:-1]) > 0
    return {"n_words": found.counts(), "n_repeat_words": tx.sums_between(repeated, found.starts)}


def _letters(texts: pa.Array) -> dict[str, np.ndarray]:
    raw, offsets = tx.column_bytes(texts)
    capital, small = (raw >= 65) & (raw <= 90), ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    upper = tx.sums_between(capital, offsets)
    return {"n_upper": upper, "n_letters": upper + tx.sums_between(small, offsets)}


MEASURES: dict[str, Callable[[pa.Array], dict[str, np.ndarray]]] = {
    "word_chars": _word_chars,
    "n_symbols": lambda texts: {"n_symbols": _occurrences(texts, SYMBOLS)},
    "n_marks": lambda texts: {"n_marks": _occurrences(texts, "!?")},
    "n_lines": _lines, "n_dup_lines": _lines, "n_words": _words, "n_repeat_words": _words,
    "n_upper": _letters, "n_letters": _letters,
}


class Rule(NamedTuple):
    """``reject`` tells which texts of a view the rule turns down."""

    name: str
    reject: Callable[[View], np.ndarray]


BASE = (
    Rule("few_words", lambda v: v["n_words"] < 10),
    Rule("repeated_words", lambda v: 100 * v["n_repeat_words"] > 20 * v["n_words"]),
)
RULES = BASE + (
    Rule("symbols", lambda v: 100 * v["n_symbols"] > 10 * v["word_chars"]),
    Rule("repeated_lines", lambda v: 2 * v["n_dup_lines"] > v["n_lines"]),
    Rule("shouting", lambda v: 2 * v["n_upper"] > v["n_letters"]),
    Rule("marks", lambda v: 100 * v["n_marks"] > 10 * v["word_chars"]),
    Rule("few_letters", lambda v: 2 * v["n_letters"] < v["word_chars"]),
    Rule("long_words", lambda v: v["word_chars"] > 40 * np.maximum(v["n_words"], 1)),
)


def measured_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> tuple[Rule, ...]:
    """The rules by rejections per second on a sample, those that reject most for their cost first."""
    chosen = first_by_hash(docs.select("doc_id", "text"), "doc_id", sample).select("text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            texts, rows = pc.fill_null(batch.column("text"), ""), []
            for at, rule in enumerate(rules):
                begun = time.perf_counter()
                rejected = int(rule.reject(View(texts)).sum())
                rows.append((at, time.perf_counter() - begun, rejected))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["rule", "cost", "rejected"])

    found = chosen.mapInArrow(measure, "rule long, cost double, rejected long")
    totals = found.groupBy("rule").agg(F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected")).collect()
    rank = {r["rule"]: r["rejected"] / max(r["cost"], 1e-9) for r in totals}
    return tuple(rules[i] for i in sorted(range(len(rules)), key=lambda i: (-rank.get(i, 0.0), i)))


def passes(view: View, rules: tuple[Rule, ...]) -> np.ndarray:
    """Which texts pass all rules; a rule sees only the texts that passed those before it."""
    alive, kept = np.arange(len(view)), np.zeros(len(view), bool)
    for rule in rules:
        if not len(alive):
            return kept
        good = ~rule.reject(view)
        if not good.all():
            alive, view = alive[good], view.take(good)
    kept[alive] = True
    return kept


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass all rules, with all their columns."""
    order = measured_order(docs, rules)
    column = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = batch.rename_columns([str(i) for i in range(batch.num_columns)])
            for piece in tx.slices([numbered], str(column)):
                good = passes(View(pc.fill_null(piece.column(column), "")), order)
                yield piece.filter(pa.array(good)).rename_columns(batch.schema.names)

    return docs.mapInArrow(keep, docs.schema)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORES = f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean"


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The base measures and the verdict of every document.

    The base measures are asked for every text; of the other rules a text sees those up to its first
    failure.
    """
    order = measured_order(docs, rules)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.slices(batches, "text"):
            view = View(pc.fill_null(piece.column("text"), ""))
            values = [view[name] for name in COUNTS]
            failed = np.logical_or.reduce([rule.reject(view) for rule in BASE])
            kept = np.zeros(len(view), bool)
            kept[~failed] = passes(view.take(~failed), order)
            columns = [piece.column("doc_id"), *map(pa.array, values), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "kept"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, SCORES)


SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM doc, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks,
    len(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    strlen(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    strlen(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters
  FROM doc LEFT JOIN rep USING (doc_id)
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR 2 * n_dup_lines > n_lines OR 2 * n_upper > n_letters
    OR 100 * n_marks > 10 * word_chars OR 2 * n_letters < word_chars OR word_chars > 40 * greatest(n_words, 1)) AS kept
FROM failed
"""
