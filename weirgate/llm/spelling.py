"""Spelling variants: words one edit apart, found by scanning a sorted word list with rows of the edit matrix.

Two words at one edit share the part before the edit or the part after it.  So each word goes, by hash, to the blocks
of its first and of its last half (cut at half the shorter word's length, so for its own length and for one less);
last halves are read backwards.  In a block the words are sorted, and a task matches all of them against the list at
once: the words that share a prefix are one range of it, a range holds one row of the edit matrix for each word still
near it, three cells wide.  The row is worked out once for the range and handed down where the longest common prefix
of neighbours ends; a range whose row exceeds one edit is left out whole.  A word looks only at the list behind it, and
a pair that shares both halves counts in its first one, so each pair is found once, whatever the blocks' size.  Work
follows the number of ranges entered, not the pairs of a block.

Words are Latin letters up to U+00FF, one byte each.  A word's form is its most frequent near word when that is ten
times as frequent; forms lead strictly upwards in frequency, so their chains end after as many steps as the greatest
count has digits.

Null and empty texts have no words.  A null id counts as empty text where it is hashed.  Repeated rows count
repeatedly.  An empty table gives an empty result.  Other columns are not read.  Texts are read whole; words of any
length are kept whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.manifest import crc_sql
from weirgate.session import remove, work_dir

SHORTEST = 7
RUN = rf"[A-Za-zÀ-ÿ]{{{SHORTEST},}}+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOISE = 31
LEAST = 2
TIMES = 10
SLAB = 50_000
QUERIES = 1 << 14
_FAR = 2  # any distance above one


def runs(docs: DataFrame) -> DataFrame:
    """Each word of each text as it stands, with the document's id."""
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def with_slips(found: DataFrame) -> DataFrame:
    """The words, one letter lost where the checksum of id and word says so."""
    checksum = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("sum") % F.length("run")).cast("int")
    slipped = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + F.lit(2)))
    return found.withColumn("sum", checksum).select(F.when(F.col("sum") % NOISE == 0, slipped).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """Words of ``SHORTEST`` letters and ``LEAST`` occurrences or more, with their number.  Counts are summed in each
    task before they are moved."""
    long_enough = words.where(F.length("word") >= SHORTEST)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)


def blocks(vocab: DataFrame) -> DataFrame:
    """``block, half, word, n``: each word in its four blocks, backwards in those of last halves."""
    size = F.length("word")

    def entry(shorter: Column, last: bool) -> Column:
        half = F.floor(shorter / 2).cast("int")
        kept = shorter - half if last else half
        word = F.reverse("word") if last else F.col("word")
        return F.struct(
            F.xxhash64(F.lit(last), shorter, F.substr(word, F.lit(1), kept)).alias("block"), shorter.alias("shorter"),
            F.lit(last).alias("last"), word.alias("word"), F.col("n"),
        )

    entries = F.array(*[entry(size - less, last) for less in (0, 1) for last in (False, True)])
    return vocab.select(F.inline(entries))


class Block(NamedTuple):
    """Sorted words of many blocks: ``letters[starts[i]:ends[i]]`` is word ``i``."""

    letters: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    shorter: np.ndarray
    last: np.ndarray
    first_of: np.ndarray  # where the block of each word begins
    end_of: np.ndarray
    common: np.ndarray  # longest common prefix with the word before, -1 at a block's begin

    def letter(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The letter of each word at a place, 0 outside."""
        inside = (at >= 0) & (at < self.sizes[word])
        return np.where(inside, self.letters[np.where(inside, self.starts[word] + at, 0)], 0)


def laid_out(words: list[str], shorter: np.ndarray, last: np.ndarray, key: np.ndarray) -> Block:
    """Blocks as they come sorted by key and word.  Halves that only share a hash part here."""
    coded = [w.encode("latin-1") for w in words]
    sizes = np.array([len(w) for w in coded], np.int64)
    starts = np.cumsum(sizes) - sizes
    letters = np.frombuffer(b"".join(coded) + b"\0", np.uint8)
    count = len(words)
    common = np.zeros(count, np.int64)
    alive = np.flatnonzero(np.append(False, key[1:] == key[:-1]))
    at = 0
    while len(alive):
        alive = alive[(sizes[alive] > at) & (sizes[alive - 1] > at)]
        alive = alive[letters[starts[alive] + at] == letters[starts[alive - 1] + at]]
        common[alive] = at + 1
        at += 1
    half = np.where(last, shorter - shorter // 2, shorter // 2)
    begins = np.append(True, (key[1:] != key[:-1]) | (common[1:] < half[1:]))
    common[begins] = -1
    border = np.append(np.flatnonzero(begins), count)
    of = np.cumsum(begins) - 1
    return Block(letters, starts, sizes, shorter, last, border[of], border[of + 1], common)


def near_pairs(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs at one edit within a block, the earlier word first."""
    by_depth = np.argsort(block.common, kind="stable")  # borders between words, by the length of the prefix they share
    depths = block.common[by_depth]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    asking = np.flatnonzero(np.arange(len(block.sizes)) + 1 < block.end_of)
    for first in range(0, len(asking), QUERIES):
        query = asking[first : first + QUERIES]
        low, high = query + 1, block.end_of[query]
        # Every word of the block shares this prefix with the query: row 0 on the diagonal, 1 beside it.
        depth = np.where(block.last[query], block.shorter[query] - block.shorter[query] // 2, block.shorter[query] // 2)
        waiting = {}
        for d in np.unique(depth):
            here = np.flatnonzero(depth == d)
            rows = np.tile(np.array([1, 0, 1], np.int8), (len(here), 1))
            waiting[int(d)] = (query[here], low[here], high[here], rows)
        at = min(waiting, default=0)
        held = None
        while waiting or held is not None:
            if held is None:
                at = min(waiting)
            if at in waiting:
                fresh = waiting.pop(at)
                held = fresh if held is None else tuple(np.concatenate(x) for x in zip(held, fresh))
            held = _one_deeper(block, by_depth, depths, at, held, found)
            at += 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _one_deeper(block: Block, by_depth, depths, at: int, held, found):
    """Ranges whose words share ``at`` letters become ranges that share one more; near words that end are found."""
    query, low, high, rows = held
    # A word that ends here is the first of its range; its distance is the cell of the query's whole length.
    ends = np.flatnonzero(block.sizes[low] == at)
    if len(ends):
        cell = block.sizes[query[ends]] - at + 1
        reached = (cell >= 0) & (cell <= 2)
        near = ends[reached]
        near = near[rows[near, cell[reached]] == 1]
        _keep(block, query[near], low[near], found)
        low = low.copy()
        low[ends] += 1
        open_ = low < high
        query, low, high, rows = query[open_], low[open_], high[open_], rows[open_]
    if not len(query):
        return None
    # Split each range where neighbours part at this depth.
    borders = by_depth[np.searchsorted(depths, at) : np.searchsorted(depths, at, "right")]
    begin, stop = np.searchsorted(borders, low, "right"), np.searchsorted(borders, high)
    parts = stop - begin + 1
    of = np.repeat(np.arange(len(query)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    padded = np.append(borders, 0)
    begin, stop = begin[of], stop[of]
    lows = np.where(nth == 0, low[of], padded[np.minimum(begin + nth - 1, len(borders))])
    highs = np.where(begin + nth >= stop, high[of], padded[np.minimum(begin + nth, len(borders))])
    letter = block.letters[block.starts[lows] + at]
    asked, before = query[of], rows[of]
    mine = [block.letter(asked, np.int64(at - 1) + s) for s in range(3)]  # the query's letters under the three cells
    # Without an edit to spare, only a letter that one of the cells waits for goes on.
    hopeful = (before.min(axis=1) == 0) | (letter == mine[0]) | (letter == mine[1]) | (letter == mine[2])
    if not hopeful.all():
        of = np.flatnonzero(hopeful)
        lows, highs, letter, asked, before = lows[of], highs[of], letter[of], asked[of], before[of]
        mine = [m[of] for m in mine]
    left, middle, right = before[:, 0], before[:, 1], before[:, 2]
    size = block.sizes[asked]
    a = np.minimum(left + (letter != mine[0]), middle + 1)
    b = np.minimum(np.minimum(middle + (letter != mine[1]), right + 1), a + 1)
    c = np.minimum(right + (letter != mine[2]), b + 1)
    after = np.stack([a, b, c], axis=1).astype(np.int8)
    cells = at + np.arange(3)  # lengths of the query's prefix that the cells stand for
    after[cells[None, :] > size[:, None]] = _FAR
    after = np.minimum(after, _FAR)
    alive = np.flatnonzero(after.min(axis=1) < _FAR)
    return (asked[alive], lows[alive], highs[alive], after[alive]) if len(alive) else None


def _keep(block: Block, one: np.ndarray, other: np.ndarray, found: list) -> None:
    """Pairs of this block's length that do not also stand in the block of the first half."""
    right = np.minimum(block.sizes[one], block.sizes[other]) == block.shorter[one]
    one, other = one[right], other[right]
    backwards = np.flatnonzero(block.last[one])
    half = block.shorter[one[backwards]] // 2
    same = np.ones(len(backwards), bool)
    for at in range(int(half.max(initial=0))):  # read backwards, the first half is at the end
        some = np.flatnonzero(same & (at < half))
        if not len(some):
            break
        x, y = one[backwards[some]], other[backwards[some]]
        same[some] = block.letter(x, block.sizes[x] - 1 - at) == block.letter(y, block.sizes[y] - 1 - at)
    single = np.ones(len(one), bool)
    single[backwards[same]] = False
    found.append((one[single], other[single]))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def matched(table: pa.Table) -> pa.RecordBatch:
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        last = table.column("last").to_numpy()
        block = laid_out(words, table.column("shorter").to_numpy().astype(np.int64), last, table.column("block").to_numpy())
        one, other = near_pairs(block)
        texts = np.array([w[::-1] if b else w for w, b in zip(words, last)], object)
        return pa.RecordBatch.from_arrays(
            [pa.array(texts[np.append(one, other)], pa.string()), pa.array(n[np.append(one, other)]),
             pa.array(texts[np.append(other, one)], pa.string()), pa.array(n[np.append(other, one)])],
            names=["word", "n", "near", "near_n"],
        )

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SLAB:
            table = pa.Table.from_batches(held)
            key = table.column("block").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last block may go on
            if cut:
                yield matched(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
    if sum(b.num_rows for b in held):
        yield matched(pa.Table.from_batches(held))


def near_words(vocab: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every two words of ``vocab`` (word, n) at exactly one edit, in both directions.

    A word has at most so many near words as its letters and the alphabet allow, so this is linear in the words.
    """
    dealt = blocks(vocab).repartition("block").sortWithinPartitions("block", "word")
    return dealt.mapInArrow(_pairs, "word string, n long, near string, near_n long")


def forms(pairs: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` of words that have near words."""
    best = F.max_by(F.col("near"), F.struct("near_n", _backwards("near")))
    per_word = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.max("n").alias("n"), best.alias("form"), F.max("near_n").alias("form_n")
    )
    strong = F.col("form_n") >= TIMES * F.col("n")
    return per_word.select(
        "word", "n_near", F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n")
    )


def _backwards(name: str) -> Column:
    """A text whose order is the reverse of the word's order.  Letters and the end become their complements."""
    code = F.hex(F.encode(name, "ISO-8859-1"))
    return F.concat(F.translate(code, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def rooted(linked: DataFrame, greatest: int) -> DataFrame:
    """``word, root``: forms followed to the last, by doubling.  ``linked`` has word and form, ``greatest`` is the
    largest count; a chain has no more steps than that has digits."""
    spark, steps = linked.sparkSession, max(1, math.ceil(math.log(max(greatest, 2), TIMES)))
    links = linked.select("word", F.col("form").alias("root"))
    paths = []
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        path = work_dir(spark, "spelling-roots")
        links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")).write.parquet(path)
        links = spark.read.parquet(path)
        paths.append(path)
    for path in paths[:-1]:
        remove(spark, path)
    return links


def variants(docs: DataFrame) -> DataFrame:
    """Per word: ``n``, the near words' number, the form, its count, and the root that forms lead to."""
    spark = docs.sparkSession

    def kept(frame: DataFrame, label: str) -> DataFrame:
        path = work_dir(spark, label)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    vocab = kept(vocabulary(with_slips(runs(docs))), "spelling-words")
    linked = kept(forms(near_words(vocab)), "spelling-forms")
    roots = rooted(linked.where(F.col("form").isNotNull()), vocab.agg(F.max("n")).first()[0] or 0)
    return vocab.join(linked, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"
    )


SQL = f"""
with recursive runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') as run from documents),
counted as (select doc_id, run, count(*) as n from runs where length(run) >= {SHORTEST} group by all),
summed as (select *, {crc_sql("coalesce(doc_id::varchar, '') || ':' || run")} as h from counted),
words as (
  select case when h % {NOISE} = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
    sum(n)::bigint as n
  from summed group by 1 having length(word) >= {SHORTEST} and sum(n) >= {LEAST}),
cuts as (
  select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select *, unnest(range(length(word))) as i from words)),
pairs as (
  select a.word, a.n, b.word as near, b.n as near_n from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a.word, a.n, b.word, b.n from words a join cuts b on a.word = b.rest
  union select b.word, b.n, a.word, a.n from words a join cuts b on a.word = b.rest),
best as (
  select word, n, near, near_n, count(*) over (partition by word) as n_near,
    row_number() over (partition by word order by near_n desc, near) as place from pairs),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= {TIMES} * w.n then near end as form,
    case when near_n >= {TIMES} * w.n then near_n end as form_n
  from words w left join best b on b.word = w.word and b.place = 1),
led as (
  select word, word as root, 0 as step from formed
  union all
  select l.word, f.form, step + 1 from led l join formed f on f.word = l.root where f.form is not null)
select word, form, (select arg_max(root, step) from led l where l.word = f.word) as root, n, n_near, form_n from formed f
"""
