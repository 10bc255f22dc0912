"""LM scoring with a hierarchical Pitman-Yor model of words and their letters.

A word is drawn from the restaurant of the word before it (of the end, for the first one), a child of the word
restaurant, whose base is the word's spelling: letter by letter, each from the restaurant of the letters before it.  The
restaurant of a context is a child of that of the context without its first letter, down to the empty context, whose
base is uniform over all code points.  Contexts so share parents, and a word never seen still has the probability of
its letters.

Seating is sampled by Gibbs in blocks: the customers of one dish leave and are seated again one after other, given all
other tables as they stand (from the fifth on a quarter more at a time).  Restaurants after a word are seated first,
given the words' probabilities with one table each; their tables, averaged over ``SAMPLES`` seatings after ``BURN_IN``, are
the customers of the word restaurant.  Customers of the letter restaurants are one table for each word.  Probabilities
are averaged likewise; perplexity is ``10 ** (-score / n_tokens)``.

``score`` is over the learned words and one type for all others, as the base score is; ``spelled_score`` tells unknown
words apart by their letters.

Texts are words and one end each.  Null, empty and blank texts are one end.  Rows repeated under one id are texts of
their own.  An empty table gives an empty result; with nothing to learn from, spelling alone decides.  Other columns
are not read.  Texts are taken whole, and all texts that are not held out are learned from.

What is gathered grows with the input: the distinct words of each chunk of texts meet their counts, and their
probabilities come back; so do its distinct pairs of words, as packed numbers.  A pair's group is that of its first
word, a word of more than ``HOT`` customers is split into several.  Words are named there by 64-bit hashes.  Letters are
sampled in one group for each last letter of the context, whose size is bounded by the alphabet to the power ``ORDER``,
not by the number of texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm import text as tx
from weirgate.llm.linking import Scratch
from weirgate.session import work_dir

ORDER = 5
BURN_IN = 3
SAMPLES = 4
STRENGTH = 1.0
CODE_POINTS = 0x110000
BEGIN, END = "\x02", "\x03"
CHUNK_BYTES = 24 << 20
WORDS_A_HOME = 100_000
TOKENS_A_HOME = 1_500_000
HOT = 200_000
TINY = float(np.finfo(float).tiny)


def grams(word: str) -> list[str]:
    """Each letter of a word and its end, with up to ``ORDER - 1`` letters of context."""
    spelled = BEGIN + word + END
    return [spelled[max(0, at - ORDER + 1) : at + 1] for at in range(1, len(spelled))]


def chunks(docs: DataFrame) -> DataFrame:
    """Texts in chunks: their words as numbers into the chunk's own list of words.  The end is the empty word."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, piece in enumerate(tx.slices(batches, "text", CHUNK_BYTES)):
            found = tx.words(piece.column("text"), lower=True)
            trained = ~piece.column("held_out").to_numpy(zero_copy_only=False)
            counts = np.bincount(found.ids[trained[found.text_of()]], minlength=len(found.distinct))
            columns = {
                "chunk": pa.array([task + number]), "doc_id": pa.array([piece.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "held_out": pa.array([piece.column("held_out").to_pylist()]),
                "n_words": pa.array([found.counts()], pa.list_(pa.int64())),
                "ids": pa.array([pa.compress(found.ids.astype(np.int32).tobytes(), "zstd", asbytes=True)], pa.binary()),
                "words": pa.array([[*found.distinct.to_pylist(), ""]], pa.list_(pa.string())),
                "trained": pa.array([np.append(counts, trained.sum())], pa.list_(pa.int64())),
            }
            yield pa.RecordBatch.from_pydict(columns)

    path = work_dir(docs.sparkSession, "lm-chunks")
    docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(
        encode,
        "chunk long, doc_id array<long>, held_out array<boolean>, n_words array<long>, ids binary, words array<string>,"
        " trained array<long>",
    ).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def discount(once: int, twice: int) -> float:
    """The usual estimate from the numbers of dishes eaten once and twice."""
    return float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once + twice else 0.5


def seat(customers: np.ndarray, fresh: np.ndarray, less: float, random: np.random.Generator) -> np.ndarray:
    """Tables for the customers of each dish, seated one after other.

    A customer sits at a new table with weight ``fresh`` and at one of the dish's tables with the number seated less
    ``less`` for each table.
    """
    tables = (customers > 0).astype(np.int64)
    seated = 1
    while True:
        active = np.flatnonzero(customers > seated)
        if not len(active):
            return tables
        following = max(seated + 1, seated + seated // 4)
        block = np.minimum(customers[active], following) - seated
        known = seated + (block - 1) / 2 - less * tables[active]
        weight = fresh[active]
        tables[active] += random.binomial(block, weight / np.maximum(weight + known, 1e-300))
        tables[active] = np.minimum(tables[active], seated + block)
        seated = following


class Level:
    """The restaurants of contexts of one length: a row for each context and letter."""

    def __init__(self, context: pd.Series, letter: pd.Series):
        keys = pd.DataFrame({"context": context, "letter": letter}).drop_duplicates(ignore_index=True)
        self.context, self.letter = keys["context"], keys["letter"]
        self.room = pd.factorize(self.context)[0]
        self.rows = pd.MultiIndex.from_frame(keys)
        self.direct = np.zeros(len(keys), np.int64)
        self.up = np.zeros(0, np.int64)

    def find(self, context: pd.Series, letter: pd.Series) -> np.ndarray:
        return self.rows.get_indexer(pd.MultiIndex.from_arrays([context, letter]))

    def total(self, values: np.ndarray) -> np.ndarray:
        """Summed over each row's restaurant."""
        return np.bincount(self.room, values)[self.room]


def sample_letters(leaves: pd.DataFrame, root: dict[str, float], seed: int) -> pd.DataFrame:
    """Averaged predictive probabilities of the grams of one subtree of contexts (those that end alike).

    ``leaves`` has gram and n, the customers; ``root`` the probability of each letter in the empty context.
    """
    random = np.random.default_rng(seed)
    context, letter = leaves["gram"].str[:-1], leaves["gram"].str[-1]
    depth = context.str.len()
    levels: dict[int, Level] = {}
    inherited_context, inherited_letter = pd.Series([], dtype=object), pd.Series([], dtype=object)
    for length in range(ORDER - 1, 0, -1):
        own = depth == length
        level = levels[length] = Level(
            pd.concat([context[own], inherited_context], ignore_index=True),
            pd.concat([letter[own], inherited_letter], ignore_index=True),
        )
        np.add.at(level.direct, level.find(context[own], letter[own]), leaves["n"].to_numpy()[own])
        inherited_context, inherited_letter = level.context.str[1:], level.letter
    for length in range(ORDER - 1, 1, -1):
        level = levels[length]
        level.up = levels[length - 1].find(level.context.str[1:], level.letter)
    base = levels[1].letter.map(root).to_numpy(dtype=float)

    held = {length: (level.direct > 0).astype(np.int64) for length, level in levels.items()}
    chance: dict[int, np.ndarray] = {}
    total = np.zeros(len(leaves))
    for sweep in range(BURN_IN + SAMPLES):
        customers, less = {}, {}
        for length in range(ORDER - 1, 0, -1):  # seats, from the longest contexts up
            level, count = levels[length], levels[length].direct.copy()
            if length + 1 in levels:
                count += np.bincount(levels[length + 1].up, held[length + 1], len(count)).astype(np.int64)
            customers[length], less[length] = count, discount((count == 1).sum(), (count == 2).sum())
            if sweep:
                above = base if length == 1 else chance[length - 1][level.up]
                fresh = (STRENGTH + less[length] * level.total(held[length])) * above
                held[length] = seat(count, fresh, less[length], random)
            else:
                held[length] = (count > 0).astype(np.int64)
        for length in range(1, ORDER):  # probabilities, from the shortest down
            level, d = levels[length], less[length]
            above = base if length == 1 else chance[length - 1][level.up]
            mass = level.total(customers[length]) + STRENGTH
            rest = STRENGTH + d * level.total(held[length])
            chance[length] = (customers[length] - d * held[length] + rest * above) / mass
        if sweep >= BURN_IN:
            for length, level in levels.items():
                own = (depth == length).to_numpy()
                total[own] += chance[length][level.find(context[own], letter[own])]
    return pd.DataFrame({"gram": leaves["gram"], "chance": total / SAMPLES})


def letter_root(leaves: DataFrame) -> dict[str, float]:
    """The empty context: a restaurant of all letters, each with one table for every longest context it follows.

    Held on the driver: a number for each letter of the alphabet.
    """
    rows = leaves.groupBy(F.substring("gram", -1, 1).alias("letter")).agg(F.sum((F.col("n") > 0).cast("long")).alias("c")).collect()
    counts = {r["letter"]: r["c"] for r in rows}
    values = np.array(list(counts.values()))
    less, mass, base = discount((values == 1).sum(), (values == 2).sum()), values.sum() + STRENGTH, 1 / CODE_POINTS
    fresh = (STRENGTH + less * (values > 0).sum()) * base
    tables = seat(values, np.full(len(values), fresh), less, np.random.default_rng(0))
    rest = (STRENGTH + less * tables.sum()) * base
    return {letter: float((c - less * t + rest) / mass) for (letter, c), t in zip(counts.items(), tables)}


def spelling(words: DataFrame, kept: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The words (home, word, c) with ``base``, the probability of the spelling.  ``kept`` writes tables by name."""
    spark = words.sparkSession

    def split(table: pa.Table) -> pa.Table:
        counted: dict[str, int] = {}
        for word, c in zip(table.column("word").to_pylist(), table.column("c").to_pylist()):
            for gram in grams(word):
                counted[gram] = counted.get(gram, 0) + (c > 0)
        home = table.column("home")[0].as_py()
        return pa.table({"home": pa.array([home] * len(counted), pa.int64()), "gram": list(counted), "n": list(counted.values())})

    asked = kept(words.groupBy("home").applyInArrow(split, "home long, gram string, n long"), "grams")
    leaves = kept(asked.groupBy("gram").agg(F.sum("n").alias("n")), "letters")
    root = spark.sparkContext.broadcast(letter_root(leaves))

    def sample(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame[["gram", "n"]].sort_values("gram", ignore_index=True)
        return sample_letters(ordered, root.value, ord(key[0]))

    last = F.substring("gram", -2, 1).alias("last")
    chances = kept(leaves.groupBy(last).applyInPandas(sample, "gram string, chance double"), "chances")

    def spell(key: tuple, of_words: pa.Table, answers: pa.Table) -> pa.Table:
        chance = dict(zip(answers.column("gram").to_pylist(), np.log(answers.column("chance").to_numpy()).tolist()))
        base = [math.exp(sum(map(chance.__getitem__, grams(word)))) for word in of_words.column("word").to_pylist()]
        return pa.table({"word": of_words.column("word"), "c": of_words.column("c"), "base": pa.array(base, pa.float64())})

    answered = asked.select("home", "gram").join(chances, "gram")
    return words.groupBy("home").cogroup(answered.groupBy("home")).applyInArrow(spell, "word string, c long, base double")


class Pairs:
    """The tokens of a chunk as pairs with the word before: ``of_token`` numbers its distinct pairs, which are in the
    order of their ``home`` and lie between ``bounds`` of it."""

    def __init__(self, row: dict, counted: np.ndarray, homes: int):
        counts = np.array(row["n_words"], np.int64)
        packed = pa.decompress(row["ids"], int(counts.sum()) * 4, "zstd", asbytes=True) if counts.sum() else b""
        ids, offsets = np.frombuffer(packed, np.int32).astype(np.int64), np.concatenate([[0], np.cumsum(counts)])
        end = len(counted) - 1
        self.word, self.before = np.insert(ids, offsets[1:], end), np.insert(ids, offsets[:-1], end)
        self.begins = offsets[:-1] + np.arange(len(counts))
        found, inverse = np.unique(self.before * len(counted) + self.word, return_inverse=True)
        names = tx.hash_strings(pa.array(row["words"], pa.string()))
        self.first, self.second = found // len(counted), found % len(counted)
        parts = np.maximum(1, -(-counted // HOT)).astype(np.uint64)[self.first]
        part = tx.mix(names[self.second]) % parts
        home = (tx.mix(names[self.first] + part * tx.FACTOR) % np.uint64(homes)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.of_token, self.parts = place[inverse], parts[order].astype(np.int64)
        self.first, self.second, home = self.first[order], self.second[order], home[order]
        self.u, self.w = names[self.first], names[self.second]
        trained = np.repeat(~np.array(row["held_out"], bool), counts + 1)
        self.n = np.bincount(self.of_token[trained], minlength=len(order))
        self.homes, begins = np.unique(home, return_index=True)
        self.bounds = np.append(begins, len(order))


def _packed(values: np.ndarray, kind: str) -> bytes:
    return pa.compress(values.astype(kind).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, size * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def seat_pairs(group: pa.Table) -> pa.Table:
    """The customers and tables of each pair, in the order each chunk has them, and what they add to their words.

    Restaurants are those of the group's first words.  One that is split counts the tables of all its parts as it would
    from its own.
    """
    rows = group.to_pylist()
    sizes = [r["size"] for r in rows]

    def whole(column: str, kind: str) -> np.ndarray:
        return np.concatenate([_unpacked(r[column], kind, r["size"]) for r in rows])

    keys = np.empty(sum(sizes), [("u", "u8"), ("w", "u8")])
    keys["u"], keys["w"] = whole("u", "u8"), whole("w", "u8")
    pairs, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
    customers = np.bincount(inverse, whole("n", "i4")).astype(np.int64)
    chance, parts = whole("p", "f4")[at].astype(float), whole("parts", "i4")[at]
    room = np.unique(pairs["u"], return_inverse=True)[1]
    once, twice = int((customers == 1).sum()), int((customers == 2).sum())
    less, random = discount(once, twice), np.random.default_rng(rows[0]["home"])
    tables, total, again = (customers > 0).astype(np.int64), np.zeros(len(pairs), np.int64), customers > 1
    for sweep in range(BURN_IN + SAMPLES):
        fresh = (STRENGTH + less * np.bincount(room, tables)[room] * parts) * chance
        tables[again] = seat(customers[again], fresh[again], less, random)
        if sweep >= BURN_IN:
            total += tables
    out, begin = [], 0
    for r in rows:
        mine = inverse[begin : begin + r["size"]]
        begin += r["size"]
        out.append({"chunk": r["chunk"], "home": r["home"], "n": _packed(customers[mine], "<i4"), "tables": _packed(total[mine], "<i4")})
    some = total > 0
    for side, column in (("u", "held"), ("w", "up")):
        names, of = np.unique(pairs[side][some], return_inverse=True)
        out.append({"names": names.view(np.int64).tolist(), column: np.bincount(of, total[some]).astype(np.int64).tolist()})
    out.append({"once": once, "twice": twice})
    return pa.Table.from_pylist(out, SEATS)


SEATS = pa.schema([
    ("chunk", pa.int64()), ("home", pa.int64()), ("n", pa.binary()), ("tables", pa.binary()), ("names", pa.list_(pa.int64())),
    ("held", pa.list_(pa.int64())), ("up", pa.list_(pa.int64())), ("once", pa.int64()), ("twice", pa.int64()),
])
_SEATS_DDL = "chunk long, home long, n binary, tables binary, names array<long>, held array<long>, up array<long>, once long, twice long"


def seat_words(words: DataFrame, less: float, rest: float) -> DataFrame:
    """The words (home, word, base, customers and others) with ``tables``, the mean of ``SAMPLES`` seatings."""

    def seats(group: pa.Table) -> pa.Table:
        group = group.sort_by("word")
        customers, base = group.column("customers").to_numpy(), group.column("base").to_numpy()
        random = np.random.default_rng(group.column("home")[0].as_py())
        mean = np.mean([seat(customers, rest * base, less, random) for _ in range(SAMPLES)], axis=0)
        return group.append_column("tables", pa.array(mean, pa.float64()))

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema.fields)
    return words.groupBy("home").applyInArrow(seats, f"{ddl}, tables double")


class WordLevel:
    """The word restaurant with the numbers that its probabilities need."""

    def __init__(self, words: DataFrame, kept: Callable[[DataFrame, str], DataFrame], label: str):
        known = F.col("customers")
        seen = words.agg(
            F.coalesce(F.sum(known), F.lit(0)).alias("n"), F.coalesce(F.sum((known > 0).cast("long")), F.lit(0)).alias("v"),
            F.coalesce(F.sum((known == 1).cast("long")), F.lit(0)).alias("once"),
            F.coalesce(F.sum((known == 2).cast("long")), F.lit(0)).alias("twice"),
        ).first()
        less = discount(seen["once"], seen["twice"])
        self.seated = kept(seat_words(words, less, STRENGTH + less * seen["v"]), label)
        # the average over seatings is linear in the tables, so their mean serves
        sums = self.seated.agg(
            F.coalesce(F.sum("tables"), F.lit(0.0)), F.coalesce(F.sum(F.when(known > 0, F.col("base"))), F.lit(0.0))
        ).first()
        standing, mass = STRENGTH + less * sums[0], STRENGTH + seen["n"]
        self.unknown = standing * max(1 - sums[1], 1e-12) / mass  # of all words never learned together
        chance = (known - less * F.col("tables") + standing * F.col("base")) / mass
        self.chances = self.seated.withColumn("chance", F.greatest(chance, F.lit(TINY)))


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, held_out): the contract's measures and the model's log10 probability."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lm")
    kept = scratch.kept

    texts = chunks(docs)
    flat = texts.select(F.explode(F.arrays_zip("words", "trained")).alias("w"))
    counted = kept(flat.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.trained").alias("c")), "counts")
    seen = counted.agg(
        F.count("*").alias("all"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v"),
        F.sum((F.col("c") == 1).cast("long")).alias("once"), F.sum((F.col("c") == 2).cast("long")).alias("twice"),
    ).first()
    total, distinct = seen["n"], seen["v"] or 0
    homes = max(1, math.ceil(seen["all"] / WORDS_A_HOME))
    words = counted.withColumn("home", F.pmod(F.xxhash64("word"), F.lit(homes)))
    named = F.pmod(F.xxhash64("word"), F.lit(homes)).alias("home")
    spelled = kept(spelling(words, kept).select(named, "word", "c", "base"), "spelled")
    scratch.drop("spelled")
    less = discount(seen["once"] or 0, seen["twice"] or 0)
    # at first each word has one table
    chance = F.col("c") - less * (F.col("c") > 0).cast("int") + (STRENGTH + less * distinct) * F.col("base")
    first = spelled.select("word", "c", F.greatest(chance / (STRENGTH + total), F.lit(TINY)).alias("chance"))

    asked = texts.select(F.col("chunk").alias("of_chunk"), F.posexplode("words").alias("at", "word"))
    answered = asked.join(first, "word").select("of_chunk", "at", "c", "chance")
    tokens = texts.agg(F.sum(F.aggregate("n_words", F.lit(0).cast("long"), lambda x, y: x + y + 1))).first()[0] or 0
    pair_homes = max(1, math.ceil(tokens / TOKENS_A_HOME))

    def pack(key: tuple, chunk: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("at").to_numpy())
        c, chance = found.column("c").to_numpy()[order], found.column("chance").to_numpy()[order]
        pairs, out = Pairs(chunk.to_pylist()[0], c, pair_homes), []
        for home, first, last in zip(pairs.homes.tolist(), pairs.bounds[:-1], pairs.bounds[1:]):
            some = slice(first, last)
            out.append((
                home, key[0].as_py(), int(last - first), _packed(pairs.u[some], "<u8"), _packed(pairs.w[some], "<u8"),
                _packed(pairs.n[some], "<i4"), _packed(chance[pairs.second[some]], "<f4"), _packed(pairs.parts[some], "<i4"),
            ))
        names = ["home", "chunk", "size", "u", "w", "n", "p", "parts"]
        types = [pa.int64()] * 3 + [pa.binary()] * 5
        return pa.table([pa.array(list(v), t) for v, t in zip(zip(*out), types)], names=names)

    packed = texts.groupBy("chunk").cogroup(answered.groupBy("of_chunk")).applyInArrow(
        pack, "home long, chunk long, size long, u binary, w binary, n binary, p binary, parts binary"
    )
    pairs = kept(packed.groupBy("home").applyInArrow(seat_pairs, _SEATS_DDL), "pairs")
    own = pairs.agg(F.coalesce(F.sum("once"), F.lit(0)), F.coalesce(F.sum("twice"), F.lit(0))).first()
    pair_less = discount(own[0], own[1])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = tx.hash_strings(batch.column("word")).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.int64())], [*batch.schema.names, "name"])

    none = F.transform("names", lambda _: F.lit(0).cast("long"))
    zipped = F.arrays_zip("names", F.coalesce("held", none).alias("held"), F.coalesce("up", none).alias("up"))
    sums = pairs.where("names IS NOT NULL").select(F.inline(zipped)).toDF("name", "held", "up").groupBy("name").agg(
        (F.sum("held") / SAMPLES).alias("held"), (F.sum("up") / SAMPLES).alias("up")
    )
    renamed = spelled.mapInArrow(hashed, "home long, word string, c long, base double, name long")
    fed = renamed.join(sums, "name", "left").select(
        "home", "word", "c", "base", F.coalesce("held", F.lit(0.0)).alias("held"),
        F.when(F.col("c") > 0, F.greatest(F.lit(1), F.round("up"))).otherwise(0).cast("long").alias("customers"),
    )
    level = WordLevel(fed, kept, "fed")
    scratch.drop("pairs", "fed")
    base_mass, unknown = total + 0.1 * (distinct + 1), level.unknown
    answers = asked.join(level.chances.select("word", "c", "held", "chance"), "word").select(
        "of_chunk", "at", "c", "held", "chance", F.lit(None).cast("long").alias("home"),
        F.lit(None).cast("binary").alias("n"), F.lit(None).cast("binary").alias("tables"),
    )
    of_pairs = pairs.where("chunk IS NOT NULL").select(
        F.col("chunk").alias("of_chunk"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("long").alias("c"),
        F.lit(None).cast("double").alias("held"), F.lit(None).cast("double").alias("chance"), "home", "n", "tables",
    )

    def measure(key: tuple, chunk: pa.Table, found: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        of_words = found.filter(pc.is_valid(found.column("at")))
        order = np.argsort(of_words.column("at").to_numpy())
        c, held, chance = (of_words.column(x).to_numpy()[order] for x in ("c", "held", "chance"))
        pairs = Pairs(row, c, pair_homes)
        n, tables = np.zeros(len(pairs.u)), np.zeros(len(pairs.u))
        for r in found.filter(pc.is_valid(found.column("home"))).select(["home", "n", "tables"]).to_pylist():
            at = int(np.searchsorted(pairs.homes, r["home"]))
            some = slice(pairs.bounds[at], pairs.bounds[at + 1])
            n[some] = _unpacked(r["n"], "<i4", some.stop - some.start)
            tables[some] = _unpacked(r["tables"], "<i4", some.stop - some.start) / SAMPLES
        first, second = pairs.first, pairs.second
        direct, back, mass = n - pair_less * tables, STRENGTH + pair_less * held[first], STRENGTH + c[first]
        known = np.where(c > 0, chance, unknown)[second]

        def summed(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values[pairs.of_token], pairs.begins) if len(pairs.begins) else np.zeros(0)

        return pa.table({
            "doc_id": pa.array(row["doc_id"], pa.int64()), "held_out": pa.array(row["held_out"], pa.bool_()),
            "n_tokens": np.array(row["n_words"], np.int64) + 1, "n_known": summed((c > 0)[second].astype(np.int64)).astype(np.int64),
            "train_tokens": np.full(len(pairs.begins), total), "base_score": summed(np.log10((c + 0.1) / base_mass)[second]),
            "score": summed(np.log10((direct + back * known) / mass)),
            "spelled_score": summed(np.log10(np.maximum((direct + back * chance[second]) / mass, TINY))),
        })

    return texts.groupBy("chunk").cogroup(answers.union(of_pairs).groupBy("of_chunk")).applyInArrow(
        measure,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double,"
        " spelled_score double",
    )
