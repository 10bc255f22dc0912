"""Mixing sources to target weights by a low-discrepancy schedule.

Slot ``i`` of the mix takes the golden-ratio point ``frac(i * PHI)``, mapped through the cumulative targets to a
source.  The slots of a source are ranked in order, and slot by slot they take the blocks of ``BLOCK`` words that
its documents, shuffled by the hash of their id, form end to end.  The words go round: after the last the first comes
again in the same block, up to ``LAPS`` times.  The last block of a source ends at its target, so a source gets its
target to the word, however small.  Slots beyond it stay empty; blocks that the points leave without a slot, a few for
each source (as the points' discrepancy says), follow at the end of the mix.

Sources by code point, null last, weigh 1, 2, 3, repeating; they share the number of all words, none above ``LAPS``
times its own size, the excess going to the others by weight.  A null or empty text has size 0 and is never taken.
A null source is a source.  Rows repeated under one id are documents of their own.  An empty table gives an empty
result.  Other columns are not read.  Reruns agree.

``sequence`` is the mix itself, with its texts; ``mixed`` has the same pieces by document; ``mix`` counts them.  A piece
is cut from its text as it stands: blanks go with the word before them, those that begin a text with its first word.

Running sums go over ranges first and inside a range after, so no window holds a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.session import work_dir

PHI = 0.6180339887498949
BLOCK = 64
LAPS = 3
WORD = r"[^\x20\x09-\x0D]+"
WORD_AND_BLANKS = r"(?:\A[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"
CELLS = 1024
RANGE_ROWS = 20_000


def sized(docs: DataFrame, *also: str) -> DataFrame:
    """doc_id, source, size and place in the shuffle, written once, each row with a number of its own."""
    path = work_dir(docs.sparkSession, "mix-sizes")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place"),
        F.monotonically_increasing_id().alias("row"), *also,
    ).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def targets(rows: DataFrame) -> DataFrame:
    """Per source: its number, size, target, that in whole words, and its stretch of the cumulative targets, as shares.

    The level of water at which all targets meet is the largest of the levels that come from filling the
    sources in order of their limits.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit", "number")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighted = sums.withColumn("number", F.row_number().over(by_name)).withColumn("weight", 1 + (F.col("number") - 1) % 3)
    limited = weighted.withColumn("limit", LAPS * F.col("source_size") / F.col("weight"))
    before = F.coalesce(F.sum(LAPS * F.col("source_size")).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    level = F.max("level").over(Window.partitionBy())
    reached = limited.withColumn("level", (total - before) / left).withColumn("level", level)
    shared = reached.withColumn("target", F.least(LAPS * F.col("source_size").cast("double"), F.col("level") * F.col("weight")))
    upto = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (
        shared.withColumn("upto", F.try_divide(upto, whole))
        .withColumn("since", F.coalesce(F.lag("upto").over(by_name), F.lit(0.0)))
        .withColumn("last", F.col("number") == F.max("number").over(Window.partitionBy()))
        .withColumn("words", F.floor(F.col("target") + 0.5))
        .select("source", "number", "source_size", "target", "words", "since", F.when(F.col("last"), 2.0).otherwise(F.col("upto")).alias("upto"))
    )


def running(rows: DataFrame, group: str, stretch: Column, order: list[str], amount: Column, name: str) -> DataFrame:
    """``name``: the sum of ``amount`` over the rows of the group that come before, in the order given.

    ``stretch`` cuts the order into ranges; ranges are summed first.
    """
    ranged = rows.withColumn("_stretch", stretch)
    of_range = ranged.groupBy(group, "_stretch").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_range.select(group, "_stretch", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = summed.join(starts, [group, "_stretch"])
    return joined.withColumn(name, F.col("_start") + F.col("_inside")).drop("_stretch", "_start", "_inside")


def schedule(rows: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """The mix in order: slot, source number, block of the source.  Each block of a target has one slot."""
    spark = rows.sparkSession
    slots = -(-total // BLOCK)
    points = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") * F.lit(PHI)).alias("x"))
    points = points.select("slot", (F.col("x") - F.floor("x")).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS))
    stretches = sources.where("words > 0").select(
        "number", "since", "upto",
        F.explode(F.sequence(F.floor(F.col("since") * CELLS), F.least(F.floor(F.col("upto") * CELLS), F.lit(CELLS - 1)))).alias("cell"),
    )
    placed = points.join(stretches, "cell").where("point >= since AND point < upto").select("slot", "number")
    length = max(RANGE_ROWS, math.isqrt(max(slots, 1)))
    ranked = running(placed, "number", F.floor(F.col("slot") / length), ["slot"], F.lit(1), "block")
    wanted = sources.where("words > 0").select("number", F.ceil(F.col("words") / BLOCK).alias("wanted"))
    used = ranked.join(wanted, "number").where("block < wanted").select("slot", "number", "block")
    had = placed.groupBy("number").agg(F.count("*").alias("had"))
    short = wanted.join(had, "number", "left").na.fill(0, ["had"]).where("had < wanted")
    late = short.select("number", "had", F.explode(F.sequence(F.col("had"), F.col("wanted") - 1)).alias("block"))
    after = F.lit(slots) + (F.col("block") - F.col("had")) * F.lit(sources.count()) + F.col("number") - 1
    return used.union(late.select(after.alias("slot"), "number", "block"))


def blocks(rows: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """What the blocks of a source take of its shuffled documents: source number, block, row and the words that lie
    in it, with the place of the first in the block (``at``).  A document lies in each lap that its source goes."""
    digits = max(1, math.ceil(math.log(max(count / RANGE_ROWS, 1), 16)))
    about = sources.where("words > 0").select(F.col("source").alias("_of"), "number", "source_size", F.col("words").alias("wanted"))
    numbered = rows.join(about, F.col("source").eqNullSafe(F.col("_of"))).where("size > 0")
    numbered = numbered.select("row", "number", "size", "place", "doc_id", "source_size", "wanted")
    put = running(numbered, "number", F.substring("place", 1, digits), ["place", "doc_id", "size", "row"], F.col("size"), "start")
    laps = F.floor((F.col("wanted") - 1 - F.col("start")) / F.col("source_size"))
    turned = put.where("start < wanted").withColumn("lap", F.explode(F.sequence(F.lit(0).cast("long"), laps)))
    begin = F.col("start") + F.col("lap") * F.col("source_size")
    end = F.least(begin + F.col("size"), F.col("wanted"))
    laid = turned.select("number", "row", begin.alias("begin"), end.alias("end"))
    cut = laid.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))))
    first = F.greatest(F.col("begin"), F.col("block") * BLOCK)
    return cut.select(
        "number", "block", "row", (first - F.col("block") * BLOCK).alias("at"), (first - F.col("begin")).alias("first_word"),
        (F.least(F.col("end"), (F.col("block") + 1) * BLOCK) - first).alias("words"),
    )


def pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and what the slots take: slot, word of the slot (``at``), row, first_word, words."""
    spark = rows.sparkSession
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("total")).first()
    path = work_dir(spark, "mix-targets")
    targets(rows).write.parquet(path)
    sources = spark.read.parquet(path)
    cut = blocks(rows, sources, totals["n"]).join(schedule(rows, sources, totals["total"]), ["number", "block"])
    return sources, cut.select("slot", "at", "row", "first_word", "words")


def mix(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes of it."""
    rows = sized(docs)
    sources, cut = pieces(rows)
    taken = cut.groupBy("row").agg(F.sum("words").alias("taken"))
    about = sources.select(F.col("source").alias("_of"), "source_size", "target")
    return (
        rows.join(about, F.col("source").eqNullSafe(F.col("_of")))
        .join(taken, "row", "left")
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed(docs: DataFrame) -> DataFrame:
    """Per document in the mix: its size, the words taken of it, and ``pieces``: slot, at, first_word, words, text.

    Ordered by slot and ``at``, the pieces of all documents are the mix.
    """
    rows = sized(docs, "text")
    _, cut = pieces(rows.drop("text"))
    of_row = cut.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("slot", "at", "first_word", "words"))).alias("cuts"),  # one document's
        F.sum("words").cast("long").alias("taken"),
    )
    # exploded, a text is split once; a plain column would be merged into the function below and split for each piece
    words_of = F.explode(F.array(F.regexp_extract_all("text", F.lit(WORD_AND_BLANKS), F.lit(0)))).alias("split")
    split = rows.join(of_row, "row").select("doc_id", "source", "size", "taken", "cuts", words_of)

    def piece(cut: Column) -> Column:
        words = F.slice("split", (cut["first_word"] + 1).cast("int"), cut["words"].cast("int"))
        return F.struct(
            cut["slot"].alias("slot"), cut["at"].alias("at"), cut["first_word"].alias("first_word"),
            cut["words"].alias("words"), F.array_join(words, "").alias("text"),
        )

    return split.select("doc_id", "source", "size", "taken", F.transform("cuts", piece).alias("pieces"))


def sequence(docs: DataFrame) -> DataFrame:
    """The mix, to be ordered by slot and ``at``: slot, at, doc_id, source, first_word, words, text."""
    flat = mixed(docs).select("doc_id", "source", F.explode("pieces").alias("p"))
    return flat.select("p.slot", "p.at", "doc_id", "source", "p.first_word", "p.words", "p.text")


SQL = rf"""
WITH r AS (
  SELECT row_number() OVER () AS row, doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS place,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
  FROM documents
), s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM r GROUP BY source
), s1 AS (
  SELECT *, 1 + (number - 1) % 3 AS weight, {LAPS} * source_size / (1 + (number - 1) % 3) AS lim FROM s0
), s2 AS (
  SELECT *, max(level) OVER () AS top FROM (
    SELECT *, (sum(source_size) OVER ()
      - coalesce(sum({LAPS} * source_size) OVER (ORDER BY lim, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY lim, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s1)
), s3 AS (
  SELECT source, number, source_size, least({LAPS} * source_size::DOUBLE, top * weight) AS target FROM s2
), s AS (
  SELECT *, floor(target + 0.5)::BIGINT AS words FROM s3
), put AS (
  SELECT r.row, r.size, s.words // s.source_size AS laps, s.words % s.source_size AS rest,
    coalesce(sum(r.size) OVER (PARTITION BY s.number ORDER BY place, doc_id, size, row
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM r JOIN s ON r.source IS NOT DISTINCT FROM s.source WHERE r.size > 0
), taken AS (
  SELECT row, laps * size + greatest(0, least(start + size, rest) - start) AS taken FROM put
)
SELECT r.doc_id, r.source, r.size, s.source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM r JOIN s ON r.source IS NOT DISTINCT FROM s.source LEFT JOIN taken t USING (row)
"""
