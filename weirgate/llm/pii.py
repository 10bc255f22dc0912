"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are the spans of fixed forms of e-mail, IP, card and phone.  The words beside a seed are its lexical
patterns.  Patterns and instances (the strings themselves) form a graph: a pattern scores the share of its
occurrences that lead to trusted instances, an instance that is no seed scores the mean of its patterns, ``ROUNDS``
times over.  Patterns of at least ``CONFIDENT`` that hold ``SUPPORT`` different seeds then mark further words that
are loosely of the kind's shape but not of its fixed form.  Seeds always stay.

Positions count code points; a match's place is what the pieces between matches and the matches before it measure.
Null and empty texts hold nothing.  Rows repeated under one id are searched one by one.  An empty table gives an
empty result.  Other columns are not read.  Texts are searched whole; of a neighbouring word the nearest
``NEIGHBOUR`` characters count.

Groups are a document's own matches or are summed per task before they meet, so no pattern gathers its occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.session import work_dir

KINDS = ("email", "ip", "card", "phone")
# The forms.  Possessive quantifiers change no match here; they keep long runs off the stack.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"  # a word with a digit
SHAPES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[0-9]+([.:][0-9]+){3}$",
    "card": r"^[0-9-]{12,23}$",
    "phone": r"^[+(]?[0-9][0-9().-]{6,18}$",
}
BLANK = r"[\x20\x09-\x0D]"
NEIGHBOUR = 64
ROUNDS = 3
CONFIDENT = 0.6
SUPPORT = 3
PRIOR = 1.0


def _valid() -> Column:
    """Whether a match of a form is one in truth."""
    octet = "TRIM(LEADING '0' FROM x)"
    ip = F.expr(f"forall(split(found, '[.]'), x -> length({octet}) <= 3 AND coalesce(try_cast({octet} AS int), 0) <= 255)")
    digits = F.length(F.regexp_replace("found", "[^0-9]", ""))
    luhn = F.expr(
        "aggregate(transform(split(reverse(regexp_replace(found, '[^0-9]', '')), ''),"
        " (c, i) -> cast(c AS int) * (1 + i % 2) - if(cast(c AS int) * (1 + i % 2) > 9, 9, 0)), 0, (s, v) -> s + v) % 10 = 0"
    )
    card = F.when(digits.between(12, 19), luhn).otherwise(False)
    return (
        F.when(F.col("kind") == "ip", ip).when(F.col("kind") == "card", card)
        .when(F.col("kind") == "phone", digits.between(9, 15)).otherwise(True)
    )


def _matches(kind: str, form: str, pieces: Column) -> Column:
    """All matches of a form: kind, number, string, the length of the piece before, the words beside.

    ``pieces`` are what lies between the matches.
    """
    text, pattern = F.coalesce(F.col("text"), F.lit("")), F.lit(form)

    def match(found: Column, at: Column) -> Column:
        before, after = F.get(pieces, at), F.get(pieces, at + 1)
        left = F.regexp_extract(F.substring(before, -NEIGHBOUR, NEIGHBOUR), rf"([^\x20\x09-\x0D]+){BLANK}*$", 1)
        right = F.regexp_extract(F.substring(after, 1, NEIGHBOUR), rf"^{BLANK}*([^\x20\x09-\x0D]+)", 1)
        return F.struct(
            F.lit(kind).alias("kind"), at.alias("at"), found.alias("found"), F.length(before).alias("gap"),
            F.lower(left).alias("left"), F.lower(right).alias("right"),
        )

    return F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), match)


def matched(docs: DataFrame) -> DataFrame:
    """Each row's matches of the forms and its candidate words, from one pass over the texts, written once."""
    path = work_dir(docs.sparkSession, "pii-matches")
    forms = [*FORMS.items(), ("", CANDIDATE)]
    none = F.array().cast("array<struct<kind: string, at: int, found: string, gap: int, left: string, right: string>>")
    # exploded, a text is split once a form; plain columns would be merged into the functions and split for each match
    apart = F.struct(*[
        F.when(F.col("text").rlike(form), F.split("text", form, -1)).alias(f"p{i}") for i, (_, form) in enumerate(forms)
    ])
    split = docs.select("doc_id", "text", F.explode(F.array(apart)).alias("apart"))
    some = [
        F.when(F.col(f"apart.p{i}").isNotNull(), _matches(kind, form, F.col(f"apart.p{i}"))).otherwise(none)
        for i, (kind, form) in enumerate(forms)
    ]
    split.select(
        F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), F.concat(*some).alias("matches")
    ).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def placed(rows: DataFrame) -> DataFrame:
    """The matches with ``start`` and ``end``."""
    flat = rows.select("row", F.explode("matches").alias("m")).select("row", "m.*")
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("found")).over(upto)
    return flat.withColumn("end", end).withColumn("start", F.col("end") - F.length("found"))


def _patterns() -> Column:
    """A match's lexical patterns: the word to its left, the word to its right."""
    sides = F.array(*[
        F.when(F.col(side) != "", F.concat(F.lit(f"{side}:"), F.translate(side, "123456789", "000000000")))
        for side in ("left", "right")
    ])
    return F.explode(F.filter(sides, lambda x: x.isNotNull()))


def candidates(found: DataFrame, seeds: DataFrame) -> DataFrame:
    """Words with a digit outside all seeds, stripped of marks at the ends, once for each kind they may be of."""
    inner = F.regexp_extract("found", r"[0-9A-Za-z+(].*[0-9A-Za-z)]", 0)
    words = found.where("kind = ''").withColumn("inner", inner).where("inner <> ''")
    words = words.withColumn("start", F.col("start") + F.expr("instr(found, inner)") - 1)
    words = words.withColumn("end", F.col("start") + F.length("inner")).withColumn("found", F.col("inner"))
    taken = seeds.select(F.col("row").alias("_row"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    overlap = (F.col("row") == F.col("_row")) & (F.col("start") < F.col("_end")) & (F.col("end") > F.col("_start"))
    free = words.join(taken, overlap, "left_anti")
    kinds = F.filter(
        F.array(*[F.when(F.col("found").rlike(shape), F.lit(kind)) for kind, shape in SHAPES.items()]),
        lambda x: x.isNotNull(),
    )
    return free.select("row", "start", "end", "found", "left", "right", F.explode(kinds).alias("kind"))


def confident_patterns(edges: DataFrame) -> DataFrame:
    """The patterns (kind, pattern) to trust.  ``edges`` has kind, pattern, instance, n and seed."""
    scored = edges.withColumn("trust", F.when(F.col("seed"), 1.0).otherwise(0.0))
    for last in (False,) * (ROUNDS - 1) + (True,):
        patterns = scored.groupBy("kind", "pattern").agg(
            (F.sum(F.col("n") * F.col("trust")) / (F.sum("n") + PRIOR)).alias("score"),
            F.sum(F.col("seed").cast("int")).alias("support"),
        )
        if last:
            return patterns.where((F.col("score") >= CONFIDENT) & (F.col("support") >= SUPPORT))
        instances = (
            edges.where("NOT seed").join(patterns, ["kind", "pattern"]).groupBy("kind", "instance")
            .agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("mean"))
        )
        scored = edges.join(instances, ["kind", "instance"], "left").withColumn(
            "trust", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("mean", F.lit(0.0)))
        )
    raise AssertionError("no round")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per document: the number of seeds of each kind, the digest of the seeds, all spans, those found by context."""
    spark = docs.sparkSession

    def kept(frame: DataFrame, label: str) -> DataFrame:
        path = work_dir(spark, label)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    rows = matched(docs)
    found = kept(placed(rows), "pii-placed")
    seeds = found.where("kind <> ''").where(_valid())
    more = kept(candidates(found, seeds), "pii-candidates")
    occurrences = seeds.select("kind", "found", "left", "right", F.lit(True).alias("seed")).union(
        more.select("kind", "found", "left", "right", F.lit(False))
    )
    edges = kept(
        occurrences.select("kind", _patterns().alias("pattern"), F.lower("found").alias("instance"), "seed")
        .groupBy("kind", "pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed")),
        "pii-edges",
    )
    trusted = kept(confident_patterns(edges).select("kind", "pattern"), "pii-patterns")
    led = more.withColumn("pattern", _patterns()).join(trusted, ["kind", "pattern"], "left_semi")
    new = led.select("row", "kind", "start", "end", F.lit(False).alias("base")).distinct()

    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = seeds.select("row", "kind", "start", "end", F.lit(True).alias("base")).union(new)
    listed = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "end", "kind", "base"))).alias("spans")
    )  # one document's spans

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    none = F.array().cast("array<struct<start: bigint, order: bigint, end: bigint, kind: string, base: boolean>>")
    out = rows.select("doc_id", "row").join(listed, "row", "left").withColumn("spans", F.coalesce("spans", none))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_found"),
    )
