"""Secrets by two character Markov models, in DataFrame functions only.

One model learns from random strings, one from ordinary identifiers; a string is taken for a secret when the logarithm
of the likelihood ratio of its letters exceeds the odds against secrets.  The labelled samples come from the corpus:
what the fixed forms (assignments to a password, access keys, hex digests) hold is random, identifiers outside of
them are ordinary; ``learn`` takes any other labelled strings as well.  Strings of the fixed forms are found in any case.

Each model is a table of letter pairs, bounded by the alphabet, not by the corpus.  Fitting reads at most about
``SAMPLE_DOCS`` documents for identifiers and ``SAMPLE_VALUES`` random strings, chosen by checksum.  Everything else
covers all rows: texts are searched once, whole, and only their matches are moved, once, by row.

Positions count code points; a match's place is what the pieces between matches and the matches before it measure.
Null and empty texts hold nothing.  Rows repeated under one id are searched one by one; a null id counts as empty text
where it is hashed.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.llm.manifest import crc_sql
from weirgate.session import work_dir

KINDS = ("assign", "access", "hex", "random")
# The forms.  Shorter runs of hex digits and of capitals fail whole, so they may as well not match.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_VALUE = "[A-Za-z0-9+/_.=-]"
_BEFORE = r"""["']?\x20*[:=]\x20*["']?"""
FORMS = {
    "assign": rf"(?i:{'|'.join(_NAMES)}){_BEFORE}{_VALUE}++",
    "access": "AKIA[A-Z0-9]{14,}+",
    "hex": "[0-9a-f]{16,}+",
    "random": "[A-Za-z0-9+/_-]{16,}+={0,2}+",
}
LEAST_VALUE = 12
ORDINARY = "[A-Za-z0-9_-]{8,}+"
PLAIN = "^([A-Za-z_-]+[0-9]{0,4}|[0-9_-]+)$"  # letters with a number behind them, or numbers: what random strings seldom are
RANDOM_LIKE = "[0-9a-f]{16}|^AKIA"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 1  # the place 0 is the begin of a string, and any other character
SAMPLE_DOCS = 4_000
SAMPLE_VALUES = 20_000
TRUST_RANDOM, TRUST_ORDINARY = 0.9, 0.99  # the share of what was counted; the rest is spread over the alphabet
ODDS = 10_000.0

_MATCHES = "array<struct<kind: string, at: int, gap: int, found: string>>"


def _sampled(key: Column, total: Column, size: int) -> Column:
    """About ``size`` of ``total`` rows by the checksum of their key."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) * total < F.lit(size << 32)


def _all_matches(kind: str) -> Column:
    """Every match of a form with the length of the piece before it."""
    gaps = F.transform(F.split("text", FORMS[kind], -1), F.length)
    found = F.regexp_extract_all("text", F.lit(FORMS[kind]), F.lit(0))
    listed = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("found")), lambda m, at: F.struct(
        F.lit(kind).alias("kind"), at.alias("at"), m["gap"].alias("gap"), m["found"].alias("found")
    ))
    return F.when(F.col("text").rlike(FORMS[kind]), listed).otherwise(F.array().cast(_MATCHES))


def matched(docs: DataFrame) -> DataFrame:
    """``doc_id, row, matches`` of every row; written, so that rows keep their number."""
    path = work_dir(docs.sparkSession, "secret-matches")
    docs.select(
        F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"),
        F.filter(F.concat(*map(_all_matches, KINDS)), lambda m: m["found"].isNotNull()).alias("matches"),
    ).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _long_enough() -> Column:
    return F.col("found").rlike(rf"^(?i:{'|'.join(_NAMES)}){_BEFORE}{_VALUE}{{{LEAST_VALUE},}}$")


def _is_base() -> Column:
    return F.when(F.col("kind") == "assign", _long_enough()).otherwise(F.col("kind") != "random")


def seed_values(rows: DataFrame) -> DataFrame:
    """What the fixed forms hold, each string once."""
    base = rows.select(F.inline("matches")).where(_is_base())
    value = F.regexp_extract("found", rf"^(?i:{'|'.join(_NAMES)}){_BEFORE}(.*)$", 1)
    return base.select(F.when(F.col("kind") == "assign", value).otherwise(F.col("found")).alias("value")).distinct()


def ordinary_identifiers(docs: DataFrame) -> DataFrame:
    """Plain identifiers of a sample of documents, but those that look like a fixed form."""
    some = docs.where(_sampled(F.col("doc_id"), docs.agg(F.count("*")).scalar(), SAMPLE_DOCS))
    found = some.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("value"))
    return found.where(F.col("value").rlike(PLAIN) & ~F.col("value").rlike(RANDOM_LIKE))


def labelled(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``value, secret``: the labelled sample."""
    seeds = seed_values(rows)
    some = seeds.where(_sampled(F.col("value"), seeds.agg(F.count("*")).scalar(), SAMPLE_VALUES))
    return some.withColumn("secret", F.lit(True)).union(ordinary_identifiers(docs).withColumn("secret", F.lit(False)))


def _place(letter: Column) -> Column:
    return F.position(letter, F.lit(ALPHABET))


def _letters(value: Column) -> tuple[Column, Column]:
    """The letters of a string, and for each the one before it."""
    letters = F.split(value, "")
    return F.concat(F.array(F.lit("^")), F.slice(letters, F.lit(1), F.length(value) - 1)), letters


def learn(samples: DataFrame) -> DataFrame:
    """One row, ``ratios``: for each pair of letters, the logarithm of its chance in a random string over that in an
    identifier."""
    before, letters = _letters(F.col("value"))
    pairs = samples.where("value <> ''").select(
        "secret", F.inline(F.arrays_zip(before.alias("before"), letters.alias("letter")))
    ).groupBy("secret", "before", "letter").agg(F.count("*").alias("n"))
    counted = pairs.groupBy((_place(F.col("before")) * SIZE + _place(F.col("letter"))).cast("long").alias("pair")).agg(
        F.sum(F.when(F.col("secret"), F.col("n")).otherwise(0)).alias("random"),
        F.sum(F.when(F.col("secret"), 0).otherwise(F.col("n"))).alias("ordinary"),
    )
    grid = samples.sparkSession.range(SIZE * SIZE).withColumnRenamed("id", "pair").join(counted, "pair", "left").na.fill(0)
    after = Window.partitionBy(F.expr(f"pair div {SIZE}"))  # pairs of one letter before: at most the alphabet

    def chance(name: str, trust: float) -> Column:
        total = F.sum(name).over(after)
        return F.when(total > 0, trust * F.col(name) / total + (1 - trust) / SIZE).otherwise(F.lit(1 / SIZE))

    ratio = F.log(chance("random", TRUST_RANDOM)) - F.log(chance("ordinary", TRUST_ORDINARY))
    table = grid.select("pair", ratio.alias("ratio")).agg(F.array_sort(F.collect_list(F.struct("pair", "ratio"))).alias("cells"))
    return table.select(F.transform("cells", lambda c: c["ratio"]).alias("ratios"))


def evidence(value: Column, model: DataFrame) -> Column:
    """The logarithm of the likelihood ratio of a string; linear in its length.

    The model goes into the expression as a constant: as many numbers as there are pairs of letters.
    """
    ratios = F.split(F.lit(",".join(map(repr, model.first()["ratios"]))), ",").cast("array<double>")
    before, letters = _letters(value)
    each = F.zip_with(before, letters, lambda a, b: F.element_at(ratios, _place(a) * SIZE + _place(b) + 1))
    return F.aggregate(each, F.lit(0.0), lambda total, x: total + x)


def find_secrets(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Per document: the number of matches of each fixed form, their digest, all spans, those found by the models.

    ``samples`` (value, secret) are labelled strings to learn from; without them the corpus labels its own.
    """
    spark = docs.sparkSession
    rows = matched(docs)
    model = learn(labelled(docs, rows) if samples is None else samples)

    flat = rows.select("doc_id", "row", F.explode_outer("matches").alias("m")).select("doc_id", "row", "m.*").repartition("row")
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("found")
    spans = flat.withColumn("end", F.sum(F.col("gap") + size).over(upto)).select(
        "doc_id", "row", "kind", (F.col("end") - size).alias("start"), "end", F.coalesce(_is_base(), F.lit(False)).alias("base"),
        F.when(F.col("kind") == "random", evidence(F.col("found"), model) >= F.log(F.lit(ODDS))).alias("likely"),
        F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("order"),
    )
    earlier = Window.partitionBy("row").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("order")).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("base")
    taken = (F.coalesce(F.max(F.when(base, F.col("end"))).over(earlier), F.lit(0)) > F.col("start")) | (
        F.coalesce(F.min(F.when(base, F.col("start"))).over(later) < F.col("end"), F.lit(False))
    )
    new = F.coalesce("likely", F.lit(False)) & ~taken
    kept = F.when(base | new, F.struct("start", "order", "end", "kind", "base"))
    listed = spans.withColumn("span", kept).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list("span")).alias("spans")
    )  # one document's spans

    def joined(chosen: Column) -> Column:
        parts = F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.concat_ws(",", parts)

    fixed = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(fixed, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return listed.select(
        "doc_id", *map(count, KINDS[:3]), F.sha2(joined(fixed), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(fixed)).cast("long").alias("n_random"),
    )


def _sql_form(kind: str) -> str:
    """A form without what DuckDB's expressions lack."""
    either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "|".join(_NAMES))
    plain = FORMS[kind].replace(f"(?i:{'|'.join(_NAMES)})", f"(?:{either})").replace("++", "+").replace("}+", "}")
    return plain.replace("'", "''")


_EITHER = _sql_form("assign").split(")")[0] + ")"
_SQL_VALUE = f"regexp_extract(found, '^{_EITHER}{_BEFORE.replace(chr(39), chr(39) * 2)}(.*)$', 1)"
_FOUND_SQL = " union all ".join(
    f"select r, doc_id, '{kind}' as kind, {order} as ord, unnest(range(len(regexp_extract_all(text, '{_sql_form(kind)}')))) as nth, "
    f"unnest(list_transform(regexp_split_to_array(text, '{_sql_form(kind)}')[:-2], lambda p: length(p))) as gap, "
    f"unnest(regexp_extract_all(text, '{_sql_form(kind)}')) as found from docs where regexp_matches(text, '{_sql_form(kind)}')"
    for order, kind in enumerate(KINDS, 1)
)


def _pairs_sql(source: str, columns: str) -> str:
    """Each letter of ``value`` with the one before it."""
    return f"""select {columns}, value[i - 1] as before, value[i] as letter from
      (select *, unnest(range(1, length(value) + 1)) as i from {source})"""


def _place_sql(letter: str) -> str:
    return f"(case when {letter} = '' then 0 else instr('{ALPHABET}', {letter}) end)"


def _chance_sql(name: str, trust: float) -> str:
    return f"case when sum({name}) over w > 0 then {trust}::double * {name} / sum({name}) over w + (1 - {trust}::double) / {SIZE} else 1.0::double / {SIZE} end"


SQL = f"""
with docs as (select row_number() over () as r, doc_id, text from documents),
matches as ({_FOUND_SQL}),
spans as (
  select *, sum(gap + length(found)) over (partition by r, kind order by nth) as e,
    kind in ('access', 'hex') or (kind = 'assign' and length({_SQL_VALUE}) >= {LEAST_VALUE}) as base from matches),
seeds as (select distinct case kind when 'assign' then {_SQL_VALUE} else found end as value from spans where base),
words as (
  select unnest(regexp_extract_all(text, '{ORDINARY.replace("}+", "}")}')) as value from docs
  where {crc_sql("coalesce(doc_id::varchar, '')")} * (select count(*) from docs) < {SAMPLE_DOCS << 32}),
samples as (
  select value, true as secret from seeds where {crc_sql("value")} * (select count(*) from seeds) < {SAMPLE_VALUES << 32}
  union all select value, false from words where regexp_matches(value, '{PLAIN}') and not regexp_matches(value, '{RANDOM_LIKE}')),
counted as (
  select {_place_sql("before")} * {SIZE} + {_place_sql("letter")} as pair, count(*) filter (secret) as random, count(*) filter (not secret) as ordinary
  from ({_pairs_sql("samples", "secret")}) group by 1),
model as (
  select pair, ln({_chance_sql("random", TRUST_RANDOM)}) - ln({_chance_sql("ordinary", TRUST_ORDINARY)}) as ratio
  from (select pair, coalesce(random, 0) as random, coalesce(ordinary, 0) as ordinary
    from (select unnest(range({SIZE * SIZE})) as pair) left join counted using (pair))
  window w as (partition by pair // {SIZE})),
judged as (
  select value, sum(ratio) >= ln({ODDS}) as likely
  from ({_pairs_sql("(select distinct found as value from matches where kind = 'random')", "value")})
  join model on pair = {_place_sql("before")} * {SIZE} + {_place_sql("letter")} group by value),
kept as (
  select r, kind, ord, e - length(found) as s, e, base from spans x left join judged on kind = 'random' and value = found
  where base or (likely and not exists (
    select 1 from spans b where b.base and b.r = x.r and b.e - length(b.found) < x.e and b.e > x.e - length(x.found))))
select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
  count(*) filter (kind = 'hex') as n_hex,
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) filter (base), '')) as base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, ord), '') as spans, count(*) filter (kind = 'random') as n_random
from docs left join kept using (r) group by r, doc_id
"""
