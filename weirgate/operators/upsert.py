"""Keyed upsert into Parquet, for catalogs without a table format that has MERGE.

Rows live in hash buckets of their key.  A batch is written as one new generation: a bucket of which it changes a
small part gets only the changed rows, any other bucket is written whole.  Readers take the newest row per key in
buckets that hold such changes and read all others as they are.  Then one small file is appended that names the
generation of each touched bucket.  That append is the only step readers can see, so a crash at any point leaves
either the old table or the new one.  One writer per table at a time.

So a batch writes rows in proportion to its size: a bucket is written whole once its changes pass ``FOLD_SHARE`` of
it or come in ``MAX_CHANGES`` pieces.  Buckets have a bounded size: when the table has grown past ``rows_per_bucket``
on average, the next upsert rewrites it into more of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weirgate.operators.latest import latest_record
from weirgate.session import folder_names, read_table, remove, small_frame

ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS = 4
LANES = 8
FOLD_SHARE = 0.25
MAX_CHANGES = 16

_HEADS_DDL = "bucket int, generation bigint, buckets int, stored_rows bigint, whole boolean, key string"


class Head(NamedTuple):
    """State of one bucket: the rows of its last whole generation and of each generation of changes since."""

    buckets: int
    live: dict[int, int]
    key: str | None

    @property
    def newest(self) -> int:
        return max(self.live)

    @property
    def stored_rows(self) -> int:
        return self.live[min(self.live)]

    @property
    def changes(self) -> int:
        return len(self.live) - 1

    @property
    def changed_rows(self) -> int:
        return sum(self.live.values()) - self.stored_rows


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _heads(spark: SparkSession, path: str) -> dict[int, Head]:
    """At most one entry per bucket; heads of an earlier number of buckets and of generations that were replaced are
    history.  A repeated publish counts once."""
    past = read_table(spark, f"{path}/heads", _HEADS_DDL)
    whole = F.coalesce("whole", F.lit(True))
    rows = past.groupBy("bucket", "buckets").agg(
        F.max(F.when(whole, F.col("generation"))).alias("base"), F.max("key").alias("key"),
        F.collect_set(F.struct("generation", "stored_rows")).alias("all"),
    ).select("bucket", "buckets", "key", F.filter("all", lambda x: x["generation"] >= F.col("base")).alias("live")).collect()
    buckets = max((r["buckets"] for r in rows), default=0)
    return {
        r["bucket"]: Head(r["buckets"], {x["generation"]: x["stored_rows"] for x in r["live"]}, r["key"])
        for r in rows if r["buckets"] == buckets
    }


def _columns_besides(spark: SparkSession, path: str, heads: dict[int, Head], columns: Sequence[str]) -> list[T.StructField]:
    """Stored columns that a batch lacks.  Each generation is written with all columns of those before it, so the
    newest one that is visible knows them all."""
    if not heads:
        return []
    newest = max(head.newest for head in heads.values())
    known = {name.lower() for name in columns} | {"_bucket"}
    return [f for f in spark.read.parquet(f"{path}/data/_generation={newest}").schema if f.name.lower() not in known]


def _bucket_count(rows: int, rows_per_bucket: int) -> int:
    """Powers of two, so that growth is rare."""
    wanted = MIN_BUCKETS
    while wanted * rows_per_bucket < rows:
        wanted *= 2
    return wanted


def _live(spark: SparkSession, path: str, heads: dict[int, Head], wanted: Sequence[int], ddl: str) -> DataFrame:
    """Rows of the live generations of the wanted buckets, with ``_generation`` and ``_bucket``.

    Generations and buckets are predicates on the partition columns, so folders of others are not opened, and no list
    of paths goes through the driver; a join with the few pairs leaves out what is neither's.
    """
    pairs = [(generation, b) for b in wanted if b in heads for generation in heads[b].live]
    if not pairs:
        return small_frame(spark, [], f"{ddl}, _generation bigint, _bucket int")
    stored = spark.read.schema(f"{ddl}, _generation bigint, _bucket int").parquet(f"{path}/data")
    generations = sorted({generation for generation, _ in pairs})
    found = stored.where(F.col("_generation").isin(generations))
    if len(wanted) < len(heads):
        found = found.where(F.col("_bucket").isin(list(wanted)))
    if len(generations) == 1:
        return found
    return found.join(small_frame(spark, pairs, "_generation bigint, _bucket int"), ["_generation", "_bucket"], "left_semi")


def read_keyed(spark: SparkSession, path: str, ddl: str, order: Sequence[Column] | None = None) -> DataFrame:
    """The current rows of a keyed table.  ``order`` is the one that the table is written with."""
    heads = _heads(spark, path)
    columns = [f.name for f in T.StructType.fromDDL(ddl)]
    rows = _live(spark, path, heads, sorted(heads), ddl)
    changed = [(b, head.key) for b, head in heads.items() if head.changes]
    if not changed:
        return rows.select(columns)
    mixed = small_frame(spark, [(b,) for b, _ in changed], "_bucket int")
    resolved = latest_record(rows.join(mixed, "_bucket", "left_semi"), ["_bucket", changed[0][1]], order or [F.desc("_generation")])
    return rows.join(mixed, "_bucket", "left_anti").select(columns).unionByName(resolved.select(columns))


def stage_upsert(
    batch: DataFrame, path: str, key: str, newest_first: Sequence[Column], rows_per_bucket: int = ROWS_PER_BUCKET,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Write a batch as a new generation and return its heads, not yet visible.

    The batch is first reduced to its newest row per key, so a hot key is one row.  Buckets to be written whole bring
    their stored rows along; all rows are partitioned once, by bucket and lane, and the choice per key and the write
    both use that partitioning.  Lanes let several tasks share a bucket.  Incoming rows replace stored ones, unless an
    ``order`` decides between all rows of a key.
    """
    spark = batch.sparkSession
    heads = _heads(spark, path)
    rows, keyless = sum(h.stored_rows + h.changed_rows for h in heads.values()), F.col(key).isNull().alias("keyless")
    if not heads:
        rows, without = batch.agg(F.count(F.lit(1)), F.count_if(keyless)).first()
        _refuse(without > 0)
    had = next(iter(heads.values())).buckets if heads else 0
    buckets = max(had, _bucket_count(rows, rows_per_bucket))
    only_stored = _columns_besides(spark, path, heads, batch.columns)
    if not heads or buckets != had:
        reread = sorted(heads)
        whole = None  # all of them
    else:
        counts = batch.groupBy(_bucket(key, buckets).alias("bucket"), keyless).agg(F.count(F.lit(1)).alias("n")).collect()
        _refuse(any(r["keyless"] for r in counts))
        if not counts:
            return small_frame(spark, [], _HEADS_DDL)
        whole = {r["bucket"] for r in counts if only_stored or _due(heads.get(r["bucket"]), r["n"])}
        reread = sorted(whole & heads.keys())
    generation = 1 + max((h.newest for h in heads.values()), default=0)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*batch.schema, *only_stored])

    incoming = latest_record(batch, [key], newest_first).withColumn("_generation", F.lit(generation).cast("bigint"))
    stored = _live(spark, path, heads, reread, ddl).drop("_bucket")
    both = stored.unionByName(incoming, allowMissingColumns=True).withColumns({
        "_bucket": _bucket(key, buckets), "_lane": F.pmod(F.hash(key), F.lit(LANES))
    }).repartition("_bucket", "_lane")
    same_key = Window.partitionBy("_bucket", "_lane", key)
    earlier = F.when(F.col("_generation") < generation, F.col("_generation"))
    both = both.withColumns({f.name: F.max_by(f"`{f.name}`", earlier).over(same_key) for f in only_stored})
    merged = latest_record(both, ["_bucket", "_lane", key], order or [F.desc("_generation")]).drop("_generation", "_lane")
    folder = f"{path}/data/_generation={generation}"
    merged.write.mode("overwrite").partitionBy("_bucket").parquet(folder)
    written = read_table(spark, folder, f"{ddl}, _bucket int").groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    return small_frame(spark, [
        (r["_bucket"], generation, buckets, r["n"], whole is None or r["_bucket"] in whole, key) for r in written.collect()
    ], _HEADS_DDL)


def _due(head: Head | None, incoming: int) -> bool:
    """Whether a bucket is written whole: it is new, or has changed too much or too often since it last was."""
    if head is None:
        return True
    return head.changes + 1 > MAX_CHANGES or head.changed_rows + incoming > FOLD_SHARE * head.stored_rows


def _refuse(keyless: bool) -> None:
    if keyless:
        raise ValueError("upsert: a row without a key")


def publish(heads: DataFrame, path: str) -> None:
    """Make a staged generation current."""
    heads.coalesce(1).write.mode("append").parquet(f"{path}/heads")


def upsert(
    batch: DataFrame, path: str, key: str, newest_first: Sequence[Column], rows_per_bucket: int = ROWS_PER_BUCKET,
    order: Sequence[Column] | None = None,
) -> None:
    """Replace rows whose key is stored, insert the others, delete nothing."""
    publish(stage_upsert(batch, path, key, newest_first, rows_per_bucket, order), path)


def drop_stale(spark: SparkSession, path: str) -> list[int]:
    """Remove generations that no bucket uses any more, while nothing reads or writes."""
    used = {generation for head in _heads(spark, path).values() for generation in head.live}
    stored = [int(name.removeprefix("_generation=")) for name in folder_names(spark, f"{path}/data")]
    stale = sorted(g for g in stored if used and g < max(used) and g not in used)
    for generation in stale:
        remove(spark, f"{path}/data/_generation={generation}")
    return stale


def merge_into(batch: DataFrame, table: str, key: str, newest_first: Sequence[Column], columns: Sequence[str]) -> None:
    """The same upsert by the table's own MERGE, for catalogs whose format has one.

    Columns are listed, so columns that only the table has keep their values.
    """
    values = {name: F.col(f"incoming.{name}") for name in columns}
    target = table.split(".")[-1]
    (
        latest_record(batch, [key], newest_first).alias("incoming")
        .mergeInto(table, F.col(f"incoming.{key}") == F.col(f"{target}.{key}"))
        .whenMatched().update(values)
        .whenNotMatched().insert(values)
        .merge()
    )
