"""From groups of likely partners to verified links: first each member with its group's pivot, then pairs that are
still in different components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm.components import components
from weirgate.llm.sampling import passing, sieve
from weirgate.session import remove, work_dir


LARGE = 512  # of sets this large nearly all MinHash bins are filled, so the bits of their tokens are independent


def sketch_of(odd: int) -> Column:
    """The sketch of a set as one column: its size, 128 bits of MinHash tokens, ``odd`` longs of its odd sketch."""
    return F.struct("n", "s1", "s2", *[f"o{i}" for i in range(odd)]).alias("sketch")


def shared_groups(members: DataFrame) -> DataFrame:
    """The members (grp, id) of groups of two or more, each once.  Only these two numbers are dealt by group."""
    dealt = members.select("grp", "id").repartition("grp")
    ends = dealt.groupBy("grp").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("grp")
    return dealt.join(ends, "grp").distinct()


def likely(sketches: DataFrame, left: str, right: str, percent: int, most_bits: int) -> Column:
    """Whether two sketched sets may have ``percent`` of their union in common.

    Sizes and odd sketches lose no link: an element held by one of the two flips at most one bit, and at ``percent``
    at most (100 - percent) / (100 + percent) of both sizes are held by one.  Tokens are asked only of large sets.
    """
    fields = sketches.schema["sketch"].dataType.names
    n, m = F.col(f"{left}sketch.n"), F.col(f"{right}sketch.n")

    def differing(names: list[str]) -> Column:
        bits = [F.bit_count(F.col(f"{left}sketch.{x}").bitwiseXOR(F.col(f"{right}sketch.{x}"))) for x in names]
        return reduce(Column.__add__, bits)

    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    odd = differing([x for x in fields if x.startswith("o")]) * (100 + percent) <= (n + m) * (100 - percent)
    return sizes & odd & ((F.least(n, m) < LARGE) | (differing(["s1", "s2"]) <= most_bits))


def star_pairs(groups: DataFrame, sketches: DataFrame, percent: int, most_bits: int) -> DataFrame:
    """Each member with the pivot of its group (one member, chosen by hash), where they are likely near and, as far as
    their components are known, these differ.  Sketches are brought to each pair once."""
    rest = [c for c in groups.columns if c != "grp"]
    pivots = groups.groupBy("grp").agg(F.min(F.struct(F.xxhash64("grp", "id").alias("by"), *rest)).alias("pivot"))
    others = groups.join(pivots, "grp").where(F.col("id") != F.col("pivot.id"))
    if "component" in rest:
        others = others.where(F.col("component") != F.col("pivot.component"))
    return sifted(others.select("id", F.col("pivot.id").alias("other")), sketches, percent, most_bits)


def more_star_pairs(level: DataFrame, sketches: DataFrame, percent: int, most_bits: int) -> DataFrame:
    """Members outside their group's largest component with up to ``PIVOTS`` members of it, where they are likely near.

    In a large group of near copies most are so connected by a number of pairs that grows with the members.  Groups of
    few members are left to comparison.
    """
    large = level.where(F.col("members") > MANY)
    by = F.xxhash64("grp", "id")
    pivots = large.where("component = top").groupBy("grp", F.pmod(by, F.lit(PIVOTS)).alias("nth")).agg(F.min(F.struct(by.alias("by"), "id")).alias("p"))
    others = large.where("component <> top").select("grp", "id").join(pivots.select("grp", F.col("p.id").alias("other")), "grp")
    return sifted(others, sketches, percent, most_bits)


def sifted(met: DataFrame, sketches: DataFrame, percent: int, most_bits: int) -> DataFrame:
    """The pairs (a, b) of ``id`` and ``other`` that are likely near, each once."""
    met = met.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("lsketch"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("rsketch"))
    return met.join(left, "a").join(right, "b").where(likely(sketches, "l", "r", percent, most_bits)).select("a", "b")


def named(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members with the component that ``labels`` gives them, their own id where it gives none."""
    found = members.drop("component").join(labels.withColumnRenamed("node", "id"), "id", "left")
    return found.withColumn("component", F.coalesce("component", "id"))


def mixed_groups(members: DataFrame) -> DataFrame:
    """The members of groups that hold more than one component, with the group's largest one, how many pairs cross and
    what the hash of its pivot is."""
    counted = members.groupBy("grp", "component").agg(F.count("*").alias("m"), F.min(F.xxhash64("grp", "id")).alias("by"))
    mixed = counted.groupBy("grp").agg(
        (F.sum(F.col("m")) ** 2 - F.sum(F.col("m") ** 2)).alias("crossing"),  # ordered pairs of different components
        F.sum("m").alias("members"), F.max(F.struct("m", "component")).alias("top"), F.min("by").alias("by"),
    ).where("crossing > 0")
    outside = (F.col("members") - F.col("top.m")).alias("outside")
    return members.join(mixed.select("grp", "crossing", "members", outside, F.col("top.component").alias("top"), "by"), "grp")


def not_met(level: DataFrame) -> DataFrame:
    """The members without their group's pivot, which has met all others, and so without groups of two."""
    return level.where((F.col("members") > 2) & (F.xxhash64("grp", "id") != F.col("by")))


def with_homes(members: DataFrame) -> DataFrame:
    """The members with the least ``HOMES`` groups of their level that they are in."""
    homes = members.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("grp")), 1, HOMES).alias("homes"))
    return members.join(homes, "id")


def cross_pairs(members: DataFrame, sketches: DataFrame, percent: int, most_bits: int) -> DataFrame:
    """Pairs of a group whose components differ and that are likely near.

    Members outside the group's largest component meet all others, so copies in one component never meet.  Two meet
    only in the least of the groups that they share, as far as ``homes`` tells, which lists the first groups of each
    member: two that share none of them meet in every group that they share.  Where many are outside, these are split
    into parts of ``SPREAD`` that meet the whole group.
    """
    parts = F.ceil(F.col("outside") / SPREAD)
    full = members.join(sketches, "id")
    left = full.where("component <> top").withColumn("part", F.pmod(F.xxhash64("id"), parts)).alias("l")
    right = full.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).alias("r")
    once = (F.col("r.component") == F.col("r.top")) | (F.col("l.id") > F.col("r.id"))
    meet = (F.col("l.component") != F.col("r.component")) & once & likely(sketches, "l.", "r.", percent, most_bits)
    least = F.coalesce(F.array_min(F.array_intersect("l.homes", "r.homes")) >= F.col("l.grp"), F.lit(True))
    together = (F.col("l.grp") == F.col("r.grp")) & (F.col("l.part") == F.col("r.part"))
    near = left.join(right, together).where(meet & least)
    return near.select(F.greatest("l.id", "r.id").alias("a"), F.least("l.id", "r.id").alias("b")).distinct()


def rare_groups(sets: DataFrame, wanted: DataFrame, to_set: Callable[[bytes], np.ndarray], percent: int) -> DataFrame:
    """Groups (grp, id) in which any two sets with ``percent`` of their union in common meet.

    Two such sets of n and m elements have at least ``percent`` of n and of m in common.  In any order of all elements
    the first ``n - least + 1`` of the one and ``m - least + 1`` of the other then share an element.  Elements stand
    by how often their slot of ``SLOTS`` is held, the rarest first, so that these groups are small.  The sets of the
    ids in ``wanted`` meet, and a few that the sieve lets through; no set is moved.
    """
    mesh, sets = sieve(wanted, "id"), sets.where("id IS NOT NULL")
    those = through(mesh)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in those(batches):
            for payload in batch.column("payload"):
                np.add.at(total, slots(to_set(payload.as_py())), 1)
        some = total.reshape(-1, RUN)
        runs = np.flatnonzero(some.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array([some[i].tobytes() for i in runs], pa.binary())], ["run", "held"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(h.as_py(), np.int64) for h in table.column("held"))
        return pa.table({"run": table.column("run")[:1], "held": pa.array([total.tobytes()], pa.binary())})

    counts = sets.select("id", "payload").mapInArrow(held, "run long, held binary")
    counted = counts.groupBy("run").applyInArrow(added, "run long, held binary").toArrow()
    often = np.zeros(SLOTS, np.int64)
    for run, total in zip(counted.column("run").to_pylist(), counted.column("held").to_pylist()):
        often[run * RUN : (run + 1) * RUN] = np.frombuffer(total, np.int64)
    shared = sets.sparkSession.sparkContext.broadcast(often)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in those(batches):
            first = []
            for payload in batch.column("payload"):
                elements = to_set(payload.as_py())
                order = np.lexsort((elements, shared.value[slots(elements)]))
                first.append(elements[order[: len(elements) + (-len(elements) * percent) // 100 + 1]])
            ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint64), *first]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "first"]
            )

    return sets.select("id", "payload").mapInArrow(rarest, "id long, first array<long>").select(F.explode("first").alias("grp"), "id")


def through(mesh: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What the sieve lets through of rows with an id."""

    def those(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passing(mesh.value, batch.column("id").to_numpy())))

    return those


def slots(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def verified(pairs: DataFrame, payloads: DataFrame, to_set: Callable[[bytes], np.ndarray], percent: int) -> DataFrame:
    """The pairs whose sets have at least ``percent`` of their union in common.

    ``payloads`` has id and payload, what ``to_set`` makes the sorted distinct elements of.  Those of the pairs, and a
    few that the sieve lets through, are moved once for either end, and once more with each pair to its other end.  An
    id with several sets is linked by any of them.
    """
    mesh = sieve(ends_of(pairs), "id")
    wanted = payloads.select("id", "payload").where("id IS NOT NULL").mapInArrow(through(mesh), "id long, payload binary")
    left = wanted.select(F.col("id").alias("a"), F.col("payload").alias("left"))
    right = wanted.select(F.col("id").alias("b"), F.col("payload").alias("right"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                left, right = left.as_py(), right.as_py()  # one pair at a time
                if left != last:
                    last, held = left, to_set(left)
                linked.append(near(held, to_set(right), percent))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return both.mapInArrow(check, "a long, b long").distinct()


def near(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


class Scratch:
    """Tables in the shared folder, for the steps of one operator."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, []

    def kept(self, frame: DataFrame, name: str) -> DataFrame:
        path = work_dir(self.spark, f"{self.label}-{name}")
        frame.write.option("compression", "zstd").parquet(path)
        self.paths.append((name, path))
        return self.spark.read.parquet(path)

    def remove(self, name: str) -> None:
        """Removes the tables of a name."""
        self.drop(*{other for other, _ in self.paths if other != name})

    def drop(self, *but: str) -> None:
        """Removes all tables but those named, which results still read."""
        for name, path in self.paths:
            if name not in but:
                remove(self.spark, path)
        self.paths = [(name, path) for name, path in self.paths if name in but]


FEW = 20  # links fewer than one in so many members leave the components of deeper levels as they are until the end
SPREAD = 512
HOMES = 8
MANY = 32  # members of a group, from which on they meet several pivots before they are compared
PIVOTS = 8
SLOTS = 1 << 18
RUN = 1 << 12  # slots whose counts make up one row


def child_groups(members: DataFrame, reps: DataFrame, coordinates: int) -> DataFrame:
    """The next level: each group selects one or two MinHash tokens by its own name, and members that share one stay
    together.  ``reps`` has id and tokens (4 bytes each)."""
    one = F.pmod(F.xxhash64("grp", F.lit(1)), F.lit(coordinates)).cast("int")
    two = F.pmod(F.xxhash64("grp", F.lit(2)), F.lit(coordinates)).cast("int")
    second = F.pmod(F.xxhash64("grp", F.lit(3)), F.lit(3)) == 0  # 4/3 tokens on average, one over the threshold
    picked = members.withColumn("at", F.explode(F.when(second, F.array(one, two)).otherwise(F.array(one))))
    mesh = sieve(members, "id")  # of all tokens, only those of members are moved
    held = reps.select("id", "tokens").mapInArrow(through(mesh), "id long, tokens binary")
    full = picked.select("grp", "at", "id", "component").distinct().join(held, "id")
    return full.select(F.xxhash64("grp", "at", token(F.col("at"))).alias("grp"), "id")


def token(coordinate: Column) -> Column:
    return F.substring(F.col("tokens"), coordinate * 4 + 1, F.lit(4))


def connected(
    groups: DataFrame, sketches: DataFrame, payloads: DataFrame, to_set: Callable[[bytes], np.ndarray], percent: int,
    most_bits: int, small: int, scratch: Scratch, levels: int = 1, reps: DataFrame | None = None, coordinates: int = 0,
) -> DataFrame:
    """The components (node, component) of all links that groups of likely partners lead to.

    Members meet their group's pivot, in larger groups several.  A group whose members then have at most ``small`` partners on average in other
    components is compared exhaustively but for its pivot.  Another is branched again by further tokens of ``reps``, up to ``levels``
    levels; as branching may part two that are near, members of crowded groups meet once more in ``rare_groups``, which
    part none.  Below the first level members carry their components along; links that would hardly change these are
    kept for the end.
    """
    kept = scratch.kept
    tried = pairs = kept(star_pairs(groups, sketches, percent, most_bits), "stars")
    found = kept(verified(pairs, payloads, to_set, percent), "links")
    labels, waiting = kept(components(found), "labels"), []
    level, crowded, candidates = named(groups, labels), None, None
    for depth in range(1, levels + 1):
        level = kept(mixed_groups(level), "level")
        if depth == 1:
            pairs = kept(more_star_pairs(level, sketches, percent, most_bits).join(tried, ["a", "b"], "left_anti"), "stars")
            if not pairs.isEmpty():
                tried = tried.union(pairs)
                labels = kept(relabelled(labels, kept(verified(pairs, payloads, to_set, percent), "links")), "labels")
                level = kept(mixed_groups(named(level.select("grp", "id"), labels)), "level")
        is_small = F.col("crossing") <= small * F.col("members")
        crossing = kept(cross_pairs(with_homes(not_met(level.where(is_small))), sketches, percent, most_bits), "crossing")
        candidates = crossing if candidates is None else candidates.union(crossing)
        large = level.where(~is_small)
        if large.isEmpty():
            break
        crowded = large.select("id").distinct() if crowded is None else crowded
        if depth == levels:
            break
        level = kept(named(shared_groups(child_groups(large, reps, coordinates)), labels), "groups")
        # a pair that was refused once is not brought together again
        pairs = kept(star_pairs(level, sketches, percent, most_bits).join(tried, ["a", "b"], "left_anti"), "stars")
        if pairs.isEmpty():
            continue
        tried = tried.union(pairs)
        waiting.append(kept(verified(pairs, payloads, to_set, percent), "links"))
        if FEW * sum(links.count() for links in waiting) >= level.count():
            labels = kept(relabelled(labels, reduce(DataFrame.union, waiting)), "labels")
            level, waiting = named(level, labels), []
    if waiting:
        labels = kept(relabelled(labels, reduce(DataFrame.union, waiting)), "labels")
    if crowded is not None:
        rare = shared_groups(rare_groups(payloads, crowded, to_set, percent))
        again = kept(mixed_groups(named(kept(rare, "rare"), labels)), "level")
        candidates = candidates.union(kept(cross_pairs(with_homes(again), sketches, percent, most_bits), "crossing"))
    more = kept(candidates.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    # one pair of each two components, then what these have not connected
    ends = F.least("x", "y"), F.greatest("x", "y")
    chosen = crossing_pairs(more, labels).groupBy(*ends).agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
    pairs = kept(chosen, "chosen")
    labels = kept(relabelled(labels, kept(verified(pairs, payloads, to_set, percent), "links")), "labels")
    rest = kept(crossing_pairs(more, labels).select("a", "b").join(pairs, ["a", "b"], "left_anti"), "rest")
    return kept(relabelled(labels, kept(verified(rest, payloads, to_set, percent), "links")), "components")


def crossing_pairs(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are of different components x and y."""
    left = labels.select(F.col("node").alias("a"), F.col("component").alias("x"))
    right = labels.select(F.col("node").alias("b"), F.col("component").alias("y"))
    known = pairs.select("a", "b").join(left, "a", "left").join(right, "b", "left")
    return known.select("a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y")).where("x <> y")


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links.  What is linked is contracted to its components first, so only those are joined."""
    nodes = ends_of(links).select(F.col("id").alias("node")).distinct()
    fresh = nodes.join(labels, "node", "left_anti")
    known = labels.select("node", "component").union(fresh.select("node", F.col("node").alias("component")))
    ends = links.join(known.select(F.col("node").alias("a"), F.col("component").alias("x")), "a")
    ends = ends.join(known.select(F.col("node").alias("b"), F.col("component").alias("y")), "b")
    joined = components(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return known.join(joined, "component", "left").select("node", F.coalesce("least", "component").alias("component"))


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))
