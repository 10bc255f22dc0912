"""Merkle manifest of a dataset: a tree of SHA-256 per source, a tree over the sources' roots, proofs and folding.

A leaf hashes the fields of one row.  Three neighbouring nodes have one parent, the last run fewer, up to a single
root.  While a parent is hashed, a copy of the hash state is kept before each child slot.  Folding a replaced child
resumes the copy of its slot with the replacement and the siblings to its right; what lies to its left is not hashed
again.  A step of a proof carries that state and the siblings, so a row can be replaced without the rest of the tree.

The work goes by pages of ``PAGE`` neighbouring nodes, ``LEVELS`` levels high: a page is one group however large its
source, a task holds ``SLAB`` rows of pages at a time.  Pages' roots are the nodes of the next round; a round for each
``LEVELS`` levels goes up, one comes down with the steps above each page.  Places of leaves come from a sort by range
and counts for each range, so no source is sorted in one task.  Texts are hashed where they are read and never moved.

Null fields hash as ``-``.  A null id sorts first and counts as empty text where the id is hashed; rows of equal id
are ordered by leaf, so repeated rows have a leaf each and reruns agree.  An empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.llm import hash_states as sha
from weirgate.session import remove, work_dir

ARITY = 3
LEVELS = 6
PAGE = ARITY**LEVELS
SLAB = 16_384
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = np.dtype([("slot", "u1"), ("kids", "u1"), ("state", ">u4", 8), ("siblings", ">u4", (ARITY - 1, 8))])
NODE_DDL = "tree string, page long, index long, total long, digest binary, changed binary, label string, doc_id long"
_STEPS_DDL = "steps array<struct<slot: int, state: binary, left: array<string>, right: array<string>>>"
_PROOF_DDL = f"doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, {_STEPS_DDL}"
_TOP_DDL = "tree string, page long, path binary, subroot binary, root binary"


def leaf(columns: dict[str, Column]) -> Column:
    """The digest of one row: each field as its length in bytes and its text, or a dash."""
    parts = []
    for name in FIELDS:
        text = columns[name].cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Level(NamedTuple):
    """One level of the trees of a slab; places count within the slab."""

    parent: np.ndarray  # of each node
    slot: np.ndarray  # of each node
    child: np.ndarray  # (parents, ARITY), -1 where there is none
    kids: np.ndarray
    active: np.ndarray  # parents that hash; the others are roots carried along
    states: np.ndarray  # (parents, ARITY, 8): the copy before each slot
    nodes: np.ndarray  # digests
    blocks: np.ndarray  # their hex text


def grow(nodes: np.ndarray, starts: np.ndarray, lifts: np.ndarray) -> tuple[list[Level], np.ndarray]:
    """All levels above the nodes of each group (``starts``), ``lifts`` of them, and the groups' last nodes."""
    levels = []
    for at in range(int(lifts.max(initial=0))):
        rises, counts = lifts > at, np.diff(starts)
        above = np.where(rises, -(-counts // ARITY), counts)
        offsets = np.concatenate([[0], np.cumsum(above)])
        group = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(nodes)) - starts[group]
        slot = np.where(rises[group], place % ARITY, 0)
        parent = offsets[group] + np.where(rises[group], place // ARITY, place)
        child = np.full((offsets[-1], ARITY), -1)
        child[parent, slot] = np.arange(len(nodes))
        active, kids = np.repeat(rises, above), (child >= 0).sum(axis=1)
        states, blocks, state = np.empty((len(child), ARITY, 8), np.uint32), sha.hex_block(nodes), sha.fresh(len(child))
        for s in range(ARITY):
            states[:, s] = state
            has = np.flatnonzero(active & (child[:, s] >= 0))
            state[has] = sha.absorb(state[has], blocks[child[has, s]])
        hashed = np.flatnonzero(active)
        digests = nodes[child[:, 0]]
        digests[hashed] = sha.finish(state[hashed], kids[hashed])
        levels.append(Level(parent, slot, child, kids, active, states, nodes, blocks))
        nodes, starts = digests, offsets
    return levels, nodes


def fold(leaves: np.ndarray, levels: list[Level]) -> np.ndarray:
    """Each leaf's page root when that leaf alone is replaced."""
    node, digests = np.arange(len(leaves)), leaves.copy()
    for level in levels:
        parent = level.parent[node]
        some = np.flatnonzero(level.active[parent])
        up, slot = parent[some], level.slot[node[some]]
        state = sha.absorb(level.states[up, slot], sha.hex_block(digests[some]))
        for right in range(1, ARITY):
            has = np.flatnonzero((slot < right) & (level.child[up, right] >= 0))
            state[has] = sha.absorb(state[has], level.blocks[level.child[up[has], right]])
        digests[some] = sha.finish(state, level.kids[up])
        node = parent
    return digests


def fold_steps(digests: np.ndarray, group: np.ndarray, paths: list[np.ndarray]) -> np.ndarray:
    """The digests carried on through the steps above their group."""
    digests = digests.copy()
    lengths = np.array([len(p) for p in paths], np.int64)
    for at in range(int(lengths.max(initial=0))):
        longer = np.flatnonzero(lengths > at)
        steps = np.array([paths[g][at] for g in longer], STEP)
        some = np.flatnonzero(lengths[group] > at)
        of = np.searchsorted(longer, group[some])
        slot, kids = steps["slot"].astype(np.int64), steps["kids"].astype(np.int64)
        state = sha.absorb(steps["state"].astype(np.uint32)[of], sha.hex_block(digests[some]))
        for s in range(ARITY - 1):
            blocks = sha.hex_block(steps["siblings"][:, s].astype(np.uint32))
            has = np.flatnonzero((slot <= s)[of] & (s < kids - 1)[of])
            state[has] = sha.absorb(state[has], blocks[of[has]])
        digests[some] = sha.finish(state, kids[of])
    return digests


def own_steps(levels: list[Level], count: int) -> tuple[np.ndarray, np.ndarray]:
    """The steps of each leaf within its page (leaves, levels), and which of them exist."""
    steps, real = np.zeros((count, len(levels)), STEP), np.zeros((count, len(levels)), bool)
    node = np.arange(count)
    for at, level in enumerate(levels):
        parent, slot = level.parent[node], level.slot[node]
        steps["slot"][:, at], steps["kids"][:, at], real[:, at] = slot, level.kids[parent], level.active[parent]
        steps["state"][:, at] = level.states[parent, slot]
        for s in range(ARITY - 1):
            sibling = level.child[parent, s + (slot <= s)]
            steps["siblings"][:, at, s] = np.where((sibling >= 0)[:, None], level.nodes[sibling], 0)
        node = parent
    return steps, real


def _siblings(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hex text of the siblings of each step, and which exist."""
    there = np.arange(ARITY - 1) < steps["kids"][..., None].astype(np.int64) - 1
    text = sha.hex_bytes(steps["siblings"].astype(np.uint32).reshape(-1, 8)).reshape(*there.shape, 64)
    return text, there


class Slab(NamedTuple):
    table: pa.Table  # the nodes, without the pages' top rows
    nodes: np.ndarray
    starts: np.ndarray
    lifts: np.ndarray
    tops: pa.Table  # one row per page, empty while going up


def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[Slab]:
    """Whole pages, about ``SLAB`` rows at a time.  Rows come sorted by tree and page, a page's top row first."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SLAB:
            table = pa.Table.from_batches(held)
            cut = int(_borders(table)[-1])
            if cut:
                yield _slab(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
    if held and (table := pa.Table.from_batches(held)).num_rows:
        yield _slab(table)


def _borders(table: pa.Table) -> np.ndarray:
    """Where pages begin."""
    tree = table.column("tree").combine_chunks().dictionary_encode()
    tree = tree.combine_chunks() if isinstance(tree, pa.ChunkedArray) else tree
    ids, page = tree.indices.to_numpy(zero_copy_only=False), table.column("page").to_numpy()
    return np.flatnonzero(np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(page) != 0)]))


def _slab(table: pa.Table) -> Slab:
    is_top = pc.is_null(table.column("index")).to_numpy()
    nodes = table.filter(pa.array(~is_top))
    starts = np.append(_borders(nodes), nodes.num_rows)
    totals = nodes.column("total").to_numpy()[starts[:-1]]
    powers = ARITY ** np.arange(LEVELS + 1)
    lifts = np.minimum(np.searchsorted(powers, totals), LEVELS)
    return Slab(nodes, sha.from_bytes(nodes.column("digest").to_pylist()), starts, lifts, table.filter(pa.array(is_top)))


def _page_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for slab in slabs(batches):
        first = slab.table.take(slab.starts[:-1])
        _, roots = grow(slab.nodes, slab.starts, slab.lifts)
        page, total = first.column("page").to_numpy(), first.column("total").to_numpy()
        yield pa.RecordBatch.from_arrays([
            first.column("tree").combine_chunks(), pa.array(page // PAGE), pa.array(page), pa.array(-(-total // PAGE)),
            pa.array(sha.to_bytes(roots), pa.binary()), pa.nulls(len(page), pa.binary()), pa.nulls(len(page), pa.string()),
            pa.nulls(len(page), pa.int64()),
        ], names=["tree", "page", "index", "total", "digest", "changed", "label", "doc_id"])


def _tops_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node the steps above it: what the page below it goes on with."""
    for slab in slabs(batches):
        levels, _ = grow(slab.nodes, slab.starts, slab.lifts)
        steps, real = own_steps(levels, len(slab.nodes))
        group = np.repeat(np.arange(len(slab.starts) - 1), np.diff(slab.starts))
        above, subroots = slab.tops.column("path").to_pylist(), slab.tops.column("subroot").to_pylist()
        roots, digests = slab.tops.column("root").to_pylist(), slab.table.column("digest").to_pylist()
        tree, index, label = (slab.table.column(c).to_pylist() for c in ("tree", "index", "label"))
        paths = [steps[i][real[i]].tobytes() + above[g] for i, g in enumerate(group)]
        # A labelled node is the root of the tree that its label names, and that tree's only page at its top is page 0.
        yield pa.RecordBatch.from_arrays([
            pa.array([t if n is None else n for t, n in zip(tree, label)], pa.string()),
            pa.array([i if n is None else 0 for i, n in zip(index, label)], pa.int64()),
            pa.array(paths, pa.binary()),
            pa.array([subroots[g] if n is None else digests[i] for i, (g, n) in enumerate(zip(group, label))], pa.binary()),
            pa.array([roots[g] for g in group], pa.binary()),
        ], names=["tree", "page", "path", "subroot", "root"])


def _proofs(with_steps: bool):
    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches):
            levels, _ = grow(slab.nodes, slab.starts, slab.lifts)
            count = len(slab.nodes)
            group = np.repeat(np.arange(len(slab.starts) - 1), np.diff(slab.starts))
            above = [np.frombuffer(p, STEP) for p in slab.tops.column("path").to_pylist()]
            changed = sha.from_bytes(pc.coalesce(slab.table.column("changed"), slab.table.column("digest")).to_pylist())
            folded = fold_steps(fold(changed, levels), group, above)
            steps, real = own_steps(levels, count)
            text, there = _siblings(steps)
            there &= real[..., None]
            ends = np.concatenate([[0], np.cumsum(there.sum(axis=(1, 2)))]) * 64
            own, higher = text[there].tobytes(), []
            for path in above:
                upper, exists = _siblings(path)
                higher.append(upper[exists].tobytes())
            proof = [hashlib.sha256(own[ends[i] : ends[i + 1]] + higher[g]).hexdigest() for i, g in enumerate(group)]
            subroot = [x.hex() for x in slab.tops.column("subroot").to_pylist()]
            root = [x.hex() for x in slab.tops.column("root").to_pylist()]
            listed = [
                _readable(steps[i][real[i]].tobytes() + above[g].tobytes()) if with_steps else None for i, g in enumerate(group)
            ]
            yield pa.RecordBatch.from_arrays([
                slab.table.column("doc_id").combine_chunks(),
                pa.array([x.hex() for x in slab.table.column("digest").to_pylist()], pa.string()),
                pa.array([subroot[g] for g in group], pa.string()), pa.array([root[g] for g in group], pa.string()),
                pa.array(proof, pa.string()), pa.array([x.hex() for x in sha.to_bytes(folded)], pa.string()),
                pa.array(listed, _STEPS_ARROW),
            ], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "steps"])

    return proofs


_STEPS_ARROW = pa.list_(pa.struct([
    ("slot", pa.int32()), ("state", pa.binary()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string())),
]))


def _readable(path: bytes) -> list[dict]:
    found = []
    for step in np.frombuffer(path, STEP):
        slot, siblings = int(step["slot"]), [s.tobytes().hex() for s in step["siblings"][: int(step["kids"]) - 1]]
        found.append({"slot": slot, "state": step["state"].tobytes(), "left": siblings[:slot], "right": siblings[slot:]})
    return found


def _stored(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = work_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path), path


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``index`` within their ``tree``, ``total`` of the tree and ``page``, written.

    ``order`` begins with the tree unless there is only one.  Rows are dealt out by range; each range holds a
    stretch of each tree, and a stretch begins where the counts of the ranges before it end.
    """
    ascending = [F.col(c).asc_nulls_first() for c in order]
    dealt, path = _stored(
        rows.repartitionByRange(*ascending).sortWithinPartitions(*ascending)
        .withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}),
        "manifest-dealt",
    )
    stretches = dealt.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("tree")
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    stretches = stretches.withColumns({"before": F.coalesce(before, F.lit(0)), "total": F.sum("rows").over(whole)})
    found = dealt.join(stretches, ["tree", "part"]).withColumn("index", F.col("place") - F.col("first") + F.col("before"))
    nodes = found.select(
        "tree", F.expr(f"index div {PAGE}").alias("page"), "index", "total", "digest", "changed", "label", "doc_id"
    )
    kept, _ = _stored(nodes, "manifest-nodes")
    remove(rows.sparkSession, path)
    return kept


def _paged(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "page").sortWithinPartitions("tree", "page", F.col("index").asc_nulls_first())


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each round; the last round has one node for each tree."""
    rounds, most = [nodes], nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        nodes, _ = _stored(_paged(nodes).mapInArrow(_page_roots, NODE_DDL), "manifest-round")
        rounds.append(nodes)
        most = -(-most // PAGE)
    return rounds


def _under(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of each page behind the row of what lies above the page."""
    return _paged(nodes.unionByName(tops, allowMissingColumns=True))


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The rows above the pages of the first round, from those above each tree."""
    for nodes in reversed(rounds[1:-1]):
        tops, _ = _stored(_under(nodes, tops).mapInArrow(_tops_below, _TOP_DDL), "manifest-tops")
    return tops


def prove(docs: DataFrame, changed: Column | None = None, with_steps: bool = False) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root`` for each row, and on request the ``steps`` upwards.

    ``changed`` is the text of a tampered copy, null where a row has none.  ``folded_root`` is the root after the
    row's leaf is replaced by that of the copy, or folded again as it is.
    """
    columns = {name: F.col(name) for name in FIELDS}
    altered = F.when(changed.isNotNull(), leaf(columns | {"text": changed})) if changed is not None else F.lit(None).cast("binary")
    leaves, path = _stored(
        docs.select(
            F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("-")).alias("tree"), F.col("doc_id").cast("long"),
            leaf(columns).alias("digest"), altered.alias("changed"), F.lit(None).cast("string").alias("label"),
        ),
        "manifest-leaves",
    )
    rounds = climb(placed(leaves, ["tree", "doc_id", "digest"]))
    remove(docs.sparkSession, path)
    subroots = rounds[-1].select(
        F.lit("").alias("tree"), F.lit(None).cast("long").alias("doc_id"), "digest",
        F.lit(None).cast("binary").alias("changed"), F.col("tree").alias("label"),
    )
    higher = climb(placed(subroots, ["label"]))
    root = higher[-1].select(
        "tree", F.lit(0).cast("long").alias("page"), F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"),
        F.col("digest").alias("root"),
    )
    tops = descend(higher, root)
    tops, _ = _stored(_under(higher[0], tops).mapInArrow(_tops_below, _TOP_DDL), "manifest-tops")
    tops = descend(rounds, tops)
    proofs = _under(rounds[0], tops).mapInArrow(_proofs(with_steps), _PROOF_DDL)
    return proofs if with_steps else proofs.drop("steps")


def tampered_text() -> Column:
    """The text without line feeds, for every second row by the checksum of its id; null for the others."""
    chosen = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    return F.when(chosen, F.replace("text", F.lit("\n"), F.lit("")))


def verified(docs: DataFrame) -> DataFrame:
    """Proofs of every row against the root, half of the rows tampered with."""
    return prove(docs, tampered_text()).withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, length(hex(encode(x))) // 2 + 1),
    lambda i: ('0x' || substr(hex(encode(x)), 2 * i - 1, 2))::ubigint)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end))"""


def crc_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes."""
    return f"xor({_CRC.replace('encode(x)', f'encode({text})')}, 4294967295::ubigint)"


def _field_sql(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::varchar)) || ':' || {name}::varchar, '-')"


_UP_SQL = """
  select tree, 0 as level, i, digest, n from {base}
  union all
  select tree, level + 1, i // 3, sha256(string_agg(digest, '' order by i)), (any_value(n) + 2) // 3
  from {up} where n > 1 group by tree, level, i // 3"""
_FOLD_SQL = """
  select {keys}, tree, 0 as level, i, {start} as digest, {proof} as proof, n from {base}
  union all
  select {keys}, f.tree, f.level + 1, f.i // 3,
    sha256(string_agg(case when u.i = f.i then f.digest else u.digest end, '' order by u.i)),
    f.proof || coalesce(string_agg(u.digest, '' order by u.i) filter (where u.i <> f.i), ''), (f.n + 2) // 3
  from {fold} f join {up} u on u.tree = f.tree and u.level = f.level and u.i // 3 = f.i // 3
  where f.n > 1 group by {keys}, f.tree, f.level, f.i, f.proof, f.n"""

SQL = f"""
with recursive docs as (
  select *, case when {crc_sql("coalesce(doc_id::varchar, '')")} % 2 = 0 then replace(text, chr(10), '') end as cut from documents),
hashed as (
  select doc_id, coalesce(':' || source, '-') as tree, sha256({" || ".join(map(_field_sql, FIELDS))}) as digest,
    case when cut is not null then sha256({" || ".join(_field_sql("cut" if f == "text" else f) for f in FIELDS)}) end as changed
  from docs),
leaves as (
  select *, row_number() over (order by tree, doc_id nulls first, digest) as r, count(*) over (partition by tree) as n,
    row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as i from hashed),
up as ({_UP_SQL.format(base="leaves", up="up")}),
subroots as (
  select '' as tree, tree as label, digest, row_number() over (order by tree) - 1 as i, count(*) over () as n from up where n = 1),
high as ({_UP_SQL.format(base="subroots", up="high")}),
folds as ({_FOLD_SQL.format(keys="r", start="coalesce(changed, digest)", proof="''", base="leaves", fold="folds", up="up")}),
starts as (
  select r, s.tree, s.i, s.n, f.digest, f.proof, s.digest as subroot from folds f join subroots s on s.label = f.tree where f.n = 1),
tops as ({_FOLD_SQL.format(keys="r, subroot", start="digest", proof="proof", base="starts", fold="tops", up="high")})
select doc_id, leaves.digest as leaf, subroot, root.digest as root, sha256(tops.proof) as proof_sha256,
  tops.digest as folded_root, tops.digest = root.digest as verified
from leaves join tops using (r) cross join (select digest from high where n = 1) root
where tops.n = 1
"""
