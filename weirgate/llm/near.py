"""MinHash near-duplicates as a chosen-path set similarity join.

Documents are sets of five-word shingles.  One permutation gives each set ``COORDINATES`` MinHash tokens and a
sketch: its size, one bit of each token and the parity of its shingles in 512 places.  In each of ``TREES`` independent trees documents branch by one or two selected tokens:
those that share the token share a node.  A node whose documents have at most ``SMALL`` partners on average that are
not yet known to be connected is compared exhaustively; another branches again by tokens of its own, up to ``LEVELS``
levels.  Two documents at the threshold meet below a node with a chance of about 0.81, so all trees miss them with a
chance of about 1e-7 at the first level.  Branching further loses none beyond that: documents of crowded nodes meet
once more by their rarest shingles, of which any two that are near share one.

Every link is confirmed on the full sets.  Documents of equal sets are one class from the start.  Before nodes
are compared, each member meets the node's pivot, which connects a large group of copies by as many links as it has
members; what is connected by then is not compared again.

Words are lower-cased (A-Z).  A document of fewer words than five has its whole sequence as one shingle.  Null,
empty and blank texts have the empty set and are linked with nothing.  Rows without an id are linked with nothing and are
kept, with a null component.  Rows repeated under one id are one document in the links.  An empty table gives an
empty result.  Other columns are not read.  Texts are taken whole.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm import text as tx
from weirgate.llm.linking import Scratch, connected, shared_groups, sketch_of, token
from weirgate.llm.sampling import passing, sieve
from weirgate.session import stepwise

WIDTH = 5
PERCENT = 75
COORDINATES = 128
TREES = 10
NEAR_BITS = 38  # of 128, asked of large sets only: at the threshold 16 differ on average, with a deviation of 3.7
ODD = 8  # longs of the odd sketch, which tells sets of up to some 700 shingles apart
SLICE_BYTES = 2 << 20
LEVELS = 2  # of crowded nodes, before their documents meet by their rarest shingles
SMALL = 512  # partners a member that a node may have to be compared exhaustively: the sketches leave few of them
_EXTRA = 1 / 3  # beside one token, a node selects a second so often: 4/3 on average, one over the threshold


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: number of shingles, two hashes that name the set, the tokens and the sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.slices(batches, "text", SLICE_BYTES):
            sets = tx.word_shingles(piece.column("text"), WIDTH)
            tokens = [tx.one_permutation(s, COORDINATES) for s in sets]
            stack = np.stack(tokens) if tokens else np.empty((0, COORDINATES), np.uint64)
            bits = np.packbits((tx.mix(stack) >> np.uint64(40)).astype(np.uint8) & 1, axis=1).view(np.int64)
            names = np.array([(np.sum(s), np.sum(tx.mix(s))) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            sizes = np.array([len(s) for s in sets], np.int64)
            odd = tx.odd_sketch(
                np.concatenate([np.empty(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), sizes), len(sets), ODD
            )
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"), pa.array(sizes),
                    pa.array(names[:, 0]), pa.array(names[:, 1]),
                    pa.array([row.tobytes() for row in (stack >> np.uint64(20)).astype(np.uint32)], pa.binary()),
                    pa.array(bits[:, 0]), pa.array(bits[:, 1]), *[pa.array(odd[:, i]) for i in range(ODD)],
                ],
                ["doc_id", "n_shingles", "k1", "k2", "tokens", "s1", "s2", *parity],
            )

    parity = [f"o{i}" for i in range(ODD)]
    ddl = "doc_id long, n_shingles long, k1 long, k2 long, tokens binary, s1 long, s2 long, "
    ddl += ", ".join(f"{c} long" for c in parity)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, ddl)


def payloads(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingles, sorted and distinct, of the documents whose ids are wanted (and of a few that the sieve lets through)."""
    mesh = sieve(wanted, "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text", SLICE_BYTES):
            ids = pc.fill_null(batch.column("id"), -1).to_numpy(zero_copy_only=False)
            some = batch.filter(pa.array(passing(mesh.value, ids)))
            packed = [s.tobytes() for s in tx.word_shingles(some.column("text"), WIDTH)]
            yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(packed, pa.binary())], ["id", "payload"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(pack, "id long, payload binary")


def shingle_set(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, np.uint64)


def first_nodes(reps: DataFrame) -> DataFrame:
    """The nodes below the roots: every tree selects the same tokens for all documents."""
    choose = random.Random(7)
    picks = [
        (tree, at) for tree in range(TREES)
        for at in choose.sample(range(COORDINATES), 1 + (choose.random() < _EXTRA))
    ]
    nodes = F.array(*[F.xxhash64(F.lit(t), F.lit(i), token(F.lit(i))) for t, i in picks])
    return reps.select(F.explode(nodes).alias("grp"), "id")


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row (doc_id, n_shingles, k1, k2), the id of each class of equal sets, and the component of every id that is linked."""
    scratch = Scratch(docs.sparkSession, "near")
    kept = scratch.kept
    signed = kept(signatures(docs), "signed").withColumn("n", F.col("n_shingles"))
    classes = kept(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2", "n_shingles")
        .agg(F.min(F.struct("doc_id", "tokens", sketch_of(ODD))).alias("r"))
        .select("k1", "k2", "n_shingles", F.col("r.doc_id").alias("id"), "r.tokens", "r.sketch"),
        "classes",
    )
    rows = kept(signed.select("doc_id", "n_shingles", "k1", "k2"), "rows")
    scratch.remove("signed")
    groups = kept(shared_groups(first_nodes(classes)), "groups")
    texts = kept(payloads(docs, groups.select("id").distinct()), "texts")
    labels = connected(
        groups, classes.select("id", "sketch"), texts, shingle_set, PERCENT, NEAR_BITS, SMALL, scratch, LEVELS, classes, COORDINATES
    )
    names = kept(classes.select("id", "k1", "k2", "n_shingles"), "names")
    scratch.drop("rows", "names", "components")
    return rows, names, labels.withColumnRenamed("node", "id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least id that links lead to) and kept."""
    with stepwise(docs.sparkSession):
        rows, names, labels = _labelled(docs)
    component = F.coalesce("component", "id")
    named = names.select("id", *[F.col(c).alias(f"_{c}") for c in ("k1", "k2", "n_shingles")])
    named = named.join(labels.hint("merge"), "id", "left").select("_k1", "_k2", "_n_shingles", component.alias("component_id"))
    same = [F.col(c) == F.col(f"_{c}") for c in ("k1", "k2", "n_shingles")] + [F.col("doc_id").isNotNull()]
    out = rows.join(named.hint("merge"), same, "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.  Rows under one id stay or go together."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone.withColumnRenamed("doc_id", "_gone"), docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")
