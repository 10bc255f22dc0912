"""The Merkle manifest against a tree built with hashlib."""

import hashlib
import zlib

import numpy as np
import pytest

from weirgate.llm import catalog, hash_states, manifest

DDL = "doc_id long, text string, lang string, source string, n_chars long, tree string, page string, `index` int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    fields = (row[0], row[3], row[2], row[4], text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def folded(nodes, at, value):
    """The root, and the siblings on the way, when the node ``at`` has another value."""
    siblings = []
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        mine = list(runs[at // 3])
        siblings += [n for i, n in enumerate(mine) if i != at % 3]
        mine[at % 3] = value
        nodes, value, at = [h(*run) for run in runs], h(*mine), at // 3
    return value, siblings


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[1]), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by_source[s], key=lambda x: x[:3]) for s in order}
    subroots = [folded([x[2] for x in trees[s]], 0, trees[s][0][2])[0] for s in order]
    root = folded(subroots, 0, subroots[0])[0]
    found = []
    for place, source in enumerate(order):
        leaves = [x[2] for x in trees[source]]
        for at, (_, _, leaf, row) in enumerate(trees[source]):
            text = row[1]
            if text is not None and zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0:
                text = text.replace("\n", "")
            top, siblings = folded(leaves, at, leaf_of(row, text))
            last, more = folded(subroots, place, top)
            found.append((row[0], leaf, subroots[place], root, h(*siblings, *more), last, last == root))
    return found


def rows_of(sizes):
    rows = []
    for source, size in sizes.items():
        for i in range(size):
            text = None if i % 7 == 3 else "" if i % 7 == 5 else f"line {i}\nñ{'x' * (i % 90)}\n" if i % 2 else f"one line {i}"
            rows.append((len(rows) * 3 % 10007, text, None if i % 3 else "de", source, None if i % 5 else i, "t", "p", 1))
    rows += [rows[0], (None, "a\nb", None, "s1", None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows


@pytest.mark.parametrize("sizes", [
    {"s1": 1}, {"s1": 5, None: 2, "": 1, "é": 9, "z" * 5000: 27}, {"hot": 2300, "s1": 729, "s2": 730, "s3": 3, "s4": 28},
    {f"h{i:03d}": i % 4 + 1 for i in range(800)},
])
def test_against_hashlib(spark, sizes):
    rows = rows_of(sizes)
    docs = catalog.shipped(lambda s: s.createDataFrame(rows, DDL).repartition(5))(spark)
    got = manifest.verified(docs).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows), key=key)


def test_long_text_and_empty_table(spark):
    even = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 2 == 0)
    docs = catalog.shipped(lambda s: s.createDataFrame([(even, "a\n" * 500_000, "en", "s", 1, "t", "p", 1)], DDL))(spark)
    row = manifest.verified(docs).first()
    assert row["leaf"] == row["subroot"] == leaf_of((even, None, "en", "s", 1), "a\n" * 500_000) and not row["verified"]
    assert row["root"] == row["leaf"] and row["proof_sha256"] == h("")
    assert manifest.verified(docs.limit(0)).count() == 0


def test_steps_rebuild_the_root_from_a_replacement(spark):
    rows = rows_of({"a": 40, "b": 3})
    docs = catalog.shipped(lambda s: s.createDataFrame(rows, DDL))(spark)
    for row in manifest.prove(docs, with_steps=True).collect():
        value, siblings = row["leaf"], []
        for step in row["steps"]:
            assert step["slot"] == len(step["left"])
            resumed = np.frombuffer(step["state"], ">u4").astype(np.uint32)[None]
            assert (resumed == state_after(step["left"])).all()
            siblings += step["left"] + step["right"]
            value = h(*step["left"], value, *step["right"])
        assert value == row["root"] == row["folded_root"] and h(*siblings) == row["proof_sha256"]


def state_after(texts):
    state = hash_states.fresh(1)
    for text in texts:
        state = hash_states.absorb(state, np.frombuffer(text.encode(), ">u4").astype(np.uint32)[None])
    return state


def test_states_resume():
    rng = np.random.default_rng(1)
    nodes = rng.integers(0, 2**32, (7, 8), dtype=np.uint32)
    levels, roots = manifest.grow(nodes, np.array([0, 7]), np.array([2]))
    texts = [x.hex() for x in hash_states.to_bytes(nodes)]
    assert hash_states.to_bytes(roots)[0].hex() == folded(texts, 0, texts[0])[0]
    # The copy before a slot is the state after the children to its left, and no more than that is needed.
    state = hash_states.absorb(levels[0].states[1, 1][None], hash_states.hex_block(nodes[4:5]))
    state = hash_states.absorb(state, hash_states.hex_block(nodes[5:6]))
    assert hash_states.to_bytes(hash_states.finish(state, np.array([3])))[0].hex() == h(*texts[3:6])
