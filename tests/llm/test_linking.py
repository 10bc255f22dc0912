"""Links of small sets and of crowded groups, against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from weirgate.llm import lines, linking, near
from weirgate.llm import text as tx


def linked(x, y):
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 75 * (len(x) + len(y) - both)


def links(sets):
    return {(i, j) for i in range(len(sets)) for j in range(i) if linked(sets[i], sets[j])}


def recall(sets, component):
    wanted = links(sets)
    assert len(wanted) >= 50
    return sum(component[i] == component[j] for i, j in wanted) / len(wanted)


def altered(rng, words, changes):
    """The words with some at either end replaced."""
    out = list(words)
    for at in range(changes):
        out[-1 - at // 2 if at % 2 else at // 2] = f"x{rng.randrange(10**6)}"
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_odd_sketches_lose_no_link():
    rng = np.random.default_rng(3)
    for size in (1, 3, 8, 20, 60, 300, 2000):
        for _ in range(50):
            x = rng.integers(0, 2**63, size, np.uint64)
            y = np.concatenate([x[: size - size // 7], rng.integers(0, 2**63, size // 7, np.uint64)])
            rows = np.repeat([0, 1], [len(x), len(y)])
            odd = tx.odd_sketch(np.concatenate([x, y]), rows, 2, 8)
            differing = sum(int(a ^ b).bit_count() for a, b in zip(*odd.view(np.uint64)))
            assert linked(x, y) and differing * 175 <= 25 * (len(x) + len(y))


@pytest.mark.parametrize("small", [near.SMALL, 1])
def test_small_documents_at_the_threshold(spark, monkeypatch, small):
    monkeypatch.setattr(near, "SMALL", small)
    rng = random.Random(11)
    texts = []
    for size in range(10, 45):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [" ".join(words)] + [" ".join(altered(rng, words, changes)) for changes in (1, 2, 3, 3)]
    sets = tx.word_shingles(pa.array(texts), near.WIDTH)
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(frame(spark, texts)).collect()}
    assert recall(sets, found) >= 0.99
    for i, component in found.items():
        assert component == i or any(found[j] == component and linked(sets[i], sets[j]) for j in found if j != i)


def test_crowded_documents(spark, monkeypatch):
    """Pairs that share a long passage with many others that they are not near to, in groups that branch."""
    monkeypatch.setattr(near, "SMALL", 8)
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for _ in range(100):
        own = [f"w{rng.randrange(10**6)}" for _ in range(50)]
        texts += [" ".join(passage + own), " ".join(passage + own[:46] + ["y", f"z{rng.randrange(10**6)}"])]
    sets = tx.word_shingles(pa.array(texts), near.WIDTH)
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(frame(spark, texts)).collect()}
    assert recall(sets, found) >= 0.99 and len(set(found.values())) == 100


def test_short_lines_at_the_threshold(spark):
    rng = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz"
    shapes = []
    for size in range(20, 61):
        for _ in range(4):
            line = "".join(rng.choice(letters) for _ in range(size))
            shapes += [line, line[:-1] + "0", "1" + line[1:]]
    shapes = list(dict.fromkeys(shapes))
    sets = [np.unique(s) for s in lines.shingles(shapes)]
    judged = lines.judged_lines(frame(spark, shapes)).collect()
    found = {r["doc_id"]: (r["keeper_doc"], r["keeper_line"]) for r in judged}
    measured = recall(sets, found)
    assert measured >= 0.97, measured


def test_crowded_lines_lose_no_link(spark, monkeypatch):
    """Buckets that are too crowded to compare lead to the links that comparing them would."""
    rng = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyz"
    passage = "".join(rng.choice(letters) for _ in range(36))
    texts = []
    for _ in range(150):
        own = "".join(rng.choice(letters) for _ in range(26))
        texts += [passage + own, passage + own[:-6] + "".join(rng.choice(letters) for _ in range(6))]

    def judged():
        rows = lines.judged_lines(frame(spark, texts)).collect()
        return {r["doc_id"]: r["keeper_doc"] for r in rows}

    whole = judged()
    monkeypatch.setattr(lines, "SMALL", 0)
    assert judged() == whole and len(set(whole.values())) < 170


def test_sets_that_are_near_share_a_rare_element(spark):
    rng = np.random.default_rng(5)
    passage, sets = rng.integers(0, 2**63, 40, np.uint64) * 2, []
    for size in (1, 2, 3, 4, 7, 12, 31, 60):
        for _ in range(10):
            one = np.concatenate([passage[: size // 2], rng.integers(0, 2**63, size - size // 2, np.uint64) * 2])
            sets += [np.unique(one), np.unique(np.concatenate([one[size // 7 :], rng.integers(0, 2**63, size // 9, np.uint64)]))]
    rows = [(i, bytearray(s.tobytes())) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "id long, payload binary")
    groups = linking.rare_groups(table, table.select("id"), near.shingle_set, 75)
    held = {}
    for r in groups.collect():
        held.setdefault(r["id"], set()).add(r["grp"])
    assert len(links(sets)) >= 50 and all(held[i] & held[j] for i, j in links(sets))
