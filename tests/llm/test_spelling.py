"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from weirgate.llm import catalog, spelling

DDL = "doc_id long, text string, word string, block long, n long"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def expected(texts):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            sum_ = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = sum_ % len(run)
            counts[run[:at] + run[at + 1:] if sum_ % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    found = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return found


def edited(rng, word, letters):
    at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(letters) + word[at:]
    return word[:at] + ("" if kind == 1 else rng.choice(letters)) + word[at + 1:]


def vocabulary(seed, letters, count, longest=14):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(7, longest))) for _ in range(count)}
    for _ in range(3):
        words |= {edited(rng, w, letters) for w in sorted(words)}
    return sorted(w for w in words if len(w) >= 7)


@pytest.mark.parametrize(("letters", "count", "slab", "queries"), [
    ("ab", 60, 50_000, 1 << 14), ("abÿé", 90, 100, 7), ("a", 10, 50_000, 1 << 14), ("abcdefghijklmnopqrstuvwxyzàöÿ÷", 120, 300, 50),
])
def test_near_words_against_all_pairs(spark, monkeypatch, letters, count, slab, queries):
    words = vocabulary(len(letters), letters, count)
    found = []
    monkeypatch.setattr(spelling, "QUERIES", queries)
    rows = catalog.shipped(lambda s: s.createDataFrame([(w, 2) for w in words], "word string, n long"))(spark)
    dealt = spelling.blocks(rows).orderBy("block", "word").toArrow()
    for part in spelling._pairs(iter(dealt.to_batches(max_chunksize=slab))):
        found += list(zip(part.column("word").to_pylist(), part.column("near").to_pylist()))
    want = {(a, b) for a in words for b in words if one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == want
    assert {tuple(r) for r in spelling.near_words(rows).select("word", "near").collect()} == want


def test_awkward_documents(spark):
    rng = random.Random(5)
    words = vocabulary(3, "abcé", 40)
    texts = [(i, " ".join(rng.choice(words[:40] if i % 2 else words) for _ in range(60))) for i in range(200)]
    texts += [(900 + i, f"{words[0].upper()} {words[0]}s, {words[1]}1{words[2]}\n" * 30) for i in range(5)]
    long_run = "".join(rng.choice("abc") for _ in range(20_000))
    texts += [(7001, None), (7002, ""), (7003, "x y z"), (None, "Nullword Nullword"), (7004, f"{long_run} {long_run} {long_run}q {long_run}q")]
    texts += [texts[0], texts[0], texts[-1]]
    rows = [(i, t, "w", 1, 1) for i, t in texts]
    docs = catalog.shipped(lambda s: s.createDataFrame(rows, DDL).repartition(3))(spark)
    got = spelling.variants(docs)
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == expected(texts)
    assert spelling.variants(docs.limit(0)).count() == 0


def test_chains_of_forms_lead_to_the_last(spark):
    chain = ["abcdefg" + "x" * i for i in range(7)]
    links = spark.createDataFrame(list(zip(chain, chain[1:])), "word string, form string")
    assert {tuple(r) for r in spelling.rooted(links, 10**6).collect()} == {(w, chain[-1]) for w in chain[:-1]}


def test_a_crowded_block_is_scanned_by_ranges():
    """20,000 words of one prefix: the ranges entered stay near the words' number times the letters that fit."""
    letters = "abcdefghijklmnopqrst"
    words = sorted("aaaaaa" + a + b + c + d for a in letters for b in letters for c in letters[:10] for d in letters[:5])
    count = len(words)
    block = spelling.laid_out(words, np.full(count, 10), np.zeros(count, bool), np.zeros(count, np.int64))
    one, _ = spelling.near_pairs(block)
    assert len(one) == count * (19 + 19 + 9 + 4) // 2
