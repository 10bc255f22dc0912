"""The document operators on small tables with awkward rows, against brute force where SQL has no say."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tests.compare import DEFAULT_DIR, connect, difference
from weirgate.llm import catalog, decontaminate, language, licenses, lines, lm, mixing, near, pii, quality, toxicity
from weirgate.llm import text as tx
from weirgate.llm.components import components
from weirgate.session import work_dir

DDL = "doc_id long, text string, lang string, source string, n_chars long, component string, row int"
LONG = " ".join(f"word{i} tale{i % 7}" for i in range(4000))
BASE = " ".join(f"alpha{i}" for i in range(60))


def rows():
    near_copy = BASE.replace("alpha30", "omega")
    texts = [
        BASE, BASE, near_copy, None, "", "   \n ", LONG, "one two", "one two", "Straße ñandú 東京 test@example.org",
        "mail a@b.co, card 4111 1111 1111 1111, ip 10.0.0.256 and 10.0.0.25, call +1 (555) 010-2030",
        "Licensed under the Apache License, Version 2.0. MIT License", "x " * 40, "SHOUT " * 3 + "ALL OF THIS TEXT IS LOUD HERE NOW",
    ]
    found = [(i, t, None if i % 5 == 0 else "en" if i % 2 else "de", f"s{i % 3}" if i % 4 else None, None, "c", 1) for i, t in enumerate(texts)]
    return [*found, found[0], (None, BASE, None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    catalog.shipped(lambda s: None)(spark)  # sets the workers' path
    return spark.createDataFrame(rows(), DDL)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def benchmark(spark):
    item = " ".join(f"alpha{i}" for i in range(20, 40))
    return spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, item.replace("alpha25", "alpha52"))], "item_id long, text string")


def held(frame):
    return frame.selectExpr("*", "coalesce(doc_id, 0) % 4 = 2 AS held_out")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_against_sql(spark, name):
    assert difference(catalog.QUERIES[name](spark, DEFAULT_DIR), connect(DEFAULT_DIR), catalog.ORACLE[name]) is None


def test_empty_tables(spark, nothing, benchmark, docs):
    flagged = held(nothing)
    results = [
        lm.score(flagged), lines.judged_lines(nothing), lines.without_repeats(nothing), decontaminate.contaminated(nothing, benchmark),
        decontaminate.contaminated(docs, benchmark.limit(0)), mixing.mix(nothing), near.near_duplicates(nothing),
        quality.judge(nothing), quality.keep_good(nothing), pii.find_personal_data(nothing), licenses.scan_licenses(nothing),
        language.predict(flagged, language.fit(nothing)),
        toxicity.predict(flagged, toxicity.fit(nothing, spark.createDataFrame([], "doc_id long, toxic int"))),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_quality(docs):
    verdicts = quality.judge(docs).collect()
    assert len(verdicts) == docs.count()
    by_id = {r["doc_id"]: r for r in verdicts}
    assert by_id[0]["kept"] and by_id[0]["n_words"] == 60
    assert by_id[3]["base_failed"] and by_id[4]["n_words"] == 0
    assert by_id[12]["n_repeat_words"] == 40 and not by_id[12]["kept"]
    assert not by_id[13]["kept"] and not by_id[13]["base_failed"]
    assert sorted(r["doc_id"] for r in quality.keep_good(docs).where("doc_id IS NOT NULL").collect()) == sorted(
        r["doc_id"] for r in verdicts if r["kept"] and r["doc_id"] is not None
    )


def test_near_duplicates_against_all_pairs(spark, docs):
    found = near.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    of = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert of[1]["component_id"] == of[2]["component_id"] == 0 and of[8]["component_id"] == 7
    assert of[3]["component_id"] == 3 and of[3]["n_shingles"] == 0 and of[7]["n_shingles"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in found if r["doc_id"] is None)
    table = spark.read.parquet(f"{DEFAULT_DIR}/documents.parquet")
    texts = table.select("doc_id", "text").toPandas()
    sets = tx.word_shingles(pa.array(texts["text"]), 5)
    ids = texts["doc_id"].tolist()
    parent = {i: i for i in ids}
    for i in range(len(ids)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(parent, ids[i]), find(parent, ids[j])
                parent[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(table).collect()}
    assert got == {i: find(parent, i) for i in ids}


def test_lines_against_all_pairs(spark, docs):
    table = spark.read.parquet(f"{DEFAULT_DIR}/documents.parquet").limit(60).union(docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id < 0"))
    judged = lines.judged_lines(table).collect()
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    places = [(d, n, lines.form(l)) for d in sorted(texts) for n, l in enumerate(texts[d].split("\n")) if lines.form(l)]
    assert sorted((r["doc_id"], r["line_no"]) for r in judged) == sorted((d, n) for d, n, _ in places)
    shapes = sorted({s for _, _, s in places})
    sets = [np.unique(s) for s in lines.shingles(shapes)]
    parent = {s: s for s in shapes}
    for i in range(len(shapes)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(parent, shapes[i])] = find(parent, shapes[j])
    first = {}
    for d, n, s in places:
        first.setdefault(find(parent, s), (d, n))
    want = {(d, n): first[find(parent, s)] for d, n, s in places}
    wrong = sum(want[r["doc_id"], r["line_no"]] != (r["keeper_doc"], r["keeper_line"]) for r in judged)
    assert wrong <= len(places) // 100
    rest = lines.without_repeats(docs)
    assert rest.columns == docs.columns
    assert {r["doc_id"] for r in rest.collect()} >= {0, 3, 4, 5, 6, 7} and 8 not in {r["doc_id"] for r in rest.collect()}


def test_decontamination(spark, docs, benchmark):
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert {k for k in found if k[0] is not None} == {(d, i) for d in (0, 1) for i in (1, 4)} | {(2, 1)}
    assert found[0, 1]["distance"] == 0 and found[0, 4]["distance"] == 2
    assert decontaminate.plain(BASE)[found[0, 1]["start"] : found[0, 1]["end"]] == " ".join(f"alpha{i}" for i in range(20, 40))
    clean = decontaminate.without_contaminated(docs, benchmark)
    assert clean.columns == docs.columns and not {0, 1} & {r["doc_id"] for r in clean.collect()}


@pytest.mark.parametrize("part", [1, 4])
@pytest.mark.parametrize("percent", [1, 2, 3, 4, 5])
def test_decontamination_finds_all_planted_edits(percent, part):
    """Against the exact edit distance, with the edits anywhere or all in the first quarter of the item."""
    random = np.random.default_rng(100 * part + percent)
    items = [(r["item_id"], decontaminate.plain(r["text"])) for r in pq.read_table(f"{DEFAULT_DIR}/benchmark.parquet").to_pylist()]
    around = [decontaminate.plain(t) for t in pq.read_table(f"{DEFAULT_DIR}/documents.parquet")["text"].to_pylist()[: len(items)]]
    texts = []
    for (_, item), text in zip(items, around):
        for _ in range(percent * len(item) // 100):
            at, kind = int(random.integers(len(item) // part)), random.integers(3)
            item = item[:at] + ("" if kind == 0 else "q" if kind == 1 else "q" + item[at]) + item[at + 1 :]
        texts.append(f"{text[-300:]} {item} {text[:300]}")
    found = decontaminate.Finder(items).find(texts)
    for (item_id, item), text, hits in zip(items, texts, found):
        best = decontaminate.best_match(item, decontaminate.plain(text), int(decontaminate.EDITS * len(item)))
        assert [h.distance for h in hits if h.item_id == item_id] == ([best[0]] if best else [])


@pytest.mark.parametrize("percent", [0, 2, 4])
def test_walks_find_most_planted_edits(percent):
    """The walks alone, without the pieces that find the rest; they find nothing that is not there."""
    random = np.random.default_rng(percent)
    letters = list("etaoinshrdlu ")
    items = [(i, "i" + "".join(random.choice(letters, 150)) + "i") for i in range(40)]
    texts = []
    for _, item in items:
        for _ in range(percent * 150 // 100):
            at, kind = int(random.integers(150)), random.integers(3)
            item = item[:at] + ("" if kind == 0 else "q" if kind == 1 else "q" + item[at]) + item[at + 1 :]
        texts.append("".join(random.choice(letters, 90)) + item + "".join(random.choice(letters, 90)))
    finder = decontaminate.Finder(items)
    alone = finder._found(texts, [finder._alike])
    assert sum(any(h.item_id == i for h in hits) for (i, _), hits in zip(items, alone)) >= 36
    assert all(set(a) <= set(b) for a, b in zip(alone, finder.find(texts)))
    assert finder.clean([*texts, "", None, "etaoin " * 40]) == [False] * 40 + [True] * 3


@pytest.mark.parametrize("edits", [0, 4])
def test_decontamination_in_text_without_blanks(edits):
    random = np.random.default_rng(7)
    item, before = ("".join(map(chr, random.integers(0x4E00, 0x9000, n))) for n in (80, 500))
    passage = item[edits:]
    hits = decontaminate.Finder([(1, item)]).find([before + passage + before, before])
    assert hits == [[decontaminate.Hit(1, 500, 500 + len(passage), edits)], []]


@pytest.mark.parametrize("item, text", [("abcdef", "xxabcdefxx"), ("abcdef", "xxabdefxx"), ("abcdef", "zzabcxdefz"), ("abcdef", "qqqq")])
def test_best_match(item, text):
    cost = [list(range(len(item) + 1))]
    for c in text:
        last, row = cost[-1], [0]
        for i, d in enumerate(item):
            row.append(min(last[i] + (c != d), last[i + 1] + 1, row[i] + 1))
        cost.append(row)
    least = min(r[-1] for r in cost)
    got = decontaminate.best_match(item, text, 3)
    assert got == (None if least > 3 else (least, next(i for i, r in enumerate(cost) if r[-1] == least)))


def test_personal_data(docs):
    forms = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]

    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(x) <= 255 for x in found.split("."))
        if kind == "card":
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    texts = {r["doc_id"]: r["text"] or "" for r in docs.where("doc_id IS NOT NULL").collect()}
    for row in pii.find_personal_data(docs.where("doc_id IS NOT NULL")).collect():
        spans = sorted(
            (m.start(), at, kind, m.end()) for at, (kind, form) in enumerate(forms)
            for m in re.finditer(form, texts[row["doc_id"]]) if valid(kind, m[0])
        )
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(row["spans"].split(","))


def test_personal_data_by_context(spark):
    known = [(i, f"card no {c} ends") for i, c in enumerate(["4111111111111111", "5500005555555559", "340000000000009", "6011000000000004"])]
    found = pii.find_personal_data(spark.createDataFrame([*known, (9, "card no 4111111111111112 ends")], "doc_id long, text string"))
    assert found.where("doc_id = 9").first()["spans"] == "card:8:24"


def test_licenses(docs):
    found = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert found[11]["labels"] == "apache,apache-2.0,mit" and found[11]["n_base"] == 2 and found[11]["score"] == 1.0
    assert found[11]["first_word"] == 3 and found[11]["last_word"] == 8
    assert found[3]["labels"] == "" and found[3]["first_word"] is None
    automaton = licenses.compile_template("a [[b c]] {{2}} d {{x|y}}")
    ends = [automaton.match([w.encode() for w in t.split()], 0) for t in ("a d x", "a b c d y", "a q q d x", "a q q q d x", "a b d x", "a d z")]
    assert ends == [3, 5, 5, None, 4, None]


def test_mix(docs):
    found = mixing.mix(docs).collect()
    assert len(found) == docs.count()
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    assert sum({r["source"]: r["target"] for r in found}.values()) == pytest.approx(sum(r["size"] for r in found))


def test_mix_holds_its_texts(docs):
    path = work_dir(docs.sparkSession, "test-mix")
    docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).write.parquet(path)
    some = docs.sparkSession.read.parquet(path)
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    ordered = mixing.sequence(some).orderBy("slot", "at").collect()
    taken, laps, slots = {}, {}, {}
    for r in ordered:
        words = r["text"].split()
        assert words == texts[r["doc_id"]].split()[r["first_word"] : r["first_word"] + r["words"]] and len(words) == r["words"]
        assert r["text"] in texts[r["doc_id"]]
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["words"]
        slots.setdefault(r["slot"], []).append((r["at"], r["words"], r["source"]))
        known = laps.get((r["doc_id"], r["first_word"]))
        laps[r["doc_id"], r["first_word"]] = max(known or "", r["text"], key=len)
    assert taken == {r["doc_id"]: r["taken"] for r in mixing.mix(some).collect() if r["taken"]}
    for cuts in slots.values():  # each slot is one block of one source, without gaps
        assert [at for at, _, _ in cuts] == [sum(n for _, n, _ in cuts[:i]) for i in range(len(cuts))]
        assert sum(n for _, n, _ in cuts) <= mixing.BLOCK and len({source for _, _, source in cuts}) == 1
    whole = [d for d in taken if taken[d] >= len(texts[d].split())]
    assert whole
    for d in whole:  # pieces that follow each other give back the text, blanks included
        at, again = 0, ""
        while at < len(texts[d].split()):
            piece = laps[d, at]
            at, again = at + len(piece.split()), again + piece
        assert again == texts[d]


def small_and_capped(spark):
    """Sources of 1 to 45 words, some of them far below their share, beside a large one."""
    sizes = [(f"s{i:03}", (i * 7) % 45 + 1) for i in range(60)] + [("big", 4001), (None, 130)]
    rows = [
        (at * 100 + part, source, " ".join(f"w{at}x{part}y{k}" for k in range(size // 3 if part < 2 else size - 2 * (size // 3))))
        for at, (source, size) in enumerate(sizes) for part in range(3)
    ]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_mix_meets_small_targets(spark):
    docs = small_and_capped(spark)
    rows = mixing.mix(docs).collect()
    of_source = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        of_source.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert len(of_source) == 62 and any(target == 3 * 1.0 for target, _ in of_source.values())
    assert all(abs(target - taken) <= 0.5 for target, taken in of_source.values())
    ordered = mixing.sequence(docs).orderBy("slot", "at").collect()
    slots = {}
    for r in ordered:
        slots.setdefault(r["slot"], []).append((r["at"], r["words"], r["source"]))
    short = {}
    for cuts in slots.values():
        assert len({source for _, _, source in cuts}) == 1
        assert [at for at, _, _ in cuts] == [sum(n for _, n, _ in cuts[:i]) for i in range(len(cuts))]
        if sum(n for _, n, _ in cuts) < mixing.BLOCK:
            short[cuts[0][2]] = short.get(cuts[0][2], 0) + 1
    assert all(n == 1 for n in short.values())  # only the last block of a source is short


def test_pipeline_ends_with_texts(spark):
    out = corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(f"{DEFAULT_DIR}/documents.parquet"), DEFAULT_DIR).collect()
    assert out and all(sum(len(p["text"].split()) for p in r["pieces"]) == r["taken"] > 0 for r in out)


def test_language_and_toxicity(spark):
    docs = spark.read.parquet(f"{DEFAULT_DIR}/documents.parquet").selectExpr("*", "doc_id % 3 = 0 AS held_out")
    model = language.fit(docs.where("NOT held_out"))
    joined = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert joined.where("lang = lang_pred").count() >= 0.95 * joined.count()
    labels = spark.read.parquet(f"{DEFAULT_DIR}/labels.parquet")
    scored = toxicity.predict(docs, toxicity.fit(docs, labels.where("doc_id % 3 <> 0"))).join(labels, "doc_id")
    means = {r["toxic"]: r["s"] for r in scored.groupBy("toxic").agg({"score": "avg"}).withColumnRenamed("avg(score)", "s").collect()}
    assert means[1] > means[0]


def test_language_of_awkward_rows(docs):
    flagged = held(docs)
    found = {r["doc_id"]: r for r in language.predict(flagged, language.fit(flagged.where("NOT held_out"))).collect()}
    assert found[3]["lang_pred"] == found[4]["lang_pred"] == "und" and found[0]["lang_pred"] in ("de", "en")


def test_language_model(spark, docs):
    found = lm.score(held(docs)).collect()
    assert len(found) == docs.count()
    of = {r["doc_id"]: r for r in found}
    assert of[4]["n_tokens"] == 1 and of[0]["n_tokens"] == 61 and all(r["score"] < 0 for r in found)
    table = spark.read.parquet(f"{DEFAULT_DIR}/documents.parquet").selectExpr("*", "doc_id % 10 = 0 AS held_out")
    unseen = lm.score(table).where("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert unseen["s"] > unseen["b"]


def test_language_model_knows_the_word_before(spark):
    learned = [(i, f"red fox {i % 7} blue sky", False) for i in range(60)]
    table = spark.createDataFrame(
        [*learned, (100, "red fox blue sky", True), (101, "fox red sky blue", True)], "doc_id long, text string, held_out boolean"
    )
    of = {r["doc_id"]: r for r in lm.score(table).collect()}
    assert of[100]["base_score"] == pytest.approx(of[101]["base_score"]) and of[100]["score"] > of[101]["score"] + 2


def test_language_model_whatever_the_partitions(spark):
    """Scores are the same, and the probabilities of different texts stay below one in all."""
    learned = [(i, f"a {'bcd'[i % 3]} a {'bd'[i % 2]}", False) for i in range(50)]
    asked = [(100 + i, f"a {w}", True) for i, w in enumerate(["a", "b", "c", "d", "never", ""])]
    table = spark.createDataFrame([*learned, *asked], "doc_id long, text string, held_out boolean")
    one, many = ({r["doc_id"]: r["score"] for r in lm.score(table.repartition(n)).collect()} for n in (1, 5))
    assert one == pytest.approx(many, abs=1e-6)
    assert sum(10 ** one[100 + i] for i in range(6)) < 1


def test_word_probabilities_sum_to_one():
    """Over the letters of every context that was seen, with the rest of all code points at the root's base."""
    import pandas as pd

    words = ["ab", "abc", "b"]
    counted = pd.Series([g for w in words for g in lm.grams(w)]).value_counts()
    leaves = pd.DataFrame({"gram": counted.index, "n": counted.to_numpy()})
    root = {c: 0.2 for c in "abc" + lm.END}
    last = leaves["gram"].str[-2]
    chances = pd.concat([lm.sample_letters(g.sort_values("gram", ignore_index=True), root, 1) for _, g in leaves.groupby(last)])
    assert ((chances["chance"] > 0) & (chances["chance"] < 1)).all()
    assert (chances.groupby(chances["gram"].str[:-1])["chance"].sum() <= 1 + 1e-9).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 200), (None, 5)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 200: 200}


def test_pipeline(spark):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["quality rules", "line dedup", "near dedup", "decontamination", "source mix"]
    out = corpus_pipeline.run(spark, DEFAULT_DIR)
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < 200
