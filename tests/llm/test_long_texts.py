"""One text of very many matches or pieces costs in proportion to its length."""

from weirgate.llm import mixing, pii


def test_a_table_of_numbers_in_one_text(spark):
    text = " ".join(f"row {i}" for i in range(20000))
    found = pii.matched(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    words = [m for m in found[0]["matches"] if m["kind"] == ""]
    assert [m["found"] for m in words] == [str(i) for i in range(20000)]
    assert {m["left"] for m in words} == {"row"} and words[5]["gap"] == 5


def test_the_mix_of_one_long_text(spark):
    words = [f"w{i}" for i in range(100000)]
    rows = mixing.sequence(spark.createDataFrame([(1, "a", " ".join(words))], "doc_id long, source string, text string")).collect()
    assert len(rows) == -(-100000 // mixing.BLOCK)
    for r in rows:
        assert r["text"].split() == words[r["first_word"] : r["first_word"] + r["words"]]
