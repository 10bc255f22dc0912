"""Landing lines, quarantine, loads."""

from pyspark.sql import functions as F

from weirgate.plans import bronze
from weirgate.schemas import BRONZE_COLUMNS
from weirgate.session import small_frame
from weirgate.sources.files import read_csv, read_lines

LINES = [
    '{"_id":1,"a":"x","n":null}', '{"a":"no key"}', "{bad json", '{"_id":{"$oid":"zz"}}', "", "  ", '{"_id":null}',
    '[{"_id":9}]', '{"_id":"cut","a":',
]


def write(spark, path, lines):
    small_frame(spark, [(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


def shaped(spark, path, run_id, at):
    return bronze.shape(bronze.parse_lines(read_lines(spark, path)), run_id, at, "tag", "full")


def test_lines_become_rows_or_quarantine(spark, folder, noon):
    write(spark, f"{folder}/in", LINES)
    bronze.append_load(shaped(spark, f"{folder}/in", "r1", noon), f"{folder}/out", "r1")
    good = bronze.read_bronze(spark, f"{folder}/out")
    assert good.columns == BRONZE_COLUMNS
    assert {(r["_source_id"], r["body_json"]) for r in good.collect()} == {
        ("1", LINES[0]), ("zz", LINES[3]),
    }
    bad = bronze.read_quarantine(spark, f"{folder}/out")
    assert {(r["body_json"], r["_reason"]) for r in bad.collect()} == {
        (LINES[1], "no key"), (LINES[2], "not a JSON object"), (LINES[6], "no key"),
        (LINES[7], "not a JSON object"), (LINES[8], "not a JSON object"),
    }
    row = good.where("_source_id = 'zz'").first()
    assert row["_source_file"].endswith(".txt") and row["_load_type"] == "full" and row["_ingestion_id"] == "r1"
    assert row["_ingestion_date"].isoformat() == "2024-02-01"


def test_good_and_quarantined_make_the_whole(spark, folder, noon):
    write(spark, f"{folder}/in", LINES * 7)
    bronze.append_load(shaped(spark, f"{folder}/in", "r1", noon), f"{folder}/out", "r1")
    n_good = bronze.read_bronze(spark, f"{folder}/out").count()
    n_bad = bronze.read_quarantine(spark, f"{folder}/out").count()
    assert n_good + n_bad == bronze.read_load(spark, f"{folder}/out", "r1").count() == 7 * 7


def test_only_broken_lines_and_empty_files(spark, folder, noon):
    write(spark, f"{folder}/in", ["{bad", "worse"])
    write(spark, f"{folder}/in", [])
    bronze.append_load(shaped(spark, f"{folder}/in", "r1", noon), f"{folder}/out", "r1")
    assert bronze.read_bronze(spark, f"{folder}/out").count() == 0
    assert bronze.read_quarantine(spark, f"{folder}/out").count() == 2


def test_a_repeated_load_replaces_itself(spark, folder, noon):
    write(spark, f"{folder}/a", ['{"_id":1}'])
    write(spark, f"{folder}/b", ['{"_id":2}', '{"_id":3}'])
    for source, run_id in (("a", "r1"), ("b", "r2"), ("b", "r2")):
        bronze.append_load(shaped(spark, f"{folder}/{source}", run_id, noon), f"{folder}/out", run_id)
    assert sorted(r[0] for r in bronze.read_bronze(spark, f"{folder}/out").select("_source_id").collect()) == ["1", "2", "3"]


def test_the_hash_of_a_document_does_not_depend_on_its_neighbours(spark, folder, noon):
    write(spark, f"{folder}/a", ['{"_id":1,"year":1999,"n":null}'])
    write(spark, f"{folder}/b", ['{"_id":1,"year":1999,"n":null}', '{"_id":2,"year":"1981x"}'])
    hashes = [
        shaped(spark, f"{folder}/{s}", "r", noon).where("_source_id = '1'").first()["_source_hash"] for s in "ab"
    ]
    assert hashes[0] == hashes[1]


def test_landing_measures_count_what_was_written(spark, folder):
    seen = bronze.write_landing(spark.range(1000), f"{folder}/l", F.max("id").alias("top"))
    assert seen == {"rows": 1000, "top": 999}
    assert read_lines(spark, f"{folder}/l").count() == 1000


def test_csv_overrides(spark, folder):
    spark.sql("select 'a;b' x, 1 y").write.option("header", True).option("sep", "|").csv(f"{folder}/c")
    assert read_csv(spark, f"{folder}/c", sep="|").dtypes == [("x", "string"), ("y", "int")]
    assert read_csv(spark, f"{folder}/c", "x string, y double", sep="|").first()["y"] == 1.0


def test_every_file_of_a_landing_is_read(spark, folder):
    for name in ("a.jsonl", "b.ndjson", "c.JSON", "d"):
        spark.range(1).selectExpr("'{\"_id\": 1}' AS value").coalesce(1).write.text(f"{folder}/{name}.part")
    spark.range(5).selectExpr("concat('{\"_id\": ', id, '}') AS value").write.option("compression", "bzip2").text(f"{folder}/packed")
    assert read_lines(spark, folder).count() == 9
    assert read_lines(spark, folder, pattern="*.bz2").count() == 5


def test_text_after_the_first_document_is_rescued(spark):
    texts = ['{"_id":1}', '{"_id":1}{"_id":2}', '{"_id":"1"} trailing', '{"_id":1},{"_id":2}', ' {"_id":3} ']
    lines = small_frame(spark, [(t, "f") for t in texts], "value string, _source_file string")
    found = {r["value"]: (r["_source_id"], r["_rescued_data"]) for r in bronze.parse_lines(lines).collect()}
    assert found == {t: (None, t) for t in texts[1:4]} | {texts[0]: ("1", None), texts[4]: ("3", None)}
