"""The operators applied to the whole given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import decontaminate, language, licenses, lines, lm, manifest, mixing, near, pii, quality, secrets, spelling, toxicity
from weirgate.llm.sampling import held_out

Query = Callable[[SparkSession, str], DataFrame]
ROOT = str(Path(__file__).resolve().parents[2])


def shipped(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Lets Python workers find this package where it lies on their disk; elsewhere ship it with the job."""

    @wraps(build)
    def found(spark: SparkSession, *rest) -> DataFrame:
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if ROOT not in known.split(":"):
            spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{known}".rstrip(":")
        return build(spark, *rest)

    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 4, 2))
    return language.predict(docs, language.fit(docs.where(~F.col("held_out")).select("doc_id", "text", "lang")))


def nb_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 5, 0))
    learned = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", "toxic")
    return toxicity.predict(docs, toxicity.fit(docs.select("doc_id", "text"), learned))


def source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id"), 10, 0))
    return lm.score(docs)


def fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.judged_lines(table(spark, sf_dir, "documents")).drop("id")


def edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("matches")


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def secret_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_pitman_yor": shipped(pitman_yor),
    "op2_fuzzy_lines": shipped(fuzzy_lines),
    "op3_string_kernel_language": shipped(string_kernel_language),
    "op4_nb_toxicity": shipped(nb_toxicity),
    "op5_edit_decontamination": shipped(edit_decontamination),
    "op6_source_schedule": shipped(source_schedule),
    "op7_near_duplicates": shipped(near_duplicates),
    "op8_quality_cascade": shipped(quality_cascade),
    "op9_personal_data": shipped(personal_data),
    "op10_license_templates": shipped(license_templates),
    "op11_secret_models": shipped(secret_models),
    "op12_merkle_manifest": shipped(merkle_manifest),
    "op13_spelling_variants": shipped(spelling_variants),
}
ORACLE: dict[str, str] = {
    "op6_source_schedule": mixing.SQL,
    "op8_quality_cascade": quality.SQL,
    "op11_secret_models": secrets.SQL,
    "op12_merkle_manifest": manifest.SQL,
    "op13_spelling_variants": spelling.SQL,
}
