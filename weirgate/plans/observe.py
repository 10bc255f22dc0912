"""Observability over the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.operators.latest import latest_record
from weirgate.plans.control import current_marks
from weirgate.spec import FAILED, PARTIAL, SUCCESS


def daily_volume(log: DataFrame) -> DataFrame:
    return log.groupBy(F.to_date("start_time").alias("dia"), "collection").agg(
        F.sum("qtd_lida_origem").alias("lidos_origem"),
        F.sum("qtd_gravada_destino").alias("gravados_bronze"),
        F.sum("qtd_quarentena").alias("quarentena"),
    ).orderBy(F.col("dia").desc(), "collection")


def throughput(log: DataFrame) -> DataFrame:
    rate = F.col("qtd_gravada_destino") / F.nullif(F.col("duracao_seg"), F.lit(0.0))
    return log.select(
        "_ingestion_id", "start_time", "collection", "duracao_seg", "qtd_gravada_destino",
        F.round(rate, 1).alias("linhas_por_seg"),
    ).orderBy(F.col("start_time").desc())


def failure_rate(log: DataFrame) -> DataFrame:
    def n(status: str):
        return F.count_if(F.col("status") == status)

    return log.groupBy(F.to_date("start_time").alias("dia")).agg(
        F.count(F.lit(1)).alias("execucoes"),
        n(SUCCESS).alias("ok"),
        n(PARTIAL).alias("partial"),
        n(FAILED).alias("failed"),
        F.round(n(FAILED) * F.lit(100.0) / F.count(F.lit(1)), 2).alias("pct_falha"),
    ).orderBy(F.col("dia").desc())


def divergent_runs(log: DataFrame) -> DataFrame:
    return log.where((F.col("divergencia_pct") > 0) | (F.col("status") != SUCCESS)).select(
        "_ingestion_id", "collection", "start_time", "qtd_lida_origem", "qtd_gravada_destino",
        "divergencia_pct", "qtd_duplicada_lote", "status",
    ).orderBy(F.col("start_time").desc())


def last_status(log: DataFrame) -> DataFrame:
    """Newest run of each dataset; runs that started together are settled by their id."""
    newest = [F.col("start_time").desc(), F.col("_ingestion_id").desc()]
    return latest_record(log, ["collection"], newest).select(
        "collection", "load_type", "status", "qtd_lida_origem", "qtd_gravada_destino",
        "divergencia_pct", "duracao_seg", "end_time",
    ).orderBy("collection")


def mark_progress(history: DataFrame) -> DataFrame:
    """Current mark of each dataset."""
    return current_marks(history).select(
        "collection", "watermark_field", "watermark_value", "watermark_type", "updated_at"
    ).orderBy("collection")


def newest_violations(violations: DataFrame) -> DataFrame:
    return violations.select(
        "collection", "field", "kind", "detail", "violation_pct", "detected_at"
    ).orderBy(F.col("detected_at").desc())


def manifest_daily(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status") == "OK").groupBy(F.to_date("ingested_at").alias("dia")).agg(
        F.count(F.lit(1)).alias("arquivos"),
        F.sum("row_count").alias("linhas"),
        F.round(F.sum("file_size_bytes") / F.lit(1024.0 * 1024.0), 2).alias("mb"),
    ).orderBy(F.col("dia").desc())


def manifest_errors(manifest: DataFrame, most: int = 50) -> DataFrame:
    """The newest failed transfers."""
    return (
        manifest.where(F.col("status") == "ERRO")
        .orderBy(F.col("ingested_at").desc(), F.col("source_table")).limit(most)
        .select("ingested_at", "source_table", "error")
    )


def result_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
