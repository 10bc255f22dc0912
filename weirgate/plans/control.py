"""Run log, marks and violations: append-only tables, read through their newest rows.

Each append has a folder of its own; a snapshot folds many of them, so a read opens a bounded number of files.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from weirgate.operators.latest import latest_record
from weirgate.schemas import RUN_LOG_DDL, VIOLATIONS_DDL, WATERMARK_DDL
from weirgate.session import finished_folders, folder_names, path_exists, read_table, remove, small_frame
from weirgate.spec import FAILED, PARTIAL, SUCCESS, Layout

MESSAGE_MAX = 4000
FOLD_AFTER = 64  # appends that are read one by one before they are folded

RUN_LOG = "control_ingestion_log"
WATERMARKS = "ingestion_watermark"
VIOLATIONS = "data_contract_violations"

_DEFAULTS = {
    "watermark_inicial": "cast(null as string)",
    "watermark_final": "cast(null as string)",
    "qtd_lida_origem": "0L",
    "qtd_gravada_destino": "0L",
    "qtd_quarentena": "0L",
    "qtd_duplicada_lote": "0L",
    "divergencia_pct": "0.0D",
    "contrato_ok": "true",
    "landing_files": "cast(array() as array<string>)",
    "mensagem_erro": "cast(null as string)",
    "ingest_mode": "'batch'",
    "pipeline_version": "''",
}


def build_run_log(runs: DataFrame) -> DataFrame:
    """Rows of the run log from whatever the runs know; the rest takes its default.

    Durations come from start and end to the millisecond, long messages are cut and empty
    ones become null.
    """
    missing = {c: F.expr(e) for c, e in _DEFAULTS.items() if c not in runs.columns}
    full = runs.withColumns(missing) if missing else runs
    micros = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time"))
    full = full.withColumns({
        "duracao_seg": F.round(micros / F.lit(1e6), 3),
        "mensagem_erro": F.nullif(F.left(F.col("mensagem_erro"), F.lit(MESSAGE_MAX)), F.lit("")),
    })
    names = [part.split()[0] for part in RUN_LOG_DDL.split(", ")]
    return full.select(*names)


def append(df: DataFrame, layout: Layout, table: str, name: str) -> None:
    """A few control rows as one file in a folder of their own.

    ``name`` identifies the run and dataset: writers never share a folder, however many run
    at once, and a repeated append replaces itself.  Many folders are folded into a snapshot.
    """
    root = layout.control(table)
    df.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}")
    if len(finished_folders(df.sparkSession, root)) > FOLD_AFTER:
        fold(df.sparkSession, layout, table, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema))


def _snapshots(spark: SparkSession, layout: Layout, table: str) -> list[int]:
    """Numbers of whole snapshots; their rows are written last."""
    root = layout.control(f"folded/{table}")
    names = [name for name in folder_names(spark, root) if path_exists(spark, f"{root}/{name}/rows/_SUCCESS")]
    return sorted(int(name) for name in names)


class _Parts(NamedTuple):
    """What a control table is made of: a snapshot with the appends it holds, and the appends since."""

    snapshot: str | None
    held: dict[str, int]
    fresh: list[str]


def _parts(spark: SparkSession, layout: Layout, table: str) -> _Parts:
    listed = finished_folders(spark, layout.control(table))
    numbers = _snapshots(spark, layout, table)
    if not numbers:
        return _Parts(None, {}, sorted(listed))
    snapshot = layout.control(f"folded/{table}/{numbers[-1]:08d}")
    held = {r["name"]: r["at"] for r in spark.read.parquet(f"{snapshot}/names").collect()}
    return _Parts(snapshot, held, sorted(name for name, at in listed.items() if held.get(name) != at))


def _named_rows(spark: SparkSession, layout: Layout, table: str, ddl: str, parts: _Parts) -> DataFrame:
    """The table's rows with ``_name`` of their append; an append that was repeated counts as it is now."""
    rows = small_frame(spark, [], f"{ddl}, _name string")
    if parts.snapshot:
        rows = spark.read.schema(f"{ddl}, _name string").parquet(f"{parts.snapshot}/rows").where(~F.col("_name").isin(parts.fresh))
    if parts.fresh:
        paths = [f"{layout.control(table)}/{name}" for name in parts.fresh]
        name = F.url_decode(F.element_at(F.split("_metadata.file_path", "/"), -2))
        rows = rows.unionByName(spark.read.schema(ddl).parquet(*paths).withColumn("_name", name))
    return rows


def fold(spark: SparkSession, layout: Layout, table: str, ddl: str) -> None:
    """Write all rows into one snapshot, so that readers open it and what was appended since.

    Appends go on meanwhile: a snapshot names the appends it holds, and any other is still read from its folder.
    Folders go only once a later snapshot was built on one that holds them, so readers of the one before are safe.
    """
    parts, root = _parts(spark, layout, table), layout.control(f"folded/{table}")
    if not parts.fresh:
        return
    listed = finished_folders(spark, layout.control(table))
    held = {name: at for name, at in parts.held.items() if listed.get(name) == at} | {
        name: listed[name] for name in parts.fresh if name in listed
    }
    number = 1 + max([0, *(int(name) for name in folder_names(spark, root))])
    target = f"{root}/{number:08d}"
    small_frame(spark, sorted(held.items()), "name string, at bigint").coalesce(1).write.parquet(f"{target}/names")
    _named_rows(spark, layout, table, ddl, parts).coalesce(1).write.parquet(f"{target}/rows")
    for name, at in parts.held.items():
        if listed.get(name) == at:
            remove(spark, f"{layout.control(table)}/{name}")
    for old in _snapshots(spark, layout, table)[:-2]:
        remove(spark, f"{root}/{old:08d}")


def read(spark: SparkSession, layout: Layout, table: str, ddl: str) -> DataFrame:
    """All rows of a control table."""
    return _named_rows(spark, layout, table, ddl, _parts(spark, layout, table)).drop("_name")


def logged(spark: SparkSession, layout: Layout, run_id: str, dataset: str) -> Row | None:
    """What a run logged for a dataset, read from its own folder or, when that was folded, from the snapshot."""
    name = f"{run_id}-{dataset}"
    own = f"{layout.control(RUN_LOG)}/{name}"
    if path_exists(spark, own):
        return read_table(spark, own, RUN_LOG_DDL).first()
    numbers = _snapshots(spark, layout, RUN_LOG)
    if not numbers:
        return None
    rows = spark.read.schema(f"{RUN_LOG_DDL}, _name string").parquet(layout.control(f"folded/{RUN_LOG}/{numbers[-1]:08d}/rows"))
    return rows.where(F.col("_name") == name).drop("_name").first()


def run_log(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per run and dataset; a run that was logged again counts once."""
    rows = read(spark, layout, RUN_LOG, RUN_LOG_DDL)
    return latest_record(rows, ["_ingestion_id", "collection"], [F.col("end_time").desc(), F.col("start_time").desc()])


def watermarks(spark: SparkSession, layout: Layout) -> DataFrame:
    return read(spark, layout, WATERMARKS, WATERMARK_DDL)


def violations(spark: SparkSession, layout: Layout) -> DataFrame:
    return read(spark, layout, VIOLATIONS, VIOLATIONS_DDL)


def current_marks(history: DataFrame) -> DataFrame:
    """The newest mark of each dataset."""
    newest = [F.col("updated_at").desc(), F.col("_ingestion_id").desc()]
    return latest_record(history, ["collection"], newest)


def marks_from_log(log: DataFrame, specs: DataFrame) -> DataFrame:
    """Marks implied by the run log, for datasets of ``specs`` (collection, field, type).

    The log row carries the final mark and is the only commit of a run, so a crash before
    the mark table is written cannot make the next run read the window twice.
    """
    advanced = may_advance_rows(log.where(F.col("load_type") == "incremental"))
    return advanced.join(specs, "collection").select(
        "collection", "watermark_field", F.col("watermark_final").alias("watermark_value"),
        "watermark_type", "_ingestion_id", F.col("end_time").alias("updated_at"),
    )


def may_advance_rows(log: DataFrame) -> DataFrame:
    """Run-log rows whose mark may become current."""
    short = F.col("qtd_gravada_destino") < F.col("qtd_lida_origem")
    safe = (F.col("status") == SUCCESS) | ((F.col("status") == PARTIAL) & ~short)
    return log.where(safe & F.col("watermark_final").isNotNull())


def advance_marks(judged: DataFrame) -> DataFrame:
    """New mark rows out of judged runs.

    Needs ``load_type, forced_full, final_mark, may_advance`` and the mark columns.  A run
    that saw no mark of its own keeps ``previous_mark``.
    """
    final = F.coalesce(F.col("final_mark"), F.col("previous_mark"))
    ready = (
        (F.col("load_type") == "incremental") & ~F.col("forced_full") & F.col("may_advance") & final.isNotNull()
    )
    return judged.where(ready).select(
        "collection", "watermark_field", final.alias("watermark_value"),
        "watermark_type", "_ingestion_id", "updated_at",
    )


def first_run(log: DataFrame) -> DataFrame:
    return log.agg(F.min_by("_ingestion_id", F.struct("start_time", "_ingestion_id")).alias("_ingestion_id"))


def of_runs(df: DataFrame, run_ids: list[str], dates: list[str] | None = None) -> DataFrame:
    """Rows of the given runs; the dates let partitions be skipped where they are known."""
    rows = df.where(F.col("_ingestion_id").isin(run_ids))
    return rows.where(F.col("_ingestion_date").isin(dates)) if dates else rows


def register_views(spark: SparkSession, layout: Layout) -> None:
    """Control tables under their usual names, for dashboards in SQL."""
    run_log(spark, layout).createOrReplaceTempView(RUN_LOG)
    current_marks(watermarks(spark, layout)).createOrReplaceTempView(WATERMARKS)
    violations(spark, layout).createOrReplaceTempView(VIOLATIONS)


def not_failed(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") != FAILED)
