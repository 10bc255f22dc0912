"""One ingestion run: scan, land, load, judge, publish, per dataset.

Order of commits: landing folder, table rows, run-log row.  The run-log row is what makes a
load count; it also carries the new mark.  Any step can be repeated under the same run id.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weirgate import __version__
from weirgate.functions.marks import mark_text
from weirgate.functions.verdict import judge
from weirgate.operators import contract as contracts_op
from weirgate.operators.latest import latest_bronze
from weirgate.operators.quality import batch_metrics
from weirgate.operators.upsert import publish, read_keyed, stage_upsert
from weirgate.plans import accumulated, bronze, control, current
from weirgate.schemas import BRONZE_COLUMNS, BRONZE_DDL, RUN_LOG_DDL, SUMMARY_COLUMNS, VIOLATIONS_DDL, WATERMARK_DDL
from weirgate.session import folder_names, path_exists, read_table, small_frame
from weirgate.sources.files import read_lines, read_run_lines
from weirgate.sources.keyed_scan import land_in_ranges
from weirgate.sources.scans import scan_incremental
from weirgate.spec import NAME, FAILED, PARTIAL, SUCCESS, Contract, DatasetSpec, Layout, Limits

_NEWEST = ("_ingestion_timestamp", "_source_hash", "_source_file")


@dataclass(frozen=True)
class RunContext:
    """Where and how runs work.  ``accumulate`` checks each dataset's whole history at the end of its run."""

    spark: SparkSession
    layout: Layout
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    at: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc))
    limits: Limits = Limits()
    contracts: dict[str, Contract] = field(default_factory=dict)
    source_tag: str = ""
    force_full: bool = False
    engine: str = "batch"
    accumulate: bool = False

    def __post_init__(self) -> None:
        if not re.fullmatch(NAME, self.run_id):
            raise ValueError(f"run_id {self.run_id!r} cannot name a folder")


def documents(ctx: RunContext, spec: DatasetSpec) -> DataFrame:
    """Current document per key of a dataset, published loads only."""
    if spec.upserts():
        return read_keyed(ctx.spark, ctx.layout.keyed(spec.name), BRONZE_DDL)
    log = control.run_log(ctx.spark, ctx.layout)
    if current.kept(ctx.spark, ctx.layout, spec.name):
        appended = current.read_current(ctx.spark, ctx.layout, spec, log)
    else:
        loads = bronze.published_loads(log, spec.name)
        appended = latest_bronze(bronze.read_published(ctx.spark, ctx.layout.bronze(spec.name), loads))
    if not path_exists(ctx.spark, ctx.layout.keyed(spec.name)):
        return appended
    # A forced full load of this dataset went into a keyed table.
    keyed = read_keyed(ctx.spark, ctx.layout.keyed(spec.name), BRONZE_DDL)
    return latest_bronze(appended.unionByName(keyed))


def keep_up(ctx: RunContext, spec: DatasetSpec) -> int:
    """Fold new loads of an appended dataset into its table of current records, where it has one."""
    if not spec.keep_current or spec.upserts(ctx.force_full):
        return 0
    log = control.run_log(ctx.spark, ctx.layout)
    return current.fold_current(ctx.spark, ctx.layout, spec, log)


def check_accumulated(ctx: RunContext, spec: DatasetSpec) -> dict:
    """The whole history of a dataset against its log; kept in the table of checks."""
    spark, layout = ctx.spark, ctx.layout
    keyed = layout.keyed(spec.name)
    if spec.upserts(ctx.force_full) or path_exists(spark, keyed):
        stored, upserted = documents(ctx, spec), True
    else:
        loads = bronze.published_loads(control.run_log(spark, layout), spec.name)
        stored, upserted = bronze.read_published(spark, layout.bronze(spec.name), loads), False
    return accumulated.check(spark, layout, spec.name, ctx.run_id, stored, upserted, ctx.at)


def _contract_findings(ctx: RunContext, contract: Contract | None, counts: dict) -> list[tuple]:
    """Violations of the whole batch; at most four per contract field."""
    if contract is None:
        return []
    ddl = ", ".join(f"`{name}` bigint" for name in counts)
    counted = small_frame(ctx.spark, [tuple(counts.values())], ddl)
    metrics = contracts_op.by_field(counted, contract)
    found = contracts_op.contract_violations(metrics, contract).collect()
    return [(r["field"], r["kind"], r["detail"], float(r["violation_pct"])) for r in found]


def _verdict(ctx: RunContext, spec: DatasetSpec, seen: int, written: int, metrics: Any, contract_ok: bool) -> Any:
    row = (
        seen, written, float(metrics["null_key_pct"]), metrics["duplicate_keys"], contract_ok,
        spec.threshold_pct,
    )
    ddl = (
        "source_count bigint, written_count bigint, null_key_pct double, duplicate_keys bigint, "
        "contract_ok boolean, threshold_pct double"
    )
    return judge(small_frame(ctx.spark, [row], ddl), ctx.limits).first()


def load_lines(
    ctx: RunContext, spec: DatasetSpec, lines: DataFrame, load_id: str, seen: int | None, schema: StructType | None = None
) -> dict:
    """Lines into the dataset's table, judged and published; returns the run-log values.

    ``seen`` is the count at the source; without an independent source it is what the files
    hold, quarantine included.  With a ``schema``, fields outside of it are rescued.
    """
    spark, layout = ctx.spark, ctx.layout
    upserting = spec.upserts(ctx.force_full)
    load_type = "full" if ctx.force_full else spec.load_type
    parsed = bronze.parse_lines(lines, spec.key)
    if schema is not None:
        parsed = bronze.with_rescued_fields(parsed, schema)
    shaped = bronze.shape(parsed, load_id, ctx.at, ctx.source_tag, load_type)
    contract = ctx.contracts.get(spec.name)
    extra = accumulated.measures() if ctx.accumulate else []
    counts = bronze.append_load(shaped, layout.bronze(spec.name), load_id, contract, *extra)
    if extra:
        accumulated.note_load(spark, layout, spec.name, load_id, counts)
        counts = {name: n for name, n in counts.items() if not name.startswith("_")}
    stored = bronze.read_load(spark, layout.bronze(spec.name), load_id)
    metrics = batch_metrics(stored, ["_source_id"]).first()
    written, heads = metrics["rows"] - metrics["null_keys"], None
    if upserting and written:
        good = stored.where(~F.col("_quarantined")).select(*BRONZE_COLUMNS)
        heads = stage_upsert(
            good, layout.keyed(spec.name), "_source_id", [F.col(c).desc() for c in _NEWEST], spec.rows_per_bucket
        )
        generation = heads.first()["generation"]
        staged = read_table(spark, f"{layout.keyed(spec.name)}/data/_generation={generation}", BRONZE_DDL)
        written = staged.where(F.col("_ingestion_id") == load_id).count()

    seen = metrics["rows"] if seen is None else seen
    findings = _contract_findings(ctx, contract, counts)
    whole = load_type == "full"
    if whole and seen < spec.expected_min:
        findings.append(("*", "volume", f"{seen} rows, expected at least {spec.expected_min}", 100.0))
    verdict = _verdict(ctx, spec, seen, written, metrics, not findings)
    if findings:
        _log_findings(ctx, spec, findings, load_id)
    if heads is not None and verdict["status"] != FAILED:
        publish(heads, layout.keyed(spec.name))
        bronze.drop_staged(spark, layout.bronze(spec.name), load_id)
    return dict(
        status=verdict["status"],
        qtd_lida_origem=seen,
        qtd_gravada_destino=written,
        qtd_quarentena=metrics["null_keys"],
        qtd_duplicada_lote=metrics["duplicate_keys"],
        divergencia_pct=verdict["divergencia_pct"],
        contrato_ok=not findings,
        mensagem_erro=None if verdict["status"] == SUCCESS else verdict["message"],
    )


def _log_findings(ctx: RunContext, spec: DatasetSpec, findings: list[tuple], load_id: str) -> None:
    rows = [(load_id, spec.name, *finding, ctx.at) for finding in findings]
    control.append(small_frame(ctx.spark, rows, VIOLATIONS_DDL), ctx.layout, control.VIOLATIONS, f"{load_id}-{spec.name}")


def current_mark(ctx: RunContext, spec: DatasetSpec) -> str | None:
    """Newest mark of the dataset, from the mark table and from the run log itself."""
    if spec.load_type != "incremental" or ctx.force_full:
        return None
    ddl = "collection string, watermark_field string, watermark_type string"
    one = small_frame(ctx.spark, [(spec.name, spec.mark_field, spec.mark_kind)], ddl)
    log = control.run_log(ctx.spark, ctx.layout).where(F.col("collection") == spec.name)
    stored = control.watermarks(ctx.spark, ctx.layout).where(F.col("collection") == spec.name)
    history = stored.unionByName(control.marks_from_log(log, one))
    row = control.current_marks(history).first()
    return row["watermark_value"] if row else None


def _empty_load(ctx: RunContext, spec: DatasetSpec, incremental: bool) -> dict:
    """The verdict on a source without rows.  Nothing new is fine for an incremental load; a full one must be allowed
    to be empty, by the dataset, by its least volume and by its contract."""
    if incremental:
        return dict(status=SUCCESS, mensagem_erro=None)
    contract, findings = ctx.contracts.get(spec.name), []
    if contract is not None and not contract.allow_empty and not spec.allow_empty:
        findings.append(("*", "missing", "no documents although the contract does not allow empty", 0.0))
    if spec.expected_min > 0:
        findings.append(("*", "volume", f"0 rows, expected at least {spec.expected_min}", 100.0))
    if findings:
        _log_findings(ctx, spec, findings, ctx.run_id)
    notes = [] if spec.allow_empty else ["source is empty although allow_empty is off"]
    notes += [detail for _, _, detail, _ in findings]
    return dict(
        status=PARTIAL if notes else SUCCESS, mensagem_erro="; ".join(notes) or None, contrato_ok=not findings,
    )


def ingest(ctx: RunContext, spec: DatasetSpec, source: DataFrame) -> dict:
    """Run one dataset and return its run-log values; nothing is logged here."""
    before = current_mark(ctx, spec)
    incremental = spec.load_type == "incremental" and not ctx.force_full
    out: dict[str, Any] = dict(watermark_inicial=before, watermark_final=before)
    scan = scan_incremental(source, spec, before, ctx.force_full)
    if scan.isEmpty():
        return out | _empty_load(ctx, spec, incremental)

    folder = f"{ctx.layout.landing(spec.name)}/run_id={ctx.run_id}"
    measures = []
    if incremental:
        dtype = source.schema[spec.mark_field].dataType
        measures = [mark_text(F.max(spec.mark_field), dtype).alias("mark")]
    if spec.scan_ranges:
        state = ctx.layout.scan_state(spec.name, ctx.run_id)
        seen = land_in_ranges(
            scan, spec.key, folder, state, spec.scan_ranges, bronze.write_landing, measures[0] if measures else None
        )
    else:
        seen = bronze.write_landing(scan, folder, *measures)
    if incremental:
        out["watermark_final"] = seen.get("mark") or before
    lines = read_lines(ctx.spark, folder)
    return out | load_lines(ctx, spec, lines, ctx.run_id, seen["rows"]) | dict(landing_files=[folder])


def _log_values(
    ctx: RunContext, spec: DatasetSpec, run_id: str, kind: str, start: dt.datetime, end: dt.datetime
) -> dict:
    """A run-log row of a load that nothing is known of yet, in the order of the table's columns."""
    names = [part.split()[0] for part in RUN_LOG_DDL.split(", ")]
    return dict.fromkeys(names) | dict(
        _ingestion_id=run_id, collection=spec.name, load_type=kind,
        qtd_lida_origem=0, qtd_gravada_destino=0, qtd_quarentena=0, qtd_duplicada_lote=0,
        divergencia_pct=0.0, contrato_ok=True, landing_files=[], ingest_mode=ctx.engine,
        pipeline_version=__version__, start_time=start, end_time=end,
    )


def log_row(ctx: RunContext, spec: DatasetSpec, run_id: str, start: dt.datetime, values: dict) -> dict:
    """Append one run-log row, and the mark row that it implies."""
    kind = "full" if ctx.force_full else spec.load_type
    row = _log_values(ctx, spec, run_id, kind, start, dt.datetime.now(dt.timezone.utc)) | values
    frame = small_frame(ctx.spark, [tuple(row.values())], RUN_LOG_DDL)
    log = control.build_run_log(frame)
    control.append(log, ctx.layout, control.RUN_LOG, f"{run_id}-{spec.name}")
    final = row["watermark_final"]
    short = row["qtd_gravada_destino"] < row["qtd_lida_origem"]
    moved = final is not None and final != row["watermark_inicial"]
    safe = row["status"] == SUCCESS or (row["status"] == PARTIAL and not short)
    if spec.load_type == "incremental" and not ctx.force_full and moved and safe:
        mark = (spec.name, spec.mark_field, final, spec.mark_kind, run_id, row["end_time"])
        marks = small_frame(ctx.spark, [mark], WATERMARK_DDL)
        control.append(marks, ctx.layout, control.WATERMARKS, f"{run_id}-{spec.name}")
    return row


def run(
    ctx: RunContext, sources: dict[str, DataFrame], specs: list[DatasetSpec], parallel: int = 1
) -> DataFrame:
    """Ingest the given datasets and return the summary, one row per dataset.

    A dataset that raises is logged as failed and does not stop the others.  When a run is
    repeated under its id, datasets that it already finished are left alone.
    """

    def one(spec: DatasetSpec) -> dict:
        done = control.logged(ctx.spark, ctx.layout, ctx.run_id, spec.name)
        if done is not None and done["status"] != FAILED:
            return done.asDict()
        start = dt.datetime.now(dt.timezone.utc)
        try:
            values = ingest(ctx, spec, sources[spec.name])
        except Exception as problem:  # the run goes on with the next dataset
            values = dict(status=FAILED, mensagem_erro=f"{type(problem).__name__}: {problem}")
        row = log_row(ctx, spec, ctx.run_id, start, values)
        keep_up(ctx, spec)
        if ctx.accumulate:
            check_accumulated(ctx, spec)
        return row

    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        rows = list(pool.map(one, specs))
    names = [part.split()[0] for part in RUN_LOG_DDL.split(", ")]
    frame = small_frame(ctx.spark, [tuple(r[n] for n in names) for r in rows], RUN_LOG_DDL)
    return control.build_run_log(frame).select(F.col("_ingestion_id").alias("run_id"), *SUMMARY_COLUMNS)


def require_ok(summary: DataFrame, limits: Limits = Limits()) -> None:
    """Raise when a dataset failed, or is partial and that counts as failure."""
    bad = [FAILED, PARTIAL] if limits.fail_on_partial else [FAILED]
    names = [r[0] for r in summary.where(F.col("status").isin(bad)).select("collection").collect()]
    if names:
        raise RuntimeError(f"run did not pass for: {', '.join(sorted(names))}")


def reprocess(ctx: RunContext, spec: DatasetSpec) -> list[dict]:
    """Rebuild a dataset from everything that was landed, without touching the source.

    All runs are read and written in one pass, whatever their number: each run's load is a function of its landing
    folder, is written in its own place and under the time of its run, so what was newest stays so.  Counts, contract
    and verdict are worked out by run.  Upserted runs go into the keyed table together, the newest run's row first.
    Files that no run wrote belong to the streaming consumer.  The driver sees one row per run.
    """
    spark, layout = ctx.spark, ctx.layout
    landing, path = layout.landing(spec.name), layout.bronze(spec.name)
    start = dt.datetime.now(dt.timezone.utc)
    runs = [name.removeprefix("run_id=") for name in folder_names(spark, landing) if name.startswith("run_id=")]
    if not runs:
        return []
    log = control.run_log(spark, layout).where(F.col("collection") == spec.name)
    landed = small_frame(spark, [(r,) for r in runs], "_ingestion_id string")
    known = {r["_ingestion_id"]: r for r in log.join(landed, "_ingestion_id", "left_semi").collect()}
    runs.sort(key=lambda run_id: (known[run_id]["start_time"].timestamp() if run_id in known else 0.0, run_id))
    plan = []
    for place, run_id in enumerate(runs):
        before = known.get(run_id)
        at = before["start_time"].astimezone(dt.timezone.utc) if before else ctx.at + dt.timedelta(microseconds=place)
        forced = bool(before) and before["load_type"] == "full" and spec.load_type != "full"
        plan.append((run_id, at, "full" if forced else spec.load_type, spec.upserts(forced)))
    runs_frame = small_frame(spark, plan, "run_id string, _at timestamp, _kind string, _upserts boolean")

    lines = read_run_lines(spark, landing).join(runs_frame.select("run_id", "_at", "_kind"), "run_id")
    parsed = bronze.parse_lines(lines, spec.key, ["run_id", "_at", "_kind"])
    current.forget(spark, layout, spec.name)
    shaped = bronze.shape(parsed, F.col("run_id"), F.col("_at"), ctx.source_tag, F.col("_kind"))
    bronze.replace_loads(shaped, path, {run_id: at.astimezone(dt.timezone.utc).date() for run_id, at, _, _ in plan})

    stored = bronze.read_loads(spark, path, runs)
    judged, findings = _judged_loads(ctx, spec, stored, runs_frame)
    upserted = [run_id for run_id, _, _, upserts in plan if upserts and judged[run_id]["status"] != FAILED]
    if upserted:
        rows = bronze.read_published(spark, path, upserted)
        order = [F.col(c).desc() for c in _NEWEST]
        publish(stage_upsert(rows, layout.keyed(spec.name), "_source_id", order, spec.rows_per_bucket), layout.keyed(spec.name))
        for run_id in upserted:
            bronze.drop_staged(spark, path, run_id)
    if findings:
        frame = small_frame(spark, [(run_id, spec.name, *finding, ctx.at) for run_id, *finding in findings], VIOLATIONS_DDL)
        control.append(frame, layout, control.VIOLATIONS, f"reprocess-{spec.name}-{ctx.run_id}")
    done, ended = [], dt.datetime.now(dt.timezone.utc)
    for place, (run_id, _, kind, upserts) in enumerate(plan):
        row, before = judged[run_id], known.get(run_id)
        marks = (before["watermark_inicial"], before["watermark_final"]) if before else (None, None)
        done.append(_log_values(ctx, spec, run_id, kind, start, ended + dt.timedelta(microseconds=place)) | dict(
            status=row["status"], qtd_lida_origem=row["source_count"], qtd_gravada_destino=row["written_count"],
            qtd_quarentena=row["null_keys"], qtd_duplicada_lote=row["duplicate_keys"], divergencia_pct=row["divergencia_pct"],
            contrato_ok=row["contract_ok"], mensagem_erro=None if row["status"] == SUCCESS else row["message"],
            watermark_inicial=marks[0], watermark_final=marks[1],
        ))
    names = [part.split()[0] for part in RUN_LOG_DDL.split(", ")]
    frame = small_frame(spark, [tuple(row[n] for n in names) for row in done], RUN_LOG_DDL)
    control.append(control.build_run_log(frame), layout, control.RUN_LOG, f"reprocess-{spec.name}-{ctx.run_id}")
    keep_up(ctx, spec)
    return done


def _judged_loads(ctx: RunContext, spec: DatasetSpec, stored: DataFrame, runs: DataFrame) -> tuple[dict, list[tuple]]:
    """Verdict of each load by its id, and the findings (load, field, kind, detail, share).  A load without rows has one."""
    per_key = stored.groupBy("_load", "_source_id").agg(F.count(F.lit(1)).alias("_n"))
    keyless = F.col("_source_id").isNull()
    counts = per_key.groupBy("_load").agg(
        F.sum("_n").alias("source_count"), F.count_if(~keyless).alias("keys"),
        F.coalesce(F.sum(F.when(keyless, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~keyless & (F.col("_n") > 1)).alias("duplicate_keys"),
    )
    none = ["source_count", "keys", "null_keys", "duplicate_keys"]
    counts = runs.select(F.col("run_id").alias("_load"), "_kind", "_upserts").join(counts, "_load", "left").na.fill(0, none)
    rows = F.col("source_count")
    counts = counts.withColumns({
        "written_count": F.when(F.col("_upserts"), F.col("keys")).otherwise(rows - F.col("null_keys")),
        "null_key_pct": F.when(rows > 0, F.col("null_keys") / rows * 100.0).otherwise(0.0),
        "threshold_pct": F.lit(spec.threshold_pct).cast("double"),
    })
    findings, contract = [], ctx.contracts.get(spec.name)
    if contract is not None:
        metrics = contracts_op.contract_metrics(stored, contract, "body_json", ["_load"])
        found = contracts_op.contract_violations(metrics, contract, ["_load"]).collect()
        findings += [(r["_load"], r["field"], r["kind"], r["detail"], float(r["violation_pct"])) for r in found]
    short = counts.where((F.col("_kind") == "full") & (rows < spec.expected_min)).select("_load", "source_count").collect()
    findings += [(r[0], "*", "volume", f"{r[1]} rows, expected at least {spec.expected_min}", 100.0) for r in short]
    broken = small_frame(ctx.spark, sorted({(f[0],) for f in findings}), "_load string").withColumn("_broken", F.lit(True))
    flagged = counts.join(broken, "_load", "left").withColumn("contract_ok", F.col("_broken").isNull())
    return {r["_load"]: r for r in judge(flagged, ctx.limits).collect()}, findings
