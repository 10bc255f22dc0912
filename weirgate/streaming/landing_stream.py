"""Landing files into Bronze as a stream: each file once, drain and stop."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.plans.run import RunContext, keep_up, load_lines, log_row
from weirgate.sources.files import with_source
from weirgate.spec import DatasetSpec, Limits
from weirgate.streaming.schema_store import evolve

# Files may come from anyone and are read once: bad lines are set aside and make the batch
# partial, but no verdict hides the good ones.
TOLERANT = Limits(null_key_is_fatal=False, hard_fail_pct=100.0)


def landing_stream(ctx: RunContext, folder: str, max_files: int = 200) -> DataFrame:
    lines = (
        ctx.spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return with_source(lines)


def consume_landing(
    ctx: RunContext, spec: DatasetSpec, folder: str | None = None, max_files: int = 200, limits: Limits = TOLERANT,
    schema_mode: str | None = None,
) -> int:
    """Load every file that the checkpoint has not seen yet; returns the micro-batches run.

    With a ``schema_mode`` the dataset keeps a schema (``schema_store``), and fields outside of it are rescued.

    The load id is made of the query's id and the batch number, both kept by the checkpoint.
    A batch that is repeated after a crash therefore replaces its own rows and its own
    run-log row, whatever process repeats it.
    """
    ctx = replace(ctx, engine="stream", limits=limits)
    done = 0

    def load(batch: DataFrame, batch_id: int) -> None:
        nonlocal done
        start = dt.datetime.now(dt.timezone.utc)
        context = batch.sparkSession.sparkContext
        query_id = context.getLocalProperty("sql.streaming.queryId")
        load_id = f"{query_id}-{batch_id:08d}"
        here = replace(ctx, spark=batch.sparkSession)
        schema = evolve(batch, ctx.layout.schemas(spec.name), load_id, schema_mode) if schema_mode else None
        values = load_lines(here, spec, batch, load_id, None, schema)
        log_row(here, spec, load_id, start, values)
        keep_up(here, spec)
        done += 1

    query = (
        landing_stream(ctx, folder or ctx.layout.landing(spec.name), max_files)
        .writeStream.option("checkpointLocation", ctx.layout.checkpoint(spec.name))
        .foreachBatch(load)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def files_loaded(bronze: DataFrame) -> DataFrame:
    """Rows per landing file, to follow a stream."""
    return bronze.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"))
