"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def build_session(app: str = "weirgate", cores: int | None = None) -> SparkSession:
    """A session for local runs; on a cluster the submitter owns the settings."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if cores:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "8g")
        )
    return builder.getOrCreate()


_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_BROADCAST_READ = "spark.sql.adaptive.autoBroadcastJoinThreshold"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def stepwise(spark: SparkSession) -> Iterator[None]:
    """Settings for steps that are each run once and written, put back afterwards.

    Shuffle files go when their step ends, not when the driver happens to collect its garbage.  A table is broadcast
    once it has been shuffled and found to be below the session's limit, not by an estimate, which is far too low for
    compressed files and for what is exploded or collected from them.
    """
    conf = spark.conf
    settings = {_CLEANUP: "true", _BROADCAST: "-1"}
    if conf.get(_BROADCAST_READ, None) is None:
        settings[_BROADCAST_READ] = conf.get(_BROADCAST)
    before = {key: conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  A folder of the
    local machine is only acceptable when the executors live on that machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weirgate-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/weirgate/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The file system that Spark itself uses for the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a path, nothing for an absent one."""
    files, target = _file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(target)] if files.exists(target) else []


def finished_folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Folders directly below a path whose write was committed, and when."""
    files, _ = _file_system(spark, path)
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS"))
    return {entry.getPath().getParent().getName(): entry.getModificationTime() for entry in found or []}


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    files, target = _file_system(spark, path)
    return files.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, in place of one that has the name already."""
    files, old = _file_system(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(new.getParent())
    if files.exists(new):
        files.delete(new, False)
    if not files.rename(old, new):
        raise OSError(f"could not rename {source} to {target}")


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a folder that was written whole in place of another.

    Two renames: a crash between them leaves both the old and the new folder whole, beside the name.
    """
    files, new = _file_system(spark, staged)
    path = spark._jvm.org.apache.hadoop.fs.Path
    old = path(f"{staged}.old")
    had = files.exists(path(target)) and files.rename(path(target), old)
    if not files.rename(new, path(target)):
        if had:
            files.rename(old, path(target))
        raise OSError(f"could not rename {staged} to {target}")
    files.delete(old, True)


def small_frame(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A few driver-side values as a DataFrame: control rows, specs, bucket heads.

    Handed over as Arrow they become a local relation, which needs no Python worker and is
    folded into the plan.
    """
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema, timestamp_utc=True)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    arrays = [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def read_table(spark: SparkSession, path: str, ddl: str, **options: str) -> DataFrame:
    """Parquet under ``path`` with a fixed schema; an absent table reads as empty."""
    if not path_exists(spark, path):
        return small_frame(spark, [], ddl)
    return spark.read.options(**options).schema(ddl).parquet(path)
