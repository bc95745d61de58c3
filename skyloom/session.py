"""Session settings, table loading and lineage cuts."""

from __future__ import annotations

import contextlib
import functools
import os
import uuid
import zipfile
from collections.abc import Iterator

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# Can only be chosen when a session starts.
START_CONF = {
    # Recording the call site of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "skyloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here relies on (UTC, AQE, dynamic overwrite)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not find it where they run."""
    here = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.join(SparkFiles.getRootDirectory(), "package")
    os.makedirs(folder, exist_ok=True)
    archive = os.path.join(folder, "skyloom.zip")
    if os.path.exists(archive):
        return
    with zipfile.ZipFile(archive, "w") as out:
        for base, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(base, name)
                out.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(archive)


def apply_runtime_conf(spark: SparkSession) -> None:
    """Bring a session made elsewhere to the runtime settings above."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Read one parquet table; zone-less timestamps become UTC instants."""
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    zoned = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(zoned) if zoned else df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; where none is named, the session's warehouse,
    which all executors share as well."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a temporary table in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder in whatever file system holds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``store`` writes inside the block when it ends. For jobs whose
    results are written before they return; a frame read from such a table must not outlive it."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            remove_path(spark, path)


def scratch_scoped(job):
    """Run a job, whose first argument is the session, inside its own ``scratch_scope``."""

    @functools.wraps(job)
    def scoped(spark: SparkSession, *args, **kwargs):
        with scratch_scope(spark):
            return job(spark, *args, **kwargs)

    return scoped


def store(df: DataFrame, name: str = "stored", outlive: bool = False) -> DataFrame:
    """Write ``df`` as a table to the shared checkpoint folder and read it back.

    For wide frames that are read several times: later reads take only the columns and rows
    they need, and a lost executor costs no recompute. With ``outlive`` the table is left to the
    scope around the innermost one.
    """
    path = scratch_path(df.sparkSession, name)
    holding = _scopes[:-1] if outlive else _scopes
    if holding:
        holding[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Checkpoint a small ``df`` in the shared folder, so a lost executor costs no recompute."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
