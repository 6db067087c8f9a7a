"""Session, table access and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Shuffle files go at the end of the action that wrote them, not when the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_PASSING: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


def build_session(app: str = "asterline", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in spark.checkpoint.dir. Only a local master may go without:
    there the folder lies in the warehouse; elsewhere its absence is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        context.setCheckpointDir(f"{warehouse}/_asterline-shared")
    # Spark appends a UUID of its own to the folder it was given.
    return os.path.dirname(context.getCheckpointDir())


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/asterline/{label}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever it lies; nothing if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def moved(spark: SparkSession, path: str, target: str) -> None:
    """Put a folder in the place of another."""
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    store = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    store.delete(to, True)
    if not store.rename(at, to):
        raise OSError(f"{path} could not be moved to {target}")


@contextmanager
def passing(*sessions: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed when the block ends, and shuffle files with the action that wrote them.

    Whatever is to be read afterwards must be written inside, or stored so that it `outlives` the block.
    """
    here: list[str] = []
    before = [(s, s.conf.get(SHUFFLES_GO, "false")) for s in sessions]
    token = _PASSING.set((*_PASSING.get(), here))
    try:
        for s, _ in before:
            s.conf.set(SHUFFLES_GO, "true")
        yield
    finally:
        _PASSING.reset(token)
        for s, value in reversed(before):
            s.conf.set(SHUFFLES_GO, value)
        for path in here:
            removed(sessions[0], path)


def passing_path(spark: SparkSession, label: str, outlives: bool = False) -> str:
    """A new path under the shared folder, removed with the innermost `passing` block, or the one around it."""
    path, blocks = scratch(spark, label), _PASSING.get()[: -1 if outlives else None]
    if blocks:
        blocks[-1].append(path)
    return path


def stored(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """Write once, read back: cuts lineage where a plan is read several times."""
    path = passing_path(df.sparkSession, label, outlives)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Cut a loop's lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
