"""Small DataFrame helpers shared by all operators."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # with the query that wrote them


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add or replace columns whose expressions are evaluated exactly once per row.

    A plain projection of costly expressions may be evaluated again: the optimizer merges adjacent
    projections and copies their expressions into a filter it pushes down.  ``inline`` over a one-element
    array of structs is a row-to-row step that neither rewrite crosses, and it stays in generated code.
    """
    kept = [F.col(c) for c in df.columns if c not in cols]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores when a small input has fewer splits; any other scan is left alone, because dealing it writes it once per read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, key)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    On a cluster it has to be set; only a local session without it gets a temporary folder.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        return path
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    return context.getCheckpointDir()


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables written inside, which goes with them at the end.

    Only for jobs that have written all their results by then; a driver that is lost before leaves the folder behind.
    """
    path = f"{scratch_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    token = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """The shuffles of a query that is run inside go at its end: otherwise their files stay until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and continue from the written table.

    This cuts the lineage in a way that survives lost executors, and later reads prune columns.
    """
    spark = df.sparkSession
    path = f"{_run_folder.get() or scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(df: DataFrame) -> DataFrame:
    """Let Spark copy this package to the Python workers; called before the few steps that run Python there."""
    context = df.sparkSession.sparkContext
    package = Path(__file__).resolve().parent.parent
    if not any(name.endswith(f"/{package.name}.zip") or name == f"{package.name}.zip" for name in context.listFiles):
        folder = tempfile.mkdtemp(prefix=f"{package.name}-")
        archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
    return df
