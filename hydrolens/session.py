"""Session defaults and staging of intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "hydrolens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a cluster, once per application.

    Functions that run there are found by name, so a worker that does not start in the repository
    and has no installed copy could not import them.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="hydrolens-")) / "hydrolens.zip"  # the driver serves it to the workers
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def _named_share(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local master without the setting gets a fresh folder; a cluster without it is an error,
    since a machine-local path would be lost with its executor.
    """
    path = _named_share(spark)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="hydrolens-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the cluster resolves it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def is_shared(spark: SparkSession, path: str) -> bool:
    """Whether a path lies in the folder that is named as shared (`shared_dir`)."""
    shared = _named_share(spark)
    return bool(shared) and f"{qualified_path(spark, path)}/".startswith(f"{qualified_path(spark, shared)}/")


def stage(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where several passes need the same derived rows: lineage is cut, an executor loss costs
    a re-read instead of a recompute, and the passes still prune columns. The copy stays, since
    the returned frame is lazy; jobs that know their end use `staging`.
    """
    path = path or stage_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries started here drop their shuffle files when they end, which otherwise stay until the driver collects garbage.

    Only for queries whose plan nobody runs again, as for one that writes a table.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """`stage` for the length of a job: the copies go when it has succeeded, and stay when it failed."""
    paths: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        paths.append(stage_path(spark, label))
        return stage(df, path=paths[-1])

    yield keep
    for path in paths:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def parallelism(spark: SparkSession) -> int:
    """Tasks to aim for: the cores of the cluster or the shuffle setting, whichever is smaller."""
    return max(1, min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
