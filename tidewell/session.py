"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import math
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings the library is tuned for. A cluster's own session may set others;
# nothing in the library depends on them for right results.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "tidewell",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the library's defaults.

    ``master`` and the sizes (memory, shuffle partitions) are left to the
    cluster unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune_for(spark: SparkSession, input_bytes: int) -> None:
    """Set the number of shuffle partitions for jobs that shuffle about ``input_bytes``.

    Some 200 MB go to each task, so that it sorts in memory; adaptive execution
    joins partitions that turn out small.
    """
    wanted = math.ceil(input_bytes / (200 * 1024**2))
    partitions = max(wanted, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))


# -- files, on whatever file system a path names -------------------------------


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path``, from the file system's own records."""
    files, place = _place(spark, path)
    return files.getContentSummary(place).getLength()


def remove_path(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    files, place = _place(spark, source)
    if not files.rename(place, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.mkdirs(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place))


# -- intermediate tables ---------------------------------------------------------

_ROOTS: dict[str, str] = {}


def working_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only where nothing is set
    and driver and executors are one process (a laptop, a test) a temporary
    folder is made; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidewell-")
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def _root(spark: SparkSession) -> str:
    """This process's own part of the working folder; it is removed when the process ends."""
    base = working_folder(spark)
    if base not in _ROOTS:
        root = _ROOTS[base] = f"{base}/tidewell-{uuid.uuid4().hex}"
        files, place = _place(spark, root)

        def remove() -> None:
            with contextlib.suppress(Exception):  # the JVM may be gone
                files.delete(place, True)

        atexit.register(remove)
    return _ROOTS[base]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the working folder that nothing else uses."""
    return f"{_root(spark)}/{label}-{uuid.uuid4().hex}"


def _stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later steps share the work.

    The copy is Parquet in the shared working folder: it outlives any executor,
    cuts the lineage, and later scans still prune columns and push filters. It
    is kept until the process ends.
    """
    return _stored_at(df, fresh_path(df.sparkSession, label))


@contextlib.contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As ``materialize``, but the copy is removed at the end of the block."""
    path = fresh_path(df.sparkSession, label)
    try:
        yield _stored_at(df, path)
    finally:
        remove_path(df.sparkSession, path)
