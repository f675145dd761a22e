"""File writers.

Row counts come from ``observe`` inside the write job, so nothing is scanned a
second time. The observed node is always the last one before the files, past
every shuffle: in that stage Spark applies each task's metrics exactly once,
also when tasks are run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewell.session import remove_path
from tidewell.sinks.swap import publish, staged_path

PACKED_ROWS = 1_000_000


def counted(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    **extra: Column,
) -> dict[str, int]:
    """Run ``write(df)`` and return ``n_rows`` and any further aggregates of the written rows."""
    watch = Observation()
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    metrics += [column.alias(name) for name, column in extra.items()]
    write(df.observe(watch, *metrics))
    return watch.get


def overwrite(df: DataFrame, path: str) -> int:
    """Replace the table at ``path``; the number of rows written."""
    return counted(df, lambda d: d.write.mode("overwrite").parquet(path))["n_rows"]


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Add rows to the table at ``path``; new columns are allowed (read with ``merge_schema``)."""

    def write(d: DataFrame) -> None:
        writer = d.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)

    return counted(df, write)["n_rows"]


def overwrite_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace the table at ``path``, one folder per value of ``partition_by``.

    Rows are brought together by folder first, so that a folder gets few files.
    ``rebalance`` lets Spark cut a folder that holds much of the data into
    several tasks and put small ones together.
    """
    placed = df.hint("rebalance", *partition_by)
    return counted(
        placed, lambda d: d.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    )["n_rows"]


def write_split(df: DataFrame, path: str, flag: str) -> dict[str, int]:
    """Write accepted and rejected rows in one job, as two folders of one table.

    ``flag`` is a boolean column, never NULL. Returns ``n_good`` and ``n_bad``.
    Writing once spares the second run of everything above, which two filtered
    writes would cost.
    """
    counts = counted(
        df,
        lambda d: d.write.mode("overwrite").partitionBy(flag).parquet(path),
        n_good=F.count_if(F.col(flag)),
    )
    return {"n_good": counts["n_good"], "n_bad": counts["n_rows"] - counts["n_good"]}


def read_split(like: DataFrame, path: str, flag: str) -> tuple[DataFrame, DataFrame]:
    """The accepted and the rejected rows written by ``write_split``; each reads its folder only."""
    stored = like.sparkSession.read.schema(like.schema).parquet(path)
    return stored.filter(F.col(flag)).drop(flag), stored.filter(~F.col(flag)).drop(flag)


def write_json_records(df: DataFrame, path: str, compression: str = "none") -> int:
    """One JSON object per line; dates and times as text, NULL fields kept.

    Readers know compressed files by their names. One task reads such a file whole, so it holds at most
    ``PACKED_ROWS`` rows.
    """
    options = {"ignoreNullFields": False, "compression": compression}
    if compression != "none":
        options["maxRecordsPerFile"] = PACKED_ROWS
    return counted(df, lambda d: d.write.mode("overwrite").options(**options).json(path))["n_rows"]


def write_csv(df: DataFrame, path: str) -> int:
    """CSV files with a header each."""
    return counted(df, lambda d: d.write.mode("overwrite").option("header", True).csv(path))[
        "n_rows"
    ]


def replace_folder(df: DataFrame, path: str) -> int:
    """Replace a table that ``df`` may read from; rows written.

    The new content is complete in a folder beside the old before the old is
    touched. Whatever fails, the old one is as it was; ``recover`` it before
    reading, in case the last writer died between two renames.
    """
    spark, staged = df.sparkSession, staged_path(path)
    try:
        written = overwrite(df, staged)
    except BaseException:
        remove_path(spark, staged)
        raise
    publish(spark, staged, path)
    return written


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write a small report as JSON only when it has a row; whether it was written."""
    if df.isEmpty():
        remove_path(df.sparkSession, path)  # of an earlier run
        return False
    write_json_records(df, path)
    return True
