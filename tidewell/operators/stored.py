"""Updates, deletes and merges of a Parquet table stored by partition, which touch few of its partitions.

Each change finds the partition folders that hold a row it concerns, reads these alone, writes them
anew beside the table and publishes them (``tidewell.sinks.swap``). All other folders are neither
read, but for the columns that the search needs, nor written. The names of the folders a change
touches pass through the driver, as they do when Spark lists a table's files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.changes import delete_where, merge_upsert, update_where
from tidewell.operators.keys import require_unique
from tidewell.operators.sets import except_rows
from tidewell.session import fresh_path, path_exists, remove_path
from tidewell.sinks.files import counted
from tidewell.sinks.swap import partition_folders, publish, recover, staged_path


def read_stored(
    spark: SparkSession, path: str, schema: T.StructType | None = None, folders: Sequence[str] | None = None
) -> DataFrame:
    """The table, or the rows of some of its partition folders; only those are then listed and read.

    Without ``schema`` the files are asked for their columns, and the folder names for the types of the
    partition columns.
    """
    reader = spark.read.option("basePath", path)
    if schema is None:
        schema = reader.option("mergeSchema", True).parquet(path).schema
    if folders is None:
        return reader.schema(schema).parquet(path)
    present = [f"{path}/{f}" for f in folders if path_exists(spark, f"{path}/{f}")]
    return reader.schema(schema).parquet(*present) if present else spark.createDataFrame([], schema)


def _file() -> Column:
    """The file a stored row is in."""
    return F.col("_metadata.file_path").alias("_path")


def folder_of(file: str, depth: int) -> Column:
    """The partition folder, relative to the table, of a file's path; escaped as in a URI."""
    parts = F.split(file, "/")
    return F.array_join(F.slice(parts, F.size(parts) - depth, depth), "/")


def _folders_of(files: DataFrame, depth: int) -> list[str]:
    """The partition folders of the files in ``_path``."""
    return sorted(unquote(r[0]) for r in files.select(folder_of("_path", depth)).distinct().collect())


def _write(rows: DataFrame, target: str, partition_by: Sequence[str], place: bool = True) -> int:
    """Rows written; those of a folder are brought together first, unless they lie as they should."""
    placed = rows.hint("rebalance", *partition_by) if place else rows
    return counted(placed, lambda d: d.write.partitionBy(*partition_by).parquet(target))["n_rows"]


def replace_partitions(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str],
    folders: Sequence[str] | None = None,
    place: bool = True,
) -> int:
    """Exchange partitions of a table for ``rows``, which may be read from it; rows written.

    ``folders`` names the partitions that go, and all that ``rows`` may have; by default they are those
    that ``rows`` have. Nothing is touched before all is written.
    """
    spark, staged, depth = rows.sparkSession, staged_path(path), len(partition_by)
    try:
        written = _write(rows, staged, partition_by, place)
        strange = set(partition_folders(spark, staged, depth)).difference(folders or ())
        if strange and folders is not None:
            raise ValueError(f"rows of partitions that are not to be replaced: {sorted(strange)[:5]}")
    except BaseException:
        remove_path(spark, staged)
        raise
    publish(spark, staged, path, depth, folders)
    return written


def update_stored(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    condition: Column,
    values: Mapping[str, Column],
    schema: T.StructType | None = None,
) -> int:
    """Set columns where ``condition`` is TRUE, in the partitions that have such a row; their number.

    A partition column cannot be set: the row would have to move.
    """
    moved = set(values) & set(partition_by)
    if moved:
        raise ValueError(f"partition columns cannot be updated: {sorted(moved)}")
    return _changed(spark, path, partition_by, condition, lambda d: update_where(d, condition, values), schema)


def delete_stored(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    condition: Column,
    schema: T.StructType | None = None,
) -> int:
    """Drop the rows where ``condition`` is TRUE, in the partitions that have such a row; their number."""
    return _changed(spark, path, partition_by, condition, lambda d: delete_where(d, condition), schema)


def _changed(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    condition: Column,
    change: Callable[[DataFrame], DataFrame],
    schema: T.StructType | None,
) -> int:
    recover(spark, path)
    table = read_stored(spark, path, schema)
    folders = _folders_of(table.filter(condition).select(_file()), len(partition_by))
    if folders:
        held = read_stored(spark, path, table.schema, folders)
        replace_partitions(change(held), path, partition_by, folders)
    return len(folders)


def _widened(rows: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """``rows`` with the fields that they lack, NULL."""
    new = [f for f in fields if f.name not in rows.columns]
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


def merge_stored(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    schema: T.StructType | None = None,
    stored_at: str | None = None,
) -> dict[str, int]:
    """Upsert ``source`` into the table at ``path``, which is made if it is not there.

    Returns ``n_rows`` of the source, and ``n_written``, those of the partitions written anew. These are
    the ones that hold a matching row, which may lie elsewhere than its new version, and the ones that
    take a row.

    The source is stored once, by partition; ``stored_at`` names the folder where it is so already. Two
    source rows for one target row are an error, before anything is written. A row without a key matches
    nothing; it is added unless an equal row is there. Columns that the table does not have are added to
    it; those that the source lacks become NULL.
    """
    spark, depth, names = source.sparkSession, len(partition_by), list(keys)
    recover(spark, path)
    if not path_exists(spark, path):
        written = replace_partitions(source, path, partition_by, place=stored_at is None)
        return {"n_rows": written, "n_written": written}
    stored_source = stored_at or fresh_path(spark, "merge-source")
    try:
        n_rows = source.count() if stored_at else _write(source, stored_source, partition_by)
        fresh = spark.read.schema(source.schema).parquet(stored_source).select(*source.columns)
        taking = partition_folders(spark, stored_source, depth)
        table = read_stored(spark, path, schema)
        # Partition columns have the source's types: folder names alone may look like other ones.
        named = {f.name: f for f in source.schema.fields if f.name in partition_by}
        table = read_stored(spark, path, T.StructType([named.get(f.name, f) for f in table.schema.fields]))
        require_unique(fresh, names, within=table)
        # Folders that take a row are written anyway; the others are searched for rows that match.
        elsewhere = sorted(set(partition_folders(spark, path, depth)).difference(taking))
        folders = sorted({*taking, *_matching(spark, path, table.schema, elsewhere, fresh, names, depth)})
        if not folders:
            return {"n_rows": n_rows, "n_written": 0}
        held = _widened(read_stored(spark, path, table.schema, folders), source.schema.fields)
        changes = _widened(fresh, held.schema.fields).select(*held.columns)
        keyed = reduce(Column.__and__, [F.col(name).isNotNull() for name in names])
        unkeyed = except_rows(changes.filter(~keyed), held.filter(~keyed))
        merged = merge_upsert(held, changes.filter(keyed).unionByName(unkeyed), names, check_source=False)
        written = replace_partitions(merged, path, partition_by, folders)
        return {"n_rows": n_rows, "n_written": written}
    finally:
        if not stored_at:
            remove_path(spark, stored_source)


def _matching(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    folders: Sequence[str],
    fresh: DataFrame,
    keys: Sequence[str],
    depth: int,
) -> list[str]:
    """Those of the partition folders that hold a row with a key of ``fresh``."""
    if not folders:
        return []
    table = read_stored(spark, path, schema, folders)
    wanted = fresh.select(*keys).dropna()
    return _folders_of(table.select(*keys, _file()).join(wanted, list(keys), "left_semi"), depth)
