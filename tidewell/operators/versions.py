"""A Parquet table that keeps its earlier versions.

``<path>/data/_version=<n>/_slice=<s>/<partition>=<value>/``  rows version n wrote
``<path>/touched/_version=<n>/``  partitions version n touched, and how
``<path>/history/``               one row per finished version

A change writes a new version folder with the partitions it touches and leaves
all others alone: an update of one country does not rewrite the rest. Its rows
come on top of the partition's earlier ones (``add``) or stand in their place
(``replace``). The history row is written last, so a change that fails half-way
is never seen and the next one overwrites what it left.

One writer at a time; there is no transaction log.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.changes import is_true, merge_upsert, update_where
from tidewell.session import materialized, path_exists
from tidewell.sinks import counted

_VERSION = "_version"
_SLICE = "_slice"
_HIT = "_hit"
_GONE = "_gone"

# A version and the columns it has; -1 and None before the first.
State = tuple[int, T.StructType | None]

_HISTORY = (
    T.StructType()
    .add("version", "integer")
    .add("operation", "string")
    .add("n_rows", "long")
    .add("committed_at", "timestamp")
    .add("schema", "string")
)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        if not partition_by:
            raise ValueError("changes are kept per partition: name a partition column")
        self.spark = spark
        self.partition_by = list(partition_by)
        self._data = f"{path}/data"
        self._touched = f"{path}/touched"
        self._history = f"{path}/history"

    # -- reading ---------------------------------------------------------

    def _versions(self) -> DataFrame:
        return self.spark.read.schema(_HISTORY).parquet(self._history)

    def history(self) -> DataFrame:
        """``version``, ``operation``, ``n_rows`` (written, changed or deleted), ``committed_at``."""
        return self._versions().drop("schema")

    def _newest(self) -> State:
        """The newest version (-1 before the first) and the columns it has."""
        if not path_exists(self.spark, self._history):
            return -1, None
        newest = self._versions().agg(F.max(F.struct("version", "schema")).alias("v")).first()["v"]
        if newest is None:
            return -1, None
        return newest["version"], T.StructType.fromJson(json.loads(newest["schema"]))

    def latest_version(self) -> int:
        return self._newest()[0]

    def _slice_key(self, version: int) -> Column:
        """Names a version's share of a partition, in one column that scans can prune by."""
        return F.concat(F.lit(f"v{version}-"), F.hex(F.xxhash64(*self.partition_by)))

    def _rows(
        self, version: int, schema: T.StructType, within: DataFrame | None = None
    ) -> DataFrame:
        """The rows at ``version``, of all partitions or of those in ``within``.

        Of each partition those versions count that lie between its last
        replacement and ``version``. The join with the short list of those slices
        prunes the scan to their folders.
        """
        partition_fields = [schema[c] for c in self.partition_by]
        number = T.StructField(_VERSION, T.IntegerType())
        key = T.StructField(_SLICE, T.StringType())
        mode = T.StructField("mode", T.StringType())

        noted = (
            self.spark.read.schema(T.StructType([mode, key, *partition_fields, number]))
            .parquet(self._touched)
            .filter(F.col(_VERSION) <= version)
        )
        replaced = F.max(F.when(F.col("mode") == "replace", F.col(_VERSION))).over(
            Window.partitionBy(*self.partition_by)
        )
        live = (
            noted.withColumn("_first", F.coalesce(replaced, F.lit(0)))
            .filter(F.col(_VERSION) >= F.col("_first"))
            .select(_SLICE, *self.partition_by)
        )
        if within is not None:
            wanted = [live[c].eqNullSafe(within[c]) for c in self.partition_by]
            live = live.join(within, wanted, "left_semi")
        stored = self.spark.read.schema(T.StructType([*schema.fields, number, key])).parquet(
            self._data
        )
        stored = stored.filter(F.col(_VERSION) <= version)
        same = [stored[_SLICE] == live[_SLICE]]
        same += [stored[c].eqNullSafe(live[c]) for c in self.partition_by]
        return stored.join(live, same, "left_semi").select(*schema.names)

    def as_of(self, version: int) -> DataFrame:
        """The table's rows, with the columns it had, at ``version``."""
        known = self._versions().filter(F.col("version") == version).first()
        if known is None:
            raise ValueError(f"no version {version}")
        return self._rows(version, T.StructType.fromJson(json.loads(known["schema"])))

    def _current(self) -> tuple[State, DataFrame]:
        version, schema = state = self._newest()
        if schema is None:
            raise ValueError("the table has no version yet")
        return state, self._rows(version, schema)

    def current(self) -> DataFrame:
        return self._current()[1]

    # -- writing ---------------------------------------------------------

    def _commit(
        self,
        state: State,
        rows: DataFrame,
        operation: str,
        mode: str,
        touched: DataFrame | None = None,
    ) -> int:
        """Write ``rows`` as the version after ``state``; the number of rows affected.

        ``rows`` may carry a boolean ``_hit`` (rows affected) and ``_gone`` (rows
        deleted). ``touched`` lists the partitions replaced, also those left
        without a row.
        """
        latest, known = state
        version = latest + 1
        folder = f"{self._data}/{_VERSION}={version}"
        flags = [c for c in (_HIT, _GONE) if c in rows.columns]
        plain = T.StructType([f for f in rows.schema.fields if f.name not in flags])
        affected = F.count_if(F.col(_HIT)) if _HIT in flags else F.count(F.lit(1))

        def write(df: DataFrame) -> None:
            kept = df.filter(~F.col(_GONE)) if _GONE in flags else df
            sliced = kept.drop(*flags).withColumn(_SLICE, self._slice_key(version))
            sliced.write.mode("overwrite").partitionBy(_SLICE, *self.partition_by).parquet(folder)

        placed = rows.hint("rebalance", *self.partition_by)
        n_rows = counted(placed, write, n_affected=affected)["n_affected"]

        if touched is None:
            # Partition values are folder names: no column of the files is read.
            touched = self.spark.read.schema(plain).parquet(folder).select(*self.partition_by)
        noted = touched.distinct().select(
            F.lit(mode).alias("mode"),
            self._slice_key(version).alias(_SLICE),
            *self.partition_by,
        )
        noted.coalesce(1).write.mode("overwrite").parquet(f"{self._touched}/{_VERSION}={version}")

        fields = list(known.fields) if known else []
        names = {f.name for f in fields}
        merged = T.StructType([*fields, *[f for f in plain.fields if f.name not in names]])
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(version).alias("version"),
            F.lit(operation).alias("operation"),
            F.lit(n_rows).cast("bigint").alias("n_rows"),
            F.current_timestamp().alias("committed_at"),
            F.lit(merged.json()).alias("schema"),
        )
        row.write.mode("append").parquet(self._history)
        return n_rows

    def create(self, df: DataFrame) -> int:
        """Version 0."""
        state = self._newest()
        if state[0] >= 0:
            raise ValueError("the table exists already")
        return self._commit(state, df, "WRITE", "add")

    def append(self, df: DataFrame) -> int:
        """Add rows; columns the table does not have yet are allowed."""
        return self._commit(self._newest(), df, "APPEND", "add")

    def _partitions_with(self, rows: DataFrame) -> AbstractContextManager[DataFrame]:
        return materialized(rows.select(*self.partition_by).distinct(), "touched")

    def update(self, condition: Column, values: Mapping[str, Column]) -> int:
        """Set columns where ``condition`` is TRUE; rewrites the partitions with such a row.

        A partition column cannot be set: the row would have to move.
        """
        moved = set(values) & set(self.partition_by)
        if moved:
            raise ValueError(f"partition columns cannot be updated: {sorted(moved)}")
        state, rows = self._current()
        hit = is_true(condition)
        with self._partitions_with(rows.filter(condition)) as touched:
            marked = self._rows(*state, touched).withColumn(_HIT, hit)
            changed = update_where(marked, F.col(_HIT), values)
            return self._commit(state, changed, "UPDATE", "replace", touched)

    def delete(self, condition: Column) -> int:
        """Drop the rows where ``condition`` is TRUE; rewrites the partitions with such a row."""
        state, rows = self._current()
        hit = is_true(condition)
        with self._partitions_with(rows.filter(condition)) as touched:
            marked = self._rows(*state, touched).withColumns({_HIT: hit, _GONE: hit})
            return self._commit(state, marked, "DELETE", "replace", touched)

    def merge(self, source: DataFrame, keys: Sequence[str]) -> int:
        """Upsert by key; the number of source rows.

        Rewrites the partitions that hold a matched row or take a source row (a
        source row may match one that lies in another partition).
        """
        state, rows = self._current()
        matched = rows.join(source.select(*keys), list(keys), "left_semi")
        either = matched.select(*self.partition_by).unionByName(source.select(*self.partition_by))
        with self._partitions_with(either) as touched:
            kept = self._rows(*state, touched).withColumn(_HIT, F.lit(False))
            merged = merge_upsert(kept, source.withColumn(_HIT, F.lit(True)), keys)
            return self._commit(state, merged, "MERGE", "replace", touched)

    def compact(self) -> int:
        """Few, evenly sized files per partition; the rows stay the same."""
        state, rows = self._current()
        with self._partitions_with(rows) as touched:
            return self._commit(state, rows, "COMPACT", "replace", touched)
