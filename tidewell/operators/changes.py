"""New content of a table after an update, delete, merge or slice replacement.

Parquet tables take no UPDATE, DELETE or MERGE. Each change is therefore a
function from the old rows to the new ones; how they are stored is up to the
caller (``tidewell.operators.versions`` rewrites only what a change touches).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.keys import require_unique


def is_true(condition: Column) -> Column:
    """The condition with NULL read as FALSE."""
    return F.coalesce(condition, F.lit(False))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns in the rows where ``condition`` is TRUE; all see the old values."""
    hit = is_true(condition)
    return df.select(
        *[
            F.when(hit, values[name]).otherwise(F.col(name)).alias(name)
            if name in values
            else F.col(name)
            for name in df.columns
        ]
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows where ``condition`` is TRUE; rows where it is NULL stay."""
    return df.filter(~is_true(condition))


def append_evolved(df: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Both row sets; a column that one side lacks is NULL there."""
    return df.unionByName(new_rows, allowMissingColumns=True)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    check_source: bool = True,
    unique_target: bool = True,
) -> DataFrame:
    """Replace the target's matching rows by the source's; insert the rest of the source.

    A NULL key matches nothing: such source rows are inserted each time, such
    target rows stay. Two source rows for one target row are an error
    (``check_source``).

    ``unique_target`` says that the target holds each key once, which is what a
    table kept by merges does. Then one anti-join is enough. Otherwise every
    copy of a matching target row is given the source's values.

    Spark picks the join by size. When both sides are shuffled, adaptive
    execution splits an oversized partition of the target in either form.
    """
    names = list(keys)
    if check_source:
        require_unique(source, names, within=target)
    if unique_target:
        kept = target.join(source.select(*names), names, "left_anti")
        return kept.unionByName(source.select(*target.columns))

    tagged = source.select(
        *[F.col(name).alias(f"_new_{name}") for name in target.columns],
        F.lit(True).alias("_matched"),
    )
    same_key = [F.col(name) == F.col(f"_new_{name}") for name in names]
    carried = target.join(tagged, same_key, "left").select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
            for name in target.columns
        ]
    )
    # Keys the two have in common: the target's keys are cut down to the
    # source's before anything wide moves.
    common = target.select(*names).join(source.select(*names), names, "left_semi").distinct()
    inserted = source.select(*target.columns).join(common, names, "left_anti")
    return carried.unionByName(inserted)


def upsert_dimension(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge the distinct source rows; attributes are overwritten, no history is kept.

    Two different rows for one key are an error, whether the target has the key or not.
    """
    rows = source.distinct()
    require_unique(rows, keys)
    return merge_upsert(target, rows, keys, check_source=False)


def unseen_rows(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key, NULL being one, ``stored`` does not have.

    The stored keys are cut down to the incoming ones first, so a large table is
    scanned, and not shuffled where the incoming keys are few.
    """
    wanted = incoming.select(F.col(key).alias("_wanted")).distinct()
    known = stored.select(F.col(key).alias("_known"))
    known = known.join(wanted, F.col("_known").eqNullSafe(F.col("_wanted")), "left_semi").distinct()
    return incoming.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")


def replace_slice(
    target: DataFrame, incoming: DataFrame, slice_column: str, value: Column, key: str
) -> DataFrame:
    """Replace one slice (say, a day) of a table that has no key of its own.

    The slice's rows are exchanged for the incoming ones of that slice. Incoming
    rows of other slices are added only when the target lacks their ``key`` (NULL
    is a key here), so running twice changes nothing and no other slice loses a row.
    """
    in_slice = F.col(slice_column).eqNullSafe(value)
    others = incoming.filter(~in_slice)
    unseen = unseen_rows(others, target.filter(~in_slice), key)
    return (
        target.filter(~in_slice)
        .unionByName(incoming.filter(in_slice).select(*target.columns))
        .unionByName(unseen.select(*target.columns))
    )
