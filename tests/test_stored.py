"""Changes of stored, partitioned tables, and what a failure in the middle of one leaves."""

import pathlib
import random
from urllib.parse import unquote

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidewell.operators import stored
from tidewell.operators.keys import DuplicateKeyError
from tidewell.session import move_path, remove_path
from tidewell.sinks import overwrite_partitioned, recover, swap

KIND = "k int, v string, p string"
PLACED = "k int, p string, v string"
ODD = ["a b", "x%y", "é:z", "007", "q=r", "{c}[d]*", None]


@pytest.fixture
def path(spark, folder):
    made = [(i, f"v{i}", ODD[i % len(ODD)]) for i in range(35)] + [(None, "none", "007")]
    overwrite_partitioned(spark.createDataFrame(made, KIND), f"{folder}/t", ["p"])
    return f"{folder}/t"


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], KIND).schema


def files(path):
    """Data files with their times."""
    return {p: p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


def table(spark, path, schema):
    return rows(stored.read_stored(spark, path, schema).select("k", "v", "p"))


def test_update_and_delete_of_odd_partitions(spark, path, schema):
    state = {k: (v, p) for k, v, p in table(spark, path, schema)}
    for value in ODD:
        mine = F.col("p").eqNullSafe(F.lit(value)) & (F.col("k") < 14)
        before = files(path)
        assert stored.update_stored(spark, path, ["p"], mine, {"v": F.lit("new")}, schema) == 1
        assert len(before.keys() - files(path).keys()) >= 1
        state |= {k: ("new", p) for k, (v, p) in state.items() if p == value and k is not None and k < 14}
    assert table(spark, path, schema) == sorted(((k, *v) for k, v in state.items()), key=lambda r: [(x is not None, str(x)) for x in r])
    assert stored.delete_stored(spark, path, ["p"], F.col("p") == "x%y", schema) == 1
    assert stored.delete_stored(spark, path, ["p"], F.col("k") == -5, schema) == 0
    assert {p for _, _, p in table(spark, path, schema)} == set(ODD) - {"x%y"}
    with pytest.raises(ValueError, match="partition columns"):
        stored.update_stored(spark, path, ["p"], F.col("k") == 1, {"p": F.lit("z")}, schema)


def test_a_partition_that_reads_as_another_is_not_lost(spark, path):
    """Without a schema 007 looks like the number 7, whose folder has another name."""
    overwrite_partitioned(spark.createDataFrame([(1, "a", "007")], KIND), path, ["p"])
    with pytest.raises(ValueError, match="not to be replaced"):
        stored.update_stored(spark, path, ["p"], F.col("k") == 1, {"v": F.lit("b")})
    assert spark.read.parquet(path).count() == 1


def test_merge_reads_and_writes_touched_partitions_only(spark, path, schema):
    before = files(path)
    source = spark.createDataFrame([(1, "moved", "new"), (100, "added", "007"), (None, "none", "007"), (None, "two", "007")], KIND)
    read = []
    original = stored.replace_partitions
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(stored, "replace_partitions", lambda d, *a, **k: (read.extend(d.inputFiles()), original(d, *a, **k))[1])
        done = stored.merge_stored(source, path, ["k"], ["p"])
    # Row 1 lay in x%y; its new version goes to a new partition.
    assert done["n_rows"] == 4 and done["n_written"] == 4 + 1 + 6 + 2
    kept = {f: t for f, t in files(path).items() if f in before}
    assert kept == {f: t for f, t in before.items() if f in kept}
    gone = {f.parent.name for f in before.keys() - kept.keys()}
    assert gone == {"p=x%25y", "p=007"}
    assert {unquote(f).split("/")[-2] for f in read if f"{path}/" in unquote(f)} == gone
    found = table(spark, path, schema)
    assert (1, "moved", "new") in found and [r for r in found if r[0] == 1] == [(1, "moved", "new")]
    assert sorted(r[1] for r in found if r[0] is None) == ["none", "two"]
    assert len(found) == 35 + 1 + 2


def test_merge_against_a_dict(spark, folder, schema):
    rng, path, state = random.Random(4), f"{folder}/t", {}
    for _ in range(5):
        batch = {rng.randrange(30): (f"v{rng.randrange(99)}", rng.choice(["1", "2", "003"])) for _ in range(8)}
        stored.merge_stored(spark.createDataFrame([(k, *v) for k, v in batch.items()], KIND), path, ["k"], ["p"])
        state |= batch
        found = stored.read_stored(spark, path, schema).select("k", "v", "p").collect()
        assert {r[0]: tuple(r[1:]) for r in found} == state and len(found) == len(state)


def test_merge_errors_and_new_columns(spark, path, schema):
    before = table(spark, path, schema)
    twice = spark.createDataFrame([(1, "a", "007"), (1, "b", "007")], KIND)
    with pytest.raises(DuplicateKeyError):
        stored.merge_stored(twice, path, ["k"], ["p"])
    assert table(spark, path, schema) == before
    wider = spark.createDataFrame([(2, "wide", "é:z", 5)], KIND + ", extra int")
    stored.merge_stored(wider, path, ["k"], ["p"])
    narrow = spark.createDataFrame([(2, "é:z")], "k int, p string")
    found = stored.read_stored(spark, path)
    assert rows(found.filter("extra = 5").select("k", "v")) == [(2, "wide")] and found.count() == len(before)
    stored.merge_stored(narrow, path, ["k"], ["p"])
    assert rows(stored.read_stored(spark, path).filter("k = 2").select("v", "extra")) == [(None, None)]


def test_merge_searches_only_folders_that_take_no_row(spark, folder, monkeypatch):
    path, searched = f"{folder}/t", []
    found = stored._folders_of

    def noted(files, depth):
        searched.append([f for f in files.inputFiles() if f"{path}/" in f])
        return found(files, depth)

    monkeypatch.setattr(stored, "_folders_of", noted)
    stored.merge_stored(spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (3, None, "old")], PLACED), path, ["k"], ["p"])
    # All folders take a row; the one with k = 1 moves from a to b, and k = 3 stays without a folder's name.
    stored.merge_stored(
        spark.createDataFrame([(1, "b", "new"), (3, None, "new"), (4, "a", "new")], PLACED), path, ["k"], ["p"]
    )
    assert searched == []
    merged = rows(stored.read_stored(spark, path).select("k", "p", "v"))
    assert merged == [(1, "b", "new"), (2, "b", "old"), (3, None, "new"), (4, "a", "new")]
    # Only b takes one: the others are searched, and k = 4 is found in a.
    done = stored.merge_stored(spark.createDataFrame([(4, "b", "newer")], PLACED), path, ["k"], ["p"])
    assert len(searched) == 1 and not any("p=b" in f for f in searched[0]) and any("p=a" in f for f in searched[0])
    assert done == {"n_rows": 1, "n_written": 3}
    merged = rows(stored.read_stored(spark, path).select("k", "p", "v"))
    assert merged == [(1, "b", "new"), (2, "b", "old"), (3, None, "new"), (4, "b", "newer")]


def test_merge_of_a_source_that_lies_by_partition(spark, folder, monkeypatch):
    """It is read where it lies, and left there."""
    path, kept = f"{folder}/t", f"{folder}/kept"
    monkeypatch.setattr(stored, "fresh_path", None)
    for batch in ([(1, "a", "old"), (2, "b", "old")], [(2, "c", "new"), (None, "a", "x")], []):
        source = spark.createDataFrame(batch, PLACED)
        source.write.mode("overwrite").partitionBy("p").parquet(kept)
        source = spark.read.schema(source.schema).parquet(kept).select("k", "p", "v")
        assert stored.merge_stored(source, path, ["k"], ["p"], stored_at=kept)["n_rows"] == len(batch)
        assert source.count() == len(batch)
    assert rows(stored.read_stored(spark, path).select("k", "p", "v")) == [(None, "a", "x"), (1, "a", "old"), (2, "c", "new")]


@pytest.mark.parametrize("nth", range(1, 8))
def test_an_error_at_any_rename_puts_the_old_rows_back(spark, path, schema, nth, monkeypatch):
    before, calls = table(spark, path, schema), []
    monkeypatch.setattr(swap, "RENAMES_AT_ONCE", 1)

    def broken(session, source, target):
        calls.append(source)
        if len(calls) == nth:
            raise OSError("no")
        move_path(session, source, target)

    monkeypatch.setattr(swap, "move_path", broken)
    with pytest.raises(OSError):
        stored.delete_stored(spark, path, ["p"], F.col("k") % 2 == 0, schema)
    assert table(spark, path, schema) == before
    assert [p.name for p in pathlib.Path(path).parent.iterdir()] == ["t"]


@pytest.mark.parametrize("nth", [1, 2, 3, 6, 7])
def test_the_next_writer_undoes_what_a_dead_one_left(spark, path, schema, nth, monkeypatch):
    """A process that dies runs no clean-up: neither the undoing nor the removal of its folders."""
    before, calls = table(spark, path, schema), []
    source = spark.createDataFrame([(1, "m", "new"), (2, "m", "é:z"), (3, "m", "other")], KIND)
    monkeypatch.setattr(swap, "RENAMES_AT_ONCE", 1)

    def dies(session, old, target):
        calls.append(old)
        if len(calls) >= nth:
            raise KeyboardInterrupt
        move_path(session, old, target)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(swap, "move_path", dies)
        patch.setattr(swap, "_undo", lambda *a: None)
        patch.setattr(swap, "remove_path", lambda *a: None)
        patch.setattr(stored, "remove_path", lambda *a: None)
        with pytest.raises(KeyboardInterrupt):
            stored.merge_stored(source, path, ["k"], ["p"])
    assert recover(spark, path) and not recover(spark, path)
    assert table(spark, path, schema) == before
    assert [p.name for p in pathlib.Path(path).parent.iterdir()] == ["t"]
    stored.merge_stored(source, path, ["k"], ["p"])
    assert [r for r in table(spark, path, schema) if r[1] == "m"] == [(1, "m", "new"), (2, "m", "é:z"), (3, "m", "other")]


def test_other_tables_folders_are_left_alone(spark, folder):
    base = pathlib.Path(folder)
    for name in (f".old-orders-x-0-{'a' * 32}", f".new-orders-x-{'a' * 32}", ".new-orders-short", "orders"):
        (base / name).mkdir()
    assert not recover(spark, f"{folder}/orders")
    assert len(list(base.iterdir())) == 4
    remove_path(spark, f"{folder}/orders")
