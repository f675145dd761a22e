"""Putting finished folders in the place of a table's, or of some of its partitions.

New content is written complete beside the table and then moved in. What it replaces is first moved
aside, into one folder whose last rename says that the exchange is done. So whatever fails, and
wherever a process dies, the table is as it was or as it was to be: an error puts back what was moved,
and the next writer (``recover``) does so for one that died.

One writer at a time. A reader that comes between two renames may find a partition missing; readers
that must not, read before or after.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tidewell.session import child_names, make_folder, move_path, path_exists, remove_path

RENAMES_AT_ONCE = 16
#: Entry of the old content for what was not there before.
_NOTHING = "_nothing"


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def staged_path(path: str) -> str:
    """A folder beside the table for content that is to be published; scans do not see it."""
    parent, name = _split(path)
    return f"{parent}/.new-{name}-{uuid.uuid4().hex}"


def _old_root(path: str, depth: int) -> str:
    parent, name = _split(path)
    return f"{parent}/.old-{name}-{depth}-{uuid.uuid4().hex}"


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partition folders of a table, ``depth`` names each, relative to it; [""] for depth 0."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}".lstrip("/") for f in found for n in child_names(spark, f"{path}/{f}") if "=" in n]
    return found


def _undo(spark: SparkSession, path: str, old: str, depth: int) -> None:
    """Put back what ``old`` holds."""
    if not path_exists(spark, f"{old}/t"):
        entries = []
    else:
        entries = partition_folders(spark, f"{old}/t", depth)
    for entry in entries:
        kept, place = f"{old}/t/{entry}".rstrip("/"), f"{path}/{entry}".rstrip("/")
        remove_path(spark, place)
        if child_names(spark, kept) != [_NOTHING]:
            move_path(spark, kept, place)
    remove_path(spark, old)


def recover(spark: SparkSession, path: str) -> bool:
    """Undo what a writer that died has left half-done; whether there was anything."""
    parent, name = _split(path)
    found = False
    for leftover in child_names(spark, parent):
        place = f"{parent}/{leftover}"
        kind, _, rest = leftover.partition(f"-{name}-")
        if kind == ".old" and rest.partition("-")[0].isdigit() and len(rest.partition("-")[2]) == 32:
            _undo(spark, path, place, int(rest.partition("-")[0]))
        elif not (kind in (".new", ".done") and len(rest) == 32):
            continue
        remove_path(spark, place)
        found = True
    return found


def publish(
    spark: SparkSession, staged: str, path: str, depth: int = 0, folders: Sequence[str] | None = None
) -> None:
    """Move ``staged`` in the place of the table at ``path``, or of its ``folders``.

    ``folders`` are partition folders, ``depth`` names each; one that ``staged`` lacks is taken away.
    """
    old = _old_root(path, depth)
    units = [""] if not depth else list(partition_folders(spark, staged, depth) if folders is None else folders)

    def exchange(unit: str) -> None:
        new, place, kept = (f"{root}/{unit}".rstrip("/") for root in (staged, path, f"{old}/t"))
        if path_exists(spark, place):
            make_folder(spark, _split(kept)[0])
            move_path(spark, place, kept)
        else:
            make_folder(spark, f"{kept}/{_NOTHING}")
        if path_exists(spark, new):
            make_folder(spark, _split(place)[0])
            move_path(spark, new, place)

    try:
        with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
            list(pool.map(exchange, units))
    except BaseException:
        _undo(spark, path, old, depth)
        remove_path(spark, staged)
        raise
    parent, name = _split(path)
    done = f"{parent}/.done-{name}-{uuid.uuid4().hex}"
    if units:
        move_path(spark, old, done)  # from here on the new content stands
    remove_path(spark, done)
    remove_path(spark, staged)
