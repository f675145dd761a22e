"""Gives the executors' Python workers this package, where they do not have it installed."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import weakref
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

_SHIPPED: weakref.WeakSet = weakref.WeakSet()

#: Rows of whole texts that go to a worker at once, where the session does not say otherwise.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tidied() -> None:
    """Gives memory that a worker no longer uses back to the system; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def shipped(df: DataFrame) -> DataFrame:
    """`df` itself; its session's executors can import the package from then on.

    The archive is written on the driver and handed out by Spark. Batches are made small unless the
    session's are set: Spark's own size is meant for rows of numbers, not of whole texts.
    """
    context = df.sparkSession.sparkContext
    if df.sparkSession.conf.get(_BATCH) == "10000":
        df.sparkSession.conf.set(_BATCH, str(BATCH_ROWS))
    if context not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tidewell-package-")) / "tidewell_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context)
    return df
