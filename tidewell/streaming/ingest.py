"""Streaming reads and writes of Parquet tables."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewell.operators.changes import is_true

EXPECTATION = "expectation"


def read_stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files: str | None = None,
    max_files_per_batch: int = 20_000,
) -> DataFrame:
    """Rows appended to a Parquet folder, each once. ``files`` is a name pattern.

    A large backlog is taken in several batches, so that a failure costs one
    batch and not the whole run.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_batch)
    if files:
        reader = reader.option("pathGlobFilter", files)
    return reader.parquet(path)


def expect_or_drop(stream: DataFrame, rule: Column) -> DataFrame:
    """Drop rows for which ``rule`` is not TRUE and count them per batch (see ``ExpectationMeter``)."""
    kept = is_true(rule)
    return stream.observe(
        EXPECTATION,
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(~kept).alias("n_dropped"),
    ).filter(rule)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived since the last run, then stop.

    The checkpoint remembers what has been read: a rerun, also after a failure,
    adds no row twice.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand what has arrived since the last run to ``take``, batch by batch with its number, then stop.

    After a failure the last batch comes again under its number, so ``take`` can tell what it has done.
    """
    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


class ExpectationMeter(StreamingQueryListener):
    """Adds up the rows seen and dropped by ``expect_or_drop`` over all batches of a run.

    Register it with ``spark.streams.addListener`` before the query starts.
    (The query itself remembers only its last batches' metrics.)
    """

    def __init__(self) -> None:
        self._batches: dict[str, dict[int, tuple[int, int]]] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def counts(self, query: StreamingQuery, timeout: float = 60) -> dict[str, int | None]:
        """``n_in`` and ``n_dropped`` of a finished run; waits for its last report to come in.

        Both are None where it does not: the rows are written by then, and a part
        of the count would be wrong.
        """
        run = str(query.runId)
        with self._change:
            if not self._change.wait_for(lambda: run in self._ended, timeout):
                return {"n_in": None, "n_dropped": None}
            batches = list(self._batches.get(run, {}).values())
        return {
            "n_in": sum(seen for seen, _ in batches),
            "n_dropped": sum(lost for _, lost in batches),
        }

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = progress.observedMetrics.get(EXPECTATION)
        if metrics is not None:
            with self._change:
                run = self._batches.setdefault(str(progress.runId), {})
                run[progress.batchId] = (metrics["n_in"], metrics["n_dropped"])

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass
