"""The audit log of job steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.sources import ensure_table

# Column names and types of the log are fixed values.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_layer", T.StringType()),
        T.StructField("notebook_name", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
    ]
)


class AuditLog:
    """Appends events to a Parquet log; all events of one object share a run id."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.run_id = str(uuid.uuid4())
        ensure_table(spark, path, LOG_SCHEMA)

    def event(
        self, layer: str, step: str, kind: str, count: int, status: str, error: str | None = None
    ) -> None:
        values = [self.run_id, layer, step, kind, int(count), status, error]
        fields = LOG_SCHEMA.fields
        row = self.spark.range(1, numPartitions=1).select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields)],
            F.current_timestamp().alias(fields[-1].name),
        )
        row.write.mode("append").parquet(self.path)

    def step(self, layer: str, step: str, work: Callable[[], dict[str, int]]) -> dict[str, int]:
        """Run ``work`` between a START and an END event.

        ``work`` returns ``n_rows`` and perhaps ``n_rejected``, which gets an event
        of its own. An error is logged and raised again.
        """
        self.event(layer, step, "START", 0, "RUNNING")
        try:
            counts = work()
        except Exception as error:
            self.event(layer, step, "ERROR", 0, "FAILED", str(error))
            raise
        self.event(layer, step, "END", counts["n_rows"], "SUCCESS")
        if "n_rejected" in counts:
            self.event(layer, step, "REJECTED", counts["n_rejected"], "SUCCESS")
        return counts

    def read(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
