"""Append-only stream tables."""

from tidewell.streaming.ingest import (
    ExpectationMeter,
    expect_or_drop,
    read_stream_table,
    run_available,
    run_batches,
)

__all__ = ["ExpectationMeter", "expect_or_drop", "read_stream_table", "run_available", "run_batches"]
