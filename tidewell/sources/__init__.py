"""Readers for files, tables and in-line rows."""

from tidewell.sources.files import (
    dated_path,
    read_csv_inferred,
    read_csv_positional,
    read_csv_strings,
    read_csv_with_date,
    read_json_lines,
    rejected_lines,
)
from tidewell.sources.tables import (
    ensure_table,
    inline_rows,
    read_named,
    read_path,
    row_position,
)

__all__ = [
    "dated_path",
    "ensure_table",
    "inline_rows",
    "read_csv_inferred",
    "read_csv_positional",
    "read_csv_strings",
    "read_csv_with_date",
    "read_json_lines",
    "read_named",
    "read_path",
    "rejected_lines",
    "row_position",
]
