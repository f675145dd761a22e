"""Writers for files and catalog tables."""

from tidewell.sinks.catalog import (
    current_namespace,
    drop_table,
    ensure_database,
    ensure_named_table,
    list_partitions,
    register_folder,
    save_managed,
    use_database,
)
from tidewell.sinks.files import (
    append,
    counted,
    overwrite,
    overwrite_partitioned,
    read_split,
    replace_folder,
    write_csv,
    write_if_any,
    write_json_records,
    write_split,
)
from tidewell.sinks.swap import publish, recover, staged_path

__all__ = [
    "append",
    "counted",
    "current_namespace",
    "drop_table",
    "ensure_database",
    "ensure_named_table",
    "list_partitions",
    "overwrite",
    "overwrite_partitioned",
    "publish",
    "read_split",
    "recover",
    "register_folder",
    "replace_folder",
    "save_managed",
    "staged_path",
    "use_database",
    "write_csv",
    "write_if_any",
    "write_json_records",
    "write_split",
]
