"""Writers: each can be run again for the same day with the same result, except the append."""

from tallyworks.sinks.checks import CheckFailed, Expect, repeated_keys, write_checked
from tallyworks.sinks.tables import (
    Buckets,
    append_rows,
    ensure_table,
    overwrite_table_partitions,
    replace_day,
    replace_table,
    stage,
    write_partitions,
    write_run,
)

__all__ = [
    "Buckets",
    "CheckFailed",
    "Expect",
    "append_rows",
    "ensure_table",
    "overwrite_table_partitions",
    "repeated_keys",
    "replace_day",
    "replace_table",
    "stage",
    "write_checked",
    "write_partitions",
    "write_run",
]
