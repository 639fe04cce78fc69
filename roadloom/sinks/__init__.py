"""Writers: Parquet snapshots, yearly partitions, JSON lines, appends, audits."""

from roadloom.sinks.writers import (  # noqa: F401
    append_table,
    audit_change,
    has_current,
    read_current,
    rows_of,
    write_envelope,
    write_bucketed_table,
    write_json_lines,
    write_snapshot,
    write_versioned,
    write_yearly,
)
