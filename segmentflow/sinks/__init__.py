from segmentflow.sinks.export import export_segments  # noqa: F401
from segmentflow.sinks.tables import (  # noqa: F401
    add_missing_columns,
    append_available_now,
    append_growing,
    append_path_available_now,
    create_if_missing,
    drop_tables,
    insert_by_name,
    overwrite_table,
    preview,
    read_additive,
    replace_partitions,
    stream_into_growing,
)
