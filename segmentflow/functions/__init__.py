from segmentflow.functions.columns import (  # noqa: F401
    any_null,
    batch_stamp,
    changed_non_null,
    epoch_to_date,
    export_file_name,
    keep_old_if_null,
    null_count,
    path_part,
    sorted_distinct,
)
