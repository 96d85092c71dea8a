from segmentflow.sources.files import (  # noqa: F401
    CONTACT_COLUMNS,
    FEED_SCHEMA,
    add_feed,
    aligned,
    grown_schema,
    load_fixture,
    read_csv,
    read_parquet_table,
    read_table,
    read_lines,
    remove_feed,
    stream_csv,
    stream_csv_inferred,
    stream_json,
    stream_lines,
    stream_parquet,
    stream_table,
    with_file_metadata,
)
from segmentflow.sources.tables import DEFAULT_SEGMENTS, inline_values, local_rows  # noqa: F401
