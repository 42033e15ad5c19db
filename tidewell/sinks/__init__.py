from .tables import (
    append_dedup,
    read_stream_table,
    resolve_uri,
    stream_path,
    transform_column,
    write_iceberg,
    write_stream_table,
    write_transformed,
)

__all__ = [
    "append_dedup",
    "read_stream_table",
    "resolve_uri",
    "stream_path",
    "transform_column",
    "write_iceberg",
    "write_stream_table",
    "write_transformed",
]
