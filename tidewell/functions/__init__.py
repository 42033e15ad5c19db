from .coerce import csv_value_json, xml_text_type
from .paths import extract_elements, path_string, path_variant, parse_path
from .temporal import (
    cursor_text,
    epoch_micros,
    normalise_cursor,
    parse_datetime,
    parse_duration,
    java_pattern,
)
from .text import link_url, sanitise_name

__all__ = [
    "csv_value_json",
    "cursor_text",
    "epoch_micros",
    "extract_elements",
    "java_pattern",
    "link_url",
    "normalise_cursor",
    "parse_datetime",
    "parse_duration",
    "parse_path",
    "path_string",
    "path_variant",
    "sanitise_name",
    "xml_text_type",
]
