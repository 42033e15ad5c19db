from .decode import decode_pages, decode_typed, page_values
from .pages import read_pages, stream_pages, route_pages
from .tables import keyset_page, list_tables, read_table

__all__ = [
    "decode_pages",
    "decode_typed",
    "keyset_page",
    "list_tables",
    "page_values",
    "read_pages",
    "read_table",
    "route_pages",
    "stream_pages",
]
