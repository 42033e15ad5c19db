"""Small text helpers: link headers and stream names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def link_url(header: Column, rel: str = "next") -> Column:
    """The URL a Link header gives for ``rel``; NULL when it has none."""
    pattern = r"<([^>]*)>[^,]*;\s*rel=[\"']?" + re.escape(rel) + r"[\"']?\s*(?:[;,]|$)"
    return F.nullif(F.regexp_extract(header, pattern, 1), F.lit(""))


def sanitise_name(name: Column) -> Column:
    """A stream name that is safe as a folder name."""
    return F.replace(name, F.lit("."), F.lit("_"))
