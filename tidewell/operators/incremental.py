"""Cursors: which rows are new, and where the next run starts."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import cursor_text


def cursor_literal(df: DataFrame, field: str, value: Any, lookback_seconds: int = 0) -> Column:
    """A stored cursor as a literal of the column's type, moved back by the lookback window."""
    dtype = df.select(field).schema[0].dataType
    if isinstance(value, str) and isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        value = value.removesuffix("Z")
    bound = F.lit(value).cast(dtype)
    if lookback_seconds:
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return bound - F.make_dt_interval(secs=F.lit(lookback_seconds))
        if isinstance(dtype, T.NumericType):
            return bound - lookback_seconds
        raise ValueError(f"no lookback on a cursor of type {dtype.simpleString()}")
    return bound


def newer_than(df: DataFrame, field: str, cursor: Any, lookback_seconds: int = 0) -> DataFrame:
    """Rows past the cursor; all rows when there is none. The filter reaches the scan."""
    if cursor is None or cursor == "":
        return df
    return df.filter(F.col(field) > cursor_literal(df, field, cursor, lookback_seconds))


def newer_than_state(
    df: DataFrame, state: DataFrame, keys: list[str], field: str, lookback_seconds: int = 0
) -> DataFrame:
    """Rows past the cursor of their own slice; slices without state keep all rows.

    ``state`` holds one row per key with ``cursor`` as text. How the two are joined
    is left to the optimizer, which knows the size of the state.
    """
    dtype = df.select(field).schema[0].dataType
    text = F.col("cursor")
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        text = F.regexp_replace(text, "Z$", "")
    bound = text.cast(dtype)
    if lookback_seconds:
        bound = bound - (lookback_seconds if isinstance(dtype, T.NumericType) else F.make_dt_interval(secs=F.lit(lookback_seconds)))
    bounds = state.select(*keys, bound.alias("_bound"))
    joined = df.join(bounds, keys, "left")
    return joined.filter(F.col("_bound").isNull() | (F.col(field) > F.col("_bound"))).select(*df.columns)


def max_cursor(df: DataFrame, field: str, compare: str = "typed", floor: Any = None) -> Column:
    """The aggregate that gives the new cursor as text.

    ``string`` compares the text forms, under which ``9`` is past ``10``. ``floor``
    is the old cursor, below which the new one never falls.
    """
    dtype = df.select(field).schema[0].dataType.typeName()
    if compare == "string":
        return F.max(cursor_text(F.col(field), dtype))
    best = F.max(field)
    if floor is not None:
        best = F.greatest(best, cursor_literal(df, field, floor))
    return cursor_text(best, dtype)


def sync_stats(df: DataFrame, stream: str, field: str | None = None, page: Column | str | None = None) -> DataFrame:
    """One row: records, pages and new cursor of a stream."""
    cursor = max_cursor(df, field) if field else F.lit(None).cast("string")
    pages = F.count_distinct(page) if page is not None else F.lit(0).cast("bigint")
    return df.agg(F.count("*").alias("records"), pages.alias("pages"), cursor.alias("cursor")).select(
        F.lit(stream).alias("stream"), "records", "pages", "cursor"
    )


def greatest_cursors(cursors: DataFrame, keys: list[str], rows: DataFrame, field: str) -> DataFrame:
    """The greatest ``cursor`` of each key among cursors as text, compared as values of the column ``field`` of ``rows``."""
    dtype = rows.select(field).schema[0].dataType
    text = F.col("cursor")
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        text = F.regexp_replace(text, "Z$", "")
    return cursors.filter("cursor IS NOT NULL").groupBy(*keys).agg(F.max_by("cursor", text.cast(dtype)).alias("cursor"))


def slice_cursors(df: DataFrame, keys: list[str], field: str) -> DataFrame:
    """The new cursor of every slice, as state rows need it."""
    return df.groupBy(*keys).agg(max_cursor(df, field).alias("cursor"), F.count("*").alias("records"))
