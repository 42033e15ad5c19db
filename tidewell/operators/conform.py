"""Records to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import cursor_text


def conform(df: DataFrame, schema: T.StructType, column: str = "record") -> DataFrame:
    """JSON text to the columns of ``schema``.

    Fields the schema lacks are dropped, absent ones are NULL, values of another
    type are NULL, and string columns take any value as JSON text.
    """
    rest = [c for c in df.columns if c != column]
    typed = F.from_json(column, schema, {"mode": "PERMISSIVE"})
    return df.select(*rest, typed.alias("_row")).select(*rest, "_row.*")


def records_json(df: DataFrame, *columns: str) -> Column:
    """Each row as one JSON object; NULL values are kept."""
    names = columns or tuple(df.columns)
    fields = [json_value(df, name).alias(name) for name in names]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def json_value(df: DataFrame, name: str) -> Column:
    """A column the way it is written into JSON."""
    dtype, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(dtype, T.BinaryType):
        return base64_text(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return cursor_text(value, dtype.typeName())
    if isinstance(dtype, T.DecimalType):
        return value.cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
        return F.when(~bad, value)
    return value


def base64_text(value: Column) -> Column:
    """Bytes as base64 without line breaks."""
    return F.translate(F.base64(value), "\r\n", "")


def to_records(df: DataFrame, *keep: str) -> DataFrame:
    """The rows as JSON text in ``record``, next to the columns in ``keep``."""
    body = [c for c in df.columns if c not in keep]
    return df.select(*keep, records_json(df, *body).alias("record"))


def union_streams(*frames: DataFrame) -> DataFrame:
    """All rows of frames with different columns; columns whose types differ become text."""
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for f in frame.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())

    def aligned(frame: DataFrame) -> DataFrame:
        return frame.select(*[_widen(frame, name, kinds[name]) for name in frame.columns])

    out = aligned(frames[0])
    for frame in frames[1:]:
        out = out.unionByName(aligned(frame), allowMissingColumns=True)
    return out


# The column types that count as integers and as numbers.
_INTEGERS = {"tinyint", "smallint", "int", "bigint"}
_NUMBERS = _INTEGERS | {"float", "double"}


def _widen(frame: DataFrame, name: str, kinds: set[str]) -> Column:
    col, dtype = F.col(f"`{name}`"), frame.schema[name].dataType
    kinds = kinds - {"void"}
    if len(kinds) <= 1:
        return col
    if kinds <= _INTEGERS:
        return col.cast("bigint").alias(name)
    if kinds <= _NUMBERS:
        return col.cast("double").alias(name)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col).alias(name)
    return col.cast("string").alias(name)
