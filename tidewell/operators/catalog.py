"""Catalogs: what streams there are and what their records look like."""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import StreamSpec, TableSpec
from .schema import describe_fields, infer_paths, json_schema

CATALOG_SCHEMA = (
    "name string, json_schema string, supported_sync_modes array<string>, source_defined_cursor boolean, "
    "default_cursor_field array<string>, source_defined_primary_key array<array<string>>"
)


def sample(records: DataFrame, n: int, order: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The first ``n`` records in a given order, or the ``n`` whose contents have the least hashes; with ``by``, of each group.

    The pick depends on the records alone, not on how they are partitioned, and samples of parts merge: the least of
    the least. Every task keeps ``n`` rows of a group before anything is shuffled.
    """
    rest = [F.col(f"`{c}`") for c in records.columns if c not in by]
    first = [F.col(order)] if order else [F.xxhash64(*rest), *rest]
    if not by:
        return records.orderBy(*first).limit(n)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*first))
    return records.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def catalog_row(spec: StreamSpec | TableSpec, schema: dict[str, Any]) -> tuple:
    cursor = spec.cursor_field
    return (
        spec.name,
        json.dumps(schema, sort_keys=True),
        ["full_refresh", "incremental"],
        cursor is not None,
        [cursor] if cursor else None,
        [[k] for k in spec.primary_key],
    )


def discover(
    spark: SparkSession,
    streams: dict[StreamSpec, DataFrame] | list[tuple[StreamSpec, DataFrame]],
    sample_size: int | None = None,
) -> DataFrame:
    """A catalog of streams of JSON records, their schemas inferred from all records or a sample, all in one job."""
    pairs = list(streams.items() if isinstance(streams, dict) else streams)
    if not pairs:
        return spark.createDataFrame([], CATALOG_SCHEMA)
    told = [records.select(F.lit(number).alias("_stream"), "record") for number, (_, records) in enumerate(pairs)]
    records = reduce(DataFrame.unionByName, told)
    if sample_size:
        records = sample(records, sample_size, by=("_stream",))
    fields: dict[int, list[Any]] = {}
    # Only schemas come to the driver.
    for row in describe_fields(infer_paths(records, by=("_stream",)), by=("_stream",)).collect():
        fields.setdefault(row["_stream"], []).append(row)
    rows = [catalog_row(spec, json_schema(fields.get(number, []))) for number, (spec, _) in enumerate(pairs)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def table_json_schema(schema: T.StructType) -> dict[str, Any]:
    """The JSON Schema of typed columns."""

    def render(dtype: T.DataType) -> dict[str, Any]:
        if isinstance(dtype, T.StructType):
            return {"type": "object", "properties": {f.name: nullable(f) for f in dtype.fields}}
        if isinstance(dtype, T.ArrayType):
            return {"type": "array", "items": render(dtype.elementType)}
        if isinstance(dtype, T.BooleanType):
            return {"type": "boolean"}
        if isinstance(dtype, T.IntegralType):
            return {"type": "integer"}
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return {"type": "number"}
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return {"type": "string", "format": "date-time"}
        if isinstance(dtype, T.DateType):
            return {"type": "string", "format": "date"}
        return {"type": "string"}

    def nullable(f: T.StructField) -> dict[str, Any]:
        out = render(f.dataType)
        return {**out, "type": [out["type"], "null"]} if f.nullable else out

    return {
        "$schema": "http://json-schema.org/draft-07/schema#",
        "type": "object",
        "properties": {f.name: nullable(f) for f in schema.fields},
        "additionalProperties": True,
    }


def table_catalog(spark: SparkSession, tables: list[tuple[TableSpec, DataFrame]]) -> DataFrame:
    """A catalog of typed tables."""
    return spark.createDataFrame(
        [catalog_row(spec, table_json_schema(df.schema)) for spec, df in tables], CATALOG_SCHEMA
    )


def column_stats(df: DataFrame, stream: str) -> DataFrame:
    """Per column: values that are there, and whether any is missing; one scan, one aggregate."""
    counts = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    kinds = {f.name: table_json_schema(T.StructType([f]))["properties"][f.name]["type"] for f in df.schema.fields}
    single = {c: next(t for t in ([k] if isinstance(k, str) else k) if t != "null") for c, k in kinds.items()}
    folded = df.agg(F.count("*").alias("_rows"), *counts)
    entries = [
        F.struct(F.lit(c).alias("field"), F.lit(single[c]).alias("json_type"), F.col(f"`{c}`").alias("present"))
        for c in df.columns
    ]
    opened = folded.select("_rows", F.explode(F.array(*entries)).alias("_e"))
    return opened.select(
        F.lit(stream).alias("stream"),
        "_e.field",
        "_e.json_type",
        F.col("_rows").alias("records"),
        "_e.present",
        (F.col("_e.present") < F.col("_rows")).alias("nullable"),
    )
