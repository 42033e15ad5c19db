"""Slices of work: lists, parent keys, date ranges, and what is already done.

A partition is a row of ``stream, partition_id, values``, the values being a
map of parameter names to text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import Duration, java_pattern, parse_datetime, parse_duration


def _rows(df: DataFrame, stream: str, identity: Column, values: dict[str, Column]) -> DataFrame:
    pairs = [c for name, value in values.items() for c in (F.lit(name), value)]
    return df.select(
        F.lit(stream).alias("stream"), identity.alias("partition_id"), F.create_map(*pairs).alias("values")
    )


def list_partitions(spark: SparkSession, stream: str, field: str, values: list[str]) -> DataFrame:
    """One partition per listed value."""
    listed = spark.createDataFrame([(v,) for v in values], "value string")
    return _rows(listed, stream, F.col("value"), {field: F.col("value")})


def parent_keys(parent: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a parent stream as text; other than text and numbers are left out."""
    dtype = parent.select(key).schema[0].dataType
    if not isinstance(dtype, (T.StringType, T.NumericType)):
        raise ValueError(f"a parent key is text or a number, not {dtype.simpleString()}")
    return parent.select(F.col(key).cast("string").alias("key")).filter("key IS NOT NULL").distinct()


def parent_partitions(parent: DataFrame, stream: str, key: str, field: str) -> DataFrame:
    """One partition per distinct key of a parent stream."""
    return _rows(parent_keys(parent, key), stream, F.col("key"), {field: F.col("key")})


def children_of(children: DataFrame, parent: DataFrame, child_field: str, key: str) -> DataFrame:
    """The child rows that have a parent."""
    keys = parent.select(F.col(key).alias("_key")).distinct()
    return children.join(keys, F.col(child_field) == F.col("_key"), "left_semi")


def datetime_partitions(
    spark: SparkSession,
    stream: str,
    start: str | Column,
    end: str | Column,
    step: str,
    fmt: str = "%Y-%m-%dT%H:%M:%SZ",
    start_param: str = "start",
    end_param: str = "end",
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Half-open slices that tile ``[start, end)``; the last one ends at ``end``.

    ``start`` and ``end`` are texts, or columns of the one-row frame ``bounds``.
    """
    base = bounds if bounds is not None else spark.range(1)

    def moment(value: str | Column) -> Column:
        if isinstance(value, str) and value == "now":
            return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
        return parse_datetime(F.lit(value)) if isinstance(value, str) else value.cast("timestamp_ntz")

    length = parse_duration(step)
    cut = base.select(moment(start).alias("_start"), moment(end).alias("_end")).filter("_start < _end")
    last = F.col("_end") - F.expr("INTERVAL '0.000001' SECOND")  # a sequence includes its end
    # The bounds are tested again: a filter alone does not keep a sequence from being built backwards.
    starts = F.when(F.col("_start") < F.col("_end"), F.sequence("_start", last, F.expr(length.sql())))
    slices = cut.select("_end", "_start", F.posexplode(starts).alias("n", "slice_start"))
    # Months are counted from the start, so that a step from the 31st does not drift.
    following = F.expr(f"_start + (n + 1) * {length.sql()}")
    slices = slices.withColumn("slice_end", F.least(following, "_end"))
    pattern = java_pattern(fmt)
    first, end_text = F.date_format("slice_start", pattern), F.date_format("slice_end", pattern)
    identity = F.concat(F.col("n").cast("string"), F.lit("_"), first)
    values = {start_param: first, end_param: end_text, "partition_start": first, "partition_end": end_text}
    pairs = [c for name, value in values.items() for c in (F.lit(name), value)]
    return slices.select(
        F.lit(stream).alias("stream"),
        identity.alias("partition_id"),
        F.map_from_arrays(F.array(*pairs[0::2]), F.array(*pairs[1::2])).alias("values"),
        "n",
        "slice_start",
        "slice_end",
    )


def slice_number(moment: Column, start: Column, step: str) -> Column:
    """The ordinal of the slice a moment falls into: arithmetic instead of a range join."""
    length: Duration = parse_duration(step)
    if length.months:
        return F.floor(F.timestamp_diff("MONTH", start, moment) / length.months)
    micros = F.timestamp_diff("MICROSECOND", start, moment)
    return F.floor(micros / F.lit(length.seconds * 1_000_000))


def pending(partitions: DataFrame, state: DataFrame) -> DataFrame:
    """The partitions that are not marked completed."""
    done = state.filter("completed").select("stream", "partition_id").distinct()
    return partitions.join(done, ["stream", "partition_id"], "left_anti")


def partition_outcomes(partitions: DataFrame, results: DataFrame) -> DataFrame:
    """Per partition: completed, failed or skipped, with records and errors.

    ``results`` has ``stream, partition_id, records, errors``; a partition without
    a result was not run.
    """
    joined = partitions.select("stream", "partition_id").join(results, ["stream", "partition_id"], "left")
    status = (
        F.when(F.col("records").isNull(), "skipped").when(F.col("errors") > 0, "failed").otherwise("completed")
    )
    return joined.select(
        "stream",
        "partition_id",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("errors", F.lit(0)).alias("errors"),
        status.alias("status"),
    )
