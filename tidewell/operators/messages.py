"""The message protocol: RECORD, STATE, LOG, SYNC_SUMMARY, CATALOG and STREAMS rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .conform import records_json


def _message(df: DataFrame, kind: str, body: Column, name: str) -> DataFrame:
    """One line of JSON: its type and its payload, which is JSON text already."""
    text = F.concat(F.lit(f'{{"type":"{kind}","{name}":'), body, F.lit("}"))
    return df.select(F.lit(kind).alias("type"), text.alias("message"))


def emitted_at() -> Column:
    return F.unix_millis(F.current_timestamp())


def record_messages(df: DataFrame, stream: str, at: Column | None = None) -> DataFrame:
    """A RECORD message per row."""
    at = emitted_at() if at is None else at
    # The data is JSON text; it is put in place as it is instead of being quoted.
    head = F.to_json(F.struct(F.lit(stream).alias("stream")))
    body = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"data":'),
        records_json(df),
        F.lit(',"emitted_at":'),
        at.cast("string"),
        F.lit("}"),
    )
    return _message(df, "RECORD", body, "record")


def state_messages(state: DataFrame) -> DataFrame:
    """A STATE message per stream from rows of ``stream, cursor``."""
    body = F.to_json(
        F.struct(
            F.lit("STREAM").alias("type"),
            F.struct(
                F.struct(F.col("stream").alias("name")).alias("stream_descriptor"),
                F.struct("cursor").alias("stream_state"),
            ).alias("stream"),
        ),
        {"ignoreNullFields": "false"},
    )
    return _message(state, "STATE", body, "state")


def log_messages(df: DataFrame, level: str, text: Column) -> DataFrame:
    """A LOG message per row."""
    if level not in ("DEBUG", "INFO", "WARN", "ERROR"):
        raise ValueError(f"unknown log level: {level}")
    return _message(df, "LOG", F.to_json(F.struct(F.lit(level).alias("level"), text.alias("message"))), "log")


def summary_message(summary: DataFrame) -> DataFrame:
    """The SYNC_SUMMARY message of a one-row summary; it goes last."""
    return _message(summary, "SYNC_SUMMARY", records_json(summary), "summary")


def catalog_message(catalog: DataFrame) -> DataFrame:
    """The CATALOG message: one row per stream folded into one document."""
    entries = F.array_sort(F.collect_list(F.struct("name", records_json(catalog).alias("entry"))))
    folded = catalog.agg(F.concat_ws(",", F.transform(entries, lambda e: e["entry"])).alias("streams"))
    body = F.concat(F.lit('{"streams":['), F.col("streams"), F.lit("]}"))
    return _message(folded, "CATALOG", body, "catalog")


def streams_message(catalog: DataFrame, connector: str) -> DataFrame:
    """The STREAMS message: just the names."""
    names = F.to_json(F.array_sort(F.collect_list("name")))
    folded = catalog.agg(names.alias("streams"))
    head = F.to_json(F.struct(F.lit("STREAMS").alias("type"), F.lit(connector).alias("connector")))
    text = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"streams":'), F.col("streams"), F.lit("}"))
    return folded.select(F.lit("STREAMS").alias("type"), text.alias("message"))
