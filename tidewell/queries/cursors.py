"""Incremental reads, cursors, latest rows and caps over the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.temporal import cursor_text, epoch_micros, normalise_cursor, parse_datetime
from ..operators.dedup import cap_per_group, latest_per_key, merge_latest, with_batches
from ..operators.incremental import (
    max_cursor,
    newer_than,
    newer_than_state,
    slice_cursors,
    sync_stats,
)
from ..sources.tables import keyset_page
from .common import Query, ntz, table


def incremental_orders(spark, folder):
    return newer_than(table(spark, folder, "orders"), "o_orderdate", "1998-01-01T00:00:00.000000Z")


def incremental_lookback(spark, folder):
    return newer_than(table(spark, folder, "events"), "ts", "2024-01-15T00:00:00.000000Z", lookback_seconds=3600)


def stream_stats(spark, folder):
    parts = [
        ("orders", "o_orderdate", "o_orderkey"),
        ("lineitem", "l_shipdate", "l_orderkey"),
        ("events", "ts", "event_id"),
    ]
    rows = [
        sync_stats(table(spark, folder, name), name, cursor, F.floor(F.col(key) / 500)) for name, cursor, key in parts
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def cursor_string_vs_typed(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.agg(
        max_cursor(orders, "o_orderkey").alias("typed_cursor"),
        max_cursor(orders, "o_orderkey", compare="string").alias("string_cursor"),
    )


def cursor_normalise(spark, folder):
    events = table(spark, folder, "events")
    micros = epoch_micros(F.col("ts"))
    text = cursor_text(F.col("ts"), "timestamp_ntz")
    return events.select(
        "event_id",
        text.alias("cursor"),
        normalise_cursor(F.floor(micros / 1_000_000).cast("string"), "unix").alias("from_unix"),
        normalise_cursor(F.floor(micros / 1_000).cast("string"), "unix_ms").alias("from_unix_ms"),
        normalise_cursor(text, "iso8601").alias("from_iso"),
    )


def datetime_parse(spark, folder):
    orders = table(spark, folder, "orders")
    day, style = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = (
        F.when(style == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(style == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(style == 2, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(style == 3, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(style == 4, F.date_format(day, "yyyy/MM/dd"))
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("!")))
    )
    return orders.select("o_orderkey", parse_datetime(text).alias("parsed"))


def keyset_batch(spark, folder):
    return keyset_page(table(spark, folder, "events"), "event_id", 250, 1000)


def max_records_per_stream(spark, folder):
    return cap_per_group(table(spark, folder, "events"), ["event_type"], ["ts", "event_id"], 100)


def dedup_latest(spark, folder):
    return latest_per_key(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])


def append_dedup_merge(spark, folder):
    orders = table(spark, folder, "orders")
    order = ["o_orderdate", "o_orderkey"]
    existing = latest_per_key(orders.filter(F.col("o_orderdate") <= ntz("1998-01-01")), ["o_custkey"], order)
    fresh = orders.filter(F.col("o_orderdate") > ntz("1997-06-01"))
    return merge_latest(existing, fresh, ["o_custkey"], order)


def per_partition_cursor(spark, folder):
    events = table(spark, folder, "events")
    earlier = events.filter((F.col("ts") <= ntz("2024-01-20")) & (F.col("event_type") != "error"))
    state = slice_cursors(earlier, ["event_type"], "ts").select("event_type", "cursor")
    return newer_than_state(events, state, ["event_type"], "ts")


def slice_cursor_update(spark, folder):
    return slice_cursors(table(spark, folder, "events"), ["event_type"], "ts")


def batch_numbers(spark, folder):
    events = table(spark, folder, "events").select("event_type", "event_id")
    return with_batches(events, ["event_type"], "event_id", batch_size=1000)


QUERIES = {
    "incremental_orders": Query(
        incremental_orders, "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'"
    ),
    "incremental_lookback": Query(
        incremental_lookback, "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15' - INTERVAL 3600 SECOND"
    ),
    "sync_stats": Query(
        stream_stats,
        """
        SELECT 'orders' AS stream, count(*) AS records, count(DISTINCT o_orderkey // 500) AS pages,
               strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S.%fZ') AS "cursor" FROM orders
        UNION ALL
        SELECT 'lineitem', count(*), count(DISTINCT l_orderkey // 500),
               strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%S.%fZ') FROM lineitem
        UNION ALL
        SELECT 'events', count(*), count(DISTINCT event_id // 500),
               strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') FROM events
        """,
    ),
    "cursor_string_vs_typed": Query(
        cursor_string_vs_typed,
        """
        SELECT CAST(max(o_orderkey) AS VARCHAR) AS typed_cursor,
               max(CAST(o_orderkey AS VARCHAR)) AS string_cursor FROM orders
        """,
    ),
    "cursor_normalise": Query(
        cursor_normalise,
        """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "cursor",
               CAST(date_trunc('second', ts) AS TIMESTAMP) AS from_unix,
               CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS from_unix_ms, ts AS from_iso
        FROM events
        """,
    ),
    "datetime_parse": Query(
        datetime_parse,
        """
        SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN NULL WHEN 1 THEN o_orderdate - INTERVAL 2 HOUR
                           ELSE o_orderdate END AS parsed FROM orders
        """,
    ),
    "keyset_page": Query(keyset_batch, "SELECT * FROM events WHERE event_id > 250 ORDER BY event_id LIMIT 1000"),
    "max_records_per_stream": Query(
        max_records_per_stream,
        "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 100",
    ),
    "dedup_latest": Query(
        dedup_latest,
        "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    ),
    "append_dedup_merge": Query(
        append_dedup_merge,
        """
        SELECT * FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
        """,
    ),
    "per_partition_cursor": Query(
        per_partition_cursor,
        """
        WITH state AS (SELECT event_type, max(ts) AS bound FROM events
                       WHERE ts <= TIMESTAMP '2024-01-20' AND event_type <> 'error' GROUP BY event_type)
        SELECT e.* FROM events e LEFT JOIN state s USING (event_type) WHERE s.bound IS NULL OR e.ts > s.bound
        """,
    ),
    "slice_cursors": Query(
        slice_cursor_update,
        """
        SELECT event_type, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS "cursor", count(*) AS records
        FROM events GROUP BY event_type
        """,
    ),
    "batch_numbers": Query(
        batch_numbers,
        """
        SELECT event_type, event_id,
               (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 1000 AS batch
        FROM events
        """,
    ),
}
