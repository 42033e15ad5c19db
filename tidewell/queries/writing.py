"""Syncs that write tables in the shared folder and read them back, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.state import empty_state, read_state, upsert_state
from ..plans.sync import sync_landed, sync_table
from ..session import scratch_path
from ..sinks.tables import append_dedup, read_merged, read_stream_table, transform_column, write_stream_table, write_transformed
from ..specs import Paging, Stop, StreamSpec, SyncSpec, TableSpec
from ..streaming.landed import drop_repeats, stream_sync
from .common import PER_PAGE, Query, envelope, ntz, packed, table


def two_runs(spark, folder):
    """A full run up to a day, then an incremental run from the state it left."""
    orders = table(spark, folder, "orders")
    base, spec = scratch_path(spark, "two-runs"), TableSpec("shop.orders", cursor_field="o_orderdate")
    first = sync_table(
        orders.filter(F.col("o_orderdate") <= ntz("1998-01-01")), spec, empty_state(spark), base, "run-1", run_date="2024-01-01"
    )
    sync_table(orders, spec, first.state, base, "run-2", run_date="2024-01-02")
    return read_stream_table(spark, base, "shop.orders").withColumn("dt", F.col("dt").cast("string"))


def repeated_run(spark, folder):
    """The same run twice: its slice is overwritten, not doubled."""
    base = scratch_path(spark, "repeated")
    events = table(spark, folder, "events")
    for _ in range(2):
        done = write_stream_table(events, base, "events", "run-1", "2024-01-01", cursor_field="event_id", compression="zstd")
    rows = read_stream_table(spark, base, "events")
    return rows.groupBy("event_type").agg(F.count("*").alias("records")).withColumn("cursor", F.lit(done["cursor"]))


def landed_sync(spark, folder):
    """Pages of orders to a typed, merged table of the latest order per customer."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    pages = envelope(packed(rows, "orders", "o_orderkey")).withColumns({"status": F.lit(200), "headers": F.create_map().cast("map<string,string>")})
    spec = StreamSpec(
        "orders", "json", "data", Paging("offset", Stop("empty_page"), limit=PER_PAGE), ("o_custkey",), "o_orderkey"
    )
    base = scratch_path(spark, "landed")
    sync_landed(pages, spec, empty_state(spark), base, "run-1", SyncSpec(write_mode="append_dedup", buckets=16))
    return read_merged(spark, base, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "day")


def merged_table(spark, folder):
    """Two batches of events merged into a bucketed table of the latest event per user."""
    events = table(spark, folder, "events")
    base, order = scratch_path(spark, "merged"), ["ts", "event_id"]
    early = F.col("ts") <= ntz("2024-01-20")
    append_dedup(events.filter(early), base, "events", ["user_id"], order, buckets=16)
    # Late rows among the new ones must not win over what is there.
    late = events.filter(~early | (F.col("ts") <= ntz("2024-01-05")))
    return append_dedup(late, base, "events", ["user_id"], order, buckets=16).drop("bucket")


def partition_transforms(spark, folder):
    orders = table(spark, folder, "orders")
    wanted = [
        ("years", "o_orderdate", "year"),
        ("months", "o_orderdate", "month"),
        ("days", "o_orderdate", "day"),
        ("hours", "o_orderdate", "hour"),
        ("head", "o_orderpriority", "truncate[3]"),
        ("tens", "o_custkey", "truncate[10]"),
        ("same", "o_orderstatus", "identity"),
    ]
    return orders.select("o_orderkey", *[transform_column(orders, c, t).alias(n) for n, c, t in wanted])


def transformed_table(spark, folder):
    base = scratch_path(spark, "transformed")
    orders = table(spark, folder, "orders")
    write_transformed(orders, base, "orders", {"o_orderdate": "year", "o_orderstatus": "identity"})
    rows = spark.read.parquet(f"{base}/orders")
    return rows.groupBy(F.col("o_orderdate_year").alias("years"), F.col("o_orderstatus_identity").alias("status")).agg(F.count("*").alias("n"))


def _murmur_sql(name, key):
    """DuckDB tables that hash a whole number of at most 63 bits, step by step."""

    def times(x, c):
        return f"(({x}) * {c}::UBIGINT) % 4294967296"

    def turned(x, r):
        return f"((({x}) << {r}) | (({x}) >> {32 - r})) & 4294967295"

    steps = [f"{name}0 AS (SELECT *, 0::UBIGINT AS h, (({key}) % 4294967296)::UBIGINT AS w1, (({key}) // 4294967296)::UBIGINT AS w2 FROM {name})"]
    at = 0

    def then(expression, column="h"):
        nonlocal at
        steps.append(f"{name}{at + 1} AS (SELECT * REPLACE (({expression})::UBIGINT AS {column}) FROM {name}{at})")
        at += 1

    for word in ("w1", "w2"):
        then(times(word, 0xCC9E2D51), word)
        then(turned(word, 15), word)
        then(times(word, 0x1B873593), word)
        then(f"xor(h, {word})")
        then(turned("h", 13))
        then("(h * 5 + 3864292196) % 4294967296")
    then("xor(h, 8::UBIGINT)")
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        then(f"xor(h, h >> {shift})")
        then(times("h", factor))
    then("xor(h, h >> 16)")
    return ", ".join(steps), f"{name}{at}"


_HASHED, _HASHED_LAST = _murmur_sql("o", "o_custkey")


def bucket_sizes(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.groupBy(transform_column(orders, "o_custkey", "bucket[16]").alias("bucket")).agg(F.count("*").alias("n"))


def _event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def streamed_sync(spark, folder):
    """Events as an available-now stream, written per batch, with the state published last."""
    base = scratch_path(spark, "streamed")
    stream_sync(
        _event_stream(spark, folder),
        "events",
        f"{base}/out",
        f"{base}/checkpoint",
        "2024-01-31",
        transform=lambda rows: rows.filter("event_type <> 'error'"),
        cursor_field="event_id",
        state_folder=f"{base}/state",
    )
    state = read_state(spark, f"{base}/state/events").select(F.col("stream"), F.col("cursor").cast("bigint").alias("state_cursor"))
    rows = read_stream_table(spark, f"{base}/out", "events").withColumn("stream", F.lit("events"))
    return rows.join(state, "stream").select("event_id", "user_id", "event_type", "value", "state_cursor")


def streamed_merge(spark, folder):
    base = scratch_path(spark, "streamed-merge")
    stream_sync(
        _event_stream(spark, folder), "events", f"{base}/out", f"{base}/checkpoint", "2024-01-31", keys=["user_id"], order=["ts", "event_id"]
    )
    return read_merged(spark, f"{base}/out", "events").drop("bucket")


def streamed_repeats(spark, folder):
    """Every event arrives twice; repeats within the lookback window are dropped."""
    base = scratch_path(spark, "streamed-repeats")
    events = _event_stream(spark, folder).withColumn("at", F.col("ts").cast("timestamp"))
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    stream_sync(drop_repeats(twice, ["event_id"], "at", 3600), "events", f"{base}/out", f"{base}/checkpoint", "2024-01-31")
    return read_stream_table(spark, f"{base}/out", "events").select("event_id", "user_id", "event_type", "value")


def completed_state(spark, folder):
    """State after a landed sync: every complete chain is marked and has its cursor, as has the stream."""
    rows = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    pages = envelope(packed(rows, "events", "event_id")).withColumns({"status": F.lit(200), "headers": F.create_map().cast("map<string,string>")})
    spec = StreamSpec("events", "json", "data", Paging("none"), cursor_field="event_id")
    base = scratch_path(spark, "completed")
    done = sync_landed(pages, spec, empty_state(spark), base, "run-1")
    return upsert_state(done.state, empty_state(spark)).select(
        "stream", F.coalesce("partition_id", F.lit("-")).alias("partition_id"), "cursor", "completed"
    )


QUERIES = {
    "sync_two_runs": Query(
        two_runs,
        """
        SELECT *, CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01' THEN '2024-01-01' ELSE '2024-01-02' END AS dt,
               CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01' THEN 'run-1' ELSE 'run-2' END AS run_id
        FROM orders
        """,
    ),
    "sync_repeated_run": Query(
        repeated_run,
        """
        SELECT event_type, count(*) AS records, (SELECT CAST(max(event_id) AS VARCHAR) FROM events) AS "cursor"
        FROM events GROUP BY event_type
        """,
    ),
    "sync_landed_pages": Query(
        landed_sync,
        """
        SELECT o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
        """,
    ),
    "sync_completed_state": Query(
        completed_state,
        """
        SELECT 'events' AS stream, 'p' || (event_id // 20000) AS partition_id, CAST(max(event_id) AS VARCHAR) AS "cursor", true AS completed
        FROM events WHERE (event_id // 500) % 40 = 0 GROUP BY ALL
        UNION ALL
        SELECT 'events', '-', CAST(max(event_id) AS VARCHAR), false FROM events WHERE (event_id // 500) % 40 = 0
        """,
    ),
    "append_dedup_table": Query(
        merged_table,
        "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    ),
    "partition_transforms": Query(
        partition_transforms,
        """
        SELECT o_orderkey, CAST(year(o_orderdate) - 1970 AS INTEGER) AS years,
               CAST((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 AS INTEGER) AS months,
               CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
               CAST(epoch(o_orderdate) // 3600 AS INTEGER) AS hours, o_orderpriority[1:3] AS head,
               o_custkey - o_custkey % 10 AS tens, o_orderstatus AS same
        FROM orders
        """,
    ),
    "transformed_table": Query(
        transformed_table,
        """
        SELECT CAST(year(o_orderdate) - 1970 AS INTEGER) AS years, o_orderstatus AS status, count(*) AS n
        FROM orders GROUP BY ALL
        """,
    ),
    "bucket_sizes": Query(
        bucket_sizes,
        f"WITH o AS (SELECT o_custkey FROM orders), {_HASHED} SELECT CAST((h & 2147483647) % 16 AS INTEGER) AS bucket, count(*) AS n FROM {_HASHED_LAST} GROUP BY 1",
    ),
    "stream_sync_events": Query(
        streamed_sync,
        """
        SELECT event_id, user_id, event_type, value, (SELECT max(event_id) FROM events WHERE event_type <> 'error') AS state_cursor
        FROM events WHERE event_type <> 'error'
        """,
    ),
    "stream_merge_events": Query(
        streamed_merge,
        "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    ),
    "stream_drop_repeats": Query(streamed_repeats, "SELECT event_id, user_id, event_type, value FROM events"),
}
