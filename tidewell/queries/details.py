"""Smaller features, each over a whole table: single records, depth caps, queries with a cursor, order, times, states in parts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.conform import records_json
from ..operators.incremental import newer_than
from ..operators.messages import record_messages
from ..operators.schema import describe_fields, infer_paths, json_type
from ..operators.state import export_state, parse_state
from ..session import scratch_path
from ..sinks.tables import write_stream_table
from ..sources.tables import read_table
from ..specs import TableSpec
from .common import Query, table


def single_records(spark, folder):
    """Every event inferred on its own: all of its fields are required."""
    events = table(spark, folder, "events")
    records = events.select("event_id", records_json(events, "user_id", "event_type", "value").alias("record"))
    fields = describe_fields(infer_paths(records, by=("event_id",)), by=("event_id",))
    return fields.groupBy("path", "json_type", "required", "nullable").agg(F.count("*").alias("n"))


DEEP = 12


def depth_cap(spark, folder):
    """Records nested deeper than the cap: what lies below it is an object, and nothing is said of its fields."""
    nested = F.col("n_nationkey").cast("string")
    for level in reversed(range(DEEP)):
        nested = F.concat(F.lit(f'{{"l{level}":'), nested, F.lit("}"))
    paths = infer_paths(table(spark, folder, "nation").select(nested.alias("record")))
    return paths.filter("path <> ''").select("path", "n", json_type(F.col("types")).alias("json_type"))


def query_with_cursor(spark, folder):
    """A stream read by a query, which has conditions of its own, past a cursor."""
    table(spark, folder, "orders").createOrReplaceTempView("tidewell_orders")
    spec = TableSpec("orders", query="SELECT o_orderkey, o_custkey, o_orderstatus FROM tidewell_orders WHERE o_orderstatus <> 'F' OR o_custkey < 50")
    return newer_than(read_table(spark, spec, {}), "o_orderkey", "4000")


def sorted_slices(spark, folder):
    """A slice written in cursor order: in every file of it, no row stands behind a greater one."""
    base = scratch_path(spark, "sorted")
    events = table(spark, folder, "events").select("event_id", "user_id").repartition(6, "user_id")
    done = write_stream_table(events, base, "events", "run-1", "2024-02-01", fmt="json", cursor_field="event_id", sort=True)
    lines = spark.read.text(done["path"]).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), F.get_json_object("value", "$.event_id").cast("bigint").alias("id"))
    before = F.lag("id").over(Window.partitionBy("file").orderBy("at"))
    marked = lines.withColumn("behind", F.coalesce((before > F.col("id")).cast("bigint"), F.lit(0)))
    return marked.agg(F.count("*").alias("rows"), F.sum("behind").alias("behind"), F.min("id").alias("least"))


def emission_times(spark, folder):
    """RECORD messages carry the moment of their run in milliseconds: one for all, later than the data and not far off."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    at = F.get_json_object("message", "$.record.emitted_at").cast("bigint")
    said = record_messages(nations, "nation").select(F.get_json_object("message", "$.record.data.n_name").alias("n_name"), at.alias("at"))
    now = F.unix_millis(F.current_timestamp())
    return said.select("n_name", ((F.col("at") > 1_700_000_000_000) & (F.abs(now - F.col("at")) < 3_600_000)).alias("timely"))


def state_in_parts(spark, folder):
    """A state with many partitions, exported in documents of a few hundred and read back."""
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
    part = orders.select(F.lit("orders").alias("stream"), F.col("o_custkey").cast("string").alias("partition_id"), F.col("last").cast("string").alias("cursor"), (F.col("last") % 2 == 0).alias("completed"))
    whole = orders.select(F.lit("orders").alias("stream"), F.lit(None).cast("string").alias("partition_id"), F.col("last")).groupBy("stream", "partition_id").agg(F.max("last").cast("string").alias("cursor"))
    docs = export_state(part.unionByName(whole.withColumn("completed", F.lit(False))), per_doc=300)
    several = docs.agg((F.count("*") > 1).alias("several"))
    return parse_state(docs).join(F.broadcast(several))


QUERIES = {
    "infer_single_records": Query(
        single_records,
        """SELECT p.path, p.json_type, true AS required, false AS nullable, count(*) AS n FROM events,
           (SELECT unnest(['user_id', 'event_type', 'value']) AS path, unnest(['integer', 'string', 'number']) AS json_type) p GROUP BY ALL""",
    ),
    "infer_depth_cap": Query(
        depth_cap,
        """WITH l AS (SELECT unnest(range(11)) AS k) SELECT array_to_string([('l' || i) FOR i IN range(k + 1)], '.') AS path, (SELECT count(*) FROM nation) AS n, 'object' AS json_type FROM l""",
    ),
    "query_with_cursor": Query(
        query_with_cursor, "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE (o_orderstatus <> 'F' OR o_custkey < 50) AND o_orderkey > 4000"
    ),
    "sorted_slices": Query(sorted_slices, "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS behind, min(event_id) AS least FROM events"),
    "emission_times": Query(emission_times, "SELECT n_name, true AS timely FROM nation"),
    "state_in_parts": Query(
        state_in_parts,
        """WITH o AS (SELECT o_custkey, max(o_orderkey) AS last FROM orders GROUP BY 1)
           SELECT 'orders' AS stream, CAST(o_custkey AS VARCHAR) AS partition_id, CAST(last AS VARCHAR) AS "cursor", last % 2 = 0 AS completed, (SELECT count(*) FROM o) > 300 AS several FROM o
           UNION ALL SELECT 'orders', NULL, CAST(max(last) AS VARCHAR), false, (SELECT count(*) FROM o) > 300 FROM o""",
    ),
}
