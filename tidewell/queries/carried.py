"""Streams of landed pages, samples and cuts that do not depend on partitioning, and compaction by tiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.catalog import sample
from ..operators.state import read_state
from ..session import matching_paths, scratch_path, staged
from ..sinks.tables import append_dedup, compact, read_merged, read_stream_table, stream_path
from ..sources.pages import stream_pages
from ..sources.tables import partition_predicates, quantile_cuts
from ..specs import StreamSpec
from ..streaming.landed import stream_landed
from .common import Query, table
from .landing import CHAINS, MORE, event_chains

FILES = 4
PAGES_IN_FILE = 20_000


def streamed_pages(spark, folder):
    """Pages spread over files in no order, some landed twice, one file to a batch: chains go on from batch to batch.

    What would be a file of very many pages lands as several, which make up the batch together.
    """
    base = scratch_path(spark, "streamed-pages")
    pages = event_chains(spark, folder).withColumn("url", F.lit(None).cast("string"))
    file = F.pmod(F.xxhash64("partition_id", "page_no"), F.lit(FILES)).cast("int")
    twice = pages.filter("page_no % 3 = 1").withColumn("_file", (file + 1) % FILES)
    spread = staged(pages.withColumn("_file", file).unionByName(twice), "spread")
    pieces = 1 + spread.count() // (FILES * PAGES_IN_FILE)
    for number in range(FILES):
        spread.filter(F.col("_file") == number).drop("_file").repartition(pieces).write.mode("append").parquet(f"{base}/landing")
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    stream_landed(stream_pages(spark, f"{base}/landing", max_files=pieces), spec, f"{base}/out", f"{base}/checkpoint", f"{base}/state", "2024-02-01")
    state = read_state(spark, f"{base}/state/events").filter("completed")
    told = state.agg(F.count("*").alias("completed"), F.max(F.col("cursor").cast("bigint")).alias("cursor"))
    versions = F.lit(len(matching_paths(spark, f"{base}/checkpoint/commits/[0-9]*")))
    rows = read_stream_table(spark, f"{base}/out", "events").select("event_id", "user_id", "event_type")
    return rows.join(F.broadcast(told)).withColumn("batches", versions)


def stable_samples(spark, folder):
    """Samples of the same records, partitioned in three ways, and merged from samples of parts: how many rows agree."""
    events, n = table(spark, folder, "events").select("event_id", "event_type", "value"), 20
    by = ("event_type",)
    parts = [sample(events.filter(F.pmod("event_id", F.lit(3)) == k), n, by=by) for k in range(3)]
    picks = [
        sample(events, n, by=by),
        sample(events.repartition(7), n, by=by),
        sample(events.repartition(5, "value"), n, by=by),
        sample(reduce(DataFrame.unionByName, parts), n, by=by),
    ]
    found = reduce(DataFrame.unionByName, picks).groupBy("event_type", "event_id").agg(F.count("*").alias("times"))
    return found.groupBy("event_type", "times").agg(F.count("*").alias("n"))


def skewed_orders(spark, folder):
    """Orders with a key that a third of them lack and that is one value for a sixth."""
    key = F.when(F.col("o_orderkey") % 3 > 0, F.when(F.col("o_orderkey") % 6 == 1, 77).otherwise(F.col("o_custkey") * F.col("o_custkey")))
    return table(spark, folder, "orders").select("o_orderkey", key.alias("k"), "o_orderdate")


def predicates(spark, folder):
    """Each order with the number of parts that it falls into, by a skewed key and by date, and whether no part is too large."""
    orders, parts = skewed_orders(spark, folder), 12
    out = []
    for column, quoted in (("k", False), ("o_orderdate", True)):
        tests = partition_predicates(column, quantile_cuts(orders, column, parts), quoted)
        numbered = orders.select("o_orderkey", column, *[F.expr(f"coalesce({t}, false)").cast("int").alias(f"t{i}") for i, t in enumerate(tests)])
        flags = [F.col(f"t{i}") for i in range(len(tests))]
        # A part may hold its share twice over, but for the hot value and the rows without a key.
        sizes = numbered.filter("k <> 77" if column == "k" else f"{column} IS NOT NULL").agg(*[F.sum(f).alias(f"t{i}") for i, f in enumerate(flags)])
        largest = sizes.select(F.greatest(*[F.coalesce(c, F.lit(0)) for c in flags]).alias("largest"))
        total = orders.agg(F.count(column).alias("total"))
        fair = largest.join(total).select((F.col("largest") <= 2 * F.col("total") / parts).alias("fair"))
        out.append(numbered.select(F.lit(column).alias("key"), "o_orderkey", reduce(lambda a, b: a + b, flags).alias("parts")).join(F.broadcast(fair)))
    return reduce(DataFrame.unionByName, out)


def tiers(spark, folder):
    """Nine batches: small ones fold by threes, and those into one larger; the rows are the same before and after."""
    events, base = table(spark, folder, "events").select("event_id", "user_id", "event_type"), scratch_path(spark, "tiers")
    for batch in range(9):
        append_dedup(events.filter(F.col("event_id") % 9 == batch), base, "events", ["user_id"], ["event_id"], 4, f"b{batch}")
    folded = compact(spark, base, "events", fan=3)
    some = len(matching_paths(spark, f"{stream_path(base, 'events')}/batch=*"))
    while compact(spark, base, "events", fan=3):
        pass
    compact(spark, base, "events")
    after = read_merged(spark, base, "events").drop("bucket")
    return after.withColumns({"state": F.lit("compacted"), "folded": F.lit(folded >= 3), "fewer": F.lit(some < 9)})


QUERIES = {
    "stream_landed_pages": Query(
        streamed_pages,
        f"""SELECT event_id, user_id, event_type, CAST({CHAINS} AS BIGINT) AS completed, max(event_id) OVER () AS "cursor", {FILES} AS batches FROM events""",
    ),
    "sample_any_partitioning": Query(stable_samples, "SELECT event_type, CAST(4 AS BIGINT) AS times, CAST(20 AS BIGINT) AS n FROM events GROUP BY event_type"),
    "partition_predicates": Query(
        predicates, "SELECT key, o_orderkey, 1 AS parts, true AS fair FROM orders, (SELECT unnest(['k', 'o_orderdate']) AS key)"
    ),
    "merge_tiers": Query(
        tiers,
        """SELECT event_id, user_id, event_type, 'compacted' AS state, true AS folded, true AS fewer FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    ),
}
