"""Runs after runs over landed pages: late partitions, holes, refetches, failures. Each ends with the table it leaves."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.incremental import newer_than_state
from ..operators.state import empty_state, get_cursor, read_state
from ..plans.sync import run_messages, sync_all, sync_landed, sync_table
from ..session import matching_paths, scratch_path
from ..sinks.tables import EmptyInput, append_dedup, compact, read_merged, read_stream_table, stream_path, write_stream_table
from ..sources.pages import read_pages
from ..sources.tables import listing, read_table
from ..specs import Paging, Stop, StreamSpec, SyncSpec, TableSpec
from ..streaming.landed import stream_sync
from .common import Query, table

CHAINS, ON_PAGE = 5, 20
MORE = Paging("offset", Stop("field", "more", False), limit=ON_PAGE)
EVENTS = ["event_id", "user_id", "event_type"]
ALL_EVENTS = "SELECT event_id, user_id, event_type FROM events"


def event_chains(spark, folder, fmt="json", broken=None, record=None):
    """Events dealt over five chains, 20 to a page, so that small tables have holes too; ``broken`` tells which records are cut off."""
    key = F.col("event_id")
    record = F.to_json(F.struct(*EVENTS)) if record is None else record
    if broken is not None:
        record = F.when(broken, F.substring(record, 1, 9)).otherwise(record)
    placed = table(spark, folder, "events").select(
        F.lit("events").alias("stream"),
        F.concat(F.lit("p"), (key % CHAINS).cast("string")).alias("partition_id"),
        (F.floor(key / (CHAINS * ON_PAGE)) + 1).cast("int").alias("page_no"),
        F.struct(key.alias("k"), record.alias("text")).alias("row"),
    )
    pages = placed.groupBy("stream", "partition_id", "page_no").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    # One row per chain is joined: a window would bring all bodies of a chain into one task.
    ends = placed.groupBy("stream", "partition_id").agg(F.max("page_no").alias("_last"))
    pages, last = pages.join(F.broadcast(ends), ["stream", "partition_id"]), F.col("_last")
    texts = F.transform("rows", lambda r: r["text"])
    lines = F.concat_ws("\n", texts)
    whole = F.concat(F.lit('{"more":'), (F.col("page_no") < last).cast("string"), F.lit(',"data":['), F.concat_ws(",", texts), F.lit("]}"))
    return pages.select(
        "stream", "partition_id", "page_no", F.lit(200).alias("status"), F.create_map().cast("map<string,string>").alias("headers"),
        (lines if fmt == "jsonl" else whole).alias("body"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"),
    )


def _two(spark, name, first, second, spec, sync=None):
    """A run over the first pages, one over the second from the state it left, and the table after both."""
    base = scratch_path(spark, name)
    done = sync_landed(first, spec, empty_state(spark), base, "run-1", sync, run_date="2024-02-01")
    done = sync_landed(second, spec, done.state, base, "run-2", sync, run_date="2024-02-02")
    return read_stream_table(spark, base, "events").select(*EVENTS), done


def late_partition(spark, folder):
    pages = event_chains(spark, folder)
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    # The chain that lands late has the least ids of all.
    return _two(spark, "late", pages.filter("partition_id <> 'p0'"), pages, spec)[0]


def gap_filled(spark, folder):
    pages = event_chains(spark, folder)
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    return _two(spark, "gap", pages.filter("page_no <> 2"), pages, spec)[0]


def refetched(spark, folder):
    pages = event_chains(spark, folder)
    early = pages.withColumns({"fetched_at": F.lit("2024-01-31 00:00:00").cast("timestamp"), "body": F.lit('{"more":false,"data":[]}')})
    spec = StreamSpec("events", "json", "data", MORE)
    return _two(spark, "refetched", early.unionByName(pages).unionByName(pages), pages.unionByName(early), spec)[0]


def open_chain(spark, folder):
    pages = event_chains(spark, folder)
    return _two(spark, "open", pages.filter("page_no <= 1"), pages, StreamSpec("events", "json", "data", MORE))[0]


def skipped_errors(spark, folder):
    pages = event_chains(spark, folder, "jsonl", F.col("event_id") % 97 == 0)
    spec = StreamSpec("events", "jsonl", paging=Paging("page_number", None))
    rows, done = _two(spark, "skip", pages, pages, spec, SyncSpec(error_strategy="skip", max_errors=1 << 30))
    return rows


def retried_errors(spark, folder):
    """Pages with broken lines end their chains; fetched again they are written, and nothing twice."""
    cut = event_chains(spark, folder, "jsonl", F.col("event_id") % 977 == 3)
    good = event_chains(spark, folder, "jsonl").withColumn("fetched_at", F.lit("2024-02-03 00:00:00").cast("timestamp"))
    spec = StreamSpec("events", "jsonl", paging=Paging("page_number", None), cursor_field="event_id")
    return _two(spark, "retry", cut, cut.unionByName(good), spec, SyncSpec(error_strategy="retry"))[0]


def failed_leaves_table(spark, folder):
    """Too many bad records: the second run fails, and the table and the state are those of the first."""
    pages, cut = event_chains(spark, folder, "jsonl"), event_chains(spark, folder, "jsonl", F.col("event_id") % 3 == 0)
    spec = StreamSpec("events", "jsonl", paging=Paging("page_number", None), cursor_field="event_id")
    rows, done = _two(spark, "failed", pages.filter("partition_id <> 'p1'"), cut, spec, SyncSpec(error_strategy="skip", max_errors=5))
    return rows.withColumns({"status": F.lit(done.status), "cursor": F.lit(get_cursor(done.state, "events"))})


def rerun_next_day(spark, folder):
    """The same run on two days: it keeps the date of its first attempt."""
    events, base = table(spark, folder, "events"), scratch_path(spark, "next-day")
    write_stream_table(events.filter("event_id % 2 = 0"), base, "events", "run-1", "2024-02-01")
    write_stream_table(events, base, "events", "run-1")
    return read_stream_table(spark, base, "events").select(*EVENTS, F.col("dt").cast("string").alias("dt"))


def overwrite_empty(spark, folder):
    events, base = table(spark, folder, "events"), scratch_path(spark, "guard")
    write_stream_table(events, base, "events", "run-1", "2024-02-01")
    try:
        write_stream_table(events.filter("event_id < 0"), base, "events", "run-2", mode="overwrite", allow_empty=False)
    except EmptyInput:
        return read_stream_table(spark, base, "events").select(*EVENTS)
    raise AssertionError("an empty overwrite was let through")


def null_keys(spark, folder):
    events = table(spark, folder, "events").withColumn("k", F.when(F.col("user_id") % 3 > 0, F.col("user_id"))).select("k", "event_id", "event_type")
    base = scratch_path(spark, "null-keys")
    for batch, part in (("b1", "event_id % 2 = 0"), ("b2", "event_id % 2 = 1"), ("b2", "event_id % 2 = 1")):
        merged = append_dedup(events.filter(part), base, "events", ["k"], ["event_id"], 8, batch)
    return merged.drop("bucket")


def rebucketed(spark, folder):
    """Another bucket count is refused; a merge writes one batch, and compaction leaves one."""
    events, base = table(spark, folder, "events").select(*EVENTS), scratch_path(spark, "rebucketed")
    for batch, part in (("b1", "event_id % 2 = 0"), ("b2", "event_id % 2 = 1")):
        append_dedup(events.filter(part), base, "events", ["user_id"], ["event_id"], 16, batch)
    try:
        append_dedup(events, base, "events", ["user_id"], ["event_id"], 64, "b3")
    except ValueError:
        before = len(matching_paths(spark, f"{stream_path(base, 'events')}/batch=*"))
        compact(spark, base, "events")
        after = len(matching_paths(spark, f"{stream_path(base, 'events')}/batch=*"))
        return read_merged(spark, base, "events").drop("bucket").withColumns({"batches": F.lit(before), "compacted": F.lit(after)})
    raise AssertionError("a merge with another bucket count was let through")


def other_zone(spark, folder):
    """A cursor over zoned timestamps, kept by a session in another zone, then used by one in UTC."""
    events = table(spark, folder, "events").withColumn("at", F.col("ts").cast("timestamp")).select("event_id", "at")
    base, spec = scratch_path(spark, "zone"), TableSpec("events", cursor_field="at")
    middle = F.lit("2024-01-15 00:00:00Z").cast("timestamp")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        done = sync_table(events.filter(F.col("at") <= middle), spec, empty_state(spark), base, "run-1", run_date="2024-02-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    sync_table(events, spec, done.state, base, "run-2", run_date="2024-02-02")
    slices = read_stream_table(spark, base, "events").groupBy("run_id").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))
    return slices.withColumn("cursor", F.lit(done.cursor))


def shared_state(spark, folder):
    """Two streams with one state folder: each has its own versions, whatever batches the other has published."""
    base = scratch_path(spark, "shared")
    schema = table(spark, folder, "events").schema
    found = []
    for kind in ("click", "view"):
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
        stream_sync(
            stream, kind, f"{base}/out", f"{base}/checkpoint/{kind}", "2024-01-31", transform=lambda rows, kind=kind: rows.filter(F.col("event_type") == kind),
            cursor_field="event_id", state_folder=f"{base}/state",
        )
        found.append(read_state(spark, f"{base}/state/{kind}").select("stream", F.col("cursor").cast("bigint").alias("cursor")))
    return found[0].union(found[1])


def messages_of_run(spark, folder):
    """Two streams in one run, one of them with unreadable lines: what the run says at its end."""
    good = event_chains(spark, folder)
    bad = event_chains(spark, folder, "jsonl", F.col("event_id") % 7 == 0).withColumn("stream", F.lit("lines"))
    streams = [
        (StreamSpec("events", "json", "data", MORE, cursor_field="event_id"), SyncSpec()),
        (StreamSpec("lines", "jsonl", paging=Paging("page_number", None)), SyncSpec(error_strategy="skip", max_errors=3)),
    ]
    results, state = sync_all(good.unionByName(bad), streams, empty_state(spark), scratch_path(spark, "messages"), "run-1")
    return run_messages(results, state)


def empty_page_ends(spark, folder):
    """Chains that end with an empty page; what landed behind it does not count."""
    pages = event_chains(spark, folder)
    last = pages.groupBy("stream", "partition_id").agg(F.max("page_no").alias("last"), F.first("headers").alias("headers"), F.max("fetched_at").alias("fetched_at"))
    extra = last.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("step")).select(
        "stream", "partition_id", (F.col("last") + F.col("step")).alias("page_no"), F.lit(200).alias("status"), "headers",
        F.when(F.col("step") == 1, '{"data":[]}').otherwise('{"data":[{"event_id":-1}]}').alias("body"), "fetched_at",
    )
    spec = StreamSpec("events", "json", "data", Paging("page_number", Stop("empty_page")))
    base = scratch_path(spark, "empty-page")
    done = sync_landed(pages.unionByName(extra), spec, empty_state(spark), base, "run-1", run_date="2024-02-01")
    marks = done.state.filter("completed").agg(F.count("*").alias("completed"))
    return read_stream_table(spark, base, "events").select(*EVENTS, marks.scalar().alias("completed"))


def pages_from_files(spark, folder):
    """Pages landed as JSON lines and read back, then synced to sorted JSON lines."""
    base = scratch_path(spark, "files")
    pages = event_chains(spark, folder).withColumn("url", F.lit(None).cast("string"))
    pages.repartition(4).write.json(f"{base}/landing")
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    found = read_pages(spark, f"{base}/landing", "json")
    sync_landed(found, spec, empty_state(spark), f"{base}/out", "run-1", run_date="2024-02-01", fmt="json", sort=True)
    return read_stream_table(spark, f"{base}/out", "events", "json").select(*EVENTS)


def tables_of_files(spark, folder):
    """The same rows by a folder of files, by a catalog name and by a query."""
    source = {"format": "parquet", "path": folder, "suffix": ".parquet"}
    by_file = read_table(spark, TableSpec("nation", table="nation"), source)
    by_file.createOrReplaceTempView("tidewell_nation")
    by_name = read_table(spark, TableSpec("nation", table="tidewell_nation"), {})
    by_query = read_table(spark, TableSpec("nation", query="SELECT * FROM tidewell_nation WHERE n_nationkey % 2 = 0"), {})
    return by_file.select(F.lit("file").alias("way"), "n_nationkey", "n_name").union(by_name.select(F.lit("name"), "n_nationkey", "n_name")).union(
        by_query.select(F.lit("query"), "n_nationkey", "n_name")
    )


def nested_cursor(spark, folder):
    """A cursor inside a struct, per event type."""
    events = table(spark, folder, "events").select("event_id", "event_type", F.struct(F.struct("event_id").alias("at")).alias("meta"))
    state = events.groupBy("event_type").agg((F.max("event_id") / 2).cast("bigint").cast("string").alias("cursor"))
    return newer_than_state(events, state, ["event_type"], "meta.at.event_id").select("event_id", "event_type")


def listed_tables(spark, folder):
    """Listed schemas: one per nation, system schemas among them left out."""
    nations = table(spark, folder, "nation")
    schema = F.when(F.col("n_nationkey") % 5 == 0, "information_schema").otherwise(F.concat(F.lit("s"), F.col("n_regionkey").cast("string")))
    return listing(nations.select(schema.alias("table_schema"), F.lower("n_name").alias("table_name")), "postgres")


QUERIES = {
    "sync_messages": Query(
        messages_of_run,
        """WITH e AS (SELECT count(*) AS n, max(event_id) AS last FROM events)
           SELECT 0 AS step, 'STATE' AS type, '{"type":"STATE","state":{"type":"STREAM","stream":{"stream_descriptor":{"name":"events"},"stream_state":{"cursor":"' || last || '"}}}}' AS message FROM e
           UNION ALL SELECT 1, 'LOG', '{"type":"LOG","log":{"level":"INFO","message":"events success rows=' || n || '"}}' FROM e
           UNION ALL SELECT 2, 'LOG', '{"type":"LOG","log":{"level":"ERROR","message":"lines failed rows=0"}}'
           UNION ALL SELECT 3, 'SYNC_SUMMARY', '{"type":"SYNC_SUMMARY","summary":{"status":"PARTIAL","total_records":' || n || ',"total_streams":2,"successful_streams":1,"failed_streams":1}}' FROM e""",
    ),
    "page_chain_empty_page": Query(empty_page_ends, "SELECT event_id, user_id, event_type, (SELECT count(DISTINCT event_id % 5) FROM events) AS completed FROM events"),
    "sync_pages_from_files": Query(pages_from_files, ALL_EVENTS),
    "read_table_ways": Query(
        tables_of_files,
        """SELECT 'file' AS way, n_nationkey, n_name FROM nation UNION ALL SELECT 'name', n_nationkey, n_name FROM nation
           UNION ALL SELECT 'query', n_nationkey, n_name FROM nation WHERE n_nationkey % 2 = 0""",
    ),
    "nested_cursor": Query(
        nested_cursor,
        """SELECT event_id, event_type FROM events
           QUALIFY event_id > max(event_id) OVER (PARTITION BY event_type) // 2""",
    ),
    "table_listing": Query(
        listed_tables, "SELECT 's' || n_regionkey || '.' || lower(n_name) AS full_name FROM nation WHERE n_nationkey % 5 <> 0"
    ),
    "sync_late_partition": Query(late_partition, ALL_EVENTS),
    "sync_gap_filled": Query(gap_filled, ALL_EVENTS),
    "sync_refetched": Query(refetched, ALL_EVENTS),
    "sync_open_chain": Query(open_chain, ALL_EVENTS),
    "sync_skip_errors": Query(skipped_errors, ALL_EVENTS + " WHERE event_id % 97 <> 0"),
    "sync_retry_errors": Query(retried_errors, ALL_EVENTS),
    "sync_failed_leaves_table": Query(
        failed_leaves_table,
        """SELECT event_id, user_id, event_type, 'FAILED' AS status,
           (SELECT CAST(max(event_id) AS VARCHAR) FROM events WHERE event_id % 5 <> 1) AS "cursor" FROM events WHERE event_id % 5 <> 1""",
    ),
    "sync_rerun_next_day": Query(rerun_next_day, "SELECT event_id, user_id, event_type, '2024-02-01' AS dt FROM events"),
    "overwrite_empty_keeps_table": Query(overwrite_empty, ALL_EVENTS),
    "append_dedup_null_keys": Query(
        null_keys,
        """SELECT CASE WHEN user_id % 3 > 0 THEN user_id END AS k, event_id, event_type FROM events
           QUALIFY row_number() OVER (PARTITION BY CASE WHEN user_id % 3 > 0 THEN user_id END ORDER BY event_id DESC) = 1""",
    ),
    "append_dedup_rebucketed": Query(
        rebucketed,
        """SELECT event_id, user_id, event_type, 2 AS batches, 1 AS compacted FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    ),
    "cursor_other_zone": Query(
        other_zone,
        """SELECT CASE WHEN ts <= TIMESTAMP '2024-01-15' THEN 'run-1' ELSE 'run-2' END AS run_id, count(*) AS n, count(*) AS ids,
           (SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') FROM events WHERE ts <= TIMESTAMP '2024-01-15') AS "cursor" FROM events GROUP BY 1""",
    ),
    "stream_shared_state": Query(
        shared_state, """SELECT event_type AS stream, max(event_id) AS "cursor" FROM events WHERE event_type IN ('click', 'view') GROUP BY 1"""
    ),
}
