"""Partitions of work, request plans, asynchronous jobs, state, messages and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.text import link_url, sanitise_name
from ..operators.jobs import completed_downloads, job_status
from ..operators.messages import (
    catalog_message,
    log_messages,
    record_messages,
    state_messages,
    streams_message,
    summary_message,
)
from ..operators.partitions import (
    children_of,
    datetime_partitions,
    list_partitions,
    parent_partitions,
    partition_outcomes,
    pending,
    slice_number,
)
from ..operators.requests import request_plan
from ..operators.state import (
    clear_state,
    cursor_updates,
    mark_completed,
    parse_state,
    parse_state_lines,
    state_lines,
    upsert_state,
)
from ..operators.summary import run_summary, stream_results
from ..specs import JobSpec, RequestSpec
from .common import Query, ntz, table


def partition_list(spark, folder):
    work = list_partitions(spark, "events", "kind", ["view", "click", "purchase", "refund"])
    events = table(spark, folder, "events")
    joined = events.join(work, F.col("event_type") == F.col("values")["kind"])
    return joined.groupBy("partition_id").agg(F.count("*").alias("records"), F.max("ts").alias("last_ts"))


def partition_parent(spark, folder):
    customers = table(spark, folder, "customer").filter("c_acctbal < 0")
    work = parent_partitions(customers, "orders", "c_custkey", "customer")
    orders = table(spark, folder, "orders")
    joined = orders.join(work, F.col("o_custkey").cast("string") == F.col("partition_id"))
    return joined.groupBy("stream", "partition_id").agg(F.count("*").alias("orders"))


def child_records(spark, folder):
    customers = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    return children_of(table(spark, folder, "orders"), customers, "o_custkey", "c_custkey")


def _slices(step, source, moment):
    def run(spark, folder):
        rows = table(spark, folder, source).withColumnRenamed(moment, "_moment")
        first = F.date_trunc("month", F.min("_moment")).cast("timestamp_ntz")
        bounds = rows.agg(first.alias("first"), F.max("_moment").alias("last"))
        # Slices are half-open, so the rows at the very end belong to the next run.
        rows = rows.filter(F.col("_moment") < bounds.select("last").scalar())
        slices = datetime_partitions(
            spark, source, F.col("first"), F.col("last"), step, "%Y-%m-%d", bounds=bounds
        )
        start = bounds.select("first").scalar()
        counts = rows.groupBy(slice_number(F.col("_moment"), start, step).cast("int").alias("n")).agg(
            F.count("*").alias("records")
        )
        joined = slices.join(counts, "n", "left")
        return joined.select(
            "partition_id", "slice_start", "slice_end", F.col("values")["end"].alias("end_text"), F.coalesce("records", F.lit(0)).alias("records")
        )

    return run


def skip_completed(spark, folder):
    customers = table(spark, folder, "customer")
    work = parent_partitions(customers, "orders", "c_custkey", "customer")
    done = parent_partitions(customers.filter("c_acctbal < 1000"), "orders", "c_custkey", "customer")
    state = mark_completed(clear_state(cursor_updates(done)), done)
    return pending(work, state).select("stream", "partition_id", F.col("values")["customer"].alias("customer"))


def outcomes_by_partition(spark, folder):
    customers = table(spark, folder, "customer")
    work = parent_partitions(customers, "orders", "c_custkey", "customer")
    orders = table(spark, folder, "orders")
    results = orders.groupBy(F.col("o_custkey").cast("string").alias("partition_id")).agg(
        F.count("*").alias("records"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("errors")
    )
    return partition_outcomes(work, results.withColumn("stream", F.lit("orders")))


_JOB = JobSpec("type.name", "purchase", ("error",), max_attempts=60)


def _polls(spark, folder):
    body = F.to_json(F.struct(F.struct(F.col("event_type").alias("name")).alias("type")))
    return table(spark, folder, "events").select(
        F.col("user_id").alias("job_id"), F.col("ts").alias("polled_at"), "event_id", body.alias("body")
    )


def async_job_status(spark, folder):
    return job_status(_polls(spark, folder), _JOB, tiebreak="event_id")


def async_job_gate(spark, folder):
    downloads = table(spark, folder, "orders").withColumn("job_id", F.col("o_custkey"))
    status = job_status(_polls(spark, folder), _JOB, tiebreak="event_id")
    return completed_downloads(downloads, status).drop("job_id")


def requests(spark, folder):
    customers = table(spark, folder, "customer")
    work = parent_partitions(customers, "orders", "c_custkey", "customer").unionByName(
        parent_partitions(customers, "profiles", "c_name", "name")
    )
    specs = [
        RequestSpec("orders", "https://api.example.com/", "/v{{ config.version }}/customers/{{ partition.customer }}/orders",
                    {"since": "{{ state.cursor }}", "size": "{{ page.size }}", "none": "{{ vars.nothing }}"}),
        RequestSpec("profiles", "https://api.example.com", "/profiles", {"name": "{{partition.name}}", "tags": "{{ vars.tags }}"}),
    ]
    plan = request_plan(work, specs, {"version": 2, "page": {"size": 50}}, {"nothing": None, "tags": ["a", "b"]})
    return plan.select(
        "stream", "partition_id", "url", F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&").alias("query")
    )


def layout_paths(spark, folder):
    """Where the rows of each stream go: streams named after source and language of documents."""
    documents = table(spark, folder, "documents")
    name = F.concat_ws(".", "source", "lang")
    path = F.concat(sanitise_name(name), F.lit("/dt=2024-01-31"))
    return documents.groupBy(name.alias("stream"), path.alias("path")).agg(F.count("*").alias("records"))


def link_headers(spark, folder):
    """Link headers made of page URLs, with the wanted relation in every position."""
    pages = table(spark, folder, "pages")
    url = F.concat(F.lit("<"), F.col("url"), F.lit(">"))
    other = F.lit('<https://example.com/1>; rel="prev"')
    header = (
        F.when(F.col("page_id") % 4 == 0, F.concat(url, F.lit('; rel="next", '), other))
        .when(F.col("page_id") % 4 == 1, F.concat(other, F.lit(", "), url, F.lit("; rel=next")))
        .when(F.col("page_id") % 4 == 2, F.concat(other, F.lit(", "), url, F.lit("; type='x'; rel='next'")))
        .otherwise(other)
    )
    return pages.select("page_id", link_url(header).alias("next_url"))


def _state(spark, folder):
    """State per customer: the last order up to a day, completed when it is older than another."""
    orders = table(spark, folder, "orders").filter(F.col("o_orderdate") <= ntz("1998-01-01"))
    last = orders.groupBy(F.col("o_custkey").cast("string").alias("partition_id")).agg(F.max("o_orderdate").alias("_last"))
    return last.select(
        F.lit("orders").alias("stream"),
        "partition_id",
        F.date_format("_last", "yyyy-MM-dd").alias("cursor"),
        (F.col("_last") <= ntz("1997-01-01")).alias("completed"),
    )


def state_upsert(spark, folder):
    later = table(spark, folder, "orders").filter(F.col("o_orderdate") > ntz("1998-01-01"))
    updates = later.groupBy(F.col("o_custkey").cast("string").alias("partition_id")).agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("cursor")
    )
    return upsert_state(_state(spark, folder), updates.withColumn("stream", F.lit("orders")))


def state_round_trip(spark, folder):
    return parse_state_lines(state_lines(_state(spark, folder)))


def state_documents(spark, folder):
    """State documents of many connectors, one per customer, in both layouts."""
    orders = table(spark, folder, "orders")
    per = orders.groupBy("o_custkey").agg(F.max("o_orderkey").cast("string").alias("cursor"))
    body = F.concat(F.lit('{"orders":{"cursor":"'), F.col("cursor"), F.lit('","partitions":{"p1":{"completed":true}}}}'))
    wrapped = F.concat(F.lit('{"streams":'), body, F.lit("}"))
    doc = F.when(F.col("o_custkey") % 2 == 0, wrapped).otherwise(body)
    parsed = parse_state(per.select(doc.alias("doc")))
    return parsed.groupBy("stream", F.coalesce("partition_id", F.lit("-")).alias("partition_id"), "completed").agg(
        F.count("*").alias("documents"), F.max(F.col("cursor").cast("bigint")).alias("greatest")
    )


def record_lines(spark, folder):
    return record_messages(table(spark, folder, "customer"), "customers", F.lit(0))


def state_lines_by_type(spark, folder):
    last = table(spark, folder, "events").groupBy(F.col("event_type").alias("stream")).agg(F.max("event_id").cast("string").alias("cursor"))
    return state_messages(last)


def log_lines(spark, folder):
    per = table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    text = F.concat(F.col("event_type"), F.lit(" done, rows: "), F.col("n").cast("string"))
    return log_messages(per, "INFO", text)


def _outcomes(spark, folder):
    """One stream per market segment, one partition per customer."""
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("records"))
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    bad = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0)
    return joined.select(
        F.col("c_mktsegment").alias("stream"),
        F.col("c_custkey").cast("string").alias("partition_id"),
        F.coalesce("records", F.lit(0)).alias("records"),
        F.ceil(F.coalesce("records", F.lit(0)) / 10).cast("bigint").alias("pages"),
        bad.cast("bigint").alias("errors"),
    )


def results_by_stream(spark, folder):
    return stream_results(_outcomes(spark, folder))


def summary(spark, folder):
    return run_summary(stream_results(_outcomes(spark, folder)))


def closing_messages(spark, folder):
    results = stream_results(_outcomes(spark, folder))
    names = results.select(F.col("stream").alias("name"), "records_synced")
    parts = [summary_message(run_summary(results)), streams_message(names, "shop"), catalog_message(names)]
    return reduce(lambda a, b: a.unionByName(b), parts)


_OUTCOMES_SQL = """
    WITH outcomes AS (
        SELECT c_mktsegment AS stream, COALESCE(n, 0) AS records, CAST(ceil(COALESCE(n, 0) / 10) AS BIGINT) AS pages,
               CAST(c_mktsegment = 'BUILDING' AND c_acctbal < 0 AS BIGINT) AS errors
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey),
    results AS (
        SELECT stream, CASE WHEN sum(errors) > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CAST(sum(records) AS BIGINT) AS records_synced, CAST(sum(pages) AS BIGINT) AS pages,
               count(*) AS partitions, CAST(sum(errors) AS BIGINT) AS errors
        FROM outcomes GROUP BY stream),
    summary AS (
        SELECT CASE WHEN count(*) FILTER (status = 'FAILED') = 0 THEN 'SUCCEEDED'
                    WHEN count(*) FILTER (status = 'SUCCESS') = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status,
               CAST(sum(records_synced) AS BIGINT) AS total_records, count(*) AS total_streams,
               count(*) FILTER (status = 'SUCCESS') AS successful_streams,
               count(*) FILTER (status = 'FAILED') AS failed_streams
        FROM results)
"""

_POLLS_SQL = """
    WITH last AS (SELECT user_id AS job_id, arg_max(event_type, event_id) AS status, count(*) AS attempts
                  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY user_id),
    last_row AS (SELECT user_id AS job_id, event_type AS status FROM events
                 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    jobs AS (
        SELECT job_id, r.status, attempts,
               CASE WHEN r.status = 'purchase' THEN 'Completed' WHEN r.status = 'error' THEN 'Failed'
                    WHEN attempts >= 60 THEN 'TimedOut' ELSE 'InProgress' END AS state
        FROM last JOIN last_row r USING (job_id))
"""

_STATE_SQL = """
    WITH state AS (
        SELECT 'orders' AS stream, CAST(o_custkey AS VARCHAR) AS partition_id, strftime(max(o_orderdate), '%Y-%m-%d') AS "cursor",
               max(o_orderdate) <= TIMESTAMP '1997-01-01' AS completed
        FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' GROUP BY o_custkey)
"""


def _slices_sql(source: str, moment: str, step: str, index: str) -> str:
    return f"""
    WITH bounds AS (SELECT date_trunc('month', min({moment}))::TIMESTAMP AS lo, max({moment}) AS hi FROM {source}),
    starts AS (SELECT unnest(generate_series(lo, hi - INTERVAL 1 MICROSECOND, INTERVAL {step})) AS slice_start, hi FROM bounds),
    slices AS (SELECT CAST(row_number() OVER (ORDER BY slice_start) - 1 AS INTEGER) AS n, slice_start,
                      least(slice_start + INTERVAL {step}, hi) AS slice_end FROM starts),
    counts AS (SELECT CAST({index} AS INTEGER) AS n, count(*) AS records FROM {source}, bounds WHERE {moment} < hi GROUP BY ALL)
    SELECT n || '_' || strftime(slice_start, '%Y-%m-%d') AS partition_id, slice_start, slice_end,
           strftime(slice_end, '%Y-%m-%d') AS end_text, COALESCE(records, 0) AS records
    FROM slices LEFT JOIN counts USING (n)
    """


QUERIES = {
    "partition_list": Query(
        partition_list,
        """
        SELECT event_type AS partition_id, count(*) AS records, max(ts) AS last_ts FROM events
        WHERE event_type IN ('view', 'click', 'purchase', 'refund') GROUP BY event_type
        """,
    ),
    "partition_parent": Query(
        partition_parent,
        """
        SELECT 'orders' AS stream, CAST(c_custkey AS VARCHAR) AS partition_id, count(*) AS orders
        FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal < 0) JOIN orders ON o_custkey = c_custkey GROUP BY ALL
        """,
    ),
    "child_records": Query(
        child_records,
        "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
    ),
    "partition_datetime": Query(
        _slices("1d", "events", "ts"), _slices_sql("events", "ts", "1 DAY", "(epoch_us(ts) - epoch_us(lo)) // 86400000000")
    ),
    "partition_months": Query(
        _slices("P3M", "orders", "o_orderdate"),
        _slices_sql("orders", "o_orderdate", "3 MONTH", "datesub('month', lo, o_orderdate) // 3"),
    ),
    "skip_completed": Query(
        skip_completed,
        """
        SELECT 'orders' AS stream, CAST(c_custkey AS VARCHAR) AS partition_id, CAST(c_custkey AS VARCHAR) AS customer
        FROM customer WHERE NOT c_acctbal < 1000
        """,
    ),
    "partition_outcomes": Query(
        outcomes_by_partition,
        """
        SELECT 'orders' AS stream, CAST(c_custkey AS VARCHAR) AS partition_id, COALESCE(n, 0) AS records,
               COALESCE(bad, 0) AS errors,
               CASE WHEN n IS NULL THEN 'skipped' WHEN bad > 0 THEN 'failed' ELSE 'completed' END AS status
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS bad
                                 FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
        """,
    ),
    "async_job_status": Query(
        async_job_status,
        _POLLS_SQL
        + "SELECT job_id, status, attempts, state, state IN ('Completed', 'Failed', 'TimedOut') AS terminal FROM jobs",
    ),
    "async_job_gate": Query(
        async_job_gate,
        _POLLS_SQL + "SELECT * FROM orders WHERE o_custkey IN (SELECT job_id FROM jobs WHERE state = 'Completed')",
    ),
    "request_plan": Query(
        requests,
        """
        SELECT 'orders' AS stream, CAST(c_custkey AS VARCHAR) AS partition_id,
               'https://api.example.com/v2/customers/' || c_custkey || '/orders' AS url, 'size=50' AS query FROM customer
        UNION ALL
        SELECT DISTINCT 'profiles', c_name, 'https://api.example.com/profiles', 'name=' || c_name || '&tags=["a","b"]' FROM customer
        """,
    ),
    "layout_paths": Query(
        layout_paths,
        """
        SELECT source || '.' || lang AS stream, replace(source || '.' || lang, '.', '_') || '/dt=2024-01-31' AS path,
               count(*) AS records FROM documents GROUP BY ALL
        """,
    ),
    "link_headers": Query(link_headers, "SELECT page_id, CASE WHEN page_id % 4 < 3 THEN url END AS next_url FROM pages"),
    "state_upsert": Query(
        state_upsert,
        _STATE_SQL
        + """
        , later AS (SELECT CAST(o_custkey AS VARCHAR) AS partition_id, strftime(max(o_orderdate), '%Y-%m-%d') AS newer
                    FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' GROUP BY o_custkey)
        SELECT 'orders' AS stream, partition_id, COALESCE(newer, "cursor") AS "cursor", COALESCE(completed, false) AS completed
        FROM state FULL JOIN later USING (partition_id)
        """,
    ),
    "state_round_trip": Query(state_round_trip, _STATE_SQL + "SELECT * FROM state"),
    "state_documents": Query(
        state_documents,
        """
        WITH per AS (SELECT max(o_orderkey) AS "cursor" FROM orders GROUP BY o_custkey)
        SELECT 'orders' AS stream, '-' AS partition_id, false AS completed, count(*) AS documents, max("cursor") AS greatest FROM per
        UNION ALL SELECT 'orders', 'p1', true, count(*), NULL FROM per
        """,
    ),
    "record_messages": Query(
        record_lines,
        """
        SELECT 'RECORD' AS type, '{"type":"RECORD","record":{"stream":"customers","data":{"c_custkey":' || c_custkey
               || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"c_acctbal":' || c_acctbal
               || ',"c_mktsegment":"' || c_mktsegment || '"},"emitted_at":0}}' AS message
        FROM customer
        """,
    ),
    "state_messages": Query(
        state_lines_by_type,
        """
        SELECT 'STATE' AS type, '{"type":"STATE","state":{"type":"STREAM","stream":{"stream_descriptor":{"name":"' || event_type
               || '"},"stream_state":{"cursor":"' || max(event_id) || '"}}}}' AS message
        FROM events GROUP BY event_type
        """,
    ),
    "log_messages": Query(
        log_lines,
        """
        SELECT 'LOG' AS type, '{"type":"LOG","log":{"level":"INFO","message":"' || event_type || ' done, rows: '
               || count(*) || '"}}' AS message
        FROM events GROUP BY event_type
        """,
    ),
    "stream_results": Query(results_by_stream, _OUTCOMES_SQL + "SELECT * FROM results"),
    "sync_summary": Query(summary, _OUTCOMES_SQL + "SELECT * FROM summary"),
    "closing_messages": Query(
        closing_messages,
        _OUTCOMES_SQL
        + """
        SELECT 'SYNC_SUMMARY' AS type, '{"type":"SYNC_SUMMARY","summary":{"status":"' || status || '","total_records":' || total_records
               || ',"total_streams":' || total_streams || ',"successful_streams":' || successful_streams
               || ',"failed_streams":' || failed_streams || '}}' AS message FROM summary
        UNION ALL
        SELECT 'STREAMS', '{"type":"STREAMS","connector":"shop","streams":["' || string_agg(stream, '","' ORDER BY stream) || '"]}' FROM results
        UNION ALL
        SELECT 'CATALOG', '{"type":"CATALOG","catalog":{"streams":[' || string_agg('{"name":"' || stream || '","records_synced":'
               || records_synced || '}', ',' ORDER BY stream) || ']}}' FROM results
        """,
    ),
}
