"""Page chains packed from orders and events, replayed under every strategy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import with_positions
from ..operators.errors import good_records
from ..operators.paging import (
    CHAIN,
    cap_pages,
    chain_breaks,
    chain_ends,
    keep_pages,
    missing_pages,
    offset_requests,
    page_signals,
    record_positions,
    replay,
)
from ..sources.decode import decode_pages
from ..sources.pages import latest_fetch, route_pages
from ..specs import Paging, Stop
from .common import PER_PAGE, Query, chain_columns, envelope, packed, table, with_chain_totals

URL = "https://api.example.com/orders?page="


def order_pages(spark, folder):
    """Order pages: a cursor, a total, a page count, a last-page flag and a next URL in the body and header."""
    pages = with_chain_totals(packed(table(spark, folder, "orders"), "orders", "o_orderkey", F.col("o_orderkey").cast("string")))
    last = F.col("page_no") == F.col("page_count")
    following = F.concat(F.lit(URL), (F.col("page_no") + 1).cast("string"))
    quoted = F.when(last, F.lit("null")).otherwise(F.concat(F.lit('"'), following, F.lit('"')))
    enveloped = envelope(
        pages,
        has_more=F.when(last, "false").otherwise("true"),
        total=F.col("total").cast("string"),
        total_pages=F.col("page_count").cast("string"),
        next=quoted,
        paging=F.concat(F.lit('{"after":"'), F.when(last, "").otherwise((F.col("page_no") + 1).cast("string")), F.lit('"}')),
    )
    back = F.concat(F.lit(f'<{URL}1>; rel="first"'))
    link = F.when(last, back).otherwise(F.concat(F.lit("<"), following, F.lit('>; rel="next", '), back))
    return enveloped.withColumn("headers", F.create_map(F.lit("link"), link))


def _pages(paging):
    def run(spark, folder):
        replayed = replay(page_signals(order_pages(spark, folder), paging, "data"), paging)
        key = {"cursor": "cursor", "offset": "offset", "page_number": "page", "link_header": "url", "next_url": "url"}
        following = F.col("next")[key[paging.strategy]] if paging.strategy in key else F.lit(None).cast("string")
        return replayed.select("partition_id", "page_no", "n_records", "stop_reason", following.alias("following"))

    return run


def _ends(paging):
    def run(spark, folder):
        replayed = replay(page_signals(order_pages(spark, folder), paging, "data"), paging)
        return chain_ends(replayed).select("partition_id", "pages", "records", "last_page", "stop_reason", "status")

    return run


def early_stop(spark, folder):
    """A stop in the middle of each chain: later pages do not count."""
    paging = Paging("offset", Stop("field", "paging.after", "8"), limit=PER_PAGE)
    pages = order_pages(spark, folder)
    replayed = replay(page_signals(pages, paging, "data"), paging)
    kept = keep_pages(pages, chain_ends(replayed))
    records = good_records(decode_pages(kept, "json", "data"))
    return records.groupBy("partition_id").agg(F.count("*").alias("records"), F.max(F.col("record").cast("bigint")).alias("last_key"))


def total_count(spark, folder):
    paging = Paging("page_number", Stop("total_count", "total"))
    replayed = replay(page_signals(order_pages(spark, folder), paging, "data"), paging)
    return replayed.select("partition_id", "page_no", "n_records", "fetched", "total", "stop_reason")


def event_pages(spark, folder):
    """Event pages with a status each, some of them failed, and all fetched twice."""
    events = table(spark, folder, "events")
    pages = packed(events, "events", "event_id", F.col("event_id").cast("string"))
    number = F.floor(F.col("first_key") / PER_PAGE)
    codes = F.array(*[F.lit(c) for c in (200, 200, 429, 200, 503, 404, 200, 501)])
    status = F.get(codes, F.pmod(number, F.lit(8)).cast("int"))
    wait = F.when(F.pmod(number, F.lit(16)) == 2, F.create_map(F.lit("retry-after"), F.lit("7")))
    return envelope(pages).withColumns(
        {"status": status, "headers": F.coalesce(wait, F.create_map().cast("map<string,string>"))}
    )


def page_outcomes(spark, folder):
    return route_pages(event_pages(spark, folder)).select("partition_id", "page_no", "status", "outcome", "retry_after")


def page_gaps(spark, folder):
    ok = route_pages(event_pages(spark, folder)).filter("outcome = 'ok'")
    return missing_pages(ok).select("partition_id", "resumes_at")


def gap_status(spark, folder):
    paging = Paging("offset", limit=PER_PAGE)
    ok = route_pages(event_pages(spark, folder)).filter("outcome = 'ok'")
    ends = chain_ends(replay(page_signals(ok, paging, "data"), paging))
    return ends.select("partition_id", "pages", "records", "last_page", "status")


def repeated_fetch(spark, folder):
    """Every page landed twice, the first time cut short; the later fetch counts."""
    pages = event_pages(spark, folder).withColumn("url", F.lit(None).cast("string"))
    second = pages.withColumn("fetched_at", F.lit("2024-02-02 00:00:00").cast("timestamp_ntz"))
    first = pages.withColumns({"fetched_at": F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), "body": F.lit('{"data":[]}')})
    kept = latest_fetch(first.unionByName(second))
    records = good_records(decode_pages(kept, "json", "data"))
    return records.groupBy("partition_id", "page_no").agg(F.count("*").alias("records"))


def request_breaks(spark, folder):
    """Requests that skipped ahead by one page on every tenth page."""
    paging = Paging("offset", limit=PER_PAGE)
    replayed = replay(page_signals(order_pages(spark, folder), paging, "data"), paging)
    ahead = F.when(F.col("page_no") % 10 == 0, F.col("page_no")).otherwise(F.col("page_no") - 1)
    asked = replayed.select(*CHAIN, "page_no", (ahead.cast("bigint") * PER_PAGE).cast("string").alias("asked"))
    return chain_breaks(replayed, asked, "offset").select("partition_id", "page_no", "asked", "promised")


RECORDS_PER_CHAIN = 7300  # the feature: a chain ends after so many records


def record_batches(spark, folder):
    """Batch numbers of records in arrival order, and a cap on the records of each chain."""
    paging = Paging("offset", limit=PER_PAGE)
    pages = order_pages(spark, folder)
    replayed = replay(page_signals(pages, paging, "data"), paging)
    before = record_positions(replayed)
    kept = cap_pages(pages, before, RECORDS_PER_CHAIN)
    records = good_records(decode_pages(kept, "json", "data")).join(before, [*CHAIN, "page_no"])
    placed = records.withColumn("position", F.col("before") + F.col("pos")).filter(F.col("position") < RECORDS_PER_CHAIN)
    return placed.select(F.col("record").cast("bigint").alias("o_orderkey"), F.floor(F.col("position") / 1000).alias("batch"))


def offset_fanout(spark, folder):
    """All offset requests for the orders of every customer, ten to a page."""
    totals = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("total"))
    return offset_requests(totals, Paging("offset", limit=10))


def positions(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", chain_columns("o_orderkey")["partition_id"].alias("partition_id"))
    return with_positions(orders, ["partition_id"], "o_orderkey", 1000)


_PAGES = """
    WITH pages AS (
        SELECT 'p' || (o_orderkey // 20000) AS partition_id, CAST((o_orderkey // 500) % 40 + 1 AS INTEGER) AS page_no,
               count(*) AS n_records, max(o_orderkey) AS last_key FROM orders GROUP BY ALL),
    chains AS (
        SELECT *, CAST(sum(n_records) OVER chain AS BIGINT) AS total, count(*) OVER chain AS page_count,
               CAST(sum(n_records) OVER (chain ORDER BY page_no) AS BIGINT) AS fetched
        FROM pages WINDOW chain AS (PARTITION BY partition_id))
"""


def _pages_sql(reason: str, following: str) -> str:
    return _PAGES + f"""
    SELECT partition_id, page_no, n_records, stop_reason,
           CASE WHEN stop_reason IS NULL THEN {following} END AS following
    FROM (SELECT *, {reason} AS stop_reason FROM chains)
    """


def _ends_sql(reason: str) -> str:
    return _PAGES + f"""
    , judged AS (SELECT *, {reason} AS stop_reason FROM chains),
    ended AS (SELECT *, min(page_no) FILTER (stop_reason IS NOT NULL) OVER (PARTITION BY partition_id) AS stop_page FROM judged)
    SELECT partition_id, count(*) AS pages, CAST(sum(n_records) AS BIGINT) AS records, max(page_no) AS last_page,
           arg_max(COALESCE(stop_reason, '-'), page_no) AS stop_reason,
           CASE WHEN count(*) < max(page_no) THEN 'gap' WHEN max(stop_page) IS NULL THEN 'open' ELSE 'complete' END AS status
    FROM ended WHERE stop_page IS NULL OR page_no <= stop_page GROUP BY partition_id
    """


_LAST = "page_no = page_count"
_NEXT_URL = f"'{URL}' || (page_no + 1)"
_CURSOR = Paging("cursor", Stop("field", "has_more", False), cursor_path="paging.after")
_OFFSET = Paging("offset", limit=PER_PAGE)
_EVENTS = """
    WITH pages AS (
        SELECT 'p' || (event_id // 20000) AS partition_id, CAST((event_id // 500) % 40 + 1 AS INTEGER) AS page_no,
               CAST([200, 200, 429, 200, 503, 404, 200, 501][(event_id // 500) % 8 + 1] AS INTEGER) AS status,
               (event_id // 500) % 16 AS n16, count(*) AS n_records
        FROM events GROUP BY ALL)
"""
_OK = "status NOT IN (429, 503, 404, 501)"

QUERIES = {
    "page_chain_cursor": Query(
        _pages(_CURSOR), _pages_sql(f"CASE WHEN {_LAST} THEN 'field' END", "CAST(page_no + 1 AS VARCHAR)")
    ),
    "page_chain_cursor_only": Query(
        _pages(Paging("cursor", None, cursor_path="$.paging.after")),
        _pages_sql(f"CASE WHEN {_LAST} THEN 'no_cursor' END", "CAST(page_no + 1 AS VARCHAR)"),
    ),
    "page_chain_offset": Query(
        _pages(_OFFSET), _pages_sql("CASE WHEN n_records < 500 THEN 'short_page' END", "CAST(page_no * 500 AS VARCHAR)")
    ),
    "page_chain_page_number": Query(
        _pages(Paging("page_number", page_size=PER_PAGE)),
        _pages_sql("CASE WHEN n_records < 500 THEN 'short_page' END", "CAST(page_no + 1 AS VARCHAR)"),
    ),
    "page_chain_total_pages": Query(
        _pages(Paging("page_number", Stop("total_pages", "total_pages"))),
        _pages_sql(f"CASE WHEN {_LAST} THEN 'total_pages' END", "CAST(page_no + 1 AS VARCHAR)"),
    ),
    "page_chain_total_count": Query(
        total_count,
        _PAGES
        + """
        SELECT partition_id, page_no, n_records, fetched, total,
               CASE WHEN fetched >= total THEN 'total_count' END AS stop_reason FROM chains
        """,
    ),
    "link_header_next": Query(
        _pages(Paging("link_header")), _pages_sql(f"CASE WHEN {_LAST} THEN 'no_next_page' END", _NEXT_URL)
    ),
    "next_url": Query(
        _pages(Paging("next_url", next_path="next")), _pages_sql(f"CASE WHEN {_LAST} THEN 'no_next_page' END", _NEXT_URL)
    ),
    "single_page": Query(_pages(Paging("none")), _pages_sql("'single_page'", "CAST(NULL AS VARCHAR)")),
    "page_chain_ends": Query(
        lambda spark, folder: _ends(_OFFSET)(spark, folder).fillna("-", ["stop_reason"]),
        _ends_sql("CASE WHEN n_records < 500 THEN 'short_page' END"),
    ),
    "page_chain_field": Query(
        early_stop,
        """
        SELECT 'p' || (o_orderkey // 20000) AS partition_id, count(*) AS records, max(o_orderkey) AS last_key
        FROM orders WHERE (o_orderkey // 500) % 40 + 1 <= 7 GROUP BY ALL
        """,
    ),
    "page_outcome": Query(
        page_outcomes,
        _EVENTS
        + """
        SELECT partition_id, page_no, status,
               CASE status WHEN 200 THEN 'ok' WHEN 429 THEN 'rate_limited' WHEN 503 THEN 'retry'
                           WHEN 404 THEN 'client_error' ELSE 'server_error' END AS outcome,
               CASE WHEN status = 429 THEN CAST(CASE WHEN n16 = 2 THEN 7 ELSE 60 END AS BIGINT) END AS retry_after
        FROM pages
        """,
    ),
    "page_gaps": Query(
        page_gaps,
        _EVENTS
        + f"""
        , ok AS (SELECT * FROM pages WHERE {_OK})
        SELECT partition_id, page_no AS resumes_at FROM ok
        WHERE page_no > 1 AND (partition_id, page_no - 1) NOT IN (SELECT (partition_id, page_no) FROM ok)
        """,
    ),
    "page_gap_status": Query(
        gap_status,
        _EVENTS
        + f"""
        , ok AS (SELECT * FROM pages WHERE {_OK}),
        ended AS (SELECT *, min(page_no) FILTER (n_records < 500) OVER (PARTITION BY partition_id) AS stop_page FROM ok)
        SELECT partition_id, count(*) AS pages, CAST(sum(n_records) AS BIGINT) AS records, max(page_no) AS last_page,
               CASE WHEN count(*) < max(page_no) THEN 'gap' WHEN max(stop_page) IS NULL THEN 'open' ELSE 'complete' END AS status
        FROM ended WHERE stop_page IS NULL OR page_no <= stop_page GROUP BY partition_id
        """,
    ),
    "repeated_fetch": Query(
        repeated_fetch, _EVENTS + f"SELECT partition_id, page_no, n_records AS records FROM pages WHERE {_OK}"
    ),
    "request_breaks": Query(
        request_breaks,
        _PAGES
        + """
        SELECT partition_id, page_no, CAST(page_no * 500 AS VARCHAR) AS asked, CAST((page_no - 1) * 500 AS VARCHAR) AS promised
        FROM chains WHERE page_no % 10 = 0
        """,
    ),
    "record_batches": Query(
        record_batches,
        """
        SELECT o_orderkey, position // 1000 AS batch
        FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey // 20000 ORDER BY o_orderkey) - 1 AS position FROM orders)
        WHERE position < 7300
        """,
    ),
    "offset_fanout": Query(
        offset_fanout,
        """
        SELECT o_custkey, unnest(generate_series(0, count(*) - 1, 10)) AS "offset", CAST(10 AS INTEGER) AS "limit"
        FROM orders GROUP BY o_custkey
        """,
    ),
    "record_positions": Query(
        positions,
        """
        SELECT o_orderkey, 'p' || (o_orderkey // 20000) AS partition_id,
               row_number() OVER (PARTITION BY o_orderkey // 20000 ORDER BY o_orderkey) - 1 AS position FROM orders
        """,
    ),
}
