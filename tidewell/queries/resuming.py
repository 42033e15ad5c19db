"""Runs that go on where others stopped: holes, newest-first chains, other formats, failed partitions, nothing new."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.state import empty_state
from ..plans.sync import landed_records, sync_landed
from ..session import scratch_path, staged
from ..sinks.tables import read_stream_table
from ..specs import Paging, Stop, StreamSpec, SyncSpec
from .common import Query, table
from .landing import CHAINS, MORE, ON_PAGE, event_chains

DAYS = ("2024-02-01", "2024-02-02", "2024-02-03", "2024-02-04")


def runs(spark, name, spec, landed, sync=None):
    """One run after the other, each from the state that the one before left: (base, results)."""
    base, state, results = scratch_path(spark, name), empty_state(spark), []
    for number, (pages, day) in enumerate(zip(landed, DAYS), 1):
        results.append(sync_landed(pages, spec, state, base, f"run-{number}", sync, run_date=day))
        state = results[-1].state
    return base, results


def by_run(spark, base, *columns):
    return read_stream_table(spark, base, "events").select("event_id", F.col("run_id").cast("string").alias("run_id"), *columns)


# SQL for where an event landed.
PLACED = f"""WITH e AS (SELECT event_id, event_id % {CHAINS} AS chain, event_id // {CHAINS * ON_PAGE} + 1 AS page,
  max(event_id // {CHAINS * ON_PAGE} + 1) OVER (PARTITION BY event_id % {CHAINS}) AS last FROM events)"""


def _with_last(pages: DataFrame) -> DataFrame:
    """The pages with the number of their chain's last as ``_last``: one row per chain is joined, bodies stay where they are."""
    ends = pages.groupBy("stream", "partition_id").agg(F.max("page_no").alias("_last"))
    return pages.join(F.broadcast(ends), ["stream", "partition_id"])


def holes(spark, folder):
    """Chain 0 misses its first page, 1 three in a row, 2 and 3 two pages each that land in either order, 4 its last."""
    pages = _with_last(staged(event_chains(spark, folder), "landed"))
    chain, page = F.col("partition_id"), F.col("page_no")
    missing = (
        ((chain == "p0") & (page == 1))
        | ((chain == "p1") & page.between(2, 4))
        | (chain.isin("p2", "p3") & page.isin(2, 5))
        | ((chain == "p4") & (page == F.col("_last")))
    )
    late = ((chain == "p2") & (page == 2)) | ((chain == "p3") & (page == 5))
    marked = pages.withColumns({"_missing": missing, "_late": late})
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    landed = [marked.filter(test).drop("_last", "_missing", "_late") for test in ("NOT _missing", "NOT _late", "true")]
    base, results = runs(spark, "holes", spec, landed)
    marks = results[-1].state.filter("completed").agg(F.count("*").alias("completed"))
    return by_run(spark, base, marks.scalar().alias("completed"))


def newest_first(spark, folder):
    """Chains whose first page has the greatest ids: what later pages hold is older than what is written."""
    pages, last = _with_last(event_chains(spark, folder)), F.col("_last")
    turned = pages.withColumn("page_no", last - F.col("page_no") + 1)
    body = F.concat(F.lit('{"more":'), (F.col("page_no") < last).cast("string"), F.substring("body", F.locate(",", F.col("body")), F.length("body")))
    turned = staged(turned.withColumn("body", body).drop("_last"), "landed")
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    base, results = runs(spark, "newest", spec, [turned.filter("page_no <= 2"), turned.filter("page_no <= 3 OR partition_id = 'p1'"), turned])
    state = results[-1].state.filter("partition_id IS NOT NULL")
    cursors = state.select(F.col("partition_id").alias("_chain"), F.col("cursor").cast("bigint").alias("cursor"))
    rows = by_run(spark, base).withColumn("_chain", F.concat(F.lit("p"), (F.col("event_id") % CHAINS).cast("string")))
    return rows.join(cursors, "_chain").drop("_chain")


def equal_cursors(spark, folder):
    """A cursor that many pages share: a chain that goes on keeps rows that equal what it has written."""
    events = table(spark, folder, "events")
    pages = event_chains(spark, folder)
    shared = F.regexp_replace("body", r'"event_id":(\d+)', r'"event_id":$1,"day":"2024-03-01"')
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="day")
    base, _ = runs(spark, "equal", spec, [pages.withColumn("body", shared).filter("page_no <= 2"), pages.withColumn("body", shared)])
    return by_run(spark, base).join(events.select("event_id", "user_id"), "event_id")


def committed_bound(spark, folder):
    """A stream without partitions, read again and again, newest first: the bound moves when a chain is written to its stop."""
    events = table(spark, folder, "events").select("event_id", "user_id")
    half = events.agg(F.floor(F.max("event_id") / 2).alias("h"))

    def chain(rows: DataFrame, newest: Column) -> DataFrame:
        numbered = rows.join(F.broadcast(half)).withColumn("_n", F.floor((newest - F.col("event_id")) / 100)).filter("_n >= 0")
        packed = numbered.groupBy(F.col("_n")).agg(F.collect_list(F.to_json(F.struct("event_id", "user_id"))).alias("_items"), F.min("event_id").alias("_least"))
        return packed.select(
            F.lit("events").alias("stream"), F.lit(None).cast("string").alias("partition_id"), (F.col("_n") + 1).cast("int").alias("page_no"), F.lit(200).alias("status"),
            F.create_map().cast("map<string,string>").alias("headers"),
            F.concat(F.lit('{"more":'), (F.col("_least") > 0).cast("string"), F.lit(',"data":['), F.concat_ws(",", "_items"), F.lit("]}")).alias("body"),
        )

    first, second = chain(events, F.col("h")), chain(events, F.col("h") * 2)
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    base, results = runs(spark, "bound", spec, [first, second.filter("page_no <= 2"), second])
    cursor = results[-1].state.agg(F.max(F.col("cursor").cast("bigint"))).scalar()
    return by_run(spark, base, cursor.alias("cursor"))


# Other formats


def written_as(spark, folder, fmt):
    """The event chains as JSON Lines, CSV or XML bodies, with the same records."""
    names = ("event_id", "user_id", "event_type")
    if fmt == "csv":
        pages = event_chains(spark, folder, "jsonl", record=F.concat_ws(",", *[F.col(n).cast("string") for n in names]))
        return pages.withColumn("body", F.concat(F.lit(",".join(names) + "\n"), F.col("body")))
    if fmt == "xml":
        tags = F.concat(*[F.concat(F.lit(f"<{n}>"), F.col(n).cast("string"), F.lit(f"</{n}>")) for n in names])
        pages = event_chains(spark, folder, "jsonl", record=F.concat(F.lit("<row>"), tags, F.lit("</row>")))
        return pages.withColumn("body", F.concat(F.lit("<rows>"), F.replace("body", F.lit("\n"), F.lit("")), F.lit("</rows>")))
    return event_chains(spark, folder, "jsonl")


def empty_body(fmt):
    return {"jsonl": "\n", "csv": "event_id,user_id,event_type\n", "xml": "<rows></rows>"}[fmt]


def _formats(paging, cap=None, behind=False):
    """Two runs in each format, the first over two pages of a chain; ``behind``: an empty page, and one more that must not count."""

    def run(spark, folder):
        found = []
        for fmt in ("jsonl", "csv", "xml"):
            pages = written_as(spark, folder, fmt)
            if behind:
                ends = pages.groupBy("stream", "partition_id").agg(F.max("page_no").alias("page_no"), F.max_by("body", "page_no").alias("_body"), F.first("headers").alias("headers"), F.max("fetched_at").alias("fetched_at"))
                more = [
                    ends.select("stream", "partition_id", (F.col("page_no") + k).alias("page_no"), F.lit(200).alias("status"), "headers", body.alias("body"), "fetched_at")
                    for k, body in ((1, F.lit(empty_body(fmt))), (2, F.col("_body")))
                ]
                pages = reduce(DataFrame.unionByName, more, pages)
            spec = StreamSpec("events", fmt, "row" if fmt == "xml" else None, paging, max_records=cap)
            base, results = runs(spark, f"format-{fmt}", spec, [pages.filter("page_no <= 2"), pages])
            rows = read_stream_table(spark, base, "events").select(F.lit(fmt).alias("fmt"), F.col("event_id").cast("bigint").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id"), "event_type")
            done = results[-1].partitions.filter("status = 'complete'").agg(F.count("*")).scalar()
            found.append(rows.withColumn("complete", done))
        return reduce(DataFrame.unionByName, found)

    return run


def _formats_sql(complete, where=""):
    # A chain ends by a short page only if its last page is not full.
    return f"""{PLACED}, f AS (SELECT unnest(['jsonl', 'csv', 'xml']) AS fmt),
      short AS (SELECT count(*) FILTER (n % {ON_PAGE} > 0) AS short, count(*) AS chains FROM (SELECT count(*) AS n FROM e GROUP BY chain))
      SELECT fmt, events.event_id, user_id, event_type, (SELECT {complete} FROM short) AS complete FROM events JOIN e USING (event_id), f {where}"""


# Failed partitions


def failed_partition(spark, folder):
    """One chain of five with cut lines: the others are written and marked; fetched again it is written, too."""
    cut = event_chains(spark, folder, "jsonl", (F.col("event_id") % CHAINS == 2) & (F.col("event_id") % 7 == 0))
    good = event_chains(spark, folder, "jsonl").withColumn("fetched_at", F.lit("2024-02-03 00:00:00").cast("timestamp"))
    spec = StreamSpec("events", "jsonl", paging=Paging("page_number", None), cursor_field="event_id")
    base, results = runs(spark, "partition", spec, [cut, cut.unionByName(good)], SyncSpec(error_strategy="fail", fail_fast=False))
    first = results[0].partitions.agg(F.count_if(F.col("status") == "failed")).scalar()
    return by_run(spark, base).withColumns({"first": F.lit(results[0].status), "failed": first, "second": F.lit(results[1].status)})


def failed_partition_many(spark, folder):
    """With ``skip`` a chain may have so many bad records; beyond that it is left out, and bad records of others are skipped."""
    cut = event_chains(spark, folder, "jsonl", (F.col("event_id") % 97 == 0) | ((F.col("event_id") % CHAINS == 4) & (F.col("event_id") % 3 == 0)))
    allowed = table(spark, folder, "events").filter(f"event_id % {CHAINS} <> 4 AND event_id % 97 = 0").count()
    spec = StreamSpec("events", "jsonl", paging=Paging("page_number", None), cursor_field="event_id")
    base, results = runs(spark, "many", spec, [cut], SyncSpec(error_strategy="skip", max_errors=allowed, fail_fast=False))
    states = results[0].state.filter("partition_id = 'p4'").agg(F.count("*")).scalar()
    return by_run(spark, base).withColumns({"status": F.lit(results[0].status), "kept_state": states})


# Nothing new


def nothing_new(spark, folder):
    """The same pages again, and no pages at all: both runs succeed with nothing to do."""
    pages = event_chains(spark, folder)
    spec = StreamSpec("events", "json", "data", MORE, cursor_field="event_id")
    base, results = runs(spark, "idle", spec, [pages, pages, pages.filter("false")])
    said = {f"run{k + 1}": F.lit(f"{r.status} {r.records}") for k, r in enumerate(results) if k}
    cursor = results[-1].state.filter("partition_id IS NULL").agg(F.max(F.col("cursor").cast("bigint"))).scalar()
    return by_run(spark, base, cursor.alias("cursor")).withColumns(said)


def usable_records(spark, folder):
    """What a first run may read of chains with holes, page by page, without writing anything."""
    pages = event_chains(spark, folder).filter("page_no % 4 <> 0 OR partition_id IN ('p0', 'p1')")
    records, ends = landed_records(pages, StreamSpec("events", "json", "data", MORE))
    counts = records.groupBy("partition_id").agg(F.count("*").alias("n"))
    return ends.join(counts, "partition_id").select("partition_id", "last_page", "pages", "status", "n")


QUERIES = {
    "sync_holes": Query(
        holes,
        f"""{PLACED} SELECT event_id, CAST({CHAINS} AS BIGINT) AS completed, CASE chain WHEN 0 THEN 'run-2' WHEN 1 THEN CASE WHEN page = 1 THEN 'run-1' ELSE 'run-2' END
            WHEN 2 THEN CASE WHEN page = 1 THEN 'run-1' ELSE 'run-3' END
            WHEN 3 THEN CASE WHEN page = 1 THEN 'run-1' WHEN page < 5 THEN 'run-2' ELSE 'run-3' END
            ELSE CASE WHEN page < last THEN 'run-1' ELSE 'run-2' END END AS run_id FROM e""",
    ),
    "sync_newest_first": Query(
        newest_first,
        f"""{PLACED} SELECT event_id, max(event_id) OVER (PARTITION BY chain) AS "cursor",
            CASE WHEN last - page + 1 <= 2 THEN 'run-1' WHEN last - page + 1 <= 3 OR chain = 1 THEN 'run-2' ELSE 'run-3' END AS run_id FROM e""",
    ),
    "sync_equal_cursors": Query(
        equal_cursors, f"{PLACED} SELECT event_id, user_id, CASE WHEN page <= 2 THEN 'run-1' ELSE 'run-2' END AS run_id FROM e JOIN events USING (event_id)"
    ),
    "sync_committed_bound": Query(
        committed_bound,
        """WITH h AS (SELECT max(event_id) // 2 AS h FROM events)
           SELECT event_id, 2 * h AS "cursor", CASE WHEN event_id <= h THEN 'run-1' WHEN 2 * h - event_id < 200 THEN 'run-2' ELSE 'run-3' END AS run_id FROM events, h WHERE event_id <= 2 * h""",
    ),
    "sync_formats_offset": Query(_formats(Paging("offset", None, limit=ON_PAGE)), _formats_sql("short")),
    "sync_formats_page_number": Query(_formats(Paging("page_number", None, page_size=ON_PAGE)), _formats_sql("short")),
    "sync_formats_empty_page": Query(_formats(Paging("page_number", Stop("empty_page")), behind=True), _formats_sql("chains")),
    "sync_formats_cap": Query(
        _formats(Paging("offset", None, limit=ON_PAGE), cap=3 * ON_PAGE - 7),
        _formats_sql("short", f"WHERE event_id // {CHAINS} < {3 * ON_PAGE - 7}"),
    ),
    "sync_failed_partition": Query(
        failed_partition,
        f"""SELECT event_id, CASE WHEN event_id % {CHAINS} = 2 THEN 'run-2' ELSE 'run-1' END AS run_id, 'PARTIAL' AS "first", CAST(1 AS BIGINT) AS failed, 'SUCCESS' AS "second" FROM events""",
    ),
    "sync_failed_partition_many": Query(
        failed_partition_many,
        f"SELECT event_id, 'run-1' AS run_id, 'PARTIAL' AS status, CAST(0 AS BIGINT) AS kept_state FROM events WHERE event_id % {CHAINS} <> 4 AND event_id % 97 <> 0",
    ),
    "sync_nothing_new": Query(
        nothing_new, """SELECT event_id, 'run-1' AS run_id, 'SUCCESS 0' AS run2, 'SUCCESS 0' AS run3, max(event_id) OVER () AS "cursor" FROM events"""
    ),
    "usable_records": Query(
        usable_records,
        f"""{PLACED}, m AS (SELECT 'p' || chain AS partition_id, chain, max(last) AS last FROM e GROUP BY chain), n AS (SELECT chain, page, count(*) AS n FROM e GROUP BY 1, 2)
            SELECT partition_id, CAST(max(page) AS INTEGER) AS last_page, count(*) AS pages, CASE WHEN max(page) = max(last) THEN 'complete' WHEN max(last) = 4 THEN 'open' ELSE 'gap' END AS status, CAST(sum(n) AS BIGINT) AS n
            FROM m JOIN n USING (chain) WHERE chain < 2 OR page < 4 GROUP BY partition_id""",
    ),
}
