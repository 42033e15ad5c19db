"""Replaying page chains: which landed pages count, where a chain ends, what comes next.

A chain is the pages of one ``stream, partition_id`` in the order of ``page_no``
(from 1). The replay works on one small row per page; bodies never go through a
shuffle. Where a running total is needed it is built from block totals, so that a
chain with very many pages is not sorted in one task.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import extract_elements, path_string, path_variant
from ..functions.text import link_url
from ..sources.decode import body_value, page_items
from ..specs import Paging, Stop
from .dedup import latest_per_key

CHAIN = ["stream", "partition_id"]
BLOCK = 4096  # pages per block of a running total


def _beside_records(pages: DataFrame, paging: Paging, fmt: str) -> tuple[DataFrame, dict[str, Column]]:
    """What the body says besides its records: ``total``, ``field_hit`` and the way ``onward``.

    The body is read for it only where the strategy or the stop condition needs it.
    """
    stop, body = paging.stop, F.col("_body")
    total, hit, onward = F.lit(None).cast("bigint"), F.lit(False), F.lit(None).cast("string")
    kind = stop.kind if stop is not None and paging.strategy not in ("link_header", "next_url", "none") else None
    if kind in ("total_count", "total_pages", "field") or paging.strategy in ("cursor", "next_url"):
        pages = pages.withColumn("_body", body_value(fmt))
    if kind in ("total_count", "total_pages"):
        text = path_string(body, stop.path)
        total = F.when(text.rlike(r"^\+?[0-9]+$"), text.try_cast("bigint"))
    elif kind == "field":
        # Equal as JSON: both sides are written out by the same encoder.
        wanted = F.to_json(F.parse_json(F.lit(json.dumps(stop.value))))
        hit = F.coalesce(F.to_json(path_variant(body, stop.path)) == wanted, F.lit(False))
    if paging.strategy == "cursor":
        onward = path_string(body, paging.cursor_path)
    elif paging.strategy == "next_url":
        onward = path_string(body, paging.next_path)
    elif paging.strategy == "link_header":
        onward = link_url(F.try_element_at(F.col("headers"), F.lit("link")), paging.rel)
    return pages, {"total": total, "field_hit": hit, "onward": F.nullif(onward, F.lit(""))}


def page_signals(pages: DataFrame, paging: Paging, records_path: str | None = None, fmt: str = "json", **options: Any) -> DataFrame:
    """One small row per page: record count, what the stop condition needs, and the way on.

    Records are counted as the decoder of the format sees them; a page table that already has ``n_records`` keeps it.
    """
    parsed, signals = _beside_records(pages, paging, fmt)
    if "n_records" in pages.columns:
        count = F.col("n_records").cast("bigint")
    elif fmt == "json":
        if "_body" not in parsed.columns:
            parsed = parsed.withColumn("_body", body_value(fmt))
        parsed = extract_elements(parsed, "_body", records_path, "_values")
        count = F.size("_values").cast("bigint")
    else:
        parsed = page_items(parsed, fmt, records_path, **options)
        count = F.size("items").cast("bigint")
    return parsed.select(
        *CHAIN,
        "page_no",
        count.alias("n_records"),
        *[value.alias(name) for name, value in signals.items()],
        *(["fetched_at"] if "fetched_at" in pages.columns else []),
        fetch_id(pages).alias("fetch"),
    )


def decoded_pages(pages: DataFrame, paging: Paging, fmt: str = "json", records_path: str | None = None, **options: Any) -> DataFrame:
    """One row per fetch: its signals, its records as ``items``, and in ``bad`` the places of those that cannot be read.

   Everything that a sync needs of a body is made here, in one narrow pass; ``row`` numbers the rows once they are
    stored. All but ``items`` is small.
    """
    parsed, signals = _beside_records(pages, paging, fmt)
    names = {name: f"_{name}" for name in signals}
    parsed = parsed.withColumns({names[name]: value for name, value in signals.items()}).drop("_body")
    listed = page_items(parsed, fmt, records_path, **options)
    places = F.filter(F.transform("items", lambda r, i: F.when(r["record"].isNull(), i)), lambda i: i.isNotNull())
    return listed.select(
        *CHAIN,
        "page_no",
        F.size("items").cast("bigint").alias("n_records"),
        *[F.col(f"_{name}").alias(name) for name in signals],
        *(["fetched_at"] if "fetched_at" in pages.columns else []),
        fetch_id(pages).alias("fetch"),
        places.alias("bad"),
        F.monotonically_increasing_id().alias("row"),
        "items",
    )


def fetch_id(pages: DataFrame) -> Column:
    """Tells the fetches of one page apart, by time and body."""
    return F.xxhash64(*(["fetched_at"] if "fetched_at" in pages.columns else []), "body")


def latest_signals(signals: DataFrame) -> DataFrame:
    """One signal per page: the one of its last fetch."""
    order = [c for c in ("fetched_at", "fetch", "row") if c in signals.columns]
    return latest_per_key(signals, [*CHAIN, "page_no"], order)


def page_runs(pages: DataFrame, block: int = BLOCK, *kept: Column) -> DataFrame:
    """The pages of each chain as maximal runs without a hole: ``first_page`` to ``last_page``.

    Pages are ranked within blocks of a chain; where the rank falls behind the page number a run begins. The
    runs of a block, one if nothing is missing, are then joined with those that they continue. ``kept`` are
    aggregates that can be taken again over their own results, such as least and greatest values.
    """
    number = F.floor((F.col("page_no") - 1) / block)
    inside = Window.partitionBy(*CHAIN, "_block").orderBy("page_no")
    ranked = pages.withColumn("_block", number).withColumn("_island", F.col("page_no") - F.dense_rank().over(inside))
    parts = ranked.groupBy(*CHAIN, "_block", "_island").agg(F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"), *kept)
    along = Window.partitionBy(*CHAIN).orderBy("first_page")
    begins = F.coalesce(F.lag("last_page").over(along) + 1 != F.col("first_page"), F.lit(True)).cast("int")
    numbered = parts.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.drop("_block", "_island", "_begins")


def joined_runs(parts: DataFrame) -> DataFrame:
    """The parts of ``page_runs`` as whole runs."""
    return parts.groupBy(*CHAIN, "_run").agg(F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page")).drop("_run")


def with_running_total(signals: DataFrame, value: str = "n_records", name: str = "fetched", block: int = BLOCK) -> DataFrame:
    """Add the total of ``value`` over a chain up to and including each page."""
    number = F.floor((F.col("page_no") - 1) / block)
    sums = signals.groupBy(*CHAIN, number.alias("_block")).agg(F.sum(value).alias("_sum"))
    along = Window.partitionBy(*CHAIN).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*CHAIN, "_block", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*CHAIN, "_block").orderBy("page_no")
    ranked = signals.withColumn("_block", number)
    ranked = ranked.withColumn("_run", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    joined = ranked.join(starts, [*CHAIN, "_block"])
    return joined.select(*signals.columns, (F.col("_start") + F.col("_run")).alias(name))


def stop_reason(paging: Paging) -> Column:
    """Why a chain ends at a page; NULL when it goes on."""
    stop = paging.stop
    n, page = F.col("n_records"), F.col("page_no")
    if paging.strategy == "none":
        return F.lit("single_page")
    reason = F.lit(None).cast("string")
    if paging.strategy == "cursor":
        reason = F.when(F.col("onward").isNull(), "no_cursor")
    elif paging.strategy == "offset":
        reason = F.when(n < paging.limit, "short_page")
    elif paging.strategy == "page_number" and paging.page_size is not None:
        reason = F.when(n < paging.page_size, "short_page")
    elif paging.strategy in ("link_header", "next_url"):
        # The way on decides alone; these strategies have no stop condition.
        return F.when(F.col("onward").isNull(), "no_next_page")
    if stop is None:
        return reason
    tests = {
        "empty_page": n == 0,
        "field": F.col("field_hit"),
        "total_count": F.col("fetched") >= F.col("total"),
        "total_pages": paging.start_page + page - 1 >= F.col("total"),
    }
    return F.when(F.coalesce(tests[stop.kind], F.lit(False)), stop.kind).otherwise(reason)


def next_params(paging: Paging) -> Column:
    """The request parameters of the page after this one."""
    page = F.col("page_no")
    pairs: list[Column] = []
    if paging.strategy == "cursor":
        pairs = [F.lit(paging.cursor_param), F.col("onward")]
    elif paging.strategy == "offset":
        pairs = [
            F.lit(paging.offset_param),
            (page.cast("bigint") * paging.limit).cast("string"),
            F.lit(paging.limit_param),
            F.lit(str(paging.limit)),
        ]
    elif paging.strategy == "page_number":
        pairs = [F.lit(paging.page_param), (page + paging.start_page).cast("string")]
        if paging.page_size_param and paging.page_size is not None:
            pairs += [F.lit(paging.page_size_param), F.lit(str(paging.page_size))]
    elif paging.strategy in ("link_header", "next_url"):
        pairs = [F.lit("url"), F.col("onward")]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def replay(signals: DataFrame, paging: Paging) -> DataFrame:
    """Per page: ``fetched`` so far (for a total count), ``stop_reason`` and ``next`` parameters."""
    needs_total = paging.stop is not None and paging.stop.kind == "total_count"
    if needs_total and paging.strategy in ("cursor", "offset", "page_number"):
        signals = with_running_total(signals)
        if "records_before" in signals.columns:
            signals = signals.withColumn("fetched", F.col("fetched") + F.col("records_before"))
    reason = stop_reason(paging)
    return signals.withColumn("stop_reason", reason).withColumn(
        "next", F.when(F.col("stop_reason").isNull(), next_params(paging))
    )


def chain_ends(replayed: DataFrame) -> DataFrame:
    """One row per chain: the page it stops at, pages and records up to there, and its state.

    ``complete`` chains reached a stop, ``open`` ones still have a next page, and
    ``gap`` ones miss a page before their end. Plain aggregates, reduced before the
    shuffle; the last two need the stop page first.
    """
    ends = replayed.groupBy(*CHAIN).agg(F.min(F.when(F.col("stop_reason").isNotNull(), F.col("page_no"))).alias("stop_page"))
    kept = keep_pages(replayed, ends)
    totals = kept.groupBy(*CHAIN).agg(
        F.count("*").alias("pages"),
        F.sum("n_records").alias("records"),
        F.max("page_no").alias("last_page"),
        F.max_by(F.struct("stop_reason", "next"), "page_no").alias("_last"),
        F.max("_stop").alias("stop_page"),
    )
    status = F.when(F.col("pages") < F.col("last_page"), "gap").when(F.col("stop_page").isNull(), "open").otherwise("complete")
    return totals.select(*CHAIN, "pages", "records", "last_page", "stop_page", "_last.stop_reason", "_last.next", status.alias("status"))


def usable_ends(replayed: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """Per chain, how far it can be written: to its stop, and never past a missing or ``bad`` page.

    ``replayed`` may have ``page_before``, the last page written by earlier runs (0 without). What can be written is the run of
    pages that starts right after it. ``last_page`` is the last usable page, NULL if there is none. ``status`` is ``complete``
    where the stop is reached, ``gap`` where pages wait behind a missing or bad one, ``open`` where more are to
    come. Everything is aggregates of small rows, folded by block first.
    """
    start = F.coalesce("page_before", F.lit(0)) if "page_before" in replayed.columns else F.lit(0)
    stop = F.min(F.when(F.col("stop_reason").isNotNull(), F.col("page_no"))).alias("stop_page")
    parts = page_runs(replayed, BLOCK, stop, F.max(start).alias("_start"))
    whole = parts.groupBy(*CHAIN, "_run").agg(
        F.min("first_page").alias("_first"), F.max("last_page").alias("_last"), F.min("stop_page").alias("stop_page"), F.max("_start").alias("_start")
    )
    after = F.col("_start").between(F.col("_first") - 1, F.col("_last") - 1)
    ends = whole.groupBy(*CHAIN).agg(
        F.min("stop_page").alias("stop_page"), F.max("_last").alias("_greatest"), F.max("_start").alias("_start"), F.max(F.when(after, F.col("_last"))).alias("_reach")
    )
    last = F.when(F.col("_reach").isNotNull(), F.least("stop_page", "_reach"))
    if bad is not None:
        ends = ends.join(bad.groupBy(*CHAIN).agg((F.min("page_no") - 1).alias("_sound")), CHAIN, "left")
        last = F.when(F.col("_reach").isNotNull(), F.least("stop_page", "_reach", "_sound"))
    ends = ends.withColumn("last_page", F.when(last > F.col("_start"), last))
    waiting = F.col("_greatest") > F.coalesce("last_page", "_start")
    status = F.when(F.col("stop_page") <= F.col("last_page"), "complete").when(waiting, "gap").otherwise("open")
    pages = F.coalesce(F.col("last_page") - F.col("_start"), F.lit(0)).cast("bigint")
    return ends.select(*CHAIN, "stop_page", "last_page", pages.alias("pages"), status.alias("status"))


def keep_pages(pages: DataFrame, ends: DataFrame) -> DataFrame:
    """The pages up to the end of their chain. ``pages`` may carry bodies: only the ends move."""
    stops = ends.select(*CHAIN, F.col("stop_page").alias("_stop"))
    joined = pages.join(stops, CHAIN, "left")
    return joined.filter(F.col("_stop").isNull() | (F.col("page_no") <= F.col("_stop")))


def missing_pages(signals: DataFrame) -> DataFrame:
    """The page before each gap, with the first page after it: a join on the page number."""
    known = signals.select(*CHAIN, "page_no")
    before = known.withColumn("page_no", F.col("page_no") + 1)
    holes = known.filter("page_no > 1").join(before, [*CHAIN, "page_no"], "left_anti")
    return holes.select(*CHAIN, F.col("page_no").alias("resumes_at"))


def chain_breaks(replayed: DataFrame, requested: DataFrame, param: str) -> DataFrame:
    """Pages whose request does not match what the page before them asked for.

    ``requested`` has the chain columns, ``page_no`` and the requested value in ``asked``.
    """
    promised = replayed.select(*CHAIN, (F.col("page_no") + 1).alias("page_no"), F.col("next")[param].alias("promised"))
    pairs = requested.join(promised, [*CHAIN, "page_no"])
    return pairs.filter(~F.col("asked").eqNullSafe(F.col("promised"))).select(*CHAIN, "page_no", "asked", "promised")


def record_positions(replayed: DataFrame) -> DataFrame:
    """Per page, how many records of the chain come before it."""
    total = replayed if "fetched" in replayed.columns else with_running_total(replayed)
    return total.select(*CHAIN, "page_no", (F.col("fetched") - F.col("n_records")).alias("before"))


def cap_pages(pages: DataFrame, positions: DataFrame, limit: int) -> DataFrame:
    """The pages that hold one of the first ``limit`` records of their chain, so that no other is decoded.

    ``positions`` comes from ``record_positions``. What moves is the list of pages to drop, without bodies.
    """
    beyond = positions.filter(F.col("before") >= limit).select(*CHAIN, "page_no")
    return pages.join(beyond, [*CHAIN, "page_no"], "left_anti")


def offset_requests(totals: DataFrame, paging: Paging) -> DataFrame:
    """All offset requests at once for streams whose ``total`` is known."""
    last = F.col("total") - 1
    steps = F.when(F.col("total") > 0, F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), F.lit(paging.limit).cast("bigint")))
    rest = [c for c in totals.columns if c != "total"]
    return totals.select(*rest, F.explode(steps).alias(paging.offset_param), F.lit(paging.limit).alias(paging.limit_param))


__all__ = [
    "Paging",
    "Stop",
    "cap_pages",
    "chain_breaks",
    "chain_ends",
    "decoded_pages",
    "fetch_id",
    "joined_runs",
    "keep_pages",
    "latest_signals",
    "missing_pages",
    "next_params",
    "offset_requests",
    "page_runs",
    "page_signals",
    "record_positions",
    "replay",
    "stop_reason",
    "usable_ends",
    "with_running_total",
]
