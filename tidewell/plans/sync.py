"""Whole runs: from landed pages or tables to written streams, state and summary.

Each run writes data first and publishes state last, so that a run that dies can
be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any
from urllib.parse import quote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import conform
from ..operators.errors import TooManyErrors, bad_records, chain_errors
from ..operators.incremental import greatest_cursors, max_cursor, newer_than, newer_than_state, slice_cursors
from ..operators.messages import log_messages, state_messages, summary_message
from ..operators.paging import CHAIN, decoded_pages, latest_signals, record_positions, replay, usable_ends
from ..operators.schema import quick_table_schema, stored_type
from ..operators.state import PROGRESS, STATE_SCHEMA, beside_rows, empty_state, get_cursor, upsert_state
from ..operators.summary import run_summary
from ..session import path_exists, release, staged
from ..sinks.tables import PARTITION, append_dedup, stream_path, write_stream_table
from ..sources.decode import item_records
from ..sources.pages import page_outcome
from ..specs import StreamSpec, SyncSpec, TableSpec


@dataclass
class SyncResult:
    """What a run did with one stream; ``updates`` are the state rows it adds.

    ``partitions`` has the status, pages and records of every chain, ``bad`` the records that could not be read, and
    ``refetch`` the pages to fetch again.
    """

    stream: str
    status: str
    records: int
    cursor: str | None
    state: DataFrame
    updates: DataFrame | None = None
    error: str | None = None
    partitions: DataFrame | None = None
    bad: DataFrame | None = None
    refetch: DataFrame | None = None


@dataclass
class Landed:
    """The records of the pages that count, how far each chain goes, and what decides it.

    ``pages`` are the decoded fetches as stored, ``inside`` the signals of the pages that count, with ``n_bad``.
    ``scratch`` names what is stored for ``records`` and can go once they are written.
    """

    records: DataFrame
    ends: DataFrame
    pages: DataFrame
    inside: DataFrame
    scratch: list[str]


def _write(
    df: DataFrame,
    base: str,
    stream: str,
    run_id: str,
    sync: SyncSpec,
    keys: tuple[str, ...],
    cursor: str | None,
    floor: str | None,
    **options: Any,
) -> dict[str, Any]:
    if sync.write_mode != "append_dedup":
        return write_stream_table(
            df, base, stream, run_id, cursor_field=cursor, cursor_floor=floor, mode=sync.write_mode, **options
        )
    if not keys:
        raise ValueError(f"append_dedup of {stream!r} needs a primary key")
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if cursor:
        metrics.append(max_cursor(df, cursor, floor=floor).alias("cursor"))
    append_dedup(
        df.observe(seen, *metrics), base, stream, list(keys), [cursor] if cursor else [], sync.buckets, run_id, options.get("check"), options.get("shape")
    )
    path = f"{stream_path(base, stream)}/batch=b-{quote(run_id, safe='')}"
    return {"rows": seen.get["rows"], "cursor": seen.get.get("cursor"), "path": path if path_exists(df.sparkSession, path) else None}


def sync_table(
    df: DataFrame,
    spec: TableSpec,
    state: DataFrame,
    base: str,
    run_id: str,
    sync: SyncSpec | None = None,
    **write_options: Any,
) -> SyncResult:
    """Copy the new rows of a table: one scan that filters, writes, counts and finds the cursor."""
    sync = sync or SyncSpec()
    cursor = get_cursor(state, spec.name) if spec.cursor_field and sync.sync_mode == "incremental" else None
    rows = newer_than(df, spec.cursor_field, cursor, spec.lookback_seconds) if cursor else df
    done = _write(rows, base, spec.name, run_id, sync, spec.primary_key, spec.cursor_field, cursor, **write_options)
    new_cursor = done["cursor"] or cursor
    updates = _cursor_row(df.sparkSession, spec.name, new_cursor)
    return SyncResult(spec.name, "SUCCESS", done["rows"], new_cursor, upsert_state(state, updates), updates)


def _cursor_row(spark: SparkSession, stream: str, cursor: str | None) -> DataFrame:
    rows = [] if cursor is None else [(stream, None, cursor, None)]
    return spark.createDataFrame(rows, STATE_SCHEMA)


def chain_state(state: DataFrame, stream: str) -> DataFrame:
    """The state of a stream's chains; the state without a partition is that of the chain with the empty name."""
    mine = state.filter(F.col("stream") == stream).withColumn("partition_id", F.coalesce("partition_id", F.lit("")))
    for name, kind in PROGRESS.items():
        if name not in mine.columns:
            mine = mine.withColumn(name, F.lit(None).cast(kind))
    return mine


def landed(pages: DataFrame, spec: StreamSpec, state: DataFrame | None = None) -> Landed:
    """The decoded records of the pages that count.

    Left out are pages of completed partitions, pages that did not succeed, pages that earlier runs have written, all but
    the last fetch of a page, and pages past a stop or a missing page. Streams without partitions are one chain
    with an empty name. Bodies are read once, into records and one small row of signals per page; everything is decided
    on the signals.
    """
    ok = pages.filter((F.col("stream") == spec.name) & (page_outcome(F.col("status")) == "ok"))
    ok = ok.withColumn("partition_id", F.coalesce("partition_id", F.lit("")))
    if state is not None:
        known = chain_state(state, spec.name).select(*CHAIN, F.col("completed").alias("_completed"), F.col("page").alias("_page"))
        ok = ok.join(beside_rows(known), CHAIN, "left").filter("NOT coalesce(_completed, false) AND page_no > coalesce(_page, 0)").drop("_completed", "_page")
    scratch: list[str] = []
    decoded = staged(decoded_pages(ok, spec.paging, spec.fmt, spec.records_path, **spec.decode_options), "decoded", scratch)
    return _chosen(decoded, spec, state, scratch)


def _chosen(decoded: DataFrame, spec: StreamSpec, state: DataFrame | None, scratch: list[str], sound: DataFrame | None = None) -> Landed:
    """What counts of the decoded fetches; chains also end before a page of ``sound``, if that is given."""
    spark = decoded.sparkSession
    signals = decoded.drop("items")
    mine = chain_state(state if state is not None else empty_state(spark), spec.name)
    written = mine.select(*CHAIN, F.col("page").alias("page_before"), F.coalesce("records", F.lit(0)).alias("records_before"))
    fresh = latest_signals(signals).join(written, CHAIN, "left").fillna(0, ["page_before", "records_before"])
    replayed = replay(fresh, spec.paging)
    ends = staged(usable_ends(replayed, sound), "ends")
    inside = replayed.join(ends.select(*CHAIN, "last_page"), CHAIN).filter(F.col("page_no") <= F.col("last_page"))
    room, bad = F.lit(None).cast("bigint"), F.size("bad")
    if spec.max_records:
        before = record_positions(replayed if "fetched" not in replayed.columns else replayed.drop("fetched"))
        inside = inside.join(before, [*CHAIN, "page_no"])
        room = spec.max_records - F.col("before") - F.col("records_before")
        bad = F.size(F.filter("bad", lambda i: i < room))
    inside = inside.select(*CHAIN, "page_no", "row", "n_records", bad.cast("bigint").alias("n_bad"), room.alias("_room"))
    inside = staged(inside, "inside", scratch)
    ends = ends.join(inside.groupBy(*CHAIN).agg(F.sum("n_records").alias("records")), CHAIN, "left").fillna(0, ["records"])
    if spec.max_records:
        inside = inside.filter("_room > 0")
    # Usually nothing or little is to drop: that list moves, not the records.
    kept = decoded
    if decoded.count() > inside.count():
        kept = decoded.join(staged(signals.select("row").join(inside.select("row"), "row", "left_anti"), "drop", scratch), "row", "left_anti")
    records = item_records(kept.select(*CHAIN, "page_no", "items"), spec.fmt)
    if spec.max_records:
        # Only the last page of a chain is cut.
        cut = inside.filter(F.col("_room") < F.col("n_records")).select(*CHAIN, "page_no", "_room")
        records = records.join(cut, [*CHAIN, "page_no"], "left")
        records = records.filter(F.col("_room").isNull() | (F.col("at") < F.col("_room"))).drop("_room")
    return Landed(records.drop("at"), ends, decoded, inside, scratch)


def landed_records(pages: DataFrame, spec: StreamSpec, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The records of ``landed`` and the ends of its chains."""
    found = landed(pages, spec, state)
    return found.records, found.ends


def sync_landed(
    pages: DataFrame,
    spec: StreamSpec,
    state: DataFrame,
    base: str,
    run_id: str,
    sync: SyncSpec | None = None,
    schema: T.StructType | None = None,
    **write_options: Any,
) -> SyncResult:
    """Sync a stream from landed pages: replay, decode, conform, filter, write, and update state.

    Every partition has its own cursor and its own progress: a late partition is read in full, a chain with
    a hole is written up to the hole and goes on when the page lands, an open chain goes on after the last page written,
    and only chains written to their stop are marked completed. The cursor that bounds a chain stays the same until
    its stop is written, so what later pages hold counts whatever the order of a source is.

    Without a ``schema`` a first pass infers it. With ``skip`` bad records are left out and handed on; with ``retry`` a chain ends before
    its first page with a bad record, and those pages are handed on to be fetched again. Bad records are known
    before anything is written: too many of them fail the run, or, with ``fail_fast`` off, leave their partition out (status
    ``failed``) and the run PARTIAL.
    """
    sync = sync or SyncSpec()
    found = landed(pages, spec, state)
    scratch = found.scratch
    try:
        return _sync_found(found, spec, state, base, run_id, sync, schema, **write_options)
    finally:
        release(pages.sparkSession, scratch)


def _sync_found(
    found: Landed, spec: StreamSpec, state: DataFrame, base: str, run_id: str, sync: SyncSpec, schema: T.StructType | None, **write_options: Any
) -> SyncResult:
    spark = state.sparkSession
    mine = chain_state(state, spec.name)
    incremental = bool(spec.cursor_field) and sync.sync_mode == "incremental"
    floor = get_cursor(state, spec.name) if incremental else None
    bad = refetch = None
    if sync.error_strategy == "retry":
        refetch = staged(found.inside.filter("n_bad > 0").select(*CHAIN, "page_no", F.col("n_bad").alias("errors")), "refetch")
        if refetch.limit(1).count():
            found = _chosen(found.pages, spec, state, found.scratch, refetch)
    # One row per chain with errors; of these only sums reach the driver.
    errors = chain_errors(found.inside, sync.error_strategy, sync.max_errors)
    total, failed = errors.agg(F.coalesce(F.sum("errors"), F.lit(0)), F.count_if("failed")).first()
    if total and sync.error_strategy == "fail" and sync.fail_fast:
        raise ValueError(f"cannot decode {total} records of {spec.name!r}")
    if sync.error_strategy == "skip":
        bad = bad_records(found.records)
        bad = staged(bad, "bad") if total else spark.createDataFrame([], bad.schema)
        if sync.fail_fast and total > sync.max_errors:
            error = str(TooManyErrors(f"{total} bad records, {sync.max_errors} allowed"))
            return SyncResult(spec.name, "FAILED", 0, floor, state, error=error, partitions=staged(_outcomes(found.ends, "failed"), "outcomes"), bad=bad)
    records, ends, outcomes = found.records, found.ends, _outcomes(found.ends)
    error = None
    if failed:
        left_out = staged(errors.filter("failed").select(*CHAIN, F.lit(True).alias("_failed")), "failed")
        outcomes = found.ends.join(left_out, CHAIN, "left").select(*CHAIN, "pages", "records", F.when(F.col("_failed"), "failed").otherwise(F.col("status")).alias("status"))
        records, ends = records.join(left_out, CHAIN, "left_anti"), ends.join(left_out, CHAIN, "left_anti")
        error = f"{failed} partitions with bad records left out"
    good = records.filter("error IS NULL").select(F.col("partition_id").alias(PARTITION), "record")
    if schema is None:
        # What the run tells nothing of is left to others; the schemas of all runs meet when the table is read.
        shape = quick_table_schema(good, unknown=True)
        schema = stored_type(shape)
        write_options["shape"] = T.StructType([T.StructField(PARTITION, T.StringType()), *shape.fields])
    status = "PARTIAL" if failed else "SUCCESS"
    if failed and not ends.limit(1).count():
        return SyncResult(spec.name, "FAILED", 0, floor, state, error=error, partitions=staged(outcomes, "outcomes"), bad=bad, refetch=refetch)
    # Without records, or without the cursor in any of them, there is no column to filter by.
    field = spec.cursor_field if spec.cursor_field and spec.cursor_field.split(".")[0] in schema.names else None
    done: dict[str, Any] = {"rows": 0, "cursor": None, "path": None}
    cursors = None
    if schema.fields:
        rows = conform(good, schema)
        if incremental and field:
            bounds = mine.filter("cursor IS NOT NULL").select(F.col("partition_id").alias(PARTITION), "cursor")
            rows = newer_than_state(rows, beside_rows(bounds), [PARTITION], field)
        done = _write(rows, base, spec.name, run_id, sync, spec.primary_key, field, floor, **write_options)
        if field:
            shown = mine.select("partition_id", F.coalesce("pending", "cursor").alias("cursor"))
            if done["path"]:
                stored = spark.read.format(write_options.get("fmt", "parquet")).load(done["path"])
                per = slice_cursors(stored, [PARTITION], field)
                shown = shown.unionByName(per.select(F.col(PARTITION).alias("partition_id"), "cursor"))
            cursors = greatest_cursors(shown, ["partition_id"], rows, field)
    new_cursor = done["cursor"] or floor
    updates = staged(_progress(ends, mine, cursors, new_cursor), "updates")
    return SyncResult(spec.name, status, done["rows"], new_cursor, upsert_state(state, updates), updates, error, staged(outcomes, "outcomes"), bad, refetch)


def _progress(ends: DataFrame, mine: DataFrame, cursors: DataFrame | None, newest: str | None) -> DataFrame:
    """State rows of the chains: marks of completed partitions, how far the others are written, and their cursors.

    ``cursors`` are the greatest that each chain has shown; they become the bound of the next run once the stop is
    reached, and are pending until then. A chain without a partition starts anew once it has reached its stop. A stream
    with partitions has one row more, for the newest cursor of all.
    """
    whole = F.col("partition_id") == ""
    complete = F.col("status") == "complete"
    before = mine.select(*CHAIN, F.coalesce("records", F.lit(0)).alias("_before"))
    rows = ends.join(before, CHAIN, "left").filter("last_page IS NOT NULL")
    rows = rows.withColumn("_shown", F.lit(None).cast("string")) if cursors is None else rows.join(cursors.withColumnRenamed("cursor", "_shown"), "partition_id", "left")
    chains = rows.select(
        "stream",
        F.when(~whole, F.col("partition_id")).alias("partition_id"),
        F.when(complete, F.col("_shown")).alias("cursor"),
        F.when(~whole, complete).alias("completed"),
        F.when(whole & complete, 0).otherwise(F.col("last_page")).cast("int").alias("page"),
        F.when(whole & complete, 0).otherwise(F.col("records") + F.coalesce("_before", F.lit(0))).cast("bigint").alias("records"),
        F.col("_shown").alias("pending"),
    )
    if newest is None:
        return chains
    over = ends.groupBy("stream").agg(F.min("partition_id").alias("_least")).filter("_least <> ''")
    return chains.unionByName(over.select("stream", F.lit(newest).alias("cursor")), allowMissingColumns=True)


def _outcomes(ends: DataFrame, status: str | None = None) -> DataFrame:
    return ends.select(*CHAIN, "pages", "records", (F.lit(status) if status else F.col("status")).alias("status"))


def sync_all(
    pages: DataFrame,
    streams: Sequence[tuple[StreamSpec, SyncSpec]],
    state: DataFrame,
    base: str,
    run_id: str,
    fail_fast: bool = False,
    **write_options: Any,
) -> tuple[DataFrame, DataFrame]:
    """Sync several streams from landed pages; gives per-stream results and the new state.

    A stream that fails leaves its state as it was, and the others go on unless
    ``fail_fast`` is set. Every stream starts from the state before the run, and all
    updates are applied at once.
    """
    rows, updates = [], []
    for spec, sync in streams:
        try:
            done = sync_landed(pages, spec, state, base, run_id, sync, **write_options)
        except (PySparkException, ValueError) as error:
            done = SyncResult(spec.name, "FAILED", 0, None, state, None, str(error).splitlines()[0])
        rows.append((done.stream, done.status, done.records, done.cursor, done.error))
        if done.updates is not None:
            updates.append(done.updates)
        if done.status == "FAILED" and fail_fast:
            break
    results = pages.sparkSession.createDataFrame(
        rows, "stream string, status string, records_synced bigint, cursor string, error string"
    )
    if updates:
        state = upsert_state(state, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), updates))
    return results, state


def run_messages(results: DataFrame, state: DataFrame) -> DataFrame:
    """What a run says at its end, in the order of ``step``: a STATE and a LOG per stream, the SYNC_SUMMARY last.

    ``results`` and ``state`` are those of ``sync_all``; RECORD messages come from the tables (``record_messages``).
    """
    cursors = state.filter("partition_id IS NULL AND cursor IS NOT NULL").select("stream", "cursor")
    said = F.concat_ws(" ", "stream", F.lower("status"), F.concat(F.lit("rows="), F.col("records_synced").cast("string")))
    parts = [
        state_messages(cursors),
        log_messages(results.filter("status = 'SUCCESS'"), "INFO", said),
        log_messages(results.filter("status <> 'SUCCESS'"), "ERROR", said),
        summary_message(run_summary(results)),
    ]
    return reduce(DataFrame.unionByName, [part.withColumn("step", F.lit(step)) for step, part in enumerate(parts)])
