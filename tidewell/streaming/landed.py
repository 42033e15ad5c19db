"""Syncs as available-now streaming queries: pick up what landed, write it, stop.

``stream_sync`` takes rows as they come; ``stream_landed`` takes landed pages, whose chains stay open between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import max_cursor
from ..operators.state import committed_versions, current_version, empty_state, publish_state, read_state, upsert_state
from ..plans.sync import chain_state, sync_landed
from ..session import matching_paths, path_exists, remove_path
from ..sinks.tables import append_dedup, write_stream_table
from ..sources.pages import page_outcome
from ..specs import StreamSpec, SyncSpec


def drop_repeats(stream: DataFrame, keys: list[str], moment: str, lookback_seconds: int) -> DataFrame:
    """One row per key among rows at most ``lookback_seconds`` apart; state older than that is dropped."""
    watched = stream.withWatermark(moment, f"{lookback_seconds} seconds")
    return watched.dropDuplicatesWithinWatermark(keys)


def stream_sync(
    stream: DataFrame,
    name: str,
    base: str,
    checkpoint: str,
    run_date: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    cursor_field: str | None = None,
    state_folder: str | None = None,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    buckets: int = 64,
) -> None:
    """Run a stream until everything that has landed is written, then stop.

    Every micro-batch writes its own slice, named by its number, and then publishes
    the state in the stream's own folder under ``state_folder``. A batch that is repeated after a failure
    replaces its slice, and a cursor never moves back, so rows are neither lost nor doubled. With ``keys`` the batch is
    merged into a table of the latest row per key instead.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        if keys:
            seen = Observation()
            if cursor_field:
                rows = rows.observe(seen, max_cursor(rows, cursor_field).alias("cursor"))
            append_dedup(rows, base, name, keys, order or [cursor_field], buckets, f"batch-{number:010d}")
            cursor = seen.get["cursor"] if cursor_field else None
        else:
            done = write_stream_table(
                rows, base, name, f"batch-{number:010d}", run_date=run_date, cursor_field=cursor_field
            )
            cursor = done["cursor"]
        if state_folder and cursor is not None:
            _advance(batch.sparkSession, f"{state_folder}/{name}", name, cursor)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _advance(spark: SparkSession, folder: str, name: str, cursor: str) -> None:
    """Publish the cursor of a batch in the stream's own line of versions; it never moves back, so repeats do no harm."""
    version = current_version(spark, folder)
    state = read_state(spark, folder)
    update = spark.createDataFrame([(name, cursor)], "stream string, cursor string")
    old = state.filter(F.col("stream") == name).select("stream", "cursor")
    # Numbers compare as numbers, everything else as text.
    rank = F.struct(F.col("cursor").try_cast("decimal(38,9)"), F.col("cursor"))
    best = update.unionByName(old).groupBy("stream").agg(F.max_by("cursor", rank).alias("cursor"))
    publish_state(upsert_state(state, best), folder, 0 if version is None else version + 1)


def stream_landed(
    pages: DataFrame,
    spec: StreamSpec,
    base: str,
    checkpoint: str,
    state_folder: str,
    run_date: str,
    sync: SyncSpec | None = None,
) -> None:
    """Sync a stream of landed pages (``stream_pages``) until everything that has landed is taken in, then stop.

    Pages may land in any order, over any number of batches. A batch is a run of ``sync_landed`` over its own pages and those
    that wait: pages behind a hole, or behind one that must be fetched again. What is written of a chain, its
    cursors, and the pages that wait are published together as one version per batch, which counts from its commit on. A
    batch that is repeated after a failure starts from the version before it and replaces its own slice,
    so every page is written once.
    """

    def write(batch: DataFrame, number: int) -> None:
        land_batch(batch, number, spec, base, state_folder, run_date, sync)

    query = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def land_batch(batch: DataFrame, number: int, spec: StreamSpec, base: str, state_folder: str, run_date: str, sync: SyncSpec | None = None) -> None:
    """Take in one batch of pages: what can be written is written, the rest waits for the next."""
    spark, folder = batch.sparkSession, f"{state_folder}/{spec.name}"
    before = max((v for v in committed_versions(spark, folder) if v < number), default=None)
    state, landed = empty_state(spark), batch.filter(F.col("stream") == spec.name)
    if before is not None:
        state = read_state(spark, folder, before)
        waited = f"{folder}/waiting/{before:010d}"
        if path_exists(spark, waited):
            landed = spark.read.schema(batch.schema).parquet(waited).unionByName(landed)
    done = sync_landed(landed, spec, state, base, f"batch-{number:010d}", sync, run_date=run_date)
    if done.status == "FAILED":
        raise RuntimeError(f"batch {number} of {spec.name!r}: {done.error}")
    _waiting(landed, done.state, spec.name).write.mode("overwrite").parquet(f"{folder}/waiting/{number:010d}")
    publish_state(done.state, folder, number)
    # The version before stays, for a batch that is repeated.
    for old in matching_paths(spark, f"{folder}/waiting/*"):
        if int(old.rsplit("/", 1)[1]) < (number if before is None else before):
            remove_path(spark, old)


def _waiting(landed: DataFrame, state: DataFrame, stream: str) -> DataFrame:
    """The pages that chains still need: those past what is written, in chains that are not at their stop."""
    known = chain_state(state, stream).select(F.col("partition_id").alias("_chain"), F.col("completed").alias("_done"), F.coalesce("page", F.lit(-1)).alias("_page"))
    joined = landed.withColumn("_chain", F.coalesce("partition_id", F.lit(""))).join(known, "_chain", "left")
    # A chain without a partition is back at page 0 once it has reached its stop.
    ended = F.coalesce("_done", F.lit(False)) | ((F.col("_chain") == "") & (F.col("_page") == 0))
    waiting = joined.filter(~ended & (F.col("page_no") > F.coalesce("_page", F.lit(0))) & (page_outcome(F.col("status")) == "ok"))
    return waiting.select(*landed.columns)
