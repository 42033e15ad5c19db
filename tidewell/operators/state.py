"""Sync state: ``stream, partition_id, cursor, completed``, with a NULL partition for whole streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import matching_paths, path_exists, remove_path

STATE_SCHEMA = "stream string, partition_id string, cursor string, completed boolean"
# How far an open chain has been written, and the greatest cursor it has shown; not every state has these. ``cursor`` is
# the bound of a chain from its first page to its stop, where ``pending`` takes its place.
PROGRESS = {"page": "int", "records": "bigint", "pending": "string"}
FULL_SCHEMA = STATE_SCHEMA + "".join(f", {name} {kind}" for name, kind in PROGRESS.items())
KEY = ["stream", "partition_id"]
# State of so many chains goes to every task of a join; more is shuffled, which its many keys spread.
BROADCAST_CHAINS = 100_000


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def beside_rows(state: DataFrame) -> DataFrame:
    """``state`` for a join with pages or records: few chains are broadcast, as a shuffle by chain would bring all bodies of one into one task."""
    return F.broadcast(state) if state.limit(BROADCAST_CHAINS + 1).count() <= BROADCAST_CHAINS else state


def cursor_updates(rows: DataFrame) -> DataFrame:
    """Rows of ``stream, cursor`` and optionally ``partition_id, completed`` as state rows."""
    partition = F.col("partition_id") if "partition_id" in rows.columns else F.lit(None)
    completed = F.col("completed") if "completed" in rows.columns else F.lit(None)
    cursor = F.col("cursor") if "cursor" in rows.columns else F.lit(None)
    return rows.select(
        "stream",
        partition.cast("string").alias("partition_id"),
        cursor.cast("string").alias("cursor"),
        completed.cast("boolean").alias("completed"),
        *[F.col(name).cast(kind).alias(name) for name, kind in PROGRESS.items() if name in rows.columns],
    )


def upsert_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """State with updates applied; a NULL cursor, flag or progress in an update keeps the old one."""
    both = state.withColumn("_n", F.lit(0)).unionByName(cursor_updates(updates).withColumn("_n", F.lit(1)), allowMissingColumns=True)
    progress = [name for name in PROGRESS if name in both.columns]

    def newest(name: str):
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("_n"))).alias(name)

    merged = both.groupBy(*KEY).agg(newest("cursor"), newest("completed"), *[newest(name) for name in progress])
    return merged.select(*KEY, "cursor", F.coalesce("completed", F.lit(False)).alias("completed"), *progress)


def mark_completed(state: DataFrame, partitions: DataFrame) -> DataFrame:
    """State with the given partitions marked completed."""
    return upsert_state(state, partitions.select("stream", "partition_id", F.lit(True).alias("completed")))


def get_cursor(state: DataFrame, stream: str, partition_id: str | None = None) -> str | None:
    """One cursor: a single value for the driver."""
    row = state.filter(
        (F.col("stream") == stream) & F.col("partition_id").eqNullSafe(F.lit(partition_id))
    ).select("cursor").first()
    return row.cursor if row else None


def clear_state(state: DataFrame, stream: str | None = None) -> DataFrame:
    """State without one stream, or empty."""
    return state.filter(F.lit(False) if stream is None else F.col("stream") != stream)


def state_lines(state: DataFrame) -> DataFrame:
    """One JSON line per state row: the form that scales with the number of partitions."""
    fields = [*KEY, "cursor", "completed", *[name for name in PROGRESS if name in state.columns]]
    return state.select("stream", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("line"))


def parse_state_lines(lines: DataFrame, column: str = "line", progress: bool = False) -> DataFrame:
    """State rows from JSON lines, on request with the progress of open chains."""
    return lines.select(F.from_json(column, FULL_SCHEMA if progress else STATE_SCHEMA).alias("_s")).select("_s.*")


def export_state(state: DataFrame, per_doc: int | None = None) -> DataFrame:
    """The state as JSON documents, rows of ``stream``, ``doc``, as ``parse_state`` reads them.

    They are built on the executors. Without ``per_doc`` a stream is one document, which its partitions must fit into; with it a stream
    is as many documents as it takes for about that many partitions each, and reading all of them gives the state.
    """
    entry = F.struct("cursor", "completed")
    parts = F.collect_list(F.when(F.col("partition_id").isNotNull(), F.struct("partition_id", entry.alias("entry"))))
    if per_doc is None:
        dealt = state.withColumn("_doc", F.lit(0))
    else:
        sizes = state.groupBy("stream").agg(F.ceil(F.count("*") / per_doc).alias("_docs"))
        number = F.when(F.col("partition_id").isNull(), 0).otherwise(F.pmod(F.xxhash64("partition_id"), F.col("_docs")))
        dealt = state.join(sizes, "stream").withColumn("_doc", number)
    docs = dealt.groupBy("stream", "_doc").agg(
        F.max(F.when(F.col("partition_id").isNull(), F.col("cursor"))).alias("cursor"),
        F.map_from_entries(F.array_sort(parts)).alias("partitions"),
    )
    body = F.to_json(F.struct("cursor", "partitions"), {"ignoreNullFields": "false"})
    name = F.to_json(F.array("stream"))
    return docs.select("stream", F.concat(F.lit('{"streams":{'), name.substr(F.lit(2), F.length(name) - 2), F.lit(":"), body, F.lit("}}")).alias("doc"))


def import_state(spark: SparkSession, text: str) -> DataFrame:
    """State rows from a JSON document, with or without the outer ``streams``."""
    return parse_state(spark.createDataFrame([(text,)], "doc string"))


def parse_state(docs: DataFrame, column: str = "doc") -> DataFrame:
    """State rows from JSON documents in a column."""
    slice_type = "struct<cursor:string,completed:boolean>"
    stream_type = f"struct<cursor:string,partitions:map<string,{slice_type}>>"
    wrapped = F.from_json(column, f"struct<streams:map<string,{stream_type}>>").getField("streams")
    bare = F.from_json(column, f"map<string,{stream_type}>")
    opened = docs.select(F.explode(F.coalesce(wrapped, bare)).alias("stream", "_s"))
    whole = F.struct(F.lit(None).cast("string").alias("partition_id"), F.col("_s.cursor").alias("cursor"), F.lit(False).alias("completed"))
    parts = F.transform(
        F.map_entries(F.coalesce("_s.partitions", F.create_map().cast(f"map<string,{slice_type}>"))),
        lambda e: F.struct(
            e["key"].alias("partition_id"),
            e["value"]["cursor"].alias("cursor"),
            F.coalesce(e["value"]["completed"], F.lit(False)).alias("completed"),
        ),
    )
    head = F.filter(F.array(whole), lambda w: w["cursor"].isNotNull())
    return opened.select("stream", F.explode(F.concat(head, parts)).alias("_r")).select("stream", "_r.*")


def publish_state(state: DataFrame, folder: str, version: int) -> None:
    """Write a version of the state; it counts once its commit row is there.

    Data goes first and the commit row last, so a run that dies in between leaves
    the version before it in force, and its rerun overwrites the half-written one.
    """
    spark = state.sparkSession
    state.write.mode("overwrite").parquet(f"{folder}/versions/{version:010d}")
    commit = spark.createDataFrame([(version,)], "version bigint").coalesce(1)
    commit.write.mode("append").json(f"{folder}/commits")
    # The version before stays, for readers that opened it.
    for old in matching_paths(spark, f"{folder}/versions/*"):
        if int(old.rsplit("/", 1)[1]) < version - 1:
            remove_path(spark, old)


def committed_versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all committed versions, of which the last two are kept."""
    if not path_exists(spark, f"{folder}/commits"):
        return []
    commits = spark.read.schema("version bigint").json(f"{folder}/commits")
    return [r.version for r in commits.distinct().orderBy(F.col("version").desc()).limit(3).collect()]


def current_version(spark: SparkSession, folder: str) -> int | None:
    """The number of the last committed version, or None."""
    return max(committed_versions(spark, folder), default=None)


def read_state(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The last committed state, or that of an earlier version; empty when there is none."""
    if version is None:
        version = current_version(spark, folder)
    if version is None:
        return empty_state(spark)
    return spark.read.schema(T.StructType.fromDDL(FULL_SCHEMA)).parquet(f"{folder}/versions/{version:010d}")
