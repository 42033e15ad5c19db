"""Landed response pages: one row per HTTP response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = (
    "stream string, partition_id string, page_no int, url string, status int, "
    "headers map<string,string>, body string, fetched_at timestamp"
)

PAGE_KEY = ("stream", "partition_id", "page_no")

# Status codes that are worth a retry.
RATE_LIMITED = 429
RETRYABLE = (500, 502, 503, 504, 520, 521, 522, 523, 524)


def read_pages(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """Pages landed as Parquet or as JSON lines."""
    return spark.read.format(fmt).schema(PAGE_SCHEMA).load(folder)


def stream_pages(spark: SparkSession, folder: str, fmt: str = "parquet", max_files: int = 1000) -> DataFrame:
    """The same pages as a stream that picks up new files."""
    return (
        spark.readStream.format(fmt).schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).load(folder)
    )


def page_outcome(status: Column) -> Column:
    """What becomes of a page: ok, rate_limited, retry, client_error or server_error."""
    return (
        F.when(status == RATE_LIMITED, F.lit("rate_limited"))
        .when(status.isin(*RETRYABLE), F.lit("retry"))
        .when(status.between(400, 499), F.lit("client_error"))
        .when(status.between(500, 599), F.lit("server_error"))
        .otherwise(F.lit("ok"))
    )


def route_pages(pages: DataFrame) -> DataFrame:
    """Add ``outcome``, and ``retry_after`` seconds where the server asked to wait."""
    asked = F.try_element_at(F.col("headers"), F.lit("retry-after")).try_cast("bigint")
    wait = F.when(F.col("status") == RATE_LIMITED, F.coalesce(asked, F.lit(60).cast("bigint")))
    return pages.withColumns({"outcome": page_outcome(F.col("status")), "retry_after": wait})


def latest_fetch(pages: DataFrame) -> DataFrame:
    """One row per page: its last successful fetch.

    ``max_by`` reduces repeats before the shuffle, so a page that was fetched
    over and over does not pile up in one task.
    """
    keys = [F.col(k) for k in PAGE_KEY]
    rest = [c for c in pages.columns if c not in PAGE_KEY]
    newest = F.max_by(F.struct(*rest), F.struct("fetched_at", F.xxhash64("body"))).alias("_page")
    ok = pages.filter(page_outcome(F.col("status")) == "ok")
    return ok.groupBy(*keys).agg(newest).select(*PAGE_KEY, "_page.*").select(*pages.columns)
