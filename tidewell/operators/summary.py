"""Per-stream results and the summary of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTCOME_SCHEMA = "stream string, partition_id string, records bigint, pages bigint, errors bigint, error string"


def stream_results(outcomes: DataFrame) -> DataFrame:
    """One row per stream from outcomes of its partitions.

    Columns in: ``stream, partition_id, records, pages, errors``. A stream with
    any error is FAILED.
    """
    return outcomes.groupBy("stream").agg(
        F.when(F.sum("errors") > 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.sum("records").alias("records_synced"),
        F.sum("pages").alias("pages"),
        F.count("*").alias("partitions"),
        F.sum("errors").alias("errors"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """The one-row summary of a run."""
    ok = F.count_if(F.col("status") == "SUCCESS")
    failed = F.count_if(F.col("status") == "FAILED")
    # A PARTIAL stream has left some of its partitions out.
    status = F.when(ok == F.count("*"), "SUCCEEDED").when(failed == F.count("*"), "FAILED").otherwise("PARTIAL")
    return results.agg(
        status.alias("status"),
        F.coalesce(F.sum("records_synced"), F.lit(0)).alias("total_records"),
        F.count("*").alias("total_streams"),
        ok.alias("successful_streams"),
        failed.alias("failed_streams"),
    )
