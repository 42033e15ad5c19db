"""Asynchronous jobs: from a log of poll responses to the jobs whose results may be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import path_variant
from ..specs import JobSpec


def job_status(polls: DataFrame, spec: JobSpec, job: str = "job_id", polled_at: str = "polled_at", body: str = "body", tiebreak: str | None = None) -> DataFrame:
    """The latest state of each job: Completed, Failed, Unknown, TimedOut or InProgress.

    Only the short status text of a poll is folded, before the shuffle.
    """
    value = path_variant(F.try_parse_json(body), spec.status_path)
    text = F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))
    order = F.struct(polled_at, *([tiebreak] if tiebreak else []))
    seen = polls.select(F.col(job), order.alias("_at"), F.coalesce(text, F.lit("")).alias("_status"))
    last = seen.groupBy(job).agg(F.max_by("_status", "_at").alias("status"), F.count("*").alias("attempts"))
    state = (
        F.when(F.col("status") == spec.completed_value, "Completed")
        .when(F.col("status").isin(*spec.failed_values), "Failed")
        .when(F.col("attempts") >= spec.max_attempts, "TimedOut")
        .when(F.col("status") == "", "Unknown")
        .otherwise("InProgress")
    )
    return last.select(
        job, "status", "attempts", state.alias("state"), state.isin("Completed", "Failed", "TimedOut").alias("terminal")
    )


def completed_downloads(downloads: DataFrame, status: DataFrame, job: str = "job_id") -> DataFrame:
    """The downloaded pages of completed jobs."""
    done = status.filter(F.col("state") == "Completed").select(job)
    return downloads.join(done, job, "left_semi")
