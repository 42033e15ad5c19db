"""Bad records: fail, skip or retry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class TooManyErrors(RuntimeError):
    """More bad records than the sync allows."""


def good_records(decoded: DataFrame, strategy: str = "fail", watch: Observation | None = None) -> DataFrame:
    """The readable records.

    ``fail`` ends the job at the first bad one. ``skip`` and ``retry`` drop them;
    ``watch`` then counts them in the same job, for ``check_errors``.
    """
    if strategy == "fail":
        # In the projection rather than a filter, which would be pushed down and read bodies twice.
        broken = F.raise_error(F.concat(F.lit("cannot decode: "), F.col("error"))).cast("string")
        return decoded.withColumn("record", F.coalesce("record", broken)).drop("error")
    if strategy not in ("skip", "retry"):
        raise ValueError(f"unknown error strategy: {strategy}")
    if watch is not None:
        decoded = decoded.observe(watch, F.count("error").alias("errors"))
    return decoded.filter("error IS NULL").drop("error")


def bad_records(decoded: DataFrame) -> DataFrame:
    """The records that could not be read, for an error table."""
    return decoded.filter("error IS NOT NULL").drop("record")


def retry_worklist(decoded: DataFrame) -> DataFrame:
    """The pages to fetch again, each once, with their number of bad records."""
    return bad_records(decoded).groupBy("stream", "partition_id", "page_no").agg(F.count("*").alias("errors"))


def chain_errors(pages: DataFrame, strategy: str, max_errors: int = 100) -> DataFrame:
    """Chains with bad records: their number ``errors``, and whether that makes them ``failed``.

    ``pages`` has ``n_bad`` per page, so nothing is decoded for it. With ``fail`` one bad record is too many, with
    ``skip`` more than ``max_errors`` are; with ``retry`` pages are fetched again and no chain fails.
    """
    errors = pages.filter("n_bad > 0").groupBy("stream", "partition_id").agg(F.sum("n_bad").alias("errors"))
    bound = {"fail": F.lit(0), "skip": F.lit(max_errors)}.get(strategy)
    return errors.withColumn("failed", F.lit(False) if bound is None else F.col("errors") > bound)


def check_errors(errors: int, max_errors: int = 100) -> None:
    if errors > max_errors:
        raise TooManyErrors(f"{errors} bad records, {max_errors} allowed")
