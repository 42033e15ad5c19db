"""The registered query of the repeated passages, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..queries.common import Query, table
from .repeats import remove_repeats


def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = remove_repeats(table(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op11_suffix_dedup": Query(op11_suffix_dedup)}
