"""What the registered queries share: table access and pages packed from tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import records_json


class Query(NamedTuple):
    """A query and, where SQL can say it, the same in SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


PER_PAGE = 500
PAGES_PER_CHAIN = 40


def chain_columns(key: str, per_page: int = PER_PAGE, pages: int = PAGES_PER_CHAIN) -> dict[str, Column]:
    """Where a row with this unique key lands: its chain and its page."""
    number = F.floor(F.col(key) / per_page)
    return {
        "partition_id": F.concat(F.lit("p"), F.floor(number / pages).cast("string")),
        "page_no": (F.pmod(number, F.lit(pages)) + 1).cast("int"),
    }


def packed(df: DataFrame, stream: str, key: str, item: Column | None = None) -> DataFrame:
    """Rows packed into pages by a unique key, at most ``PER_PAGE`` to a page.

    ``items`` holds the rows of a page in key order, as JSON texts unless ``item``
    says otherwise. The key is unique, so no page can grow past its size.
    """
    placed = df.select(
        F.lit(stream).alias("stream"),
        *[c.alias(n) for n, c in chain_columns(key).items()],
        F.struct(F.col(key).alias("k"), (records_json(df) if item is None else item).alias("item")).alias("_row"),
    )
    pages = placed.groupBy("stream", "partition_id", "page_no").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    return pages.select(
        "stream", "partition_id", "page_no", F.transform("_rows", lambda r: r["item"]).alias("items"), F.col("_rows")[0]["k"].alias("first_key")
    )


def json_array(items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", items), F.lit("]"))


def envelope(pages: DataFrame, **fields: Column) -> DataFrame:
    """Pages with a JSON body: the items under ``data``, then the given fields, which are JSON texts."""
    parts = [F.lit('{"data":'), json_array(F.col("items"))]
    for name, value in fields.items():
        parts += [F.lit(f',"{name}":'), value]
    return pages.withColumn("body", F.concat(*parts, F.lit("}"))).drop("items")


def with_chain_totals(pages: DataFrame) -> DataFrame:
    """Add the number of records and pages of each chain: a join on the chain."""
    sized = pages.select("stream", "partition_id", F.size("items").cast("bigint").alias("_n"))
    totals = sized.groupBy("stream", "partition_id").agg(F.sum("_n").alias("total"), F.count("*").alias("page_count"))
    return pages.join(totals, ["stream", "partition_id"])
