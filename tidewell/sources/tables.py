"""Database tables, queries and files as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import TableSpec

# System schemas that a table listing leaves out.
SYSTEM_SCHEMAS = {
    "postgres": ("pg_catalog", "information_schema"),
    "mysql": ("mysql", "information_schema", "performance_schema", "sys"),
    "sqlite": (),
    "duckdb": ("information_schema", "pg_catalog"),
}


def qualified(table: str, default_schema: str = "public") -> str:
    """A table name with its schema."""
    return table if "." in table else f"{default_schema}.{table}"


def read_table(spark: SparkSession, spec: TableSpec, source: Mapping[str, Any]) -> DataFrame:
    """The rows of a stream.

    ``source`` holds ``format`` and reader options. For ``jdbc``, ``predicates`` (``partition_predicates``) or ``partition_column``,
    ``lower``, ``upper`` and ``partitions`` split the read over executors (a read in one task must be asked for); filters
    that are put on the result reach the database. For file formats, ``path`` is the
    folder that holds one dataset per table. Without a format, the catalog is used.
    """
    fmt = source.get("format")
    if spec.query and fmt != "jdbc":
        return spark.sql(spec.query)
    if not spec.query and not spec.table:
        raise ValueError(f"stream {spec.name!r} needs a table or a query")
    if fmt is None:
        return spark.table(spec.table)
    reader = spark.read.format(fmt).options(**source.get("options", {}))
    if fmt != "jdbc":
        return reader.load(f"{source['path']}/{spec.table}{source.get('suffix', '')}")
    if not source.get("partition_column") and not source.get("predicates") and source.get("partitions") != 1:
        raise ValueError("name predicates or a partition_column with its bounds, or ask for partitions=1: else one task reads the whole table")
    target = f"({spec.query}) q" if spec.query else qualified(spec.table)
    if source.get("predicates"):
        options = dict(source.get("options", {}))
        return spark.read.jdbc(options.pop("url"), target, predicates=list(source["predicates"]), properties=options)
    reader = reader.option("dbtable", target)
    if source.get("partition_column"):
        reader = reader.options(
            partitionColumn=source["partition_column"],
            lowerBound=str(source["lower"]),
            upperBound=str(source["upper"]),
            numPartitions=str(source.get("partitions", 64)),
        )
    return reader.load()


def quantile_cuts(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """Values that cut a key into ``parts`` of about equal rows, as text; fewer where one value holds several parts.

    The quantiles are approximate, folded before the shuffle, and all that reaches the driver; nulls are left out.
    """
    dtype = keys.select(column).schema[0].dataType
    if not isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"no quantiles of {dtype.simpleString()}")
    shares = [k / parts for k in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column, F.array(*[F.lit(s) for s in shares]), accuracy).alias("c"))
    rows = found.select(F.explode(F.array_distinct("c")).alias("c")).orderBy("c").select(F.col("c").cast("string").alias("c"))
    return [r.c for r in rows.collect()]


def partition_predicates(column: str, cuts: list[str], quoted: bool = False) -> list[str]:
    """Conditions that split a table at cuts: every row meets exactly one, rows without a key the last.

    ``quoted`` for keys that are written as text, such as dates. Each condition is one task of a database read
    (``read_table`` with ``predicates``); its column may well have an index, so no function stands around it.
    """
    written = ["'" + c.replace("'", "''") + "'" if quoted else c for c in cuts]
    if not written:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(written, written[1:])]
    return [f"{column} < {written[0]}", *inner, f"{column} >= {written[-1]}", f"{column} IS NULL"]


def listing(tables: DataFrame, engine: str) -> DataFrame:
    """``schema.table`` names from rows of ``table_schema, table_name``, system schemas left out."""
    kept = tables.filter(~F.lower("table_schema").isin(*SYSTEM_SCHEMAS[engine], ""))
    full = F.concat_ws(".", "table_schema", "table_name").alias("full_name")
    return kept.orderBy("table_schema", "table_name").select(full)


def list_tables(spark: SparkSession, source: Mapping[str, Any] | None = None, engine: str = "postgres") -> DataFrame:
    """The tables of a database, or of the Spark catalog when no source is given."""
    if source is None:
        shown = spark.sql("SHOW TABLES").filter(~F.col("isTemporary"))
        return listing(shown.select(F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name")), "sqlite")
    reader = spark.read.format("jdbc").options(**source.get("options", {}))
    if engine == "sqlite":
        rows = reader.option("query", "SELECT 'main' AS table_schema, name AS table_name FROM sqlite_master WHERE type = 'table'")
    else:
        rows = reader.option("query", "SELECT table_schema, table_name FROM information_schema.tables")
    return listing(rows.load(), engine)


def keyset_page(df: DataFrame, cursor: str, after: Any, size: int) -> DataFrame:
    """The next ``size`` rows after a cursor value, in cursor order."""
    if after is not None:
        df = df.filter(F.col(cursor) > F.lit(after).cast(df.schema[cursor].dataType))
    return df.orderBy(cursor).limit(size)
