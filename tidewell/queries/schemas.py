"""Schema inference and catalogs over the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators.catalog import column_stats, discover, sample, table_catalog
from ..operators.conform import conform, to_records
from ..operators.schema import (
    describe_fields,
    format_name,
    infer_paths,
    merge_paths,
    quick_table_schema,
    table_schema,
)
from ..specs import StreamSpec, TableSpec
from .common import Query, table


def event_records(spark, folder):
    """Events as JSON with a field that is missing, one that is null and one of two kinds."""
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    code = F.when(kind == "signup", kind.cast("variant")).otherwise(F.col("user_id").cast("variant"))
    ratio = F.when(kind == "view", F.col("user_id").cast("variant")).otherwise((F.col("user_id") + 0.5).cast("variant"))
    fields = [
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"),
        F.when(kind != "error", F.col("value")).alias("value"),
        F.when(kind == "click", F.parse_json(F.lit("null"))).otherwise(kind.cast("variant")).alias("kind"),
        code.alias("code"),
        ratio.alias("ratio"),
    ]
    return events.select(F.to_json(F.struct(*fields)).alias("record"))


def nested_records(spark, folder):
    """Orders as nested JSON: an object, an array of strings and an array of objects."""
    orders = table(spark, folder, "orders")
    line = F.struct(
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") == "F", F.lit("2024-01-01")).alias("closed"),
    )
    extra = F.struct((F.col("o_totalprice") + 1).alias("price"), F.lit(None).cast("string").alias("closed"))
    return orders.select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("id"),
                F.struct(F.col("o_custkey").alias("key"), F.concat(F.col("o_custkey"), F.lit("@example.com")).alias("mail")).alias("buyer"),
                F.array("o_orderstatus", "o_orderpriority").alias("tags"),
                F.array(line, extra).alias("lines"),
            )
        ).alias("record")
    )


def infer_fields(spark, folder):
    return describe_fields(infer_paths(event_records(spark, folder)))


def infer_nested(spark, folder):
    return describe_fields(infer_paths(nested_records(spark, folder)))


def infer_merged(spark, folder):
    """Two streams with one shared field of different kinds, inferred apart and merged."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("ref"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("ref"), "o_totalprice")
    parts = [infer_paths(to_records(df), depth=1) for df in (customers, orders)]
    return describe_fields(merge_paths(*parts))


def format_detect(spark, folder):
    def texts(name, *columns):
        df = table(spark, folder, name)
        return df.select(F.explode(F.array(*columns)).alias("text"))

    digest = F.md5("c_name")
    uuid = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    parts = [
        texts("pages", "url", "html"),
        texts("documents", "source", "text"),
        texts("events", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "props"),
        texts("orders", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority"),
        texts("customer", F.concat("c_name", F.lit("@example.com")), uuid),
    ]
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.groupBy(F.coalesce(format_name(F.col("text")), F.lit("none")).alias("format")).agg(F.count("*").alias("texts"))


def infer_and_conform(spark, folder):
    """Both passes of a sync without a stored schema."""
    records = nested_records(spark, folder)
    rows = conform(records, quick_table_schema(records))
    return rows.select(
        "id",
        F.col("buyer.key").alias("buyer"),
        F.array_join("tags", "|").alias("tags"),
        F.col("lines")[0]["closed"].alias("closed"),
        F.round(F.col("lines")[1]["price"] - F.col("lines")[0]["price"]).cast("bigint").alias("step"),
    )


def inferred_columns(spark, folder):
    """The table schema of the event records, one row per column, next to the values it holds."""
    records = event_records(spark, folder)
    schema = table_schema(infer_paths(records))
    rows = conform(records, schema)
    folded = rows.agg(*[F.count(f.name).alias(f.name) for f in schema.fields])
    entries = [
        F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("present"))
        for f in schema.fields
    ]
    return folded.select(F.inline(F.array(*entries)))


def column_catalog(spark, folder):
    names = ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations")
    return reduce(lambda a, b: a.unionByName(b), [column_stats(table(spark, folder, n), n) for n in names])


def discover_catalog(spark, folder):
    streams = [
        (StreamSpec("events", primary_key=("event_id",), cursor_field="at"), event_records(spark, folder)),
        (StreamSpec("orders"), nested_records(spark, folder)),
    ]
    found = discover(spark, streams)
    schema = F.from_json("json_schema", "properties map<string,struct<type:string>>, required array<string>")
    return found.select(
        "name",
        F.array_join(F.array_sort(F.map_keys(schema["properties"])), ",").alias("fields"),
        F.array_join(schema["required"], ",").alias("required"),
        "source_defined_cursor",
        F.array_join("supported_sync_modes", ",").alias("modes"),
        F.array_join(F.flatten("source_defined_primary_key"), ",").alias("primary_key"),
    )


def discover_sample(spark, folder):
    records = to_records(table(spark, folder, "events"), "event_id")
    first = sample(records, 100, "event_id")
    return describe_fields(infer_paths(first)).select("path", "n", "json_type", "required")


def table_types(spark, folder):
    tables = [(TableSpec(n), table(spark, folder, n)) for n in ("orders", "events")]
    found = table_catalog(spark, tables)
    fields = F.from_json("json_schema", "properties map<string,struct<type:array<string>,format:string>>")["properties"]
    opened = found.select("name", F.explode(fields).alias("field", "d"))
    kinds = opened.select("name", "field", F.col("d.type")[0].alias("json_type"), F.col("d.format").alias("format"))
    stats = column_stats(table(spark, folder, "orders"), "orders").unionByName(
        column_stats(table(spark, folder, "events"), "events")
    )
    return kinds.join(stats.select(F.col("stream").alias("name"), "field", "present"), ["name", "field"])


def _fields(rows: list[tuple]) -> str:
    """SQL for described fields: path, source, condition, JSON type, column type, format, nullable, required."""
    parts = []
    for path, source, n, json_type, column_type, fmt, nullable, required in rows:
        fmt = f"'{fmt}'" if fmt else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{path}' AS path, CAST({n} AS BIGINT) AS n, '{json_type}' AS json_type, '{column_type}' AS column_type, "
            f"{fmt} AS format, {nullable} AS nullable, {required} AS required FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _columns_sql(names: dict[str, list[tuple[str, str]]]) -> str:
    parts = []
    for name, columns in names.items():
        for column, kind in columns:
            parts.append(
                f"SELECT '{name}' AS stream, '{column}' AS field, '{kind}' AS json_type, count(*) AS records, "
                f"count({column}) AS present, count({column}) < count(*) AS nullable FROM {name}"
            )
    return " UNION ALL ".join(parts)


_COLUMNS = {
    "customer": [("c_custkey", "integer"), ("c_name", "string"), ("c_nationkey", "integer"), ("c_acctbal", "number"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "integer"), ("s_name", "string"), ("s_nationkey", "integer"), ("s_acctbal", "number")],
    "part": [("p_partkey", "integer"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "integer"), ("p_retailprice", "number")],
    "orders": [("o_orderkey", "integer"), ("o_custkey", "integer"), ("o_orderstatus", "string"), ("o_totalprice", "number"), ("o_orderdate", "string"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "integer"), ("l_partkey", "integer"), ("l_suppkey", "integer"), ("l_linenumber", "integer"), ("l_quantity", "number"), ("l_extendedprice", "number"), ("l_discount", "number"), ("l_tax", "number"), ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "string")],
    "events": [("event_id", "integer"), ("ts", "string"), ("user_id", "integer"), ("event_type", "string"), ("value", "number"), ("props", "string")],
    "documents": [("doc_id", "integer"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "integer")],
    "pages": [("page_id", "integer"), ("url", "string"), ("html", "string")],
    "labels": [("doc_id", "integer"), ("quality", "integer"), ("toxic", "integer")],
    "conversations": [("conv_id", "integer"), ("turn", "integer"), ("role", "string"), ("text", "string")],
}

_FORMAT_SQL = """
    WITH texts AS (
        SELECT unnest([url, html]) AS text FROM pages
        UNION ALL SELECT unnest([source, text]) FROM documents
        UNION ALL SELECT unnest([strftime(ts, '%Y-%m-%d %H:%M:%S'), props]) FROM events
        UNION ALL SELECT unnest([strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority]) FROM orders
        UNION ALL SELECT unnest([c_name || '@example.com', concat_ws('-', md5(c_name)[1:8], md5(c_name)[9:12],
                                 md5(c_name)[13:16], md5(c_name)[17:20], md5(c_name)[21:32])]) FROM customer)
    SELECT CASE WHEN regexp_matches(text, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}') THEN 'date-time'
                WHEN regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'date'
                WHEN starts_with(text, 'http://') OR starts_with(text, 'https://') THEN 'uri'
                WHEN contains(text, '@') AND contains(text, '.') AND strlen(text) > 5 THEN 'email'
                WHEN regexp_full_match(text, '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}')
                THEN 'uuid' ELSE 'none' END AS format,
           count(*) AS texts
    FROM texts GROUP BY ALL
"""

QUERIES = {
    "infer_fields": Query(
        infer_fields,
        _fields(
            [
                ("event_id", "events", "count(*)", "integer", "bigint", None, "false", "true"),
                ("at", "events", "count(*)", "string", "string", "date-time", "false", "true"),
                ("value", "events", "count(*) FILTER (event_type <> 'error')", "number", "double", None, "true", "false"),
                ("kind", "events", "count(*)", "string", "string", None, "true", "false"),
                ("code", "events", "count(*)", "string", "string", None, "false", "true"),
                ("ratio", "events", "count(*)", "number", "double", None, "false", "true"),
            ]
        ),
    ),
    "infer_nested": Query(
        infer_nested,
        _fields(
            [
                ("id", "orders", "count(*)", "integer", "bigint", None, "false", "true"),
                ("buyer", "orders", "count(*)", "object", "object", None, "false", "true"),
                ("buyer.key", "orders", "count(*)", "integer", "bigint", None, "false", "false"),
                ("buyer.mail", "orders", "count(*)", "string", "string", "email", "false", "false"),
                ("tags", "orders", "count(*)", "array", "array", None, "false", "true"),
                ("tags[]", "orders", "2 * count(*)", "string", "string", None, "false", "false"),
                ("lines", "orders", "count(*)", "array", "array", None, "false", "true"),
                ("lines[]", "orders", "2 * count(*)", "object", "object", None, "false", "false"),
                ("lines[].price", "orders", "2 * count(*)", "number", "double", None, "false", "false"),
                ("lines[].closed", "orders", "count(*) FILTER (o_orderstatus = 'F')", "string", "string", "date", "true", "false"),
            ]
        ),
    ),
    "infer_merged": Query(
        infer_merged,
        _fields(
            [
                ("key", "(SELECT c_custkey FROM customer UNION ALL SELECT o_orderkey FROM orders)", "count(*)", "integer", "bigint", None, "false", "true"),
                ("ref", "(SELECT c_custkey FROM customer UNION ALL SELECT o_orderkey FROM orders)", "count(*)", "string", "string", None, "false", "true"),
                ("o_totalprice", "orders", "count(*)", "number", "double", None, "true", "false"),
            ]
        ),
    ),
    "format_detect": Query(format_detect, _FORMAT_SQL),
    "infer_and_conform": Query(
        infer_and_conform,
        """
        SELECT o_orderkey AS id, o_custkey AS buyer, o_orderstatus || '|' || o_orderpriority AS tags,
               CASE WHEN o_orderstatus = 'F' THEN '2024-01-01' END AS closed, CAST(1 AS BIGINT) AS step FROM orders
        """,
    ),
    "inferred_columns": Query(
        inferred_columns,
        """
        SELECT 'at' AS field, 'string' AS type, count(*) AS present FROM events
        UNION ALL SELECT 'code', 'string', count(*) FROM events
        UNION ALL SELECT 'event_id', 'bigint', count(*) FROM events
        UNION ALL SELECT 'kind', 'string', count(*) FILTER (event_type <> 'click') FROM events
        UNION ALL SELECT 'ratio', 'double', count(*) FROM events
        UNION ALL SELECT 'value', 'double', count(*) FILTER (event_type <> 'error') FROM events
        """,
    ),
    "column_catalog": Query(column_catalog, _columns_sql(_COLUMNS)),
    "discover_catalog": Query(
        discover_catalog,
        """
        SELECT 'events' AS name, 'at,code,event_id,kind,ratio,value' AS fields, 'at,code,event_id,ratio' AS required,
               true AS source_defined_cursor, 'full_refresh,incremental' AS modes, 'event_id' AS primary_key
        UNION ALL
        SELECT 'orders', 'buyer,id,lines,tags', 'buyer,id,lines,tags', false, 'full_refresh,incremental', ''
        """,
    ),
    "discover_sample": Query(
        discover_sample,
        """
        WITH first AS (SELECT * FROM events ORDER BY event_id LIMIT 100)
        SELECT 'ts' AS path, count(*) AS n, 'string' AS json_type, true AS required FROM first
        UNION ALL SELECT 'user_id', count(*), 'integer', true FROM first
        UNION ALL SELECT 'event_type', count(*), 'string', true FROM first
        UNION ALL SELECT 'value', count(*), 'number', true FROM first
        UNION ALL SELECT 'props', count(*), 'string', true FROM first
        """,
    ),
    "table_types": Query(
        table_types,
        " UNION ALL ".join(
            f"SELECT '{name}' AS name, '{column}' AS field, '{kind}' AS json_type, "
            + ("'date-time'" if column in ("o_orderdate", "ts") else "CAST(NULL AS VARCHAR)")
            + f" AS format, count({column}) AS present FROM {name}"
            for name in ("orders", "events")
            for column, kind in _COLUMNS[name]
        ),
    ),
}
