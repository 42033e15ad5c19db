"""Page bodies packed from the tables, decoded and conformed back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import csv_value_type, quote_json, xml_text_type
from ..functions.paths import path_string, path_variant
from ..operators.conform import base64_text, conform, records_json, to_records, union_streams
from ..operators.errors import good_records, retry_worklist
from ..sources.decode import decode_pages, decode_typed, page_values
from .common import Query, envelope, packed, table

ORDER_FIELDS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
EVENT_FIELDS = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"

ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS o_orderdate, o_orderpriority FROM orders
"""


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def order_pages(spark, folder):
    return envelope(packed(table(spark, folder, "orders"), "orders", "o_orderkey"), has_more=F.lit("true"))


def decode_json_records(spark, folder):
    records = decode_pages(order_pages(spark, folder), "json", "data")
    return conform(good_records(records).select("record"), _schema(ORDER_FIELDS))


def decode_json_wildcard(spark, folder):
    records = decode_pages(order_pages(spark, folder), "json", "$.data[*].o_custkey")
    return good_records(records).groupBy(F.col("record").cast("bigint").alias("o_custkey")).agg(F.count("*").alias("n"))


def decode_json_typed(spark, folder):
    return decode_typed(order_pages(spark, folder), _schema(ORDER_FIELDS), "data").select(
        *_schema(ORDER_FIELDS).names
    )


def decode_jsonl(spark, folder):
    pages = packed(table(spark, folder, "events"), "events", "event_id")
    # Blank lines and both line ends, as they occur in exports.
    body = F.concat(F.array_join("items", "\r\n\n "), F.lit("\n"))
    records = decode_pages(pages.withColumn("body", body).drop("items"), "jsonl")
    return conform(good_records(records).select("record"), _schema(EVENT_FIELDS))


def decode_csv(spark, folder):
    parts = table(spark, folder, "part")
    label = F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"'))
    quoted = F.concat(F.lit('"'), F.replace(label, F.lit('"'), F.lit('""')), F.lit('"'))
    flag = F.when(F.col("p_size") > 25, F.lit("Yes")).otherwise(F.lit("no"))
    note = F.when(F.col("p_size") % 2 == 0, F.lit("None")).otherwise(F.col("p_type"))
    cells = [F.col("p_partkey").cast("string"), quoted, F.col("p_retailprice").cast("string"), flag, note]
    line = F.concat_ws(", ", *cells)
    pages = packed(parts, "part", "p_partkey", line)
    body = F.concat(F.lit("id,label,price,large,note,absent\n"), F.array_join("items", "\n"))
    records = decode_pages(pages.withColumn("body", body).drop("items"), "csv")
    schema = _schema("id bigint, label string, price double, large boolean, note string, absent string")
    return conform(good_records(records).select("record"), schema)


def decode_xml(spark, folder):
    customers = table(spark, folder, "customer")
    element = F.concat(
        F.lit('<row kind="c"><key>'),
        F.col("c_custkey").cast("string"),
        F.lit("</key><name> "),
        F.col("c_name"),
        F.lit("</name><account><balance>"),
        F.col("c_acctbal").cast("string"),
        F.lit("</balance><segment>"),
        F.col("c_mktsegment"),
        F.lit("</segment></account><empty/></row>"),
    )
    pages = packed(customers, "customer", "c_custkey", element)
    body = F.concat(F.lit("<?xml version='1.0'?><rows>"), F.array_join("items", "\n"), F.lit("</rows>"))
    records = decode_pages(pages.withColumn("body", body).drop("items"), "xml", "row")
    schema = _schema("key bigint, name string, account struct<balance double, segment string>, empty string")
    return conform(good_records(records).select("record"), schema).select(
        "key", "name", "account.balance", "account.segment", "empty"
    )


def decode_raw(spark, folder):
    values = page_values(order_pages(spark, folder))
    rows = path_variant(F.col("value"), "data").cast("array<variant>")
    return values.select(
        "partition_id",
        "page_no",
        F.size(rows).alias("n_records"),
        path_string(F.col("value"), "has_more").alias("has_more"),
    )


def decode_errors(spark, folder):
    """Error events are cut off in their JSON line; the pages that hold them go on the retry list."""
    events = table(spark, folder, "events")
    whole = records_json(events)
    line = F.when(F.col("event_type") == "error", F.substring(whole, F.lit(1), F.length(whole) - 3)).otherwise(whole)
    pages = packed(events, "events", "event_id", line)
    decoded = decode_pages(pages.withColumn("body", F.array_join("items", "\n")).drop("items"), "jsonl")
    return retry_worklist(decoded)


def path_last_element(spark, folder):
    values = page_values(order_pages(spark, folder))
    v = F.col("value")
    return values.select(
        "partition_id",
        "page_no",
        path_string(v, "data[-1].o_orderkey").cast("bigint").alias("last_key"),
        path_string(v, "$.data[0].o_orderpriority").alias("first_priority"),
        path_string(v, "data").alias("not_scalar"),
    )


def event_props(spark, folder):
    props = F.try_parse_json("props")
    events = table(spark, folder, "events")
    return events.select(
        "event_id", path_string(props, "k").cast("bigint").alias("k"), path_string(props, "k.x").alias("below")
    )


def coerce_words(spark, folder):
    """The types that the words of all documents would have as CSV cells and as XML text."""
    words = table(spark, folder, "documents").select(F.explode(F.split("text", r"\s+")).alias("word"))
    return words.groupBy(csv_value_type(F.col("word")).alias("csv_type"), xml_text_type(F.col("word")).alias("xml_type")).agg(
        F.count("*").alias("words")
    )


def typed_to_json(spark, folder):
    return to_records(table(spark, folder, "orders"), "o_orderkey")


def blob_values(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.encode("url", "utf-8").alias("body"))
    return pages.select("page_id", base64_text(F.col("body")).alias("body64"), records_json(pages, "body").alias("record"))


def conflict_to_string(spark, folder):
    events = table(spark, folder, "events")
    number, word = F.col("user_id").cast("string"), quote_json(F.col("event_type"))
    code = F.when(F.col("event_type") == "click", word).when(F.col("event_type") == "view", F.col("props")).otherwise(number)
    record = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"code":'), code, F.lit("}"))
    return conform(events.select(record.alias("record")), _schema("event_id bigint, code string"))


def union_of_streams(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("ref"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("ref"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    return union_streams(customers, suppliers, orders)


def raw_jsonl_array(spark, folder):
    pages = packed(table(spark, folder, "events"), "events", "event_id")
    values = page_values(pages.withColumn("body", F.array_join("items", "\n")).drop("items"), "jsonl")
    last = path_string(F.col("value"), "[-1].event_id").cast("bigint")
    return values.select("partition_id", "page_no", F.size(F.col("value").cast("array<variant>")).alias("n"), last.alias("last_id"))


_CHAIN = "concat('p', {key} // 20000) AS partition_id, CAST(({key} // 500) % 40 + 1 AS INTEGER) AS page_no"
_COERCE_SQL = """
    WITH words AS (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents),
    typed AS (
        SELECT lower(word) AS low,
               regexp_full_match(word, '[+-]?[0-9]+') AND TRY_CAST(word AS BIGINT) IS NOT NULL AS is_int,
               regexp_full_match(word, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
                 AND isfinite(TRY_CAST(word AS DOUBLE)) AS is_float
        FROM words)
    SELECT CASE WHEN is_int THEN 'integer' WHEN is_float THEN 'number'
                WHEN low IN ('true', 'yes', 'false', 'no') THEN 'boolean'
                WHEN low IN ('', 'null', 'none') THEN 'null' ELSE 'string' END AS csv_type,
           CASE WHEN is_int THEN 'integer' WHEN is_float THEN 'number'
                WHEN low IN ('true', 'false') THEN 'boolean' ELSE 'string' END AS xml_type,
           count(*) AS words
    FROM typed GROUP BY ALL
"""

QUERIES = {
    "decode_json_records": Query(decode_json_records, ORDERS_SQL),
    "decode_json_wildcard": Query(
        decode_json_wildcard, "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey"
    ),
    "decode_json_typed": Query(decode_json_typed, ORDERS_SQL),
    "decode_jsonl": Query(
        decode_jsonl,
        """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, user_id, event_type, value, props FROM events
        """,
    ),
    "decode_csv": Query(
        decode_csv,
        """
        SELECT p_partkey AS id, p_name || ', "' || p_brand || '"' AS label, p_retailprice AS price,
               p_size > 25 AS large, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END AS note,
               CAST(NULL AS VARCHAR) AS absent
        FROM part
        """,
    ),
    "decode_xml": Query(
        decode_xml,
        """
        SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
               CAST(NULL AS VARCHAR) AS empty FROM customer
        """,
    ),
    "decode_raw": Query(
        decode_raw,
        f"""
        SELECT {_CHAIN.format(key='o_orderkey')}, CAST(count(*) AS INTEGER) AS n_records, 'true' AS has_more
        FROM orders GROUP BY ALL
        """,
    ),
    "decode_errors": Query(
        decode_errors,
        f"""
        SELECT 'events' AS stream, {_CHAIN.format(key='event_id')}, count(*) AS errors
        FROM events WHERE event_type = 'error' GROUP BY ALL
        """,
    ),
    "path_last_element": Query(
        path_last_element,
        f"""
        SELECT {_CHAIN.format(key='o_orderkey')}, max(o_orderkey) AS last_key,
               arg_min(o_orderpriority, o_orderkey) AS first_priority, CAST(NULL AS VARCHAR) AS not_scalar
        FROM orders GROUP BY partition_id, page_no
        """,
    ),
    "event_props": Query(
        event_props,
        """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS below
        FROM events
        """,
    ),
    "coerce_words": Query(coerce_words, _COERCE_SQL),
    "typed_to_json": Query(
        typed_to_json,
        """
        SELECT o_orderkey,
               '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":'
               || o_totalprice || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ')
               || '","o_orderpriority":"' || o_orderpriority || '"}' AS record
        FROM orders
        """,
    ),
    "blob_values": Query(
        blob_values,
        """
        SELECT page_id, base64(encode(url)) AS body64, '{"body":"' || base64(encode(url)) || '"}' AS record FROM pages
        """,
    ),
    "conflict_to_string": Query(
        conflict_to_string,
        """
        SELECT event_id, CASE event_type WHEN 'click' THEN event_type
               WHEN 'view' THEN replace(props, ': ', ':')
               ELSE CAST(user_id AS VARCHAR) END AS code FROM events
        """,
    ),
    "union_streams": Query(
        union_of_streams,
        """
        SELECT c_custkey AS key, CAST(c_nationkey AS VARCHAR) AS ref, c_mktsegment AS segment,
               CAST(NULL AS DOUBLE) AS amount FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier
        UNION ALL SELECT o_orderkey, NULL, NULL, o_totalprice FROM orders
        """,
    ),
    "raw_jsonl_array": Query(
        raw_jsonl_array,
        f"""
        SELECT {_CHAIN.format(key='event_id')}, CAST(count(*) AS INTEGER) AS n, max(event_id) AS last_id
        FROM events GROUP BY partition_id, page_no
        """,
    ),
}
