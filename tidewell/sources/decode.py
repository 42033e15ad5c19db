"""Page bodies to records.

Every decoder returns the page columns without the body, plus

* ``pos``     position of the record in its page, from 0,
* ``record``  the record as JSON text, NULL when it could not be read,
* ``error``   why it could not be read, else NULL.

All formats are read by expressions that run in the JVM. A page is one HTTP
response, so its size is bounded by what was fetched, and exploding it is a
narrow step without a shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import csv_value_json, quote_json
from ..functions.paths import extract_elements, parse_path

# The characters that count as white space at the ends of a cell.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The comma is neither group nor decimal mark here, so "1,000" stays text.
XML_OPTIONS = {"excludeAttribute": "true", "locale": "de-CH"}


def decode_pages(
    pages: DataFrame,
    fmt: str = "json",
    records_path: str | None = None,
    delimiter: str = ",",
    has_header: bool = True,
) -> DataFrame:
    """Records of JSON, JSON Lines, CSV or XML pages."""
    if fmt == "json":
        return _json(pages, records_path)
    if fmt == "jsonl":
        return _one_row_per_item(pages, _jsonl_items(F.col("body")), "line")
    if fmt == "csv":
        return _csv(pages, delimiter, has_header)
    if fmt == "xml":
        return _xml(pages, records_path)
    raise ValueError(f"unknown format: {fmt}")


ITEMS = "array<struct<pos:int,record:string>>"


def page_items(
    pages: DataFrame,
    fmt: str = "json",
    records_path: str | None = None,
    delimiter: str = ",",
    has_header: bool = True,
) -> DataFrame:
    """Each page with its records as ``items``: what ``decode_pages`` gives, still in one row and made in one pass.

    ``record`` is NULL where it could not be read; blank lines are left out, and ``pos`` counts them. ``item_records``
    opens the pages.
    """
    if fmt == "csv":
        return _csv_items(pages, delimiter, has_header)
    if fmt == "json":
        listed, texts = _json_texts(pages, records_path)
    elif fmt == "jsonl":
        listed, texts = pages, _jsonl_items(F.col("body"))
    elif fmt == "xml":
        listed, texts = _xml_texts(pages, records_path)
    else:
        raise ValueError(f"unknown format: {fmt}")
    texts = F.coalesce(texts, F.array(F.lit(None).cast("string")))
    numbered = F.transform(texts, lambda t, i: F.struct(i.alias("pos"), t.alias("record")))
    some = F.filter(numbered, lambda r: r["record"].isNull() | (r["record"] != "")) if fmt == "jsonl" else numbered
    return listed.select(*pages.columns, some.cast(ITEMS).alias("items"))


def item_records(listed: DataFrame, fmt: str = "json") -> DataFrame:
    """The rows of ``page_items``, one per record, as ``decode_pages`` gives them; ``at`` counts records without blank lines."""
    keep = [c for c in listed.columns if c not in ("body", "items")]
    rows = listed.select(*keep, F.posexplode("items").alias("at", "_item")).select(*keep, "at", "_item.*")
    line = F.concat(F.lit("bad line "), (F.col("pos") + 1).cast("string"))
    return rows.withColumn("error", F.when(F.col("record").isNull(), line if fmt == "jsonl" else F.lit("bad body")))


def decode_typed(pages: DataFrame, schema: T.StructType, records_path: str | None = None) -> DataFrame:
    """JSON pages straight to typed columns, in one parse, when the schema is known.

    Only for paths of plain keys to an array. Rows of pages that do not have
    this shape come out as one all-NULL row with ``error`` set.
    """
    steps = parse_path(records_path) if records_path else []
    if not all(isinstance(s, str) for s in steps):
        raise ValueError("decode_typed takes a path of keys; use decode_pages and conform")
    wrapped: T.DataType = T.ArrayType(schema)
    for step in reversed(steps):
        wrapped = T.StructType([T.StructField(step, wrapped)])
    items = F.from_json("body", wrapped)
    for step in steps:
        items = items.getField(step)
    error = F.when(items.isNull(), F.lit("no array of records"))
    listed = pages.select(*_keep(pages), items.alias("_items"), error.alias("error"))
    rows = listed.select(*_keep(pages), "error", F.posexplode_outer("_items").alias("pos", "_row"))
    rows = rows.filter(F.col("_row").isNotNull() | F.col("error").isNotNull())
    return rows.select(*_keep(pages), "pos", "error", "_row.*")


def page_values(pages: DataFrame, fmt: str = "json", delimiter: str = ",", has_header: bool = True) -> DataFrame:
    """The whole body of each page as one JSON value in ``value``: the raw view.

    JSON Lines and CSV bodies become arrays. Unreadable JSON and XML give NULL.
    """
    if fmt == "csv":
        texts = F.transform("items", lambda r: r["record"])
        text = F.concat(F.lit("["), F.concat_ws(",", texts), F.lit("]"))
        listed = _csv_items(pages, delimiter, has_header)
        return listed.select(*_keep(pages), F.when(F.col("body").isNotNull(), F.try_parse_json(text)).alias("value"))
    if fmt == "json":
        return pages.withColumn("value", F.try_parse_json("body")).drop("body")
    if fmt == "xml":
        return pages.withColumn("value", _xml_value(F.col("body"))).drop("body")
    if fmt == "jsonl":
        lines = _trimmed_lines(F.col("body"))
        kept = F.filter(lines, lambda line: line != "")
        text = F.concat(F.lit("["), F.concat_ws(",", kept), F.lit("]"))
        return pages.withColumn("value", F.try_parse_json(text)).drop("body")
    raise ValueError(f"no raw view for {fmt}")


def _keep(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c != "body"]


def _one_row_per_item(
    pages: DataFrame, items: Column, what: str = "body", drop: tuple[str, ...] = ()
) -> DataFrame:
    """Explode ``array<string>`` items: a NULL array is an unreadable page, a NULL item an unreadable
    record, and an empty text a blank line.

    What is bad shows in the exploded values only, so that filters on it stay above the
    explode and the body is read once.
    """
    keep = [c for c in _keep(pages) if c not in drop]
    listed = pages.select(*keep, F.coalesce(items, F.array(F.lit(None).cast("string"))).alias("_items"))
    rows = listed.select(*keep, F.posexplode_outer("_items").alias("pos", "record"))
    rows = rows.filter("pos IS NOT NULL AND (record IS NULL OR record <> '')")
    text = F.lit("bad body") if what == "body" else F.concat(F.lit(f"bad {what} "), (F.col("pos") + 1).cast("string"))
    return rows.withColumn("error", F.when(F.col("record").isNull(), text))


# A string element that begins like an object, or a closing bracket before what cannot follow one.
SUSPECT = r'[\[,]\s*"\s*\{|[\]}]\s*[^\s,\]}]'


def _balanced(body: Column) -> Column:
    def count(char: str) -> Column:
        return F.length(body) - F.length(F.replace(body, F.lit(char), F.lit("")))

    return (count("{") == count("}")) & (count("[") == count("]"))


def _whole_json(body: Column) -> Column:
    """A body as VARIANT, NULL unless all of it is one value: the parser alone stops after the first."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    alone = F.try_variant_get(wrapped, "$[1]", "variant").isNull()
    return F.when(alone, F.try_variant_get(wrapped, "$[0]", "variant"))


def _json(pages: DataFrame, path: str | None) -> DataFrame:
    listed, items = _json_texts(pages, path)
    return _one_row_per_item(listed, items, drop=("_direct", "_v", "_values"))


def _json_texts(pages: DataFrame, path: str | None) -> tuple[DataFrame, Column]:
    """The records of JSON bodies as an array of JSON texts.

    The usual shape, an array of objects behind plain keys, is read in one pass
    that keeps the text of each record as it is. Every other shape goes through
    VARIANT. Costly values get columns of their own, so that each is computed once.
    """
    steps = parse_path(path) if path else []
    if steps and steps[-1] is None:
        steps = steps[:-1]
    plain_path = all(isinstance(s, str) for s in steps)
    body = F.col("body")
    if plain_path:
        shape: T.DataType = T.ArrayType(T.StringType())
        for step in reversed(steps):
            shape = T.StructType([T.StructField(step, shape)])
        direct = F.from_json(body, shape)
        for step in steps:
            direct = direct.getField(step)
        # Strings lose their quotes, nulls vanish and text after the value is passed over in the direct read. A string
        # may look like an object, so bodies in which an element may be one go the strict way, as do those
        # where something else than JSON allows follows a closing bracket, or brackets do not match in number.
        odd = F.exists("_direct", lambda r: r.isNull() | ~r.startswith("{")) | body.rlike(SUSPECT) | ~_balanced(body)
        pages = pages.withColumn("_direct", direct)
        pages = pages.withColumn("_direct", F.when(~odd, F.col("_direct")))
    else:
        pages = pages.withColumn("_direct", F.lit(None).cast("array<string>"))
    pages = pages.withColumn("_v", F.when(F.col("_direct").isNull(), _whole_json(body)))
    pages = extract_elements(pages, "_v", path, "_values")
    texts = F.transform("_values", lambda v: F.to_json(v))
    if not steps:
        whole = F.btrim(body, F.lit(WHITE_SPACE))
        texts = F.when(whole.startswith("{"), F.array(whole)).otherwise(texts)
    return pages, F.coalesce("_direct", F.when(F.col("_v").isNotNull(), texts))


def _trimmed_lines(body: Column) -> Column:
    return F.transform(F.split(body, "\r?\n"), lambda line: F.btrim(line, F.lit(WHITE_SPACE)))


def _jsonl_items(body: Column) -> Column:
    def checked(line: Column) -> Column:
        return F.when((line == "") | F.try_parse_json(line).isNotNull(), line)

    return F.when(body.isNull(), F.array().cast("array<string>")).otherwise(F.transform(_trimmed_lines(body), checked))


def csv_cells(line: Column, delimiter: str = ",") -> Column:
    """The trimmed cells of one CSV line; quotes may enclose any part of a cell."""
    d = re.escape(delimiter)
    # Possessive groups keep long cells off the regex engine's stack.
    cell = d + r'((?:[^"' + d + r']++|"[^"]*+(?:""[^"]*+)*+(?:"|$))*+)'
    cells = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(cell), F.lit(1))
    opened = r'"([^"]*+(?:""[^"]*+)*+)(?:"|$)'

    def clean(text: Column) -> Column:
        unquoted = F.replace(F.regexp_replace(text, opened, "$1"), F.lit('""'), F.lit('"'))
        return F.btrim(F.when(text.contains('"'), unquoted).otherwise(text), F.lit(WHITE_SPACE))

    return F.transform(cells, clean)


def _csv_items(pages: DataFrame, delimiter: str, has_header: bool) -> DataFrame:
    """The records of each CSV body, made in the row of its page."""
    trim = F.lit(WHITE_SPACE.replace(delimiter, ""))
    split = pages.select(*pages.columns, F.split("body", "\r?\n").alias("_lines"))
    names = csv_cells(F.get("_lines", F.lit(0)), delimiter)
    if not has_header:
        names = F.transform(names, lambda _, i: F.concat(F.lit("column_"), i.cast("string")))
    rest = F.slice("_lines", 2 if has_header else 1, F.greatest(F.size("_lines"), F.lit(1)))
    lines = F.transform(rest, lambda t, i: F.struct(i.alias("pos"), F.btrim(t, trim).alias("text")))
    lines = F.filter(lines, lambda t: t["text"] != "")
    rows = F.transform(lines, lambda t: F.struct(t["pos"].alias("pos"), csv_cells(t["text"], delimiter).alias("cells")))
    cells = split.select(*pages.columns, names.alias("_names"), rows.alias("_rows"))
    # What the header decides is made once per page. A repeated column name keeps its last cell.
    keyed = F.transform("_names", lambda name, i: F.struct(i.alias("i"), F.concat(quote_json(name), F.lit(":")).alias("key"), name.alias("name")))
    last = F.filter(keyed, lambda c: ~F.array_contains(F.slice("_names", c["i"] + 2, F.size("_names")), c["name"]))

    def record(row: Column, columns: Column) -> Column:
        pairs = F.transform(columns, lambda c: F.concat(c["key"], csv_value_json(F.coalesce(F.get(row, c["i"]), F.lit("")))))
        return F.concat(F.lit("{"), F.concat_ws(",", pairs), F.lit("}"))

    def opened(columns: Column) -> Column:
        return F.transform("_rows", lambda row: F.struct(row["pos"].alias("pos"), record(row["cells"], columns).alias("record")))

    made = F.flatten(F.transform(F.array(last), opened))
    return cells.select(*pages.columns, F.coalesce(made, F.array()).cast(ITEMS).alias("items"))


def _csv(pages: DataFrame, delimiter: str, has_header: bool) -> DataFrame:
    trim = WHITE_SPACE.replace(delimiter, "")
    lines = F.split("body", "\r?\n")
    first = csv_cells(F.get("_lines", F.lit(0)), delimiter)
    if not has_header:
        first = F.transform(first, lambda _, i: F.concat(F.lit("column_"), i.cast("string")))
    split = pages.select(*_keep(pages), lines.alias("_lines")).withColumn("_names", first)
    # A repeated column name keeps its last cell.
    split = split.withColumn(
        "_cols",
        F.filter(
            F.transform(
                "_names",
                lambda name, i: F.struct(i.alias("i"), quote_json(name).alias("key"), name.alias("name")),
            ),
            lambda c: ~F.array_contains(F.slice("_names", c["i"] + 2, F.size("_names")), c["name"]),
        ),
    )
    start = 2 if has_header else 1
    rest = F.slice("_lines", start, F.greatest(F.size("_lines"), F.lit(1)))
    rows = split.select(*_keep(pages), "_cols", rest.alias("_rest"))
    rows = rows.select(*_keep(pages), "_cols", F.posexplode_outer("_rest").alias("pos", "_text"))
    rows = rows.withColumn("_text", F.btrim("_text", F.lit(trim))).filter("_text <> ''")
    rows = rows.select(*_keep(pages), "pos", "_cols", csv_cells(F.col("_text"), delimiter).alias("_cells"))
    cell = lambda c: csv_value_json(F.coalesce(F.get("_cells", c["i"]), F.lit("")))
    pairs = F.transform("_cols", lambda c: F.concat(c["key"], F.lit(":"), cell(c)))
    record = F.concat(F.lit("{"), F.concat_ws(",", pairs), F.lit("}"))
    return rows.select(*_keep(pages), "pos", record.alias("record"), F.lit(None).cast("string").alias("error"))


def _xml_value(body: Column) -> Column:
    # VARIANT reading of broken XML throws; the struct reading reports it instead.
    check = F.from_xml(body, "_corrupt_record string", {"mode": "PERMISSIVE"})
    broken = body.isNull() | ~F.ltrim(body).startswith("<") | check.getField("_corrupt_record").isNotNull()
    return F.when(~broken, F.from_xml(body, "variant", XML_OPTIONS))


def _xml_texts(pages: DataFrame, path: str | None) -> tuple[DataFrame, Column]:
    pages = extract_elements(pages.withColumn("_v", _xml_value(F.col("body"))), "_v", path, "_values")
    return pages, F.when(F.col("_v").isNotNull(), F.transform("_values", lambda v: F.to_json(v)))


def _xml(pages: DataFrame, path: str | None) -> DataFrame:
    listed, items = _xml_texts(pages, path)
    return _one_row_per_item(listed, items, drop=("_v", "_values"))


def body_value(fmt: str) -> Column:
    """The whole ``body`` as VARIANT, for what stands beside the records; JSON Lines and CSV have none."""
    if fmt not in ("json", "xml"):
        raise ValueError(f"{fmt} bodies hold records only: a cursor, flag or total beside them needs json or xml")
    return F.try_parse_json("body") if fmt == "json" else _xml_value(F.col("body"))
