"""Schema inference over records held as JSON text.

``infer_paths`` reduces any number of records to a *path table*, one row per
field path:

* ``path``     keys joined by dots, ``[]`` for array items, ``''`` for the record,
* ``n``        how many values were seen there,
* ``objects``  how many of them were objects, the base for "missing" children,
* ``types``    the kinds seen, as bits,
* ``formats``  the string formats seen, as bits.

Counts add and bits OR, so path tables of slices, streams or earlier runs merge
in any order (``merge_paths``) and a stored one can be widened without reading
the old data again.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One bit per kind. EMPTY stands for the unknown item of an empty
# array and for values below the depth limit, which count as objects without fields.
NULL, BOOLEAN, INTEGER, BIG, NUMBER, STRING, ARRAY, OBJECT, EMPTY = (1 << i for i in range(9))

# String formats in order of trial, one bit each.
FORMATS = ("date-time", "date", "uri", "email", "uuid")

# The patterns that tell the formats.
DATETIME_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
UUID_TEXT = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

LIMIT = "LIMIT"  # stands for the shape of values below the depth limit

MAX_DEPTH = 10


def format_name(text: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """The format of a string, NULL when it has none of the ``formats``."""
    tests = {
        "date-time": text.rlike(DATETIME_TEXT),
        "date": text.rlike(DATE_TEXT),
        "uri": text.startswith("http://") | text.startswith("https://"),
        "email": text.contains("@") & text.contains(".") & (F.octet_length(text) > 5),
        "uuid": text.rlike(UUID_TEXT),
    }
    chosen = F.lit(None).cast("string")
    for name in reversed([f for f in FORMATS if f in formats]):
        chosen = F.when(tests[name], F.lit(name)).otherwise(chosen)
    return chosen


def _kind(shape: Column) -> Column:
    """The kind bit of a VARIANT shape such as ``BIGINT`` or ``DECIMAL(3,1)``."""
    whole = F.regexp_extract(shape, r"^DECIMAL\((\d+),0\)$", 1).try_cast("int")
    return (
        F.when(shape.isNull(), None)
        .when(shape == "STRING", STRING)
        .when(shape == "BIGINT", INTEGER)
        .when(shape == "BOOLEAN", BOOLEAN)
        .when(shape == "VOID", NULL)
        .when(shape == "OBJECT", OBJECT)
        .when(shape == "ARRAY", ARRAY)
        .when(shape == LIMIT, EMPTY)
        .when(whole >= 19, BIG)
        .otherwise(NUMBER)
    )


def _shape(value: Column) -> Column:
    return F.substring_index(F.schema_of_variant(value), "<", 1)


def _step_text(key: Column, first: bool) -> Column:
    """A key as a path step; dots, brackets and backslashes in it are escaped."""
    escaped = F.regexp_replace(key, r"([.\[\]\\])", r"\\$1")
    plain = F.when(key.rlike(r"[.\[\]\\]"), escaped).otherwise(key)
    step = plain if first else F.concat(F.lit("."), plain)
    return F.when(key.isNull(), F.lit("[]")).otherwise(step)


def _depth(records: DataFrame, column: str, max_depth: int) -> int:
    """How many levels the records nest, from one aggregate over their brackets.

    Dropping all innermost pairs takes one level off, so the depth is the number of
    rounds until nothing is left.
    """
    bare = F.regexp_replace(column, r'"(?:[^"\\]++|\\.)*+"', "")
    brackets = F.regexp_replace(F.translate(bare, "[]", "{}"), "[^{}]++", "")
    rounds = records.select(brackets.alias("_r0"))
    for i in range(max_depth + 1):
        rounds = rounds.withColumn(f"_r{i + 1}", F.replace(f"_r{i}", F.lit("{}"), F.lit("")))
    depth = sum((F.when(F.col(f"_r{i}") != "", 1).otherwise(0) for i in range(max_depth + 1)), F.lit(0))
    return rounds.agg(F.max(depth)).first()[0] or 0


def infer_paths(
    records: DataFrame,
    column: str = "record",
    max_depth: int = MAX_DEPTH,
    formats: tuple[str, ...] = FORMATS,
    depth: int | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """The path table of JSON records, or one for each value of the columns ``by``.

    One pass opens the records level by level, without a shuffle, and one hash
    aggregate on the path, reduced before its shuffle, counts them. ``depth``
    is the number of levels to open; without it a first pass finds it.
    """
    if depth is None:
        depth = _depth(records, column, max_depth)
    rows = records.select(*by, F.lit(None).cast("int").alias("_f"), F.try_parse_json(column).alias("_v"))
    for level in range(1, depth + 1):
        inner = rows.sparkSession.tvf.variant_explode_outer(F.col("_v").outer())
        opened = rows.lateralJoin(inner.toDF("_pos", "_key", "_child"), how="left")
        # What opened is a container; only scalars and empty containers have their shape looked up.
        shape = F.when(F.col("_key").isNotNull(), "OBJECT").when(F.col("_pos").isNotNull(), "ARRAY")
        rows = _told(opened, level - 1, shape.otherwise(_shape(F.col("_v"))), formats).select(
            *by,
            *[c for c in rows.columns if c[:2] in ("_t", "_s", "_z")],
            f"_t{level - 1}",
            "_f",
            _step_text(F.col("_key"), first=level == 1).alias(f"_s{level}"),
            (F.col("_pos") > 0).alias(f"_z{level}"),
            F.col("_child").alias("_v"),
        )
    last = F.when(F.col("_v").isNotNull(), LIMIT) if depth > max_depth else _shape(F.col("_v"))
    rows = _told(rows, depth, last, formats).drop("_v")
    # Rows that differ only in their values fold here, before any shuffle.
    leaves = rows.groupBy(*rows.columns).agg(F.count("*").alias("_m"))
    return _entries(leaves, depth, by).groupBy(*by, "path").agg(
        F.sum(F.when(F.col("real"), F.col("_m")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("kind") == OBJECT, F.col("_m")).otherwise(0)).alias("objects"),
        F.bit_or("kind").alias("types"),
        F.bit_or("format").alias("formats"),
    )


def _told(rows: DataFrame, level: int, shape: Column, formats: tuple[str, ...]) -> DataFrame:
    """Add the kind of ``_v`` as ``_t{level}``, and note the format of a string as ``_f``; both are bits from here on."""
    kind = f"_t{level}"
    told = rows.withColumn("_x", shape).withColumn(kind, _kind(F.col("_x")))
    told = told.withColumn("_x", F.when(F.col(kind) == STRING, F.col("_v").cast("string")))
    return told.withColumn("_f", F.coalesce("_f", _format_bit(format_name(F.col("_x"), formats)))).drop("_x")


def _format_bit(name: Column) -> Column:
    bit = F.lit(None).cast("int")
    for i, known in enumerate(FORMATS):
        bit = F.when(name == known, 1 << i).otherwise(bit)
    return bit


def _entries(leaves: DataFrame, depth: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Each value once: a leaf carries its ancestors, and only their first leaf reports them."""
    entries = []
    for level in range(depth + 1):
        kind = F.col(f"_t{level}")
        path = F.concat(F.lit(""), *[F.col(f"_s{i}") for i in range(1, level + 1)])
        first = kind.isNotNull()
        for below in range(level + 1, depth + 1):
            first = first & ~F.coalesce(F.col(f"_z{below}"), F.lit(False))
        form = F.when(kind == STRING, F.coalesce("_f", F.lit(0))).otherwise(0)
        entry = F.struct(path.alias("path"), kind.alias("kind"), form.alias("format"), F.lit(True).alias("real"))
        entries.append(F.when(first, entry))
        # An array that opened to nothing is empty; its items are of unknown kind.
        hollow = kind == ARRAY
        if level < depth:
            hollow = hollow & F.col(f"_t{level + 1}").isNull()
        items = F.struct(
            F.concat(path, F.lit("[]")).alias("path"),
            F.lit(EMPTY).alias("kind"),
            F.lit(0).alias("format"),
            F.lit(False).alias("real"),
        )
        entries.append(F.when(hollow, items))
    opened = leaves.select(*by, "_m", F.explode(F.array_compact(F.array(*entries))).alias("_e"))
    return opened.select(*by, "_m", "_e.path", "_e.kind", "_e.format", "_e.real")


def merge_paths(*tables: DataFrame) -> DataFrame:
    """One path table for all records behind the given ones."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return merged.groupBy("path").agg(
        F.sum("n").alias("n"),
        F.sum("objects").alias("objects"),
        F.bit_or("types").alias("types"),
        F.bit_or("formats").alias("formats"),
    )


def _has(bits: Column, *kinds: int) -> Column:
    return bits.bitwiseAND(F.lit(sum(kinds))) != 0


def json_type(types: Column) -> Column:
    """The JSON-Schema type of a set of kinds: nulls give way, integers widen, conflicts are strings."""
    integer = _has(types, INTEGER, BIG)
    families = [
        (_has(types, BOOLEAN), "boolean"),
        (_has(types, INTEGER, BIG, NUMBER), "number"),
        (_has(types, STRING), "string"),
        (_has(types, ARRAY), "array"),
        (_has(types, OBJECT, EMPTY), "object"),
    ]
    seen = sum((f.cast("int") for f, _ in families), F.lit(0))
    chosen = F.when(seen == 0, "null").when(seen > 1, "string")
    for present, name in families:
        if name == "number":
            chosen = chosen.when(present & integer & ~_has(types, NUMBER), "integer")
        chosen = chosen.when(present, name)
    return chosen


def table_type(types: Column) -> Column:
    """The column type of a set of kinds; integers beyond 64 bits are doubles."""
    name = json_type(types.bitwiseAND(F.lit(511 - EMPTY)))
    wide = (name == "integer") & _has(types, BIG)
    return (
        F.when(wide, "double")
        .when(name == "integer", "bigint")
        .when(name == "number", "double")
        .when(name == "null", "string")
        .otherwise(name)
    )


def _parent(path: Column) -> Column:
    """The path one step up, NULL for the record itself."""
    up = F.regexp_replace(path, r"(?:\[\]|(?:^|\.)(?:\\.|[^.\[\]\\])+)$", "")
    return F.when(path != "", up)


def describe_fields(paths: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per field: count, JSON type, column type, format, nullable, required.

    A field is nullable when a null was seen or an object lacked it, and required
    when every record has it and it is not nullable. A window over the fields of one
    object brings them its counts.
    """
    # Every field stands beside the object that holds it: one exchange, and the path table is made once.
    own = F.when((F.col("objects") > 0) | (F.col("path") == ""), F.struct(F.col("path").alias("parent"), F.lit(True).alias("own")))
    held = F.when(F.col("path") != "", F.struct(_parent(F.col("path")).alias("parent"), F.lit(False).alias("own")))
    placed = paths.select("*", F.explode(F.array_compact(F.array(own, held))).alias("_at"))
    placed = placed.select(*paths.columns, F.col("_at.parent").alias("_parent"), F.col("_at.own").alias("_own"))
    beside = Window.partitionBy(*by, "_parent")
    joined = placed.withColumns({f"_{name}": F.max(F.when(F.col("_own"), F.col(column))).over(beside) for name, column in (("objects", "objects"), ("parent_n", "n"))})
    joined = joined.filter("NOT _own")
    item = F.col("path").endswith("[]")
    missing = ~item & (F.col("n") < F.col("_objects"))
    one_format = F.bit_count("formats") == 1
    named = F.lit(None).cast("string")
    for i, name in enumerate(FORMATS):
        named = F.when(F.col("formats") == (1 << i), name).otherwise(named)
    nullable = _has(F.col("types"), NULL) | missing
    top = F.col("_parent") == ""
    return joined.select(
        *by,
        "path",
        "n",
        json_type(F.col("types")).alias("json_type"),
        table_type(F.col("types")).alias("column_type"),
        F.when(one_format, named).alias("format"),
        nullable.alias("nullable"),
        (top & ~item & ~nullable & (F.col("n") == F.col("_parent_n"))).alias("required"),
    )


@dataclass
class Node:
    """A field on the driver, with its children."""

    row: Any = None
    fields: dict[str, Node] = field(default_factory=dict)
    items: Node | None = None


def split_path(path: str) -> list[str]:
    """The steps of a path; ``[]`` stands for array items."""
    steps = re.findall(r"\[\]|(?:\\.|[^.\[\]\\])+", path)
    return [s if s == "[]" else re.sub(r"\\(.)", r"\1", s) for s in steps]


def field_tree(paths: DataFrame, as_text: tuple[str, ...] = ()) -> Node:
    """The described fields as a tree. Only a schema, never data, comes to the driver.

    Paths in ``as_text`` are taken for JSON text: what lies below them is left out before it gets here.
    That is the rule for objects keyed by ids, whose keys are data.
    """
    described = describe_fields(paths)
    for path in as_text:
        described = described.filter(~F.col("path").startswith(f"{path}.") & ~F.col("path").startswith(f"{path}[]"))
    return _tree(described.collect())


def _tree(rows: list[Any]) -> Node:
    root = Node()
    for row in sorted(rows, key=lambda r: r.path):
        node = root
        for step in split_path(row.path):
            if step == "[]":
                node.items = node.items or Node()
                node = node.items
            else:
                node = node.fields.setdefault(step, Node())
        node.row = row
    return root


def json_schema(paths: DataFrame | list[Any]) -> dict[str, Any]:
    """The draft-07 JSON Schema of a path table, or of its described fields."""

    def render(node: Node) -> dict[str, Any]:
        kind = node.row.json_type
        out: dict[str, Any] = {"type": [kind, "null"] if node.row.nullable and kind != "null" else kind}
        if node.row.format:
            out["format"] = node.row.format
        if node.fields:
            out["properties"] = {k: render(v) for k, v in sorted(node.fields.items())}
            out["additionalProperties"] = True
        if node.items:
            out["items"] = render(node.items)
        return out

    root = _tree(paths) if isinstance(paths, list) else field_tree(paths)
    schema: dict[str, Any] = {
        "$schema": "http://json-schema.org/draft-07/schema#",
        "type": "object",
        "properties": {k: render(v) for k, v in sorted(root.fields.items())},
        "additionalProperties": True,
    }
    required = sorted(k for k, v in root.fields.items() if v.row.required)
    if required:
        schema["required"] = required
    return schema


def json_schema_text(paths: DataFrame) -> str:
    return json.dumps(json_schema(paths), sort_keys=True)


def table_schema(paths: DataFrame, as_text: tuple[str, ...] = ()) -> T.StructType:
    """The table schema of a path table: every column nullable, columns by name, paths in ``as_text`` strings."""

    def build(node: Node) -> T.DataType:
        kind = node.row.column_type
        if kind == "array" and (node.items or node.row.path not in as_text):
            item = node.items
            known = item is not None and item.row is not None
            return T.ArrayType(build(item) if known else T.StringType())
        if kind == "object":
            # Parquet has no empty structs; such objects stay JSON text.
            return struct(node) if node.fields else T.StringType()
        return {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}.get(
            kind, T.StringType()
        )

    def struct(node: Node) -> T.StructType:
        return T.StructType([T.StructField(k, build(v)) for k, v in sorted(node.fields.items())])

    return struct(field_tree(paths, as_text))


def quick_table_schema(records: DataFrame, column: str = "record", compat: bool = False, unknown: bool = False) -> T.StructType:
    """The table schema from one aggregate over the records, without counts or formats.

    ``compat`` turns a field whose objects or arrays differ in shape into text, instead of
    merging the shapes. ``unknown`` keeps what only had nulls or empty containers as void and empty structs, so that other
    runs can tell their types; ``stored_type`` gives the columns.
    """
    parsed = records.select(F.try_parse_json(column).alias("_v"))
    shape = parsed.agg(F.schema_of_variant_agg("_v")).first()[0]
    if not shape or not shape.startswith("OBJECT"):
        return T.StructType([])
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\bVARIANT\b", "STRING", shape))
    schema = _settle(T.DataType.fromDDL(ddl), unknown)
    if not compat:
        return schema
    inner = records.sparkSession.tvf.variant_explode(F.col("_v").outer()).toDF("_pos", "key", "_child")
    shapes = parsed.lateralJoin(inner).select(
        "key", F.regexp_replace(F.schema_of_variant("_child"), r"DECIMAL\(\d+,\d+\)|FLOAT", "DOUBLE").alias("shape")
    )
    nested = F.col("shape").rlike("^(OBJECT|ARRAY)")
    # The smallest and largest shape differ as soon as any two do.
    known = F.when(F.col("shape") != "VOID", F.col("shape"))
    mixed = shapes.groupBy("key").agg(F.max(nested).alias("nested"), (F.min(known) != F.max(known)).alias("mixed"))
    text = {r.key for r in mixed.filter("nested AND mixed").select("key").collect()}
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in schema.fields]
    )


def _settle(dtype: T.DataType, unknown: bool = False) -> T.DataType:
    if isinstance(dtype, T.StructType):
        fields = [T.StructField(f.name, _settle(f.dataType, unknown)) for f in sorted(dtype.fields, key=lambda f: f.name)]
        return T.StructType(fields) if fields or unknown else T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_settle(dtype.elementType, unknown))
    if isinstance(dtype, (T.DecimalType, T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, (T.LongType, T.BooleanType)) or (unknown and isinstance(dtype, T.NullType)):
        return dtype
    return T.StringType()


def stored_type(dtype: T.DataType, top: bool = True) -> T.DataType:
    """How a type is stored: what is unknown yet, void or an object without fields, is text."""
    if isinstance(dtype, T.StructType):
        fields = [T.StructField(f.name, stored_type(f.dataType, False)) for f in dtype.fields]
        return T.StructType(fields) if fields or top else T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(stored_type(dtype.elementType, False))
    return T.StringType() if isinstance(dtype, T.NullType) else dtype


def refit(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one table schema as one of a schema merged from it.

    Numbers widen, objects get the fields they lack, and what became text is JSON text.
    """
    target = stored_type(want, False)
    if have == want:
        return value
    if isinstance(have, T.NullType):
        return F.lit(None).cast(target)
    if isinstance(want, T.StringType):
        nested = isinstance(have, (T.ArrayType, T.MapType)) or (isinstance(have, T.StructType) and have.fields)
        return F.to_json(value) if nested else value.cast("string")
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        if not have.fields:
            return F.from_json(value, target)
        mine = {f.name: f.dataType for f in have.fields}
        fields = [
            (refit(value.getField(f.name), mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(stored_type(f.dataType, False))).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda item: refit(item, have.elementType, want.elementType))
    return value.cast(target)


def refit_rows(df: DataFrame, have: T.StructType, want: T.StructType, rest: tuple[str, ...] = ()) -> DataFrame:
    """Rows stored under one schema with the columns of a merged one, and the columns ``rest`` as they are."""
    mine = {f.name: f.dataType for f in have.fields}
    columns = []
    for f in want.fields:
        known = refit(F.col(f"`{f.name}`"), mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(stored_type(f.dataType, False))
        columns.append(known.alias(f.name))
    return df.select(*columns, *[F.col(f"`{c}`") for c in rest])


def merge_table_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """The union of two table schemas; fields of different kinds become strings."""

    def merge(x: T.DataType, y: T.DataType) -> T.DataType:
        if x == y:
            return x
        if isinstance(x, T.StructType) and isinstance(y, T.StructType):
            return merge_table_schemas(x, y)
        if isinstance(x, T.ArrayType) and isinstance(y, T.ArrayType):
            return T.ArrayType(merge(x.elementType, y.elementType))
        if isinstance(x, T.NullType) or isinstance(y, T.NullType):
            return y if isinstance(x, T.NullType) else x
        if isinstance(x, T.IntegralType) and isinstance(y, T.IntegralType):
            return T.LongType()
        if all(isinstance(t, (T.IntegralType, T.FractionalType)) and not isinstance(t, T.DecimalType) for t in (x, y)):
            return T.DoubleType()
        return T.StringType()

    mine = {f.name: f.dataType for f in a.fields}
    theirs = {f.name: f.dataType for f in b.fields}
    names = sorted(mine.keys() | theirs.keys())
    return T.StructType(
        [
            T.StructField(n, merge(mine[n], theirs[n]) if n in mine and n in theirs else mine.get(n) or theirs[n])
            for n in names
        ]
    )
