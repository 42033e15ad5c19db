import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.catalog import discover, table_json_schema
from tidewell.operators.schema import (
    describe_fields,
    infer_paths,
    json_schema,
    merge_paths,
    merge_table_schemas,
    quick_table_schema,
    split_path,
    table_schema,
)
from tidewell.specs import StreamSpec


@pytest.fixture
def recs(spark):
    def make(*records):
        rows = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
        return spark.createDataFrame(rows, "record string")

    return make


def table_of(df):
    return {tuple(r) for r in df.collect()}


def test_types_nulls_and_required(recs):
    schema = json_schema(infer_paths(recs({"id": 1, "name": "A"}, {"id": 2, "name": None}, {"id": 3})))
    assert schema["properties"] == {"id": {"type": "integer"}, "name": {"type": ["string", "null"]}}
    assert schema["required"] == ["id"]
    assert schema["additionalProperties"] is True


def test_numbers_and_conflicts(recs):
    schema = json_schema(
        infer_paths(recs('{"a":1,"b":1,"c":18446744073709551615,"d":null}', '{"a":1.5,"b":"x","c":1,"d":null}'))
    )["properties"]
    assert schema == {
        "a": {"type": "number"},
        "b": {"type": "string"},
        "c": {"type": "integer"},
        "d": {"type": "null"},
    }


def test_formats(recs):
    formats = {
        "t": "2024-01-15T10:30:00Z",
        "t2": "2024-01-15 10:30:00",
        "d": "2024-01-15",
        "u": "https://example.com",
        "e": "a@b.co",
        "g": "550e8400-e29b-41d4-a716-446655440000",
        "x": "a@.co",
    }
    found = json_schema(infer_paths(recs(formats)))["properties"]
    assert {k: v.get("format") for k, v in found.items()} == {
        "t": "date-time", "t2": "date-time", "d": "date", "u": "uri", "e": "email", "g": "uuid", "x": None,
    }
    off = json_schema(infer_paths(recs(formats), formats=("uri",)))["properties"]
    assert off["t"].get("format") is None and off["u"]["format"] == "uri"
    mixed = json_schema(infer_paths(recs({"a": "2024-01-15"}, {"a": "https://x.y"}, {"a": "plain"})))
    assert "format" not in mixed["properties"]["a"]


def test_nested_objects_and_arrays(recs):
    paths = infer_paths(
        recs(
            {"o": {"x": 1, "y": {"z": True}}, "l": [{"a": 1}, {"a": 2, "b": None}], "t": ["a", None]},
            {"o": {"x": 2}, "l": [], "t": []},
        )
    )
    found = json_schema(paths)["properties"]
    assert found["o"]["properties"]["x"] == {"type": "integer"}
    assert found["o"]["properties"]["y"]["type"] == ["object", "null"]
    assert found["l"]["items"]["properties"]["a"] == {"type": "integer"}
    assert found["l"]["items"]["properties"]["b"] == {"type": "null"}
    # The unknown items of an empty array count as objects, which conflicts with text.
    assert found["t"]["items"]["type"] == ["string", "null"]
    assert table_schema(paths) == T.StructType.fromDDL(
        "l array<struct<a:bigint,b:string>>, o struct<x:bigint,y:struct<z:boolean>>, t array<string>"
    )


def test_depth_limit(recs):
    deep = {"a": {"b": {"c": {"d": 1}}}}
    found = json_schema(infer_paths(recs(deep), max_depth=2))["properties"]
    assert found["a"]["properties"]["b"]["properties"] == {"c": {"type": "object"}}
    flat = json_schema(infer_paths(recs({"a": {"b": {"c": 1}}, "l": [[[1]]]}), max_depth=2))["properties"]
    assert flat["a"]["properties"]["b"]["properties"] == {"c": {"type": "object"}}
    assert flat["l"]["items"]["items"] == {"type": "object"}


def test_odd_keys(recs):
    paths = infer_paths(recs({"a.b": {"c[0]": 1, "back\\slash": 2}}))
    assert split_path("a\\.b.c\\[0\\]") == ["a.b", "c[0]"]
    assert table_schema(paths).simpleString() == "struct<a.b:struct<back\\slash:bigint,c[0]:bigint>>"


def test_quick_schema_agrees(recs):
    df = recs({"a": 1, "b": [1, 2.5], "c": {"d": "x"}}, {"a": "s", "b": [], "c": {"e": None}}, {"f": True, "g": {}})
    assert quick_table_schema(df) == table_schema(infer_paths(df))


def test_compat_collapses_shapes(recs):
    df = recs({"o": {"a": 1}, "p": {"a": 1}, "n": None}, {"o": {"b": 1}, "p": {"a": 2}, "n": {"k": 1}})
    assert quick_table_schema(df, compat=True).simpleString() == "struct<n:struct<k:bigint>,o:string,p:struct<a:bigint>>"


def test_merge_table_schemas():
    a = T.StructType.fromDDL("id bigint, v bigint, s struct<x:bigint>, k string")
    b = T.StructType.fromDDL("id bigint, v double, s struct<y:string>, k bigint, z boolean")
    assert merge_table_schemas(a, b) == T.StructType.fromDDL(
        "id bigint, k string, s struct<x:bigint,y:string>, v double, z boolean"
    )


leaf = st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from([1.5, 2.25, "x", "2024-01-01", "a@b.co"])
value = st.recursive(leaf, lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from("abc"), c, max_size=3), max_leaves=6)
record = st.dictionaries(st.sampled_from(["k", "l", "m"]), value, max_size=3)


@settings(max_examples=4, deadline=None)
@given(st.lists(record, min_size=1, max_size=6), st.lists(record, min_size=1, max_size=6))
def test_merging_is_inferring_over_all(spark, left, right):
    def paths(records):
        return infer_paths(spark.createDataFrame([(json.dumps(r),) for r in records], "record string"))

    whole = table_of(paths(left + right))
    assert table_of(merge_paths(paths(left), paths(right)).select("path", "n", "objects", "types", "formats")) == whole
    assert table_of(merge_paths(paths(right), paths(left)).select("path", "n", "objects", "types", "formats")) == whole


@settings(max_examples=6, deadline=None)
@given(st.lists(record, min_size=1, max_size=6))
def test_counts_match_a_walk(spark, records):
    seen: dict[str, int] = {}

    def walk(path, v):
        seen[path] = seen.get(path, 0) + 1
        if isinstance(v, dict):
            for k, x in v.items():
                walk(f"{path}.{k}" if path else k, x)
        elif isinstance(v, list):
            for x in v:
                walk(path + "[]", x)

    for r in records:
        walk("", r)
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "record string")
    found = {r.path: r.n for r in infer_paths(df).collect()}
    assert {p: n for p, n in found.items() if n} == seen


def test_describe(recs):
    rows = {r.path: r for r in describe_fields(infer_paths(recs({"a": [1]}, {"a": [None]}))).collect()}
    assert rows["a[]"].nullable and not rows["a[]"].required
    assert rows["a"].required


def test_catalog(spark, recs):
    streams = [(StreamSpec("users", primary_key=("id",), cursor_field="at"), recs({"id": 1, "at": "2024-01-01"}))]
    row = discover(spark, streams).first()
    assert json.loads(row.json_schema)["properties"]["at"]["format"] == "date"
    assert row.default_cursor_field == ["at"] and row.source_defined_primary_key == [["id"]]
    typed = table_json_schema(T.StructType.fromDDL("a int, b timestamp, c array<double>, d decimal(9,2)"))["properties"]
    assert typed["b"] == {"type": ["string", "null"], "format": "date-time"}
    assert typed["c"]["items"] == {"type": "number"} and typed["d"]["type"] == ["string", "null"]


def test_conform_step_of_prices(spark, tmp_path):
    """Prices whose double, plus 1, minus itself is a little less than 1: the step is 1 all the same."""
    from tidewell.queries.schemas import QUERIES

    prices = [0.9, 1000.5, 255.02, 255.03, 255.04]
    assert sum(p + 1 - p < 1 for p in prices) == 4
    rows = [(k, k, "F", p, "1-URGENT") for k, p in enumerate(prices)]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    assert {r.step for r in QUERIES["infer_and_conform"].run(spark, str(tmp_path)).collect()} == {1}


def test_fields_are_described_from_one_reading(spark, recs):
    """The path table is made once: no join of it with itself, so the records are opened once."""
    found = describe_fields(infer_paths(recs({"a": {"b": 1}}, {"a": None}).withColumn("k", F.lit(1)), by=("k",)), by=("k",))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    assert {(r.path, r.n, r.nullable, r.required) for r in found.collect()} == {("a", 2, True, False), ("a.b", 1, False, False)}
