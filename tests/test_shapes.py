"""Schemas that change, record paths against a plain reading, and the bucket hash against its published values."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.hashing import bucket_number, murmur3
from tidewell.functions.paths import extract_elements, parse_path, path_string
from tidewell.operators.schema import merge_table_schemas, quick_table_schema, refit_rows, stored_type
from tidewell.operators.state import empty_state
from tidewell.plans.sync import sync_landed
from tidewell.session import matching_paths
from tidewell.sinks.tables import append_dedup, compact, read_merged, read_stream_table, write_stream_table
from tidewell.sources.decode import decode_pages
from tidewell.specs import Paging, StreamSpec, SyncSpec


def run(spark, pages, base, number, records, mode="append", key=("id",)):
    spec = StreamSpec("s", "json", "data", Paging("none"), key, "id")
    page = pages(json.dumps({"data": records}), partition=f"p{number}")
    done = sync_landed(page, spec, empty_state(spark), base, f"r{number}", SyncSpec(write_mode=mode, buckets=4), run_date=f"2024-02-0{number}")
    assert done.status == "SUCCESS"


def files(spark, path):
    return {p: spark.read.format("binaryFile").load(p).select("modificationTime", "length").first()[:] for p in matching_paths(spark, path)}


@pytest.mark.parametrize("mode", ["append", "append_dedup"])
def test_types_change_between_runs(spark, pages, tmp_path, mode):
    base = str(tmp_path)
    run(spark, pages, base, 1, [{"id": 1, "a": 1, "o": {"x": 1}, "l": [], "n": None, "e": {}}], mode)
    kept = files(spark, f"{base}/s/*/*/*.parquet")
    run(spark, pages, base, 2, [{"id": 2, "a": "x", "o": {"x": 2, "y": {"z": True}}, "l": [{"k": 1}], "n": 2, "e": {"f": 1.5}}], mode)
    run(spark, pages, base, 3, [{"id": 3, "a": {"b": [1]}, "o": {"x": 2.5}, "l": [{"k": 1, "m": "t"}], "n": 7, "w": False}], mode)
    rows = read_stream_table(spark, base, "s") if mode == "append" else read_merged(spark, base, "s")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    assert kinds["a"] == "string" and kinds["n"] == "bigint" and kinds["w"] == "boolean"
    assert kinds["o"] == "struct<x:double,y:struct<z:boolean>>" and kinds["l"] == "array<struct<k:bigint,m:string>>" and kinds["e"] == "struct<f:double>"
    got = {r.id: r for r in rows.collect()}
    assert [got[i].a for i in (1, 2, 3)] == ["1", "x", '{"b":[1]}'] and [got[i].n for i in (1, 2, 3)] == [None, 2, 7]
    assert [got[i].o.x for i in (1, 2, 3)] == [1.0, 2.0, 2.5] and got[1].o.y is None and got[2].o.y.z is True
    assert got[1].l == [] and got[3].l[0][:] == (1, "t") and got[2].l[0][:] == (1, None) and got[2].e.f == 1.5
    assert kept.items() <= files(spark, f"{base}/s/*/*/*.parquet").items()


def test_merge_keys_that_change_their_type(spark, pages, tmp_path):
    base = str(tmp_path)
    run(spark, pages, base, 1, [{"id": 1, "v": "old"}, {"id": 2, "v": "two"}], "append_dedup")
    run(spark, pages, base, 2, [{"id": "1", "v": "new"}, {"id": "x", "v": "text"}], "append_dedup")
    want = {("1", "new"), ("2", "two"), ("x", "text")}
    assert {(r.id, r.v) for r in read_merged(spark, base, "s").collect()} == want
    assert compact(spark, base, "s") == 2
    assert {(r.id, r.v) for r in read_merged(spark, base, "s").collect()} == want


def test_tables_written_by_others_are_read_as_they_are(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{base}/t/dt=2024-01-01/run_id=r0")
    write_stream_table(spark.createDataFrame([(2, "b", 5)], "id int, v string, w int"), base, "t", "r1", "2024-01-02")
    assert {(r.id, r.v, r.w) for r in read_stream_table(spark, base, "t").collect()} == {(1, "a", None), (2, "b", 5)}


def test_compacted_tables_are_read_without_a_shuffle(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(400).select("id", (F.col("id") % 7).alias("at"))
    for k in range(3):
        append_dedup(rows.filter(F.col("id") % 3 == k), base, "t", ["id"], ["at"], 4, f"b{k}")
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" in plan(read_merged(spark, base, "t"))
    before = read_merged(spark, base, "t").collect()
    assert compact(spark, base, "t") == 3
    after = read_merged(spark, base, "t")
    assert "Exchange" not in plan(after) and sorted(after.collect()) == sorted(before)
    # A batch that touches one bucket leaves the others as they are.
    one = append_dedup(rows.filter("id = 5").withColumn("at", F.lit(99).cast("bigint")), base, "t", ["id"], ["at"], 4, "b9")
    assert "Union" in plan(one) and one.filter("id = 5").first()["at"] == 99 and one.count() == 400
    # A crash after the new batch is in place, before the old ones are gone, changes nothing.
    old = matching_paths(spark, f"{base}/t/batch=b-b9")[0]
    spark.read.parquet(old).write.partitionBy("bucket").parquet(f"{base}/t/batch=c-again")
    assert read_merged(spark, base, "t").count() == 400


def test_lattice_of_schemas():
    def of(text):
        return T.StructType.fromDDL(text)

    assert merge_table_schemas(of("a int"), of("a bigint")) == of("a bigint")
    assert merge_table_schemas(of("a int"), of("a double")) == of("a double")
    assert merge_table_schemas(of("a struct<b:void>"), of("a struct<b:boolean,c:int>")) == of("a struct<b:boolean,c:int>")
    assert merge_table_schemas(of("a timestamp"), of("a bigint")) == of("a string")
    assert stored_type(of("a void, b struct<c:void>, d array<void>")) == of("a string, b struct<c:string>, d array<string>")


def test_refit_of_nested_values(spark):
    have, want = T.StructType.fromDDL("a array<struct<b:bigint>>, m bigint"), T.StructType.fromDDL("a array<struct<b:string,c:double>>, m double, z array<string>")
    df = spark.createDataFrame([([(1,), None], 3), (None, None)], have)
    assert [r[:] for r in refit_rows(df, have, want).collect()] == [([T.Row(b="1", c=None), None], 3.0, None), (None, None, None)]


def test_unknown_types_stay_open(spark):
    df = spark.createDataFrame([('{"a":null,"b":[],"c":{}}',)], "record string")
    assert quick_table_schema(df, unknown=True).simpleString() == "struct<a:void,b:array<void>,c:struct<>>"
    assert quick_table_schema(df).simpleString() == "struct<a:string,b:array<string>,c:string>"


# Record paths


def found(spark, value, path):
    df = spark.createDataFrame([(json.dumps(value),)], "body string").withColumn("v", F.parse_json("body"))
    return [json.loads(t) for t in extract_elements(df, "v", path, "e").select(F.transform("e", lambda v: F.to_json(v)).alias("e")).first().e]


STORE = {"a b": {"x": [0, 1, 2, 3, 4, 5]}, "list": [{"k": 1, "s": "p", "f": True}, {"k": 2.5, "s": "q", "f": None}, {"s": "r", "in": {"k": 9}}], "it's": {'q"': 8}}


@pytest.mark.parametrize(
    ("path", "want"),
    [
        ("$['a b'].x[1:3]", [1, 2]),
        ("$['a b'].x[-2:]", [4, 5]),
        ("$['a b'].x[:-4]", [0, 1]),
        ("$['a b'].x[1::2]", [1, 3, 5]),
        ("$['a b'].x[::-2]", [5, 3, 1]),
        ("$['a b'].x[4:1:-1]", [4, 3, 2]),
        ("$['a b'].x[9:]", []),
        ("$['a b'].x[0,-1,2:4]", [0, 5, 2, 3]),
        ("a b.x[2]", [2]),
        ("$.list[*]['k','s']", [1, "p", 2.5, "q", "r"]),
        ("$..k", [1, 2.5, 9]),
        ("$.list[?@.k].s", ["p", "q"]),
        ("$.list[?!@.k].s", ["r"]),
        ("$.list[?@.k > 1].s", ["q"]),
        ("$.list[?2 > @.k].s", ["p"]),
        ("$.list[?@.f == null].s", ["q"]),
        ("$.list[?@.f == true].s", ["p"]),
        ("$.list[?@.s >= 'q' && @.s < \"r\"].s", ["q"]),
        ("$.list[?(@.s == 'p' || @.in.k == 9)].s", ["p", "r"]),
        ("$.list[?@.k != 1].s", ["q", "r"]),
        ("$.list[?@.s == 1]", []),
        ("$[\"it's\"]['q\"']", [8]),
        ("$.list[*]..k", [1, 2.5, 9]),
        ("$.none[*]", []),
        ("$.list[*].in.k", [9]),
    ],
)
def test_path_forms(spark, path, want):
    assert found(spark, STORE, path) == want


@pytest.mark.parametrize("path", ["$.a[", "$.a[b]", "a..", "$.a[?@.b ==]", "$.a[1:2:0]", "a[0]b", "$.a[?b]", "$.a[?(@.b == 'x']", "$.a['b]", "$.a[*,1]", "$.a[?@.b =~ 'x']", "$.a[?count(@.b)]"])
def test_paths_that_are_refused(path):
    with pytest.raises(ValueError, match="cannot read the path"):
        parse_path(path)


def test_descent_never_passes_over_depth(spark):
    value = {"k": 1}
    for _ in range(14):
        value = {"d": value}
    with pytest.raises(Exception, match="nested deeper"):
        found(spark, value, "$..k")


def test_a_path_to_one_value_has_no_choice(spark):
    with pytest.raises(ValueError, match="more than one"):
        path_string(F.lit(None).cast("variant"), "$.a[*]")


# The bucket hash: values published with the table format.


@pytest.mark.parametrize(
    ("value", "kind", "want"),
    [
        (34, "int", 2017239379),
        (34, "bigint", 2017239379),
        (Decimal("14.20"), "decimal(9,2)", -500754589),
        (dt.date(2017, 11, 16), "date", -653330422),
        (dt.datetime(2017, 11, 16, 22, 31, 8), "timestamp_ntz", -2047944441),
        (dt.datetime(2017, 11, 16, 22, 31, 8, 1), "timestamp_ntz", -1207196810),
        ("iceberg", "string", 1210000089),
        (bytearray([0, 1, 2, 3]), "binary", -188683207),
    ],
)
def test_published_hashes(spark, value, kind, want):
    df = spark.createDataFrame([(value,), (None,)], f"v {kind}")
    dtype = df.schema["v"].dataType
    rows = df.select(murmur3(F.col("v"), dtype), bucket_number(F.col("v"), dtype, 16)).collect()
    assert rows[0][:] == (want, (want & 0x7FFFFFFF) % 16) and rows[1][:] == (None, None)


def plain_murmur(data):
    h, mask = 0, 0xFFFFFFFF

    def turned(x, r):
        return ((x << r) | (x >> (32 - r))) & mask

    def word(k):
        return turned(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask

    for i in range(0, len(data) // 4 * 4, 4):
        h = turned(h ^ word(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64 & mask
    if len(data) % 4:
        h ^= word(int.from_bytes(data[len(data) // 4 * 4 :], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hashes_against_plain_steps(spark):
    texts = ["", "a", "ab", "abc", "abcd", "abcde", "ümlaut", "日本語テキスト", "x" * 101]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(murmur3(F.col("v"), T.StringType())).collect()] == [plain_murmur(t.encode()) for t in texts]
    numbers = [0, 1, -1, 2**31, -(2**31), 2**63 - 1, -(2**63), 123456789012]
    df = spark.createDataFrame([(n,) for n in numbers], "v bigint")
    assert [r[0] for r in df.select(murmur3(F.col("v"), T.LongType())).collect()] == [plain_murmur(n.to_bytes(8, "little", signed=True)) for n in numbers]
    decimals = [Decimal(n).scaleb(-2) for n in (0, 1, 127, 128, 255, 256, -1, -128, -129, -256, 32767, 32768, -32768, -32769, 10**16)]
    df = spark.createDataFrame([(d,) for d in decimals], "v decimal(18,2)")

    def fewest(n):
        size = 1
        while not -(1 << 8 * size - 1) <= n < 1 << 8 * size - 1:
            size += 1
        return n.to_bytes(size, "big", signed=True)

    assert [r[0] for r in df.select(murmur3(F.col("v"), T.DecimalType(18, 2))).collect()] == [plain_murmur(fewest(int(d.scaleb(2)))) for d in decimals]
    with pytest.raises(ValueError):
        murmur3(F.lit(1.5), T.DoubleType())


@pytest.mark.parametrize("path", ["$.a[-2:]", "$.a[::2]", "$.a[2::-1]"])
def test_slices_make_their_items_once(spark, pages, path):
    """The number of items is asked for at every item: it must not open the array anew each time."""
    found = decode_pages(pages('{"a":[1,2,3,4,5]}'), "json", path)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" in plan and "size(try_variant_get" not in plan


def test_bodies_of_grouped_pages_are_bounded(spark):
    """More users give more bodies, not longer ones."""
    from tidewell.queries.shapes import USERS_IN_BODY, grouped_pages

    found = grouped_pages(spark, "/root/testdata/sf0.01").select(F.regexp_count("body", F.lit('"user id":')).alias("n"))
    assert found.agg(F.max("n")).first()[0] <= USERS_IN_BODY
