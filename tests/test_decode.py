import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.paths import extract_elements, parse_path, path_string
from tidewell.functions.text import link_url, sanitise_name
from tidewell.operators.conform import conform
from tidewell.operators.errors import TooManyErrors, bad_records, check_errors, good_records
from tidewell.sources.decode import csv_cells, decode_pages, decode_typed, page_items, page_values


def records(df):
    rows = df.orderBy("page_no", "pos").collect()
    return [json.loads(r.record) for r in rows if r.record is not None]


@pytest.mark.parametrize(
    ("body", "path", "expected"),
    [
        ('[{"sku":"k7"},{"sku":"k9"}]', None, [{"sku": "k7"}, {"sku": "k9"}]),
        ('{"sku":"k7","open":false}', None, [{"sku": "k7", "open": False}]),
        ('{"page":4,"rows":[{"sku":"k7"},{"sku":"k9"}]}', "rows", [{"sku": "k7"}, {"sku": "k9"}]),
        ('{"outer":{"rows":[{"q":0.5}]},"took":12}', "outer.rows", [{"q": 0.5}]),
        ('{"rows":[{"q":1},{"q":2},{"q":3}]}', "rows[-1]", [{"q": 3}]),
        ('{"rows":[{"q":1},{"q":2},{"q":3}]}', "$.rows[1].q", [2]),
        ('{"rows":[{"q":1},{"q":2}]}', "$.rows[*]", [{"q": 1}, {"q": 2}]),
        ('{"rows":[{"m":[9,8]},{"m":[7]},{"n":0}]}', "$.rows[*].m[*]", [9, 8, 7]),
        ('{"rows":{"q":3}}', "rows", [{"q": 3}]),
        ('{"rows":null}', "rows", [None]),
        ('{"rows":[]}', "rows", []),
        ('{"lines":1}', "rows", []),
        ('{"rows":["a",1,null,{"b":2}]}', "rows", ["a", 1, None, {"b": 2}]),
        ('{"rows":["{x","{}",{"b":2}]}', "rows", ["{x", "{}", {"b": 2}]),
        ('{"rows":[{"t":"] x [, \\"{"}]}', "rows", [{"t": '] x [, "{'}]),
        ("[]", None, []),
    ],
)
def test_json_record_paths(pages, body, path, expected):
    decoded = decode_pages(pages(body), "json", path)
    assert records(decoded) == expected
    assert decoded.filter("error IS NOT NULL").count() == 0


def test_json_keeps_number_text(pages):
    rows = decode_pages(pages('{"data":[{"a":1.0}]}', '{"a":1.0}'), "json", "data").collect()
    assert [r.record for r in rows] == ['{"a":1.0}']
    assert decode_pages(pages('{"a":1.0}'), "json").first().record == '{"a":1.0}'


def test_bad_bodies_are_reported(pages):
    decoded = decode_pages(pages("not valid json", "", '{"data":[{"a":1},', '[{"a":1}]', None), "json")
    assert [r.page_no for r in decoded.filter("error = 'bad body'").orderBy("page_no").collect()] == [1, 2, 3, 5]
    assert bad_records(decoded).count() == 4
    assert good_records(decoded, "skip").count() == 1
    with pytest.raises(Exception, match="cannot decode"):
        good_records(decoded, "fail").collect()


def test_too_many_errors():
    check_errors(100)
    with pytest.raises(TooManyErrors):
        check_errors(101, 100)


def test_jsonl_lines(pages):
    decoded = decode_pages(pages('{"id":1}\n\n {"id":2} \r\nnot valid json\n{"id":3}\n'), "jsonl")
    assert records(decoded) == [{"id": 1}, {"id": 2}, {"id": 3}]
    assert [r.error for r in decoded.filter("error IS NOT NULL").collect()] == ["bad line 4"]
    raw = page_values(pages('{"id":1}\n\n{"id":2}'), "jsonl").select(F.to_json("value").alias("v")).first().v
    assert json.loads(raw) == [{"id": 1}, {"id": 2}]


@pytest.mark.parametrize(
    ("body", "options", "expected"),
    [
        ("sku,town,left\nk7,Oslo,30\nk9,Lima,0", {}, [{"sku": "k7", "town": "Oslo", "left": 30}, {"sku": "k9", "town": "Lima", "left": 0}]),
        ('p,q\n"one, two","5"" wide"', {}, [{"p": "one, two", "q": '5" wide'}]),
        ("k7,Oslo,30", {"has_header": False}, [{"column_0": "k7", "column_1": "Oslo", "column_2": 30}]),
        ("sku\ttown\nk7\tOslo\n\tLima", {"delimiter": "\t"}, [{"sku": "k7", "town": "Oslo"}, {"sku": None, "town": "Lima"}]),
        ("v\ntrue\nno\nyes\nfalse\n0\n1", {}, [{"v": v} for v in (True, False, True, False, 0, 1)]),
        ("p,q\n,null\nnone,z", {}, [{"p": None, "q": None}, {"p": None, "q": "z"}]),
        ("p,q\n8\n\n7,6,5", {}, [{"p": 8, "q": None}, {"p": 7, "q": 6}]),
        ("v\n2.5f\nNaN\n1e999\n.25\n-9\n2e3", {}, [{"v": v} for v in ("2.5f", "NaN", "1e999", 0.25, -9, 2000.0)]),
        ("p,p\n3,4", {}, [{"p": 4}]),
        ("p,q", {}, []),
        ("", {}, []),
    ],
)
def test_csv(pages, body, options, expected):
    assert records(decode_pages(pages(body), "csv", **options)) == expected


def test_csv_cells_survive_long_text(spark):
    cell = "x" * 300_000
    quotes = '""' * 50_000
    line = f'"{cell}","{quotes}",end'
    row = spark.createDataFrame([(line,)], "line string").select(csv_cells(F.col("line")).alias("c")).first()
    assert row.c == [cell, '"' * 50_000, "end"]


def written(cell: str, spaces: int) -> str:
    """A cell as a line holds it: quoted where it must be, with white space around it."""
    quoted = '"' + cell.replace('"', '""') + '"' if set(cell) & set('",') else cell
    return " " * spaces + quoted + " " * spaces


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text(alphabet='a", b', max_size=9), st.integers(0, 2)), min_size=1, max_size=6), min_size=1, max_size=40))
def test_csv_cells_read_back(spark, lines):
    texts = [",".join(written(cell, spaces) for cell, spaces in line) for line in lines]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, line string")
    got = {r.i: r.c for r in df.select("i", csv_cells(F.col("line")).alias("c")).collect()}
    assert [got[i] for i in range(len(lines))] == [[cell.strip(" ") for cell, _ in line] for line in lines]


def test_text_around_json_is_reported(pages):
    decoded = decode_pages(pages('{"rows":[{"a":1}]} more', '{"rows":[{"a":1}]}}', '{"rows":[{"a":1}]}{"b":2}', '{"rows":[{"a":1}]} \n'), "json", "rows")
    assert [r.page_no for r in decoded.filter("error IS NOT NULL").orderBy("page_no").collect()] == [1, 2, 3]


def test_raw_csv(pages):
    raw = page_values(pages('p,q\n1,"x, y"\n\n2', "", None), "csv").orderBy("page_no").select(F.to_json("value").alias("v")).collect()
    assert [json.loads(r.v) if r.v else None for r in raw] == [[{"p": 1, "q": "x, y"}, {"p": 2, "q": None}], [], None]


@pytest.mark.parametrize(
    ("body", "path", "expected"),
    [
        ("<root><name>Test</name><value>42</value></root>", None, [{"name": "Test", "value": 42}]),
        ("<root><items><item><id>1</id></item><item><id>2</id></item></items></root>", "items.item", [{"id": 1}, {"id": 2}]),
        ("<root><items><item><id>1</id></item></items></root>", "items.item", [{"id": 1}]),
        ("<user><profile><name>A</name><age>7</age></profile></user>", None, [{"profile": {"name": "A", "age": 7}}]),
        ("<?xml version='1.0'?><r><a x='1'>yes</a><b/><c>1,000</c><d>TRUE</d></r>", None, [{"a": "yes", "b": None, "c": "1,000", "d": True}]),
    ],
)
def test_xml(pages, body, path, expected):
    assert records(decode_pages(pages(body), "xml", path)) == expected


def test_broken_xml_is_reported(pages):
    decoded = decode_pages(pages("not xml", "<a><b>1</a>", "", "<a><b>1</b></a>"), "xml")
    assert [r.page_no for r in decoded.filter("error IS NOT NULL").orderBy("page_no").collect()] == [1, 2, 3]


def test_decode_typed_is_decode_then_conform(pages):
    bodies = ['{"d":[{"a":1,"b":"x"},{"a":"no","c":2}]}', '{"d":[]}', '{"e":1}', "bad"]
    schema = T.StructType.fromDDL("a bigint, b string")
    typed = decode_typed(pages(*bodies), schema, "d")
    assert [(r.a, r.b) for r in typed.filter("error IS NULL").orderBy("pos").collect()] == [(1, "x"), (None, None)]
    assert [r.page_no for r in typed.filter("error IS NOT NULL").orderBy("page_no").collect()] == [3, 4]


def test_paths(spark):
    assert parse_path("$.a.b[0][-1]") == ["a", "b", 0, -1]
    assert parse_path("a[-1].x[*].y") == ["a", -1, "x"]
    df = spark.createDataFrame([('{"a":{"b":[1,{"c":"x"}]},"n":null,"t":true}',)], "j string").select(F.parse_json("j").alias("v"))
    got = df.select(*[path_string(F.col("v"), p).alias(f"c{i}") for i, p in enumerate(["a.b[0]", "a.b[-1].c", "a.b", "n", "t", "a.b[9]", "a.b[-9]"])]).first()
    assert list(got) == ["1", "x", None, None, "true", None, None]
    items = extract_elements(df, "v", "a.b", "e").select(F.transform("e", lambda v: F.to_json(v)).alias("e")).first().e
    assert items == ["1", '{"c":"x"}']


def test_conform(spark):
    df = spark.createDataFrame([('{"id":1,"s":{"k":1},"x":9,"n":1.5,"t":["a",1]}',), ('{"id":"2","n":3}',), ("7",)], "record string")
    rows = conform(df, T.StructType.fromDDL("id bigint, s string, n double, t array<string>, gone boolean")).collect()
    assert [tuple(r) for r in rows] == [
        (1, '{"k":1}', 1.5, ["a", "1"], None),
        (None, None, 3.0, None, None),
        (None, None, None, None, None),
    ]


def test_link_headers(spark):
    cases = {
        '<https://a/2>; rel="next", <https://a/1>; rel="prev"': "https://a/2",
        "<https://a/1>; rel=\"prev\", <https://a/3?x=1,2>; rel=next": "https://a/3?x=1,2",
        '<https://a/1>; rel="prev"': None,
        '<https://a/1>; rel="nextish"': None,
        "": None,
    }
    df = spark.createDataFrame([(i, h) for i, h in enumerate(cases)], "i int, h string")
    got = [r.u for r in df.select("i", link_url(F.col("h")).alias("u")).orderBy("i").collect()]
    assert got == list(cases.values())
    assert spark.range(1).select(sanitise_name(F.lit("a.b.c"))).first()[0] == "a_b_c"


def test_csv_keys_are_made_once_per_page(spark, pages):
    """What the header decides does not stand in the expression that makes the records."""
    listed = page_items(pages("a,b,a\n1,2,3\n4,5,6"), "csv")
    # The lambda over the records sees the keys as a variable.
    assert "transform(array(filter(" in listed._jdf.queryExecution().optimizedPlan().toString()
    assert [r["record"] for r in listed.first()["items"]] == ['{"b":2,"a":3}', '{"b":5,"a":6}']
