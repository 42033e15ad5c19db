import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions.temporal import cursor_text, java_pattern, normalise_cursor, parse_datetime, parse_duration
from tidewell.operators.dedup import cap_per_group, latest_per_key, merge_latest, with_batches
from tidewell.operators.incremental import max_cursor, newer_than, newer_than_state
from tidewell.operators.jobs import completed_downloads, job_status
from tidewell.operators.messages import record_messages, state_messages
from tidewell.operators.partitions import (
    datetime_partitions,
    list_partitions,
    parent_partitions,
    pending,
    slice_number,
)
from tidewell.operators.requests import request_plan
from tidewell.operators.state import (
    clear_state,
    current_version,
    empty_state,
    export_state,
    get_cursor,
    import_state,
    parse_state,
    mark_completed,
    publish_state,
    read_state,
    upsert_state,
)
from tidewell.operators.summary import run_summary
from tidewell.sources.tables import listing
from tidewell.specs import JobSpec, RequestSpec


def slices(spark, *args, **kw):
    rows = datetime_partitions(spark, "s", *args, **kw).orderBy("n").collect()
    return [(r.partition_id, str(r.slice_start), str(r.slice_end)) for r in rows]


def test_daily_and_partial_slices(spark):
    got = slices(spark, "2024-01-01", "2024-01-02 12:00:00", "1d", "%Y-%m-%d")
    assert got == [
        ("0_2024-01-01", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        ("1_2024-01-02", "2024-01-02 00:00:00", "2024-01-02 12:00:00"),
    ]
    assert len(slices(spark, "2024-01-01", "2024-01-04", "1d")) == 3
    assert len(slices(spark, "2024-01-01", "2024-01-01 03:00:00", "1h")) == 3
    assert slices(spark, "2024-01-02", "2024-01-01", "1d") == []


def test_month_slices_do_not_drift(spark):
    got = slices(spark, "2024-01-31", "2024-05-01", "P1M", "%Y-%m-%d")
    assert [g[1][:10] for g in got] == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 400), st.sampled_from(["7m", "1h", "5h", "1d"]))
def test_slices_tile_the_range(spark, hours, step):
    end = dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)
    got = slices(spark, "2024-01-01", str(end), step)
    assert got[0][1] == "2024-01-01 00:00:00" and got[-1][2] == str(end)
    assert all(a[2] == b[1] for a, b in zip(got, got[1:]))


def test_slice_number(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:59",), ("2024-01-02 00:00:00",)], "t string")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    got = df.select(slice_number(F.col("t").cast("timestamp_ntz"), start, "1d").alias("n")).collect()
    assert [r.n for r in got] == [0, 1]


def test_durations_and_patterns():
    assert [parse_duration(t).seconds for t in ("1d", "2h", "30m", "45s", "2w", "3", "PT6H", "P1D")] == [
        86400, 7200, 1800, 45, 1209600, 259200, 21600, 86400,
    ]
    assert parse_duration("P1Y2M").months == 14
    for bad in ("x", "1y", "P", ""):
        with pytest.raises(ValueError):
            parse_duration(bad)
    assert java_pattern("%Y-%m-%dT%H:%M:%SZ") == "yyyy-MM-dd'T'HH:mm:ss'Z'"
    with pytest.raises(ValueError):
        java_pattern("%Q")


def test_datetimes(spark):
    texts = ["2024-01-15T10:30:00.5+02:00", "2024-01-15T10:30:00", "2024-01-15 10:30:00", "2024-01-15", "2024/01/15", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r.p for r in df.select(parse_datetime(F.col("t")).alias("p")).collect()]
    day, clock = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15, 10, 30)
    assert got == [dt.datetime(2024, 1, 15, 8, 30, 0, 500000), clock, clock, day, day, None]
    one = spark.range(1)
    assert one.select(normalise_cursor(F.lit("1701388800"), "unix")).first()[0] == dt.datetime(2023, 12, 1)
    assert one.select(cursor_text(F.lit("2024-01-01").cast("date"), "date")).first()[0] == "2024-01-01"


def test_lists_parents_and_pending(spark):
    work = list_partitions(spark, "s", "region", ["us-east", "us-west"])
    assert [r["values"] for r in work.orderBy("partition_id").collect()] == [{"region": "us-east"}, {"region": "us-west"}]
    state = mark_completed(empty_state(spark), work.filter("partition_id = 'us-east'"))
    assert [r.partition_id for r in pending(work, state).collect()] == ["us-west"]
    parents = spark.createDataFrame([(1,), (2,), (1,), (None,)], "id int")
    assert sorted(r.partition_id for r in parent_partitions(parents, "s", "id", "parent").collect()) == ["1", "2"]


def test_requests(spark):
    work = list_partitions(spark, "s", "region", ["a"])
    spec = RequestSpec("s", "https://h/", "/{{ partition.region }}/{{config.v}}", {"q": "{{ vars.q }}", "e": "{{ name }}", "c": "{{state.cursor}}"})
    row = request_plan(work, [spec], {"v": 2, "name": "n"}, {"q": None}).first()
    assert (row.url, row.params) == ("https://h/a/2", {"e": "n"})
    with pytest.raises(ValueError, match="undefined"):
        request_plan(work, [RequestSpec("s", "https://h", "/{{ config.no }}")])
    with pytest.raises(Exception, match="undefined"):
        request_plan(work, [RequestSpec("s", "https://h", "/{{ partition.no }}")]).collect()


def test_jobs(spark):
    rows = [(1, 1, '{"state":"InProgress"}'), (1, 2, '{"state":"JobComplete"}'), (2, 1, '{"state":"Aborted"}'), (3, 1, "{}"),
            (4, 1, '{"state":"Queued"}'), (5, 1, '{"state":7}')]
    polls = spark.createDataFrame(rows, "job_id int, polled_at int, body string")
    status = job_status(polls, JobSpec())
    assert {r.job_id: r.state for r in status.collect()} == {1: "Completed", 2: "Failed", 3: "Unknown", 4: "InProgress", 5: "Unknown"}
    assert {r.job_id: r.state for r in job_status(polls, JobSpec(max_attempts=1)).collect()}[4] == "TimedOut"
    downloads = spark.createDataFrame([(1, "x"), (2, "y")], "job_id int, page string")
    assert [r.page for r in completed_downloads(downloads, status).collect()] == ["x"]


def test_cursors(spark):
    df = spark.createDataFrame([("9", 9, "a"), ("10", 10, "b")], "s string, n int, k string")
    assert df.agg(max_cursor(df, "s")).first()[0] == "9"
    assert df.agg(max_cursor(df, "n"), max_cursor(df, "n", "string"), max_cursor(df, "n", floor="50")).first()[:] == ("10", "9", "50")
    assert newer_than(df, "n", "9").count() == 1 and newer_than(df, "n", None).count() == 2
    state = spark.createDataFrame([("a", "9")], "k string, cursor string")
    assert [r.k for r in newer_than_state(df, state, ["k"], "n").collect()] == ["b"]


rows_of = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30)), max_size=25, unique=True)


@settings(max_examples=6, deadline=None)
@given(rows_of, rows_of)
def test_merge_is_latest_of_all(spark, old, new):
    schema = "k int, o int"
    existing = latest_per_key(spark.createDataFrame(old, schema), ["k"], ["o"])
    got = {tuple(r) for r in merge_latest(existing, spark.createDataFrame(new, schema), ["k"], ["o"]).collect()}
    best: dict[int, int] = {}
    for k, o in [*old, *new]:
        best[k] = max(o, best.get(k, -1))
    assert got == set(best.items())


def test_hot_key_caps_and_batches(spark):
    # One key holds most rows.
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 3).alias("k"), "id")
    want = {k: [] for k in (0, 1, 2)}
    for i in range(5000):
        want[0 if i % 10 < 8 else i % 3].append(i)
    got = cap_per_group(df, ["k"], ["id"], 150, salts=8).collect()
    assert {k: sorted(r.id for r in got if r.k == k) for k in want} == {k: v[:150] for k, v in want.items()}
    batches = with_batches(df, ["k"], "id", batch_size=100, width=256).collect()
    assert all(r.batch == want[r.k].index(r.id) // 100 for r in batches)


def test_state(spark, tmp_path):
    text = json.dumps({"streams": {"a": {"cursor": "5", "partitions": {"p": {"completed": True}}}}})
    state = import_state(spark, text)
    assert get_cursor(state, "a") == "5" and get_cursor(state, "z") is None
    bare = import_state(spark, json.dumps({"a": {"cursor": "5"}}))
    assert get_cursor(bare, "a") == "5"
    state = upsert_state(state, spark.createDataFrame([("a", "7"), ("b", "1")], "stream string, cursor string"))
    out = {k: v for r in export_state(state).collect() for k, v in json.loads(r.doc)["streams"].items()}
    assert {tuple(r) for r in parse_state(export_state(state)).collect()} == {tuple(r) for r in state.collect()}
    assert out["a"] == {"cursor": "7", "partitions": {"p": {"cursor": None, "completed": True}}} and out["b"]["cursor"] == "1"
    assert clear_state(state, "a").count() == 1 and clear_state(state).count() == 0
    folder = str(tmp_path / "state")
    assert current_version(spark, folder) is None and read_state(spark, folder).count() == 0
    publish_state(state, folder, 1)
    publish_state(upsert_state(read_state(spark, folder), spark.createDataFrame([("a", "8")], "stream string, cursor string")), folder, 2)
    # A version without its commit row is not in force.
    clear_state(state).write.parquet(f"{folder}/versions/0000000003")
    assert get_cursor(read_state(spark, folder), "a") == "8"


def test_messages_and_summary(spark):
    df = spark.createDataFrame([(1, None, bytearray(b"hi"))], "id int, name string, b binary")
    message = json.loads(record_messages(df, "users", F.lit(5)).first().message)
    assert message == {"type": "RECORD", "record": {"stream": "users", "data": {"id": 1, "name": None, "b": "aGk="}, "emitted_at": 5}}
    state = spark.createDataFrame([("users", "9")], "stream string, cursor string")
    assert json.loads(state_messages(state).first().message)["state"]["stream"]["stream_state"] == {"cursor": "9"}
    for statuses, expected in ((["SUCCESS"], "SUCCEEDED"), (["FAILED"], "FAILED"), (["SUCCESS", "FAILED"], "PARTIAL")):
        results = spark.createDataFrame([(s, 1) for s in statuses], "status string, records_synced bigint")
        assert run_summary(results).first().status == expected


def test_listing_leaves_out_system_schemas(spark):
    rows = [("public", "b"), ("public", "a"), ("pg_catalog", "x"), ("information_schema", "y")]
    got = listing(spark.createDataFrame(rows, "table_schema string, table_name string"), "postgres").collect()
    assert [r.full_name for r in got] == ["public.a", "public.b"]
