import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.conform import union_streams
from tidewell.operators.state import current_version, empty_state, get_cursor, read_state
from tidewell.operators.summary import run_summary
from tidewell.plans.sync import landed_records, sync_all, sync_landed, sync_table
from tidewell.sinks.tables import (
    EmptyInput,
    append_dedup,
    read_stream_table,
    resolve_uri,
    transform_column,
    write_stream_table,
)
from tidewell.sources.tables import read_table
from tidewell.specs import Paging, Stop, StreamSpec, SyncSpec, TableSpec
from tidewell.streaming.landed import stream_sync


def test_incremental_table_sync(spark, tmp_path):
    base, spec = str(tmp_path / "out"), TableSpec("shop.users", cursor_field="at", primary_key=("id",))
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, at string")
    first = sync_table(df, spec, empty_state(spark), base, "r1", run_date="2024-02-01")
    assert (first.records, first.cursor) == (2, "2024-01-02")
    more = df.union(spark.createDataFrame([(3, "2024-01-03")], "id int, at string"))
    second = sync_table(more, spec, first.state, base, "r2", run_date="2024-02-01")
    assert (second.records, second.cursor) == (1, "2024-01-03")
    idle = sync_table(more, spec, second.state, base, "r3", run_date="2024-02-02")
    assert (idle.records, idle.cursor) == (0, "2024-01-03")
    assert sorted(r.id for r in read_stream_table(spark, base, "shop.users").collect()) == [1, 2, 3]


def test_lookback_reads_again_but_the_cursor_stays(spark, tmp_path):
    spec = TableSpec("t", cursor_field="n", lookback_seconds=5)
    df = spark.createDataFrame([(i,) for i in range(10)], "n int")
    done = sync_table(df, spec, empty_state(spark), str(tmp_path), "r1")
    again = sync_table(df.filter("n < 8"), spec, done.state, str(tmp_path), "r2")
    assert (again.records, again.cursor) == (3, "9")


def test_overwrite_json_and_empty(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    write_stream_table(df, base, "s", "r1", "2024-01-01", fmt="json")
    write_stream_table(df.limit(1), base, "s", "r2", "2024-01-02", fmt="json", mode="overwrite")
    assert spark.read.json(f"{base}/s").count() == 1
    with pytest.raises(EmptyInput):
        write_stream_table(df.limit(0), base, "s", "r3", allow_empty=False)
    with pytest.raises(ValueError):
        write_stream_table(df, base, "s", "r4", compression="lzo")
    write_stream_table(df, base, "lines", "r1", "2024-01-01", fmt="json")
    assert {(r.id, r.v) for r in spark.read.json(f"{base}/lines").collect()} == {(1, None), (2, "x")}


def test_append_dedup_with_a_new_column(spark, tmp_path):
    base = str(tmp_path)
    append_dedup(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id int, at int, v string"), base, "t", ["id"], ["at"], 4)
    fresh = spark.createDataFrame([(1, 2, "c", 9), (2, 0, "late", 9), (3, 1, "d", 9)], "id int, at int, v string, w int")
    table = append_dedup(fresh, base, "t", ["id"], ["at"], 4)
    assert {(r.id, r.v, r.w) for r in table.collect()} == {(1, "c", 9), (2, "b", None), (3, "d", 9)}


def envelope(ids, **extra):
    return json.dumps({"data": [{"id": i, "at": f"2024-01-{i:02d}", "v": i / 2} for i in ids], **extra})


def test_landed_sync_stops_resumes_and_dedups(spark, pages, tmp_path):
    spec = StreamSpec("s", "json", "data", Paging("cursor", Stop("field", "more", False), cursor_path="next"), ("id",), "at")
    landed = pages(envelope([1, 2], more=True, next="2"), envelope([3], more=False, next=None), envelope([4], more=True))
    done = sync_landed(landed, spec, empty_state(spark), str(tmp_path), "r1", run_date="2024-02-01")
    assert (done.status, done.records, done.cursor) == ("SUCCESS", 3, "2024-01-03")
    rows = read_stream_table(spark, str(tmp_path), "s")
    assert {(r.id, r.v) for r in rows.collect()} == {(1, 0.5), (2, 1.0), (3, 1.5)}
    assert rows.schema["id"].dataType == T.LongType()
    # The chain is complete, so a second run has nothing to do.
    state = done.state
    assert landed_records(landed, spec, state)[0].count() == 0
    assert get_cursor(state, "s") == "2024-01-03"


def test_landed_cap_and_errors(spark, pages, tmp_path):
    spec = StreamSpec("s", "json", "data", max_records=3, paging=Paging("page_number"))
    assert landed_records(pages(envelope([1, 2]), envelope([3, 4]), envelope([5])), spec)[0].count() == 3
    lines = StreamSpec("s", "jsonl")
    bad = pages('{"id":1}\nbroken\n{"id":2}')
    with pytest.raises(Exception, match="cannot decode"):
        sync_landed(bad, lines, empty_state(spark), str(tmp_path), "r1", SyncSpec(error_strategy="fail"))
    skipped = sync_landed(bad, lines, empty_state(spark), str(tmp_path), "r2", SyncSpec(error_strategy="skip"))
    assert (skipped.status, skipped.records) == ("SUCCESS", 2)
    strict = sync_landed(bad, lines, empty_state(spark), str(tmp_path), "r3", SyncSpec(error_strategy="skip", max_errors=0))
    assert strict.status == "FAILED" and "1 bad records" in strict.error


def test_streams_without_partitions_are_synced_again(spark, pages, tmp_path):
    spec = StreamSpec("s", "json", "data", cursor_field="at")
    landed = pages(envelope([1, 2]), partition=None)
    done = sync_landed(landed, spec, empty_state(spark), str(tmp_path), "r1")
    assert done.records == 2 and done.state.filter("completed").count() == 0
    again = sync_landed(pages(envelope([2, 3]), partition=None), spec, done.state, str(tmp_path), "r2")
    assert (again.records, again.cursor) == (1, "2024-01-03")


def test_a_failing_stream_does_not_stop_the_others(spark, pages, tmp_path):
    landed = pages("broken", stream="a").union(pages(envelope([1]), stream="b"))
    streams = [(StreamSpec("a", "json", "data"), SyncSpec()), (StreamSpec("b", "json", "data", cursor_field="at"), SyncSpec())]
    results, state = sync_all(landed, streams, empty_state(spark), str(tmp_path), "r1")
    assert {r.stream: r.status for r in results.collect()} == {"a": "FAILED", "b": "SUCCESS"}
    assert run_summary(results).first().status == "PARTIAL"
    assert {(r.stream, r.partition_id, r.cursor) for r in state.collect()} == {("b", "p", "2024-01-01"), ("b", None, "2024-01-01")}
    stopped, _ = sync_all(landed, streams, empty_state(spark), str(tmp_path), "r2", fail_fast=True)
    assert stopped.count() == 1


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    schema = "id int, at string"

    def land(name, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{landing}/{name}")

    def sync():
        source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
        stream_sync(source, "s", out, str(tmp_path / "cp"), "2024-01-01", cursor_field="at", state_folder=str(tmp_path / "state"))

    land("a", (1, "2024-01-01"), (2, "2024-01-02"))
    sync()
    land("b", (3, "2023-12-31"))
    sync()
    assert sorted(r.id for r in read_stream_table(spark, out, "s").collect()) == [1, 2, 3]
    # The late row does not move the cursor back.
    assert get_cursor(read_state(spark, str(tmp_path / "state" / "s")), "s") == "2024-01-02"
    assert current_version(spark, str(tmp_path / "state" / "s")) == 1


def test_union_of_conflicting_columns(spark):
    a = spark.createDataFrame([(1, 2)], "id int, v int")
    b = spark.createDataFrame([(2, 1.5)], "id int, v double")
    c = spark.createDataFrame([(3, "x", True)], "id bigint, w string, z boolean")
    out = union_streams(a, b, c)
    assert dict(out.dtypes) == {"id": "bigint", "v": "double", "w": "string", "z": "boolean"}


def test_uris_and_transforms(spark):
    assert [resolve_uri(u) for u in ("s3://b/p", "r2://b", "gs://b", "az://c/p", "/x", "file:///x")] == [
        "s3a://b/p", "s3a://b", "gs://b", "abfss://c/p", "/x", "file:///x",
    ]
    with pytest.raises(ValueError):
        resolve_uri("ftp://x")
    df = spark.createDataFrame([("abcdef", -7)], "s string, n int")
    assert df.select(transform_column(df, "s", "truncate[2]"), transform_column(df, "n", "truncate[5]")).first()[:] == ("ab", -10)
    for bad in ("bucket", "week", "year[2]"):
        with pytest.raises(ValueError):
            transform_column(df, "s", bad)


def test_filters_reach_the_scan(spark, tmp_path):
    from tidewell.operators.incremental import newer_than

    path = str(tmp_path / "t")
    spark.range(100).select("id", F.lit("x").alias("pad")).write.parquet(path)
    plan = newer_than(spark.read.parquet(path), "id", "50").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,50)" in plan and "pad" not in plan


def test_bodies_do_not_move(spark, pages):
    spec = StreamSpec("s", "json", "data", Paging("cursor", Stop("field", "more", False), cursor_path="next"))
    found, _ = landed_records(pages(envelope([1, 2], more=True, next="2"), envelope([3], more=False, next=None)), spec)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 3


def test_a_jdbc_read_in_one_task_must_be_asked_for(spark):
    with pytest.raises(ValueError, match="partition_column"):
        read_table(spark, TableSpec("t", table="t"), {"format": "jdbc"})
