"""Runs that go on: holes, order of pages, formats, failed partitions, batches of a stream."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators.paging import joined_runs, page_runs, page_signals, replay, usable_ends
from tidewell.operators.state import empty_state, read_state
from tidewell.plans import sync
from tidewell.plans.sync import sync_all, sync_landed
from tidewell.session import matching_paths, shared_folder
from tidewell.sinks.tables import read_stream_table
from tidewell.sources.decode import decode_pages, item_records, page_items, page_values
from tidewell.sources.pages import PAGE_SCHEMA
from tidewell.specs import Paging, Stop, StreamSpec, SyncSpec
from tidewell.streaming.landed import land_batch

MORE = Paging("offset", Stop("field", "more", False), limit=2)


def landed(spark, numbered, last, fmt="json", stream="s", partition="p", fetched="2024-01-01 00:00:00", size=2, make=None):
    """Pages by number: page k holds ids 2k-1 and 2k."""
    rows = []
    for k in numbered:
        records = (make or (lambda k: [{"id": i, "v": f"v{i}"} for i in range(size * k - size + 1, size * k + 1)]))(k)
        if fmt == "json":
            body = json.dumps({"more": k < last, "data": records})
        elif fmt == "jsonl":
            body = "\n".join(json.dumps(r) for r in records)
        elif fmt == "csv":
            body = "\n".join(["id,v", *[f"{r['id']},{r['v']}" for r in records]])
        else:
            body = "<r>" + "".join(f"<row><id>{r['id']}</id><v>{r['v']}</v></row>" for r in records) + f"<more>{str(k < last).lower()}</more></r>"
        rows.append((stream, partition, k, None, 200, {}, body, fetched))
    return spark.createDataFrame(rows, PAGE_SCHEMA.replace("fetched_at timestamp", "fetched_at string")).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def ids(spark, base, stream="s"):
    return sorted(r.id for r in read_stream_table(spark, base, stream).collect())


# Runs of pages


@pytest.mark.parametrize(("pages_", "before", "last", "status"), [([1, 3, 4], 0, 1, "gap"), ([2, 3], 0, None, "gap"), ([1, 5, 6], 0, 1, "gap"), ([2, 3], 1, 3, "open"), ([3, 5], 2, 3, "gap"), ([4], 2, None, "gap")])
def test_progress_is_the_run_after_what_is_written(spark, pages_, before, last, status):
    replayed = replay(page_signals(landed(spark, pages_, 99), MORE, "data"), MORE).withColumn("page_before", F.lit(before))
    row = usable_ends(replayed).first()
    assert (row.last_page, row.status) == (last, status)


def test_runs_of_pages_against_plain_runs(spark):
    draw = random.Random(4)
    held = {f"p{c}": sorted(draw.sample(range(1, 60), draw.randrange(1, 50))) for c in range(12)}
    rows = [("s", c, p) for c, numbers in held.items() for p in numbers for _ in range(draw.randrange(1, 3))]
    df = spark.createDataFrame(rows, "stream string, partition_id string, page_no int")
    want = set()
    for c, numbers in held.items():
        for _, run in itertools.groupby(enumerate(numbers), lambda t: t[1] - t[0]):
            run = [p for _, p in run]
            want.add((c, run[0], run[-1]))
    for block in (1, 3, 7, 4096):
        got = {(r.partition_id, r.first_page, r.last_page) for r in joined_runs(page_runs(df, block)).collect()}
        assert got == want


def test_holes_fill_in_any_order(spark, tmp_path):
    spec = StreamSpec("s", "json", "data", MORE, cursor_field="id")
    for k, order in enumerate(([[1, 4], [2], [3, 5, 6]], [[3, 5, 6], [1, 4], [2]])):
        base, state, seen = str(tmp_path / str(k)), empty_state(spark), []
        for number, pages_ in enumerate(order):
            seen += pages_
            done = sync_landed(landed(spark, sorted(seen), 6), spec, state, base, f"r{number}")
            state = done.state
        assert ids(spark, base) == list(range(1, 13))
        assert state.filter("partition_id = 'p'").first().completed


# Cursors


def test_a_chain_that_goes_on_keeps_what_is_older(spark, tmp_path):
    base, spec = str(tmp_path), StreamSpec("s", "json", "data", MORE, cursor_field="id")
    newest = lambda k: [{"id": 10 - 2 * k + 1}, {"id": 10 - 2 * k}]
    one = sync_landed(landed(spark, [1], 3, make=newest), spec, empty_state(spark), base, "r1")
    row = one.state.filter("partition_id = 'p'").first()
    assert (row.cursor, row.pending, row.completed) == (None, "9", False) and one.cursor == "9"
    two = sync_landed(landed(spark, [1, 2, 3], 3, make=newest), spec, one.state, base, "r2")
    row = two.state.filter("partition_id = 'p'").first()
    assert (row.cursor, row.completed) == ("9", True) and ids(spark, base) == [4, 5, 6, 7, 8, 9]


def test_a_stream_without_partitions_has_one_bound_per_chain(spark, tmp_path):
    base, spec = str(tmp_path), StreamSpec("s", "json", "data", MORE, cursor_field="id")
    def pages_(numbers, last, top):
        return landed(spark, numbers, last, partition=None, make=lambda k: [{"id": top - 2 * k + 2}, {"id": top - 2 * k + 1}])

    one = sync_landed(pages_([1, 2], 2, 104), spec, empty_state(spark), base, "r1")
    assert one.state.first().cursor == "104"
    two = sync_landed(pages_([1], 3, 108), spec, one.state, base, "r2")
    assert (two.state.first().cursor, two.state.first().pending, two.cursor) == ("104", "108", "108")
    three = sync_landed(pages_([1, 2, 3], 3, 108), spec, two.state, base, "r3")
    assert (three.state.first().cursor, three.state.first().page) == ("108", 0)
    assert ids(spark, base) == list(range(101, 109))


def test_numbers_are_compared_as_numbers(spark, tmp_path):
    base, spec = str(tmp_path), StreamSpec("s", "json", "data", MORE, cursor_field="id")
    make = {1: [{"id": 9}, {"id": 100}], 2: [{"id": 20}, {"id": 99}]}.get
    one = sync_landed(landed(spark, [1], 2, make=make), spec, empty_state(spark), base, "r1")
    two = sync_landed(landed(spark, [1, 2], 2, make=make), spec, one.state, base, "r2")
    assert two.state.filter("partition_id = 'p'").first().cursor == "100"


# Nothing new, scratch


def test_a_run_with_nothing_new_succeeds(spark, tmp_path):
    base, spec = str(tmp_path), StreamSpec("s", "json", "data", MORE, cursor_field="id")
    pages_ = landed(spark, [1, 2], 2)
    one = sync_landed(pages_, spec, empty_state(spark), base, "r1")
    for k, again in enumerate((pages_, pages_.limit(0))):
        done = sync_landed(again, spec, one.state, base, f"idle{k}")
        assert (done.status, done.records, done.cursor) == ("SUCCESS", 0, "4")
    results, _ = sync_all(pages_, [(spec, SyncSpec()), (StreamSpec("other", "json", "data", MORE, cursor_field="id"), SyncSpec())], one.state, base, "r3")
    assert {(r.stream, r.status) for r in results.collect()} == {("s", "SUCCESS"), ("other", "SUCCESS")}


def test_records_without_the_cursor_are_kept(spark, tmp_path):
    spec = StreamSpec("s", "json", "data", MORE, cursor_field="at")
    done = sync_landed(landed(spark, [1], 1), spec, empty_state(spark), str(tmp_path), "r1")
    assert (done.status, done.records, done.cursor) == ("SUCCESS", 2, None)


def test_scratch_goes_with_the_run(spark, tmp_path):
    spec = StreamSpec("s", "json", "data", MORE, cursor_field="id")
    sync_landed(landed(spark, [1], 1), spec, empty_state(spark), str(tmp_path), "r0")
    before = {kind: len(matching_paths(spark, f"{shared_folder(spark)}/{kind}-*")) for kind in ("decoded", "inside", "drop")}
    done = sync_landed(landed(spark, [1, 2], 2), spec, empty_state(spark), str(tmp_path / "b"), "r1", SyncSpec(error_strategy="skip"))
    assert before == {kind: len(matching_paths(spark, f"{shared_folder(spark)}/{kind}-*")) for kind in before}
    assert done.partitions.first().records == 4 and done.bad.count() == 0 and done.state.count() == 2


# Other formats


@pytest.mark.parametrize(
    ("fmt", "paging"),
    [("jsonl", Paging("offset", None, limit=2)), ("csv", Paging("page_number", None, page_size=2)), ("xml", Paging("offset", Stop("empty_page"), limit=2))],
)
def test_formats_are_counted_by_their_decoder(spark, tmp_path, fmt, paging):
    spec = StreamSpec("s", fmt, "row" if fmt == "xml" else None, paging)
    # Two full pages, one of one record.
    make = lambda k: [{"id": i, "v": "x"} for i in {1: (1, 2), 2: (3, 4), 3: (5,)}[k]]
    pages_ = landed(spark, [1, 2, 3], 3, fmt, make=make)
    one = sync_landed(pages_.filter("page_no < 3"), spec, empty_state(spark), str(tmp_path), "r1")
    assert (one.records, one.partitions.first().status) == (4, "open")
    two = sync_landed(pages_, spec, one.state, str(tmp_path), "r2")
    assert two.partitions.first().status == "complete" and [int(i) for i in ids(spark, str(tmp_path))] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("fmt", ["jsonl", "csv"])
def test_what_stands_beside_records_needs_a_body_for_it(spark, fmt):
    for paging in (Paging("cursor", cursor_path="next"), Paging("next_url", next_path="next"), Paging("offset", Stop("total_count", "n"))):
        with pytest.raises(ValueError, match="beside them"):
            page_signals(landed(spark, [1], 1, fmt), paging, None, fmt)


def test_xml_says_where_to_go_on(spark, tmp_path):
    spec = StreamSpec("s", "xml", "row", Paging("page_number", Stop("field", "more", False)))
    done = sync_landed(landed(spark, [1, 2, 3], 2, "xml"), spec, empty_state(spark), str(tmp_path), "r1")
    assert done.records == 4


def test_items_are_the_decoded_records(spark, pages):
    bodies = {
        "jsonl": ['{"a":1}\n\nbroken\r\n {"a":2} ', "", None],
        "csv": ['a,b,a\n1,"x, ""y""",3\n\n ,z\n', "a", "", None],
        "json": ['{"data":[{"a":1},{"a":"{"}]}', '{"data":', "[]", None],
        "xml": ["<r><row><a>1</a></row><row><a>2</a></row></r>", "<r>", "", None],
    }
    for fmt, texts in bodies.items():
        path = {"json": "data", "xml": "row"}.get(fmt)
        df = pages(*texts)
        want = sorted((tuple(r) for r in decode_pages(df, fmt, path).select("page_no", "pos", "record", "error").collect()), key=repr)
        got = sorted((tuple(r) for r in item_records(page_items(df, fmt, path), fmt).select("page_no", "pos", "record", "error").collect()), key=repr)
        assert got == want, fmt


def test_raw_csv_with_another_delimiter(spark, pages):
    row = page_values(pages("1;x\n2;y"), "csv", ";", False).select(F.to_json("value")).first()
    assert json.loads(row[0]) == [{"column_0": 1, "column_1": "x"}, {"column_0": 2, "column_1": "y"}]


def test_the_cap_counts_records_not_lines(spark, tmp_path):
    make = lambda k: [{"id": k}]
    page = landed(spark, [1], 1, "jsonl", make=make).withColumn("body", F.lit('\n\n{"id":1}\n\n{"id":2}\n{"id":3}'))
    done = sync_landed(page, StreamSpec("s", "jsonl", max_records=2), empty_state(spark), str(tmp_path), "r1")
    assert done.records == 2 and ids(spark, str(tmp_path)) == [1, 2]


# Failed partitions


def test_errors_stop_at_their_partition(spark, tmp_path):
    good = [landed(spark, [1], 1, "jsonl", partition=f"p{k}", make=lambda _, k=k: [{"id": k}]) for k in range(4)]
    bad = landed(spark, [1], 1, "jsonl", partition="bad").withColumn("body", F.lit('{"id":9}\nbroken'))
    pages_ = good[0].union(good[1]).union(good[2]).union(good[3]).union(bad)
    spec = StreamSpec("s", "jsonl", paging=Paging("page_number", None), cursor_field="id")
    with pytest.raises(ValueError, match="cannot decode 1 records"):
        sync_landed(pages_, spec, empty_state(spark), str(tmp_path), "r1")
    assert matching_paths(spark, f"{tmp_path}/s/dt=*") == []
    done = sync_landed(pages_, spec, empty_state(spark), str(tmp_path), "r1", SyncSpec(fail_fast=False))
    assert (done.status, done.records) == ("PARTIAL", 4) and "1 partitions" in done.error
    assert {(r.partition_id, r.status) for r in done.partitions.collect()} == {("bad", "failed"), *[(f"p{k}", "open") for k in range(4)]}
    assert done.state.filter("partition_id = 'bad'").count() == 0 and ids(spark, str(tmp_path)) == [0, 1, 2, 3]
    only = sync_landed(bad, spec, empty_state(spark), str(tmp_path), "r2", SyncSpec(fail_fast=False))
    assert only.status == "FAILED" and only.records == 0


def test_allowed_errors_are_counted_by_partition(spark, tmp_path):
    def chain(name, broken):
        return landed(spark, [1], 1, "jsonl", partition=name).withColumn("body", F.lit("\n".join(['{"id":1}'] + ["x"] * broken)))

    pages_ = chain("a", 2).union(chain("b", 3)).union(chain("c", 0))
    done = sync_landed(pages_, StreamSpec("s", "jsonl"), empty_state(spark), str(tmp_path), "r1", SyncSpec(error_strategy="skip", max_errors=2, fail_fast=False))
    assert (done.status, done.records) == ("PARTIAL", 2) and done.bad.count() == 5
    assert {r.partition_id: r.status for r in done.partitions.collect()} == {"a": "complete", "b": "failed", "c": "complete"}


# Streams of pages


def test_batches_carry_open_chains_and_repeat_safely(spark, tmp_path):
    base, folder = str(tmp_path / "out"), str(tmp_path / "state")
    spec = StreamSpec("s", "json", "data", MORE, cursor_field="id")

    def take(number, *numbered, partition="p", last=5):
        land_batch(landed(spark, numbered, last, partition=partition), number, spec, base, folder, "2024-01-01")

    take(0, 3, 4)
    assert matching_paths(spark, f"{base}/s/dt=*") == []
    take(1, 1)
    assert ids(spark, base) == [1, 2]
    before = sorted((r[:] for r in read_state(spark, f"{folder}/s").collect()), key=repr)
    take(1, 1)  # repeated after a failure
    assert ids(spark, base) == [1, 2] and sorted((r[:] for r in read_state(spark, f"{folder}/s").collect()), key=repr) == before
    take(2, 2, 1)
    assert ids(spark, base) == list(range(1, 9))
    take(2, 2, 1)
    take(3, 5)
    assert ids(spark, base) == list(range(1, 11))
    assert read_state(spark, f"{folder}/s").filter("partition_id = 'p'").first().completed
    waiting = matching_paths(spark, f"{folder}/s/waiting/*")
    assert len(waiting) == 2 and spark.read.parquet(waiting[-1]).count() == 0


def test_a_page_that_must_be_fetched_again_waits(spark, tmp_path):
    base, folder = str(tmp_path / "out"), str(tmp_path / "state")
    spec, retry = StreamSpec("s", "jsonl", paging=Paging("offset", None, limit=2), cursor_field="id"), SyncSpec(error_strategy="retry")
    cut = landed(spark, [1, 2, 3], 3, "jsonl").withColumn("body", F.when(F.col("page_no") == 2, F.lit('{"id":3}\n{"id":')).otherwise(F.col("body")))
    land_batch(cut, 0, spec, base, folder, "2024-01-01", retry)
    assert ids(spark, base) == [1, 2]
    land_batch(landed(spark, [2], 3, "jsonl", fetched="2024-01-02 00:00:00"), 1, spec, base, folder, "2024-01-01", retry)
    assert ids(spark, base) == [1, 2, 3, 4, 5, 6]


def test_a_batch_of_many_pages_lands_as_several_files(spark, tmp_path, monkeypatch):
    """More pages give more files to a batch, so no task writes or reads all of it; the batches stay as many."""
    from tidewell.queries import carried

    base = str(tmp_path)
    monkeypatch.setattr(carried, "scratch_path", lambda spark, label: f"{base}/{label}")
    monkeypatch.setattr(carried, "PAGES_IN_FILE", 5, raising=False)
    rows = carried.streamed_pages(spark, "/root/testdata/sf0.001").agg(F.count("*"), F.count_distinct("event_id"), F.max("batches")).first()
    files = len(matching_paths(spark, f"{base}/streamed-pages/landing/*.parquet"))
    assert files > carried.FILES and files % carried.FILES == 0
    assert rows[0] == rows[1] == 1000 and rows[2] == carried.FILES


def test_state_does_not_gather_the_pages_of_a_chain(spark):
    """The pages of one chain are decoded where they are, whatever state is joined: not all in one task."""
    body = F.concat(F.lit('{"more":'), (F.col("id") < 39).cast("string"), F.lit(',"data":[{"a":'), F.col("id").cast("string"), F.lit("}]}"))
    pages = spark.range(0, 40, 1, 4).select(
        F.lit("events").alias("stream"), F.lit("p0").alias("partition_id"), (F.col("id") + 1).cast("int").alias("page_no"), F.lit(200).alias("status"),
        F.create_map().cast("map<string,string>").alias("headers"), body.alias("body"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"),
    )
    spec = StreamSpec("events", "json", "data", Paging("offset", Stop("field", "more", False), limit=1))
    found = sync.landed(pages, spec, empty_state(spark))
    assert found.records.count() == 40
    assert found.pages.select(F.input_file_name()).distinct().count() == 4
