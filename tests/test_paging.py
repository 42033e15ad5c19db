import json

import pytest
from pyspark.sql import functions as F

from tidewell.operators.paging import (
    chain_ends,
    keep_pages,
    missing_pages,
    offset_requests,
    page_signals,
    record_positions,
    replay,
    with_running_total,
)
from tidewell.sources.pages import latest_fetch, page_outcome
from tidewell.specs import Paging, Stop


def body(n, **extra):
    return json.dumps({"data": [{"id": i} for i in range(n)], **extra})


def run(pages, paging):
    replayed = replay(page_signals(pages, paging, "data"), paging)
    rows = replayed.orderBy("page_no").collect()
    return [(r.stop_reason, r.next) for r in rows]


def test_cursor_follows_until_the_flag(pages):
    paging = Paging("cursor", Stop("field", "has_more", False), cursor_param="starting_after", cursor_path="data[-1].id")
    got = run(pages(body(2, has_more=True), body(1, has_more=False)), paging)
    assert got == [(None, {"starting_after": "1"}), ("field", None)]


@pytest.mark.parametrize("after", [None, "", {"x": 1}])
def test_cursor_ends_without_a_value(pages, after):
    paging = Paging("cursor", Stop("empty_page"), cursor_path="next")
    assert run(pages(body(2, next=after)), paging) == [("no_cursor", None)]


def test_offset(pages):
    got = run(pages(body(3), body(2)), Paging("offset", limit=3))
    assert got == [(None, {"offset": "3", "limit": "3"}), ("short_page", None)]


def test_empty_page_comes_first(pages):
    assert run(pages(body(0)), Paging("offset", limit=3)) == [("empty_page", None)]


@pytest.mark.parametrize("start", [0, 1])
def test_page_number(pages, start):
    paging = Paging("page_number", Stop("total_pages", "meta.total"), start_page=start, page_size_param="per", page_size=2)
    got = run(pages(body(2, meta={"total": 2}), body(2, meta={"total": 2})), paging)
    assert got[0] == (None, {"page": str(start + 1), "per": "2"})
    assert got[1][0] == ("total_pages" if start == 1 else None)


def test_total_count_is_cumulative(pages):
    paging = Paging("offset", Stop("total_count", "total"), limit=50)
    got = run(pages(body(50, total=75), body(50, total=75)), paging)
    assert [g[0] for g in got] == [None, "total_count"]


def test_total_that_is_no_number_goes_on(pages):
    paging = Paging("page_number", Stop("total_count", "total"))
    assert run(pages(body(5, total="many"), body(5)), paging) == [(None, {"page": "2"}), (None, {"page": "3"})]


def test_link_header_and_next_url(pages):
    headers = [{"link": '<https://a/2>; rel="next"'}, {"link": '<https://a/1>; rel="prev"'}, {}]
    got = run(pages(body(1), body(1), body(1), headers=headers), Paging("link_header"))
    assert got == [(None, {"url": "https://a/2"}), ("no_next_page", None), ("no_next_page", None)]
    got = run(pages(body(1, links={"next": "https://a/2"}), body(0, links={"next": ""})), Paging("next_url", next_path="links.next"))
    assert got == [(None, {"url": "https://a/2"}), ("no_next_page", None)]


@pytest.mark.parametrize(("value", "stops"), [(False, True), ("false", False), (0, False), (None, False)])
def test_field_equality_is_typed(pages, value, stops):
    paging = Paging("page_number", Stop("field", "more", False))
    assert (run(pages(body(1, more=value)), paging)[0][0] == "field") == stops


def test_ends_gaps_and_kept_pages(pages):
    chain = pages(body(2), body(2), body(1), body(2))
    paging = Paging("offset", limit=2)
    replayed = replay(page_signals(chain, paging, "data"), paging)
    end = chain_ends(replayed).first()
    assert (end.pages, end.records, end.stop_page, end.status, end.stop_reason) == (3, 5, 3, "complete", "short_page")
    assert keep_pages(chain, chain_ends(replayed)).count() == 3
    holed = chain.filter("page_no <> 2")
    replayed = replay(page_signals(holed, paging, "data"), paging)
    assert chain_ends(replayed).first().status == "gap"
    assert [r.resumes_at for r in missing_pages(holed).collect()] == [3]
    unfinished = chain.filter("page_no <= 2")
    end = chain_ends(replay(page_signals(unfinished, paging, "data"), paging)).first()
    assert end.status == "open" and end.next == {"offset": "4", "limit": "2"}


def test_running_total_over_blocks(spark):
    rows = [("s", p, n, (n * 7) % 5) for p in ("a", "b") for n in range(1, 60)]
    df = spark.createDataFrame(rows, "stream string, partition_id string, page_no int, n_records bigint")
    got = {(r.partition_id, r.page_no): r.fetched for r in with_running_total(df, block=8).collect()}
    for p in ("a", "b"):
        total = 0
        for n in range(1, 60):
            total += (n * 7) % 5
            assert got[p, n] == total


def test_positions_and_fanout(pages, spark):
    replayed = replay(page_signals(pages(body(2), body(3)), Paging(), "data"), Paging())
    assert sorted((r.page_no, r.before) for r in record_positions(replayed).collect()) == [(1, 0), (2, 2)]
    totals = spark.createDataFrame([("a", 5), ("b", 0)], "stream string, total bigint")
    assert [(r.stream, r.offset, r.limit) for r in offset_requests(totals, Paging("offset", limit=2)).collect()] == [
        ("a", 0, 2), ("a", 2, 2), ("a", 4, 2),
    ]


def test_outcomes(spark):
    codes = [200, 204, 301, 400, 404, 429, 500, 501, 503, 524]
    df = spark.createDataFrame([(c,) for c in codes], "status int")
    got = [r.o for r in df.select("status", page_outcome(F.col("status")).alias("o")).orderBy("status").collect()]
    assert got == ["ok", "ok", "ok", "client_error", "client_error", "rate_limited", "retry", "server_error", "retry", "retry"]


def test_latest_fetch(spark):
    schema = "stream string, partition_id string, page_no int, status int, body string, fetched_at string"
    rows = [("s", "p", 1, 200, "old", "1"), ("s", "p", 1, 200, "new", "2"), ("s", "p", 1, 500, "down", "3"), ("s", "p", 2, 404, "x", "1")]
    assert [(r.page_no, r.body) for r in latest_fetch(spark.createDataFrame(rows, schema)).collect()] == [(1, "new")]
