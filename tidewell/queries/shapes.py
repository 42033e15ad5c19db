"""Types that change between runs, and every form of record path."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.state import empty_state
from ..plans.sync import sync_landed
from ..session import scratch_path, staged
from ..sinks.tables import compact, read_merged, read_stream_table
from ..sources.decode import decode_pages
from ..specs import StreamSpec, SyncSpec
from .common import Query, table
from .landing import CHAINS, MORE, event_chains

DRIFTED = ["event_id", "v", "o", "t", "n"]


def drifting(spark, folder):
    """Events whose fields change from chain to chain: ``v`` from number to text, ``o`` gets a field, ``t`` turns from object
    to text, ``n`` is null, then whole, then broken."""
    chain, user = F.col("event_id") % CHAINS, F.col("user_id")
    ident, named = F.col("event_id"), F.concat(F.lit("u"), user.cast("string"))
    small = F.struct(ident.alias("a"))
    grown = F.struct(ident.alias("a"), F.col("event_type").alias("b"))
    held = F.struct(user.alias("k"))
    keep = {"ignoreNullFields": "false"}
    first = F.to_json(F.struct(ident, user.alias("v"), small.alias("o"), held.alias("t"), F.lit(None).cast("string").alias("n")), keep)
    second = F.to_json(F.struct(ident, named.alias("v"), grown.alias("o"), held.alias("t"), user.alias("n")), keep)
    third = F.to_json(F.struct(ident, named.alias("v"), grown.alias("o"), F.lit("plain").alias("t"), (user + 0.5).alias("n")), keep)
    return event_chains(spark, folder, record=F.when(chain < 2, first).when(chain < 4, second).otherwise(third))


def _told(rows: DataFrame) -> DataFrame:
    kinds = "; ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in DRIFTED)
    return rows.select("event_id", "v", F.col("o.a").alias("a"), F.col("o.b").alias("b"), "t", "n", F.lit(kinds).alias("types"))


def _drifting_runs(spark, folder, name, sync):
    pages, spec = staged(drifting(spark, folder), "landed"), StreamSpec("events", "json", "data", MORE, ("event_id",), "event_id")
    base, state = scratch_path(spark, name), empty_state(spark)
    for number, chains in enumerate((("p4",), ("p0", "p1"), ("p2", "p3")), 1):
        done = sync_landed(pages.filter(F.col("partition_id").isin(*chains)), spec, state, base, f"run-{number}", sync, run_date=f"2024-02-0{number}")
        state = done.state
    return base


def drift_appended(spark, folder):
    return _told(read_stream_table(spark, _drifting_runs(spark, folder, "drift", None), "events"))


def drift_merged(spark, folder):
    base = _drifting_runs(spark, folder, "drift-merged", SyncSpec(write_mode="append_dedup", buckets=8))
    before = staged(_told(read_merged(spark, base, "events")), "before")
    compact(spark, base, "events")
    after = _told(read_merged(spark, base, "events"))
    return before.withColumn("state", F.lit("batches")).unionByName(after.withColumn("state", F.lit("compacted")))


_DRIFTED = f"""SELECT event_id, CASE WHEN event_id % {CHAINS} < 2 THEN '' ELSE 'u' END || user_id AS v, event_id AS a, CASE WHEN event_id % {CHAINS} >= 2 THEN event_type END AS b,
  CASE WHEN event_id % {CHAINS} < 4 THEN '{{"k":' || user_id || '}}' ELSE 'plain' END AS t, CASE WHEN event_id % {CHAINS} = 4 THEN user_id + 0.5 WHEN event_id % {CHAINS} >= 2 THEN CAST(user_id AS DOUBLE) END AS n,
  'event_id bigint; v string; o struct<a:bigint,b:string>; t string; n double' AS types FROM events"""

# Record paths

FORMS = {
    "wildcard": "$.groups[*].items[*].id",
    "descent": "$..items[*].id",
    "descent_key": "$..id",
    "quoted": "$['groups'][*][\"user id\"]",
    "slice": "$.groups[*].items[1:3].id",
    "slice_from_end": "$.groups[*].items[-2:].id",
    "slice_step": "$.groups[*].items[::2].id",
    "slice_back": "$.groups[*].items[2::-1].id",
    "union_index": "$.groups[*].items[0,2].id",
    "union_key": "$.groups[*].items[*]['id','user']",
    "filter_text": "$.groups[*].items[?(@.kind == 'click')].id",
    "filter_number": "$.groups[*].items[?(@.id >= 100 && @.id < 300 || @.id == 5)].id",
    "filter_not": "$.groups[*].items[?(!(@.kind == 'view') && @.kind != 'click')].id",
    "filter_exists": "$.groups[?@.vip].items[*].id",
    "filter_two_paths": "$.groups[*].items[?@.id > @.user].id",
    "filter_flag": "$.groups[?(@.even == true)]['user id']",
}


USERS_IN_BODY = 5


def grouped_pages(spark, folder):
    """Events by user, ten pages: ``{"groups":[{"user id":…,"even":…,"vip":…,"items":[{"id":…,"kind":…,"user":…}]}]}``; ``vip`` is rare.

    A page comes in bodies of a few users each, so that no body grows with the number of users.
    """
    events = table(spark, folder, "events")
    item = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("user_id").alias("user"))
    users = events.groupBy("user_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    vip = F.when(F.col("user_id") % 7 == 0, F.lit(1))
    group = F.to_json(F.struct(F.col("user_id").alias("user id"), (F.col("user_id") % 2 == 0).alias("even"), vip.alias("vip"), "items"))
    part = F.floor(F.col("user_id") / (10 * USERS_IN_BODY)).alias("_part")
    pages = users.groupBy((F.col("user_id") % 10).alias("page_no"), part).agg(F.sort_array(F.collect_list(F.struct("user_id", group.alias("text")))).alias("_g"))
    body = F.concat(F.lit('{"groups":['), F.concat_ws(",", F.transform("_g", lambda g: g["text"])), F.lit("]}"))
    return pages.select(F.col("page_no").cast("int").alias("page_no"), body.alias("body"))


def path_forms(spark, folder):
    pages = staged(grouped_pages(spark, folder), "grouped")
    found = [
        decode_pages(pages, "json", path).select(F.lit(form).alias("form"), "page_no", F.col("record").cast("bigint").alias("value"))
        for form, path in FORMS.items()
    ]
    return reduce(DataFrame.unionByName, found)


_ITEMS = """WITH i AS (SELECT event_id AS id, event_type AS kind, user_id AS u, user_id % 10 AS page,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM events),
  g AS (SELECT DISTINCT u, page FROM i)"""
_FORM_SQL = {
    "wildcard": "id FROM i",
    "descent": "id FROM i",
    "descent_key": "id FROM i",
    "quoted": "u FROM g",
    "slice": "id FROM i WHERE pos BETWEEN 1 AND 2",
    "slice_from_end": "id FROM i WHERE pos >= n - 2",
    "slice_step": "id FROM i WHERE pos % 2 = 0",
    "slice_back": "id FROM i WHERE pos <= least(2, n - 1)",
    "union_index": "id FROM i WHERE pos IN (0, 2)",
    "union_key": "unnest([id, u]) FROM i",
    "filter_text": "id FROM i WHERE kind = 'click'",
    "filter_number": "id FROM i WHERE id BETWEEN 100 AND 299 OR id = 5",
    "filter_not": "id FROM i WHERE kind NOT IN ('view', 'click')",
    "filter_exists": "id FROM i WHERE u % 7 = 0",
    "filter_two_paths": "id FROM i WHERE id > u",
    "filter_flag": "u FROM g WHERE u % 2 = 0",
}

QUERIES = {
    "sync_type_drift": Query(drift_appended, _DRIFTED),
    "merge_type_drift": Query(drift_merged, f"SELECT d.*, s.state FROM ({_DRIFTED}) d, (SELECT unnest(['batches', 'compacted']) AS state) s"),
    "record_path_forms": Query(
        path_forms,
        _ITEMS + " " + " UNION ALL ".join(f"SELECT '{form}' AS form, CAST(page AS INTEGER) AS page_no, {sql.replace(' FROM', ' AS value FROM', 1)}" for form, sql in _FORM_SQL.items()),
    ),
}
