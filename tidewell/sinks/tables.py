"""Writing streams as Hive-partitioned tables."""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable, Mapping
from datetime import UTC, datetime
from typing import Any
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import bucket_number
from ..operators.dedup import latest_per_key
from ..operators.incremental import max_cursor
from ..operators.schema import merge_table_schemas, refit_rows, stored_type
from ..session import folder_bytes, matching_paths, path_exists, remove_path, replace_path, write_text

# The chain that a landed row came from; stored with it for cursors per partition, hidden from readers.
PARTITION = "_partition"

# The compression names that are accepted for Parquet.
COMPRESSION = ("snappy", "zstd", "gzip", "none")

# URL schemes and the file-system schemes behind them.
SCHEMES = {"s3": "s3a", "s3a": "s3a", "r2": "s3a", "gs": "gs", "az": "abfss", "azure": "abfss", "abfss": "abfss"}


class EmptyInput(ValueError):
    """There is nothing to write."""


def resolve_uri(url: str) -> str:
    """A destination URL as a Hadoop file-system URI."""
    scheme, _, rest = url.partition("://")
    if not rest and "://" not in url:
        return url
    if scheme == "file":
        return f"file://{rest}"
    if scheme not in SCHEMES:
        raise ValueError(f"unknown destination scheme: {scheme}")
    return f"{SCHEMES[scheme]}://{rest}"


def utc_date() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d")


def stream_path(base: str, stream: str) -> str:
    """The folder of a stream."""
    return f"{resolve_uri(base).rstrip('/')}/{stream.replace('.', '_')}"


def write_stream_table(
    df: DataFrame,
    base: str,
    stream: str,
    run_id: str,
    run_date: str | None = None,
    fmt: str = "parquet",
    compression: str = "snappy",
    cursor_field: str | None = None,
    cursor_floor: Any = None,
    sort: bool = False,
    mode: str = "append",
    allow_empty: bool = True,
    options: Mapping[str, Any] | None = None,
    check: Callable[[], None] | None = None,
    shape: T.StructType | None = None,
) -> dict[str, Any]:
    """Write to ``{stream}/dt=…/run_id=…`` and return the row count, the new cursor and the slice's path.

    Both are observed in the job that writes, so the source is scanned once. Rows are written
    aside and put in place only once they are complete, ``check`` has passed and there are some if
    there must be: a run that fails leaves the table as it was. A run replaces its own slice only, and keeps the date
    of its first attempt: repeating it gives the same table on any day. ``mode='overwrite'`` replaces the whole
    stream, the new slice first. The schema of the slice is stored beside the table, for readers that merge schemas;
    ``shape`` says more of it than the columns do (``quick_table_schema(unknown=True)``).
    """
    if fmt == "parquet" and compression not in COMPRESSION:
        raise ValueError(f"unknown compression: {compression}")
    spark, path = df.sparkSession, stream_path(base, stream)
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if cursor_field:
        metrics.append(max_cursor(df, cursor_field, floor=cursor_floor).alias("cursor"))
    watched = df.observe(seen, *metrics)
    if sort and cursor_field:
        watched = watched.sortWithinPartitions(cursor_field)
    writer = watched.write.format(fmt).mode("overwrite").options(**(options or {}))
    if fmt == "parquet":
        writer = writer.option("compression", "uncompressed" if compression == "none" else compression)
    run = quote(run_id, safe="")
    aside = f"{path}/_staged/{run}"
    try:
        writer.save(aside)
        found = seen.get
        if check:
            check()
        if not found["rows"] and not allow_empty:
            raise EmptyInput(f"no rows for stream {stream!r}")
    except Exception:
        remove_path(spark, aside)
        raise
    earlier = matching_paths(spark, f"{path}/dt=*/run_id={run}")
    date = run_date or (re.search(r"/dt=([^/]+)/", earlier[0])[1] if earlier else utc_date())
    target = f"{path}/dt={date}/run_id={run}"
    if found["rows"]:
        _keep_schema(spark, path, f"dt={date}/run_id={run}", shape or df.schema)
        replace_path(spark, aside, target)
    else:
        remove_path(spark, aside)
    for other in matching_paths(spark, f"{path}/dt=*/run_id=*") if mode == "overwrite" else earlier:
        if not (found["rows"] and other.endswith(f"/dt={date}/run_id={run}")):
            remove_path(spark, other)
    return {"rows": found["rows"], "cursor": found.get("cursor"), "path": target if found["rows"] else None}


def read_stream_table(spark: SparkSession, base: str, stream: str, fmt: str = "parquet") -> DataFrame:
    """All slices of a stream; columns that appeared later are NULL in older slices.

    Parquet slices whose types differ are read under the merged schema of all (``merge_table_schemas``): numbers widen,
    objects get the fields they lack, and what conflicts becomes text. Nothing is rewritten for it.
    """
    path = stream_path(base, stream)
    if fmt != "parquet":
        return spark.read.format(fmt).load(path).drop(PARTITION)
    return _read_slices(spark, path, "dt=*/run_id=*")[0].drop(PARTITION)


def _schema_file(path: str, name: str) -> str:
    return f"{path}/_schemas/{quote(name, safe='')}"


def _keep_schema(spark: SparkSession, path: str, name: str, schema: T.StructType) -> None:
    write_text(spark, _schema_file(path, name), json.dumps({"slice": name, "schema": schema.json()}))


def _read_slices(spark: SparkSession, path: str, pattern: str, names: list[str] | None = None) -> tuple[DataFrame, T.StructType | None, list[dict[str, str]]]:
    """Slices under their merged schema, that schema, and the types of the columns in each version of it.

    Slices of one schema are read together, without looking into their files for it. What was written by others is read as
    its files say. Only distinct schemas and names of slices come to the driver.
    """
    slices = {"/".join(p.rsplit("/", pattern.count("/") + 1)[1:]): p for p in matching_paths(spark, f"{path}/{pattern}")}
    if names is not None:
        slices = {n: p for n, p in slices.items() if n in names}
    versions: dict[str, list[str]] = {}
    if path_exists(spark, f"{path}/_schemas"):
        kept = spark.read.text(f"{path}/_schemas").select(F.from_json("value", "slice string, schema string").alias("k"))
        for row in kept.groupBy("k.schema").agg(F.collect_set("k.slice").alias("names")).collect():
            held = sorted(slices[n] for n in row["names"] if n in slices)
            if held:
                versions[row["schema"]] = held
    known = {p for held in versions.values() for p in held}
    if not versions or any(p not in known for p in slices.values()):
        # Not all is written here.
        reader = spark.read.option("mergeSchema", "true").option("basePath", path)
        return reader.parquet(*(slices.values() if names is not None else [path])), None, []
    shapes = {text: T.StructType.fromJson(json.loads(text)) for text in versions}
    kinds = [{f.name: f.dataType.simpleString() for f in shape.fields} for shape in shapes.values()]
    texts = sorted(versions)
    merged = shapes[texts[0]]
    for text in texts[1:]:
        merged = merge_table_schemas(merged, shapes[text])
    # What folders say is told from all of them, so that every version gets the same types.
    whole = spark.read.schema(stored_type(merged)).option("basePath", path).parquet(*(slices.values() if names is not None else [path]))
    if len(texts) == 1:
        return whole, merged, kinds
    folders = [c for c in whole.columns if c not in merged.names]
    out = None
    for text in texts:
        own = stored_type(shapes[text])
        found = spark.read.schema(T.StructType([*own.fields, *[whole.schema[c] for c in folders]])).option("basePath", path).parquet(*versions[text])
        fitted = refit_rows(found, shapes[text], merged, tuple(folders))
        out = fitted if out is None else out.unionByName(fitted)
    return out, merged, kinds


def append_dedup(
    fresh: DataFrame,
    base: str,
    stream: str,
    keys: list[str],
    order: list[str],
    buckets: int = 64,
    batch: str | None = None,
    check: Callable[[], None] | None = None,
    shape: T.StructType | None = None,
) -> DataFrame:
    """Merge rows into a table that has one row per key, the latest winning; NULL keys are keys like others.

    A merge writes its own rows only, folded, in ``batch=…/bucket=…`` folders by a hash of the key; nothing that is
    there is touched. Readers fold the batches (``read_merged``), and ``compact`` does so for good. Keys, order and
    bucket count belong to the table: others are refused. A batch is put in place when it is complete
    and ``check`` has passed; repeating it replaces it.
    """
    spark, path = fresh.sparkSession, stream_path(base, stream)
    layout = {"keys": list(keys), "order": list(order), "buckets": buckets}
    known = merge_layout(spark, base, stream)
    if known is None:
        text = spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{path}/_layout")
    elif known != layout:
        raise ValueError(f"the table of {stream!r} has {known}, not {layout}")
    placed = _tied(fresh.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
    folded = latest_per_key(placed, [*keys, "bucket"], [*order, "_tie"]).drop("_tie")
    name = quote(batch or uuid.uuid4().hex, safe="")
    aside = f"{path}/_staged/{name}"
    try:
        # Small buckets share a task and large ones are split over several, by their size at run time.
        folded.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(aside)
        if check:
            check()
    except Exception:
        remove_path(spark, aside)
        raise
    if matching_paths(spark, f"{aside}/bucket=*"):
        _keep_schema(spark, path, f"batch=b-{name}", shape or fresh.schema)
        replace_path(spark, aside, f"{path}/batch=b-{name}")
    else:
        remove_path(spark, aside)
        remove_path(spark, f"{path}/batch=b-{name}")
    if not matching_paths(spark, f"{path}/batch=*"):
        return folded.limit(0)
    return read_merged(spark, base, stream)


def merge_layout(spark: SparkSession, base: str, stream: str) -> dict[str, Any] | None:
    """Keys, order and bucket count of a merge table; None if there is none."""
    path = f"{stream_path(base, stream)}/_layout"
    return json.loads(spark.read.text(path).first().value) if path_exists(spark, path) else None


def _batches(spark: SparkSession, base: str, stream: str, names: list[str] | None = None) -> tuple[DataFrame, T.StructType | None]:
    """The rows of all batches, or of some, with their ``bucket``, and their merged schema.

    Keys whose type differs between batches have other hashes, so their buckets are told anew; ``_told`` marks that.
    """
    path = stream_path(base, stream)
    table, shape, kinds = _read_slices(spark, path, "batch=*", names)
    layout = merge_layout(spark, base, stream)
    if any(len({kind.get(key) for kind in kinds}) > 1 for key in layout["keys"]):
        number = F.pmod(F.xxhash64(*layout["keys"]), F.lit(layout["buckets"])).cast("int")
        table = table.withColumns({"bucket": number, "_told": F.lit(True)})
    return table.drop("batch"), shape


def read_merged(spark: SparkSession, base: str, stream: str) -> DataFrame:
    """The rows of a merge table: the latest of all batches per key.

    Only buckets that several batches hold are folded, which shuffles them; the others are read as they are.
    """
    path = stream_path(base, stream)
    table, shape = _batches(spark, base, stream)
    held: dict[int, int] = {}
    for folder in matching_paths(spark, f"{path}/batch=*/bucket=*"):
        number = int(folder.rsplit("=", 1)[1])
        held[number] = held.get(number, 0) + 1
    several = sorted(n for n, count in held.items() if count > 1)
    if not several:
        return table.drop(PARTITION)
    layout = merge_layout(spark, base, stream)

    def folded(rows: DataFrame) -> DataFrame:
        return latest_per_key(_tied(rows), [*layout["keys"], "bucket"], [*layout["order"], "_tie"]).drop("_tie", PARTITION)

    if len(several) == len(held) or "_told" in table.columns:
        return folded(table.drop("_told"))
    alone = F.col("bucket").isin(*[n for n in held if n not in several])
    return table.filter(alone).drop(PARTITION).unionByName(folded(table.filter(~alone)))


def compact(spark: SparkSession, base: str, stream: str, fan: int = 1) -> int:
    """Fold batches of a merge table into one, and tell how many; a crash in between leaves rows that fold to the same table.

    With ``fan`` above 1 only batches of about one size are folded, once there are ``fan`` of them: sizes grow by that
    factor from tier to tier, so a row is written again once per tier and not at every compaction.
    """
    path = stream_path(base, stream)
    batches = matching_paths(spark, f"{path}/batch=*")
    chosen = batches
    if fan > 1:
        tiers: dict[int, list[str]] = {}
        for batch in batches:
            tiers.setdefault(int(math.log(max(folder_bytes(spark, batch), 1), fan)), []).append(batch)
        full = [tier for tier in sorted(tiers) if len(tiers[tier]) >= fan]
        chosen = tiers[full[0]] if full else []
    if len(chosen) < 2:
        return 0
    name = uuid.uuid4().hex
    layout = merge_layout(spark, base, stream)
    table, shape = _batches(spark, base, stream, [b.rsplit("/", 1)[1] for b in chosen])
    folded = latest_per_key(_tied(table.drop("_told")), [*layout["keys"], "bucket"], [*layout["order"], "_tie"]).drop("_tie")
    folded.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{path}/_staged/{name}")
    _keep_schema(spark, path, f"batch=c-{name}", folded.drop("bucket").schema if shape is None else shape)
    replace_path(spark, f"{path}/_staged/{name}", f"{path}/batch=c-{name}")
    for old in chosen:
        remove_path(spark, old)
    return len(chosen)


def _tied(df: DataFrame) -> DataFrame:
    """Rows that tie on the order columns are told apart by their content."""
    return df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]))


_TRANSFORM = re.compile(r"(identity|year|month|day|hour|bucket|truncate)(?:\[(\d+)\])?")
_UNIX_EPOCH = "1970-01-01 00:00:00"


def transform_column(df: DataFrame, name: str, transform: str) -> Column:
    """A table-format partition transform as a column.

    Years, months, days and hours are counted from 1970, and buckets are those of the formats' own hash, as they store them.
    """
    match = _TRANSFORM.fullmatch(transform)
    if not match or (match[1] in ("bucket", "truncate")) != bool(match[2]):
        raise ValueError(f"unknown transform: {transform}")
    kind, width = match[1], int(match[2] or 0)
    col, dtype = F.col(name), df.schema[name].dataType
    if kind == "identity":
        return col
    if kind == "bucket":
        return bucket_number(col, dtype, width)
    if kind == "truncate":
        if isinstance(dtype, T.StringType):
            return F.substring(col, 1, width)
        if isinstance(dtype, T.IntegralType):
            return col - F.pmod(col, F.lit(width).cast(dtype))
        raise ValueError(f"cannot truncate {dtype.simpleString()}")
    if kind == "year":
        return F.year(col) - 1970
    if kind == "month":
        return (F.year(col) - 1970) * 12 + F.month(col) - 1
    if kind == "day":
        return F.datediff(F.to_date(col), F.lit("1970-01-01").cast("date"))
    moment = col.cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", F.lit(_UNIX_EPOCH).cast("timestamp_ntz"), moment)
    return F.floor(micros / F.lit(3_600_000_000)).cast("int")


def write_transformed(df: DataFrame, base: str, stream: str, partitioning: Mapping[str, str]) -> list[str]:
    """Append with folders derived by transforms, where no table-format catalog is at hand."""
    derived = {}
    for name, transform in partitioning.items():
        derived[f"{name}_{re.sub(r'[^a-z]', '', transform)}"] = transform_column(df, name, transform)
    out = df.withColumns(derived)
    out.write.mode("append").partitionBy(*derived).option("compression", "zstd").parquet(stream_path(base, stream))
    return list(derived)


def write_iceberg(df: DataFrame, table: str, partitioning: Mapping[str, str] | None = None) -> None:
    """Append to a table of a configured table-format catalog, creating it when absent."""
    parts = []
    for name, transform in (partitioning or {}).items():
        match = _TRANSFORM.fullmatch(transform)
        if not match:
            raise ValueError(f"unknown transform: {transform}")
        kind, width = match[1], match[2]
        if kind == "identity":
            parts.append(F.col(name))
        elif kind == "bucket":
            parts.append(F.partitioning.bucket(int(width), name))
        elif kind == "truncate":
            parts.append(F.expr(f"truncate({width}, {name})"))
        else:
            parts.append(getattr(F.partitioning, f"{kind}s")(name))
    writer = df.writeTo(table).using("iceberg")
    if df.sparkSession.catalog.tableExists(table):
        writer.append()
    elif parts:
        writer.partitionedBy(*parts).create()
    else:
        writer.create()
