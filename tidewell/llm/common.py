"""Word rules and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shingles import chunks

# Fixed by the task: words are what stands between runs of these characters, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A broadcast side may have so many rows of a few dozen bytes; beyond that joins shuffle.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; a null text has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` hinted for broadcast if a count proves it small, else as it is, so that the join shuffles.

    The count stops at the bound, so it reads no more than it must.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


# Measured bytes that a broadcast side may have.
BROADCAST_BYTES = 16 << 20


def broadcast_if_few_bytes(df: DataFrame, size: Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` hinted for broadcast if the bytes of its rows, ``size`` each, add up to few; ``df`` should be stored."""
    total = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns called like an operator's results, whatever their case: the results replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


# Bytes of text that a task of ``map_texts`` opens at a time, however many the texts of a batch have.
OPEN_BYTES = 3_000_000


def map_texts(rows: DataFrame, text: str, carried: list[Column], made: str, make: Callable[[list[str]], tuple[dict[str, Any], Any]]) -> DataFrame:
    """The ``carried`` columns of ``rows`` beside what ``make`` makes of their texts, batch by batch.

    ``make`` gets some texts of a batch, empty where null, and gives the columns of the schema ``made`` and, unless
    each text gives one row, the number of the text each row belongs to. Carried values pass as they are, nulls included.
    """
    chosen = rows.select(F.coalesce(F.col(text), F.lit("")).alias("_text"), *carried)
    kept = chosen.schema.fields[1:]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [made])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in chunks(batch.column(0), OPEN_BYTES):
                yield batch.slice(first, len(some))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            columns, owners = make(batch.column(0).to_pylist())
            given = [batch.column(i + 1) for i in range(len(kept))]
            if owners is not None:
                given = [c.take(pa.array(owners, pa.int64())) for c in given]
            made_ = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
            yield pa.RecordBatch.from_arrays(given + made_, [f.name for f in kept] + list(columns))

    return chosen.mapInArrow(run, schema)


def with_label(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """``text`` and ``label`` (0 or 1) of about ``sample`` labelled documents of each label.

    The labels are thinned by a hash of the id first, so that a bounded number of ids meets the texts, which
    stay where they are. An id with several labels has the greatest.
    """
    one = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    few = _thinned(one, sample, F.xxhash64("doc_id", F.lit(label)))
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", "label")


def labelled_rows(rows: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` rows of each ``label``, chosen by a hash of their ``text``; null texts are empty."""
    told = rows.filter(F.col("label").isin(0, 1)).select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"))
    return _thinned(told, sample, F.xxhash64("text", F.lit("sample")))


def _thinned(rows: DataFrame, sample: int, draw: Column) -> DataFrame:
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("label") == 1, min(1.0, sample / sizes.get(1, 1))).otherwise(min(1.0, sample / sizes.get(0, 1)))
    return rows.filter(F.pmod(draw, F.lit(1_000_000)) < share * 1_000_000)
