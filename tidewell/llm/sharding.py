"""Sharding by histogram sort: exact byte counts below probes, splitters within tolerance, one exchange.

Documents are ordered by a 63-bit key: the hash of the text above the hash of the
id. Equal texts are neighbours, and a group of copies, however large, can still be
cut because the ids spread it. Splitters are found by counting: every round cuts the
cells in which a splitter still lies into ``2**PROBE_BITS`` cells and sums the exact
bytes of each over all partitions, until the bytes below a boundary meet the
tolerance or a cell holds one row. Only those sums reach the driver, at most
``2**PROBE_BITS`` per splitter and round whatever the size of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import without

KEY_BITS = 63
PROBE_BITS = 9
ROW_BYTES = 8  # what a row costs besides its text

RESULTS = ["size", "shard", "slot"]


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and a fixed cost per row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def sort_key(text: Column, *low: Column) -> Column:
    """The hash of the text above the hash of what tells rows with equal texts apart."""
    high = F.shiftleft(F.xxhash64(text).bitwiseAND(F.lit((1 << 31) - 1)), 32)
    return high.bitwiseOR(F.xxhash64(*low, F.lit("shard")).bitwiseAND(F.lit((1 << 32) - 1)))


def _cells(keyed: DataFrame, shift: int, within: list[int] | None, previous: int) -> dict[int, tuple[int, int]]:
    """Exact bytes and rows of each cell of ``2**shift`` keys, in the given cells of the round before."""
    rows = keyed if within is None else keyed.filter(F.shiftright("_key", previous).isin(within))
    sums = rows.groupBy(F.shiftright("_key", shift).alias("cell")).agg(F.sum("_size").alias("bytes"), F.count("*").alias("n"))
    return {r["cell"]: (r["bytes"], r["n"]) for r in sums.collect()}


class EqualKeys(Exception):
    """A splitter lies within rows of one key."""


def find_splitters(keyed: DataFrame, shards: int, tolerance: float) -> tuple[list[int], int]:
    """Keys at which shards 1, 2, ... begin, and the bytes of all rows.

    ``keyed`` has ``_key`` and ``_size``. The bytes below a splitter differ from an
    equal share by at most ``tolerance`` of a shard, or by part of one row where a
    row is larger than that. Raises ``EqualKeys`` where only a cut through rows of one key would do.
    """
    shift = KEY_BITS - PROBE_BITS
    found = _cells(keyed, shift, None, KEY_BITS)
    total = sum(b for b, _ in found.values())
    if not total:
        return [0] * (shards - 1), 0
    slack = tolerance * total / shards
    # Per splitter: the cell it lies in (None: the whole range), bytes below that cell.
    open_ = {i: (None, 0) for i in range(1, shards)}
    done: dict[int, int] = {}
    previous = KEY_BITS
    while open_:
        by_parent: dict[int | None, list[int]] = {}
        for cell in sorted(found):
            by_parent.setdefault(None if previous == KEY_BITS else cell >> (previous - shift), []).append(cell)
        refine: dict[int, tuple[int, int]] = {}
        for i, (parent, below) in open_.items():
            target = total * i / shards
            for cell in by_parent[parent]:
                size, rows = found[cell]
                if below + size < target:
                    below += size
                    continue
                to_start, to_end = target - below, below + size - target
                if shift == 0 and rows > 1 and min(to_start, to_end) > slack:
                    raise EqualKeys
                if min(to_start, to_end) <= slack or rows == 1:
                    done[i] = (cell if to_start <= to_end else cell + 1) << shift
                else:
                    refine[i] = (cell, below)
                break
        open_ = refine
        if open_:
            previous, shift = shift, max(0, shift - PROBE_BITS)
            found = _cells(keyed, shift, sorted({cell for cell, _ in open_.values()}), previous)
    return [done[i] for i in range(1, shards)], total


def _shard_of(key: Column, splitters: list[int], first: int = 0) -> Column:
    """The number of splitters at or below the key, by halving."""
    if not splitters:
        return F.lit(first)
    mid = len(splitters) // 2
    return F.when(key < F.lit(splitters[mid]), _shard_of(key, splitters[:mid], first)).otherwise(
        _shard_of(key, splitters[mid + 1 :], first + mid + 1)
    )


def shard_documents(
    docs: DataFrame, shards: int = 24, tolerance: float = 0.001, block_bytes: int = 8 << 20, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """All columns of ``docs`` with ``size``, ``shard`` and ``slot``; bytes per shard are near equal.

    ``slot`` numbers the rows of a shard from 0 without gaps. For that a shard is cut
    into hash blocks of about ``block_bytes``; blocks are counted, the counts summed along
    the shard, and rows ranked inside their block, so no task holds a whole shard.

    Null texts have size 8; null ids hash like any value; repeated rows each get their
    own slot; no rows give no rows. Columns called like a result are replaced.
    """
    base = without(docs, RESULTS)
    try:
        return _placed(base, sort_key(F.col(text), F.col(doc_id)), shards, tolerance, block_bytes, text, doc_id)
    except EqualKeys:
        # Rows that are equal in id and text are told apart by a number of their own, which is stored to stay theirs.
        numbered = staged(base.withColumn("_copy", F.monotonically_increasing_id()), "copies")
        found = _placed(numbered, sort_key(F.col(text), F.col(doc_id), F.col("_copy")), shards, tolerance, block_bytes, text, doc_id)
        return found.drop("_copy")


def _placed(base: DataFrame, key: Column, shards: int, tolerance: float, block_bytes: int, text: str, doc_id: str) -> DataFrame:
    keyed = base.withColumns({"_size": size_of(F.col(text)), "_key": key})
    narrow = keyed.select("_key", "_size").persist()
    try:
        splitters, total = find_splitters(narrow, shards, tolerance)
        blocks = max(1, -(-total // (shards * block_bytes)))
        place = {
            "shard": _shard_of(F.col("_key"), splitters),
            "_block": F.pmod(F.xxhash64("_key", F.lit("block")), F.lit(blocks)).cast("int"),
        }
        counts = narrow.withColumns(place).groupBy("shard", "_block").agg(F.count("*").alias("_n"))
        along = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_start"))
    finally:
        narrow.unpersist()
    inside = Window.partitionBy("shard", "_block").orderBy("_key", F.col(doc_id))
    ranked = keyed.withColumns(place).withColumn("_rank", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["shard", "_block"]).select(
        *[F.col(f"`{c}`") for c in base.columns],
        F.col("_size").alias("size"),
        "shard",
        (F.col("_start") + F.col("_rank")).alias("slot"),
    )
