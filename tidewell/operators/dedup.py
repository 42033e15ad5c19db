"""Latest row per key, merges, caps and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


MAX_CUTS = 1024


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order``, NULLs lowest.

    ``max_by`` folds rows before the shuffle, so a key with very many versions
    sends one row per task instead of all of them to a single sort. ``order``
    must not tie within a key, or the pick is open.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def merge_latest(existing: DataFrame, fresh: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``existing`` with ``fresh`` rows merged in, the latest per key winning.

    ``existing`` already has one row per key, so only ``fresh`` is folded. The
    table is not sorted or shuffled as a whole: rows that lose are found by joins on
    the keys of the fresh rows, which the optimizer broadcasts when they are few.
    """
    fresh = latest_per_key(fresh, keys, order).select(*existing.columns)
    challenger = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    key_of = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]

    def beaten(rows: DataFrame, others: DataFrame, test) -> DataFrame:
        marks = others.select(*key_of, challenger.alias("_other"))
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        condition = on[0]
        for part in on[1:]:
            condition = condition & part
        own = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
        return rows.join(marks, condition & test(own, F.col("_other")), "left_anti")

    kept = beaten(existing, fresh, lambda own, other: own < other)
    # Only the keys and order columns of the table are read to judge the fresh rows.
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    mine = existing.join(fresh.select(*key_of), same, "left_semi").select(*dict.fromkeys(keys + order))
    added = beaten(fresh, mine, lambda own, other: own <= other)
    return kept.unionByName(added)


def cap_per_group(
    df: DataFrame, keys: list[str], order: list[Column | str], limit: int, salts: int = 64
) -> DataFrame:
    """The first ``limit`` rows of each group.

    Rows first compete within salted parts of their group, so that no task sorts a
    whole group; at most ``salts * limit`` rows per group reach the last ranking.
    ``order`` must not tie within a group.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    first = salted.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= limit)
    return first.withColumn("_rank", F.row_number().over(whole)).filter(F.col("_rank") <= limit).select(*df.columns)


def blocks_of(df: DataFrame, order: str, rows: int = 100_000) -> Column:
    """The block of ``order`` each row is in, growing with it; about ``rows`` rows share a block.

    Blocks are cut at approximate quantiles, so neither a far outlier nor a dense stretch makes one block of many.
    At most ``MAX_CUTS`` cuts are taken to the driver; of more rows a block holds more.
    """
    cuts = max(1, min(MAX_CUTS, df.count() // rows))
    points = df.approxQuantile(order, [i / cuts for i in range(1, cuts)], 1 / (4 * cuts)) if cuts > 1 else []
    points = sorted({int(p) for p in points})

    def halved(some: list[int], first: int) -> Column:
        if not some:
            return F.lit(first)
        mid = len(some) // 2
        return F.when(F.col(order) < some[mid], halved(some[:mid], first)).otherwise(halved(some[mid + 1 :], first + mid + 1))

    return halved(points, 0)


def with_positions(
    df: DataFrame, keys: list[str], order: str, width: int | None = None, name: str = "position"
) -> DataFrame:
    """Number the rows of each group from 0 by a unique integer column.

    The column is cut into blocks of ``width`` values. Blocks are counted, the
    counts are summed along the group, and rows are ranked inside their block, so
    a window holds the rows of one block or one row per block. Without a ``width``
    quantiles of the column cut it.
    """
    block = F.floor(F.col(order) / width) if width else blocks_of(df, order)
    counts = df.groupBy(*keys, block.alias("_block")).agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_start"))
    ranked = df.withColumn("_block", block).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(order)) - 1
    )
    joined = ranked.join(starts, [*keys, "_block"])
    return joined.select(*df.columns, (F.col("_start") + F.col("_rank")).alias(name))


def with_batches(
    df: DataFrame, keys: list[str], order: str, batch_size: int = 1000, width: int | None = None
) -> DataFrame:
    """Number the batches of ``batch_size`` rows of each group from 0."""
    placed = with_positions(df, keys, order, width, "_position")
    return placed.withColumn("batch", F.floor(F.col("_position") / batch_size)).drop("_position")
