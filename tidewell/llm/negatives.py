"""Hard negatives by angular triangle filtering.

Every vector is stored with its norm and its angles to a few reference directions. For two vectors at angles s and t to the
same direction, the angle between them lies in [|s - t|, s + t], so the cosines of these limits times the norms
bound their inner product from both sides. Bounds are widened by more than their rounding error; where they miss the
window of scores that can still change an anchor's list, nothing is scored. What is left is scored in whole numbers.

Rows stand in slices, sorted by label and angle and cut into segments of one label; anchors in blocks. Each slice
meets each block once, in either of two passes: the positives of an anchor, then the negatives in their windows. A task keeps the best rows
of the anchors of a block only, and what it found is merged by anchor.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, staged
from .vectors import whole_numbers

REFERENCES = 8
SLICE = 4096  # rows that are stored and scored together
SEGMENT = 128  # rows of one label that share a bound
ANCHORS = 1024  # anchors of a block
PART = 16  # blocks that a slice meets in one task
BROADCAST_BLOCKS = 64  # of about 400 KB; more blocks are shuffled
SLICES_A_FILE = 32
MARGIN = 1e-6  # more than the rounding error of an angle near 0
LEAST = np.iinfo(np.int64).min

STORED = "slice string, ids array<bigint>, labels array<bigint>, width int, vectors binary, norms binary, angles binary"
FOUND = "block string, place int, slot int, score bigint, id bigint"


def angles_to(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the vectors and their angles to the directions; those of a zero vector are 0, as its scores are."""
    x = vectors.astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    wide = max(x.shape[1], directions.shape[1])
    x, d = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (x, directions.astype(np.float64)))
    cosines = (x @ d.T) / np.where(norms > 0, norms, 1)[:, None] / np.sqrt((d * d).sum(axis=1))[None, :]
    cosines[norms == 0] = 1
    return norms, np.arccos(np.clip(cosines, -1, 1))


def _stored(rows: DataFrame, directions: np.ndarray, size: int) -> DataFrame:
    """Rows of (id, label, vector) as slices of at most ``size`` rows, sorted by label, nearest direction and angle."""

    def made(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        norms, angles = angles_to(vectors, directions)
        near = angles.argmin(axis=1)
        order = np.lexsort((ids, angles[np.arange(len(ids)), near], near, labels))
        row = {
            "slice": uuid.uuid4().hex, "ids": ids[order].tolist(), "labels": labels[order].tolist(), "width": vectors.shape[1],
            "vectors": vectors[order].astype(np.int32).tobytes(), "norms": norms[order].tobytes(), "angles": angles[order].tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            wide = max(v.shape[1] for _, _, v in held)
            return np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for _, _, v in held])

        for batch in batches:
            at, vectors, _ = whole_numbers(batch.column(2))
            if not len(at):
                continue
            held.append((batch.column(0).to_numpy(zero_copy_only=False)[at], batch.column(1).to_numpy(zero_copy_only=False)[at], vectors))
            n += len(at)
            if n >= size:
                ids, labels, vectors = joined()
                whole = n - n % size
                for s in range(0, whole, size):
                    yield made(ids[s : s + size], labels[s : s + size], vectors[s : s + size])
                held, n = [(ids[whole:], labels[whole:], vectors[whole:])], n - whole
        if n:
            yield made(*joined())

    lists = pa.list_(pa.int64())
    schema = pa.schema([("slice", pa.string()), ("ids", lists), ("labels", lists), ("width", pa.int32()), ("vectors", pa.binary()), ("norms", pa.binary()), ("angles", pa.binary())])
    return rows.mapInArrow(run, STORED)


class Stored:
    """A slice read back."""

    def __init__(self, batch: pa.RecordBatch, i: int, first: int = 0) -> None:
        ids, labels, width, vectors, norms, angles = (batch.column(first + c)[i] for c in range(1, 7))
        self.name = batch.column(first)[i].as_py()
        self.ids, self.labels = (a.values.to_numpy(zero_copy_only=False) for a in (ids, labels))
        n = len(self.ids)
        self.vectors = np.frombuffer(vectors.as_buffer(), np.int32).reshape(n, width.as_py())
        self.norms = np.frombuffer(norms.as_buffer(), np.float64)
        self.angles = np.frombuffer(angles.as_buffer(), np.float64).reshape(n, -1)

    def segments(self) -> list[tuple[int, int]]:
        """Runs of rows of one label, of at most ``SEGMENT`` rows."""
        cuts = np.flatnonzero(np.diff(self.labels)) + 1
        out = []
        for start, end in zip([0, *cuts], [*cuts, len(self.labels)]):
            out += [(s, min(s + SEGMENT, end)) for s in range(start, end, SEGMENT)]
        return out


def score_bounds(anchors: Stored, rows: Stored, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have with any row of a segment, never inside the true ones."""
    low, high = rows.angles[start:end].min(axis=0), rows.angles[start:end].max(axis=0)
    small, large = rows.norms[start:end].min(), rows.norms[start:end].max()
    apart = np.maximum(np.maximum(low - anchors.angles, anchors.angles - high), 0).max(axis=1)
    widest = np.minimum(anchors.angles + high, math.pi).min(axis=1)
    best, worst = np.cos(np.maximum(apart - MARGIN, 0)), np.cos(np.minimum(widest + MARGIN, math.pi))
    upper = anchors.norms * np.where(best > 0, large, small) * best
    lower = anchors.norms * np.where(worst > 0, small, large) * worst
    slack = 1e-9 * anchors.norms * large + 1
    return lower - slack, upper + slack


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products; by floating point where every partial sum is a whole number below 2**53."""
    wide = min(a.shape[1], x.shape[1])
    a, x = a[:, :wide], x[:, :wide]
    if a.size and x.size and int(np.abs(a).max()) * int(np.abs(x).max()) * wide < 1 << 53:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


class Best:
    """The first ``keep`` rows of each group by score, then id; ``least`` is the score that can still enter."""

    def __init__(self, groups: int, keep: int) -> None:
        self.keep, self.least = keep, np.full(groups, LEAST)
        self.group = self.score = self.ident = np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._n = 0

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        self._new.append((group, score, ident))
        self._n += len(group)
        if self._n > 1 << 17:
            self.settle()

    def settle(self) -> None:
        if not self._n:
            return
        group, score, ident = (np.concatenate([old, *new]) for old, new in zip((self.group, self.score, self.ident), zip(*self._new)))
        order = np.lexsort((ident, -score, group))
        group, score, ident = group[order], score[order], ident[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        kept = place < self.keep
        self.group, self.score, self.ident = group[kept], score[kept], ident[kept]
        full = place == self.keep - 1
        self.least[group[full]] = score[full]
        self._new, self._n = [], 0


def find_positives(anchors: Stored, rows: Stored, best: Best) -> int:
    """Offer all rows of an anchor's label, but those of its own id; gives how many pairs were scored."""
    scored = 0
    for start, end in rows.segments():
        _, upper = score_bounds(anchors, rows, start, end)
        active = np.flatnonzero((anchors.labels == rows.labels[start]) & (upper >= best.least))
        if not len(active):
            continue
        s, ids = scores(anchors.vectors[active], rows.vectors[start:end]), rows.ids[start:end]
        scored += s.size
        a, r = np.nonzero((s >= best.least[active][:, None]) & (ids[None, :] != anchors.ids[active][:, None]))
        best.add(active[a], s[a, r], ids[r])
        best.settle()
    return scored


def find_negatives(anchors: Stored, rows: Stored, low: np.ndarray, high: np.ndarray, best: Best) -> int:
    """Offer rows of other labels to the windows (``low`` to ``high``, per anchor and slot) of the anchors."""
    scored, slots = 0, low.shape[1]
    for start, end in rows.segments():
        lower, upper = score_bounds(anchors, rows, start, end)
        need = np.maximum(low, best.least.reshape(low.shape))
        open_ = (need <= high) & (upper[:, None] >= need) & (lower[:, None] <= high)
        active = np.flatnonzero((anchors.labels != rows.labels[start]) & open_.any(axis=1))
        if not len(active):
            continue
        s, ids = scores(anchors.vectors[active], rows.vectors[start:end]), rows.ids[start:end]
        scored += s.size
        for slot in range(slots):
            a, r = np.nonzero((s >= need[active, slot][:, None]) & (s <= high[active, slot][:, None]))
            best.add(active[a] * slots + slot, s[a, r], ids[r])
    best.settle()
    return scored


def _met(slices: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every slice beside every block of anchors, joined on the part a block belongs to.

    Few blocks are broadcast, by count; otherwise both sides are dealt out by part and lane, so that neither a part
    nor a lane holds all of the other side.
    """
    n = blocks.count()
    parts = max(1, math.ceil(n / PART))
    theirs = blocks.select(F.pmod(F.xxhash64("slice"), F.lit(parts)).cast("int").alias("part"), *[F.col(c).alias(f"a_{c}") for c in blocks.columns])
    if n <= BROADCAST_BLOCKS:
        mine = slices.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return mine.join(F.broadcast(theirs), "part")
    lanes = max(1, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")) // parts)
    mine = slices.withColumn("lane", F.pmod(F.xxhash64("slice"), F.lit(lanes)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    theirs = theirs.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return mine.join(theirs, ["part", "lane"]).drop("lane")


def _searched(met: DataFrame, slots: int, keep: int, look: Callable[..., int]) -> DataFrame:
    """The best rows that each task found for each anchor and slot, as ``FOUND``."""
    count = len(STORED.split(","))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests: dict[str, Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                anchors = Stored(batch, i, count)
                if anchors.name not in bests:
                    bests[anchors.name] = Best(len(anchors.ids) * slots, keep)
                windows = batch.column(2 * count)[i].as_py() if batch.num_columns > 2 * count else None
                look(anchors, Stored(batch, i), windows, bests[anchors.name])
        for name, best in bests.items():
            best.settle()
            place, slot = np.divmod(best.group, slots)
            columns = [pa.array([name] * len(place), pa.string()), pa.array(place, pa.int32()), pa.array(slot, pa.int32()), pa.array(best.score), pa.array(best.ident)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "place", "slot", "score", "id"])

    names = [c.strip().split()[0] for c in STORED.split(",")]
    windows = ["a_windows"] if "a_windows" in met.columns else []
    return met.select(*names, *[f"a_{c}" for c in names], *windows).mapInArrow(run, FOUND)


def _first(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("block", "place", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def share(score: int, percent: int, up: bool) -> int:
    """``percent`` hundredths of a score, rounded up or down, without leaving 64 bits."""
    q, r = divmod(score, 100)
    return percent * q + (-(-percent * r // 100) if up else percent * r // 100)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, ident: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of another.

    Scores are inner products of floor(256 x); higher ones come first, ties by smaller id. A negative's score must lie between ``low``
    and ``high`` percent of its positive's. Gives ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Rows without id, label or vector and those with a null, NaN or infinite component take no part. Vectors of different lengths are
    compared as if the shorter one ended in zeros. Repeated rows count each; rows of an anchor's own id are not its positives. A positive
    with a negative score has an empty window. An empty table gives no rows; a component beyond ``vectors.LARGEST`` raises an error.
    """
    spark = rows.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    chosen = rows.select(F.col(f"`{ident}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"), F.col(f"`{vector}`").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    chosen = chosen.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    fine = F.exists("vector", lambda x: F.coalesce(x != 0, F.lit(False))) & F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    drawn = chosen.filter(fine).orderBy(F.xxhash64("id"), "vector").limit(REFERENCES).collect()
    directions = whole_numbers(pa.array([r.vector for r in drawn], pa.list_(pa.float64())))[1]
    directions = directions[(directions != 0).any(axis=1)]
    if not len(directions):
        directions = np.ones((1, 1), np.int64)

    path = scratch_path(spark, "slices")
    _stored(chosen.select("id", "label", "vector"), directions, SLICE).write.option("maxRecordsPerFile", SLICES_A_FILE).parquet(path)
    slices = spark.read.schema(STORED).parquet(path)
    blocks = staged(_stored(chosen.filter("anchor").select("id", "label", "vector"), directions, ANCHORS), "anchors")

    def look_for_positives(anchors: Stored, mine: Stored, _: None, best: Best) -> int:
        return find_positives(anchors, mine, best)

    first = staged(_first(_searched(_met(slices, blocks), 1, positives, look_for_positives), positives), "positives")
    if not first.limit(1).count():
        return spark.createDataFrame([], schema)
    # At most ``positives`` rows for each of the ``ANCHORS`` anchors of a block.
    armed = blocks.join(first.groupBy("block").agg(F.collect_list(F.struct("place", "rank", "score")).alias("windows")), F.col("slice") == F.col("block")).drop("block")

    def look_for_negatives(anchors: Stored, mine: Stored, windows: list, best: Best) -> int:
        lows, highs = (np.full((len(anchors.ids), positives), v, np.int64) for v in (0, -1))
        for w in windows:
            lows[w["place"], w["rank"] - 1] = share(w["score"], low, True)
            highs[w["place"], w["rank"] - 1] = share(w["score"], high, False)
        return find_negatives(anchors, mine, lows, highs, best)

    found = _first(_searched(_met(slices, staged(armed, "armed")), positives, negatives, look_for_negatives), negatives)
    asked = first.select("block", "place", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = blocks.select(F.col("slice").alias("block"), F.posexplode("ids").alias("place", "anchor_id"))
    done = found.join(asked, ["block", "place", "slot"]).join(names, ["block", "place"])
    return done.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
