"""Exact k-means over whole-number vectors by subvector dictionaries.

Vectors are cut into blocks of ``BLOCK`` dimensions. Every slice of ``SLICE`` vectors is dictionary-encoded once, without
loss: per block its distinct subvectors, and per vector their codes. A round computes the squared distances of the
distinct subvectors to all centroids, once each, and adds them up by code, so work that vectors share is done once and
only small integers are read again. The encoded slices are a stored table; a round moves one row of sums per
centroid and task, and centroids are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .vectors import whole_numbers

BLOCK = 2
SLICE = 16_384  # vectors that share dictionaries; codes fit 16 bits
SLICES_A_FILE = 16  # so that no batch of a reader holds many slices


def _usable(vector: Column, width: int) -> Column:
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == width) & fine, F.lit(False))


def encode(ids: list, vectors: np.ndarray, block: int = BLOCK) -> dict[str, object]:
    """A slice as dictionaries and codes: ``values`` are the distinct subvectors of block after block."""
    values, codes, sizes = [], [], []
    for start in range(0, vectors.shape[1], block):
        part = np.ascontiguousarray(vectors[:, start : start + block])
        distinct, code = np.unique(part, axis=0, return_inverse=True)
        values.append(distinct.astype(np.int32).tobytes())
        codes.append(code.reshape(-1).astype(np.uint16).tobytes())
        sizes.append(len(distinct))
    return {"ids": ids, "sizes": sizes, "vals": b"".join(values), "codes": b"".join(codes)}


class Slice:
    """An encoded slice, read back block by block."""

    def __init__(self, n: int, width: int, sizes: list[int], values: bytes, codes: bytes, block: int = BLOCK) -> None:
        self.n, self.width = n, width
        flat, self.blocks, at = np.frombuffer(values, np.int32), [], 0
        for k, size in enumerate(sizes):
            start = k * block
            wide = min(block, width - start)
            distinct = flat[at : at + size * wide].reshape(size, wide).astype(np.int64)
            code = np.frombuffer(codes, np.uint16, n, 2 * n * k)
            self.blocks.append((slice(start, start + wide), distinct, code))
            at += size * wide

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each vector's nearest centroid, the smaller one of equals, and its squared distance."""
        total = np.zeros((self.n, len(centroids)), np.int64)
        partial = np.empty_like(total)
        for where, distinct, code in self.blocks:
            known = ((distinct[:, None, :] - centroids[None, :, where]) ** 2).sum(axis=2)
            total += np.take(known, code, axis=0, out=partial)
        number = total.argmin(axis=1)
        return number, total[np.arange(self.n), number]

    def sums(self, number: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and componentwise sums per centroid: codes are counted, then their subvectors weighted."""
        out = np.zeros((k, self.width), np.int64)
        for where, distinct, code in self.blocks:
            m = len(distinct)
            seen, times = np.unique(number * m + code, return_counts=True)
            np.add.at(out[:, where], seen // m, distinct[seen % m] * times[:, None])
        return np.bincount(number, minlength=k), out


def _encoded(rows: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n = [], [], 0

        def flush(everything: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, held, n
            if not n or (n < SLICE and not everything):
                return
            whole = np.concatenate(held)
            names = pa.concat_arrays(ids)
            end = n if everything else n - n % SLICE
            for at in range(0, end, SLICE):
                to = min(at + SLICE, end)
                made = encode(names.slice(at, to - at).to_pylist(), whole[at:to])
                yield pa.RecordBatch.from_pylist([made], schema)
            ids, held, n = [names.slice(end)], [whole[end:]], n - end

        for batch in batches:
            at, whole, _ = whole_numbers(batch.column(1), width)
            if len(at):
                ids.append(batch.column(0).take(pa.array(at)))
                held.append(whole)
                n += len(at)
                yield from flush(False)
        yield from flush(True)

    schema = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("vals", pa.binary()), ("codes", pa.binary())])
    return rows.mapInArrow(run, "ids array<bigint>, sizes array<int>, vals binary, codes binary")


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, Slice]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column(0)[i].values
            sizes, values, codes = (batch.column(c)[i] for c in (1, 2, 3))
            yield ids, Slice(len(ids), width, sizes.as_py(), values.as_buffer(), codes.as_buffer())


def _round(slices: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per centroid with vectors, their number and componentwise sums: at most one row per centroid comes back."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _, part in _slices(batches, width):
            number, _ = part.nearest(centroids)
            n, s = part.sums(number, k)
            counts += n
            sums += s
        held = np.flatnonzero(counts)
        if len(held):
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(held, pa.int32()), "n": pa.array(counts[held]), "sums": pa.array(sums[held].tolist(), pa.list_(pa.int64()))})

    found = slices.mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    totals = found.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)])
    return {r[0]: (r[1], list(r[2:])) for r in totals.collect()}


def first_centroids(rows: DataFrame, ident: str, vector: str, width: int, k: int, salt: str) -> np.ndarray:
    """The vectors whose ``salt`` and id have the smallest hashes; equal ids by their vectors."""
    draw = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(ident).cast("string"), F.lit(""))), 256)
    chosen = rows.filter(_usable(F.col(vector), width)).orderBy(draw, vector).limit(k).select(vector).collect()
    return whole_numbers(pa.array([r[0] for r in chosen], pa.list_(pa.float64())), width)[1]


def cluster_vectors(rows: DataFrame, ident: str = "vec_id", vector: str = "embedding", width: int = 64, k: int = 40, rounds: int = 5, salt: str = "2:") -> DataFrame:
    """k-means of all vectors of ``width`` usable components, in whole numbers floor(256 x).

    The ``k`` vectors with the smallest SHA-256 of ``salt`` and id start as centroids. A round assigns every vector to the
    nearest centroid (ties: the smaller number) and replaces each centroid that has vectors by the floor of their
    mean; after the last round vectors are assigned once more. Gives the id, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256`` (of the components, as decimals joined by commas).

    Null vectors, other lengths and components that are null, NaN or infinite leave a row out; repeated rows and
    rows without an id count each. With fewer than ``k`` vectors there are fewer centroids, from an empty table no rows. A component beyond
    ``vectors.LARGEST`` raises an error. Other columns are not read.
    """
    spark, made = rows.sparkSession, f"`{ident}` bigint, cluster int, distance bigint"
    chosen = rows.select(F.col(f"`{ident}`").cast("bigint").alias(ident), F.col(f"`{vector}`").alias(vector))
    centroids = first_centroids(chosen, ident, vector, width, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], made + ", cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    path = scratch_path(spark, "slices")
    _encoded(chosen, width).write.option("maxRecordsPerFile", SLICES_A_FILE).parquet(path)
    slices = spark.read.parquet(path).select("ids", "sizes", "vals", "codes")
    for _ in range(rounds):
        centroids = centroids.copy()
        for number, (n, sums) in _round(slices, centroids).items():
            centroids[number] = [s // n for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, part in _slices(batches, width):
            number, distance = part.nearest(centroids)
            yield pa.RecordBatch.from_pydict({ident: ids, "cluster": pa.array(number.astype(np.int32)), "distance": pa.array(distance)})

    path = scratch_path(spark, "assigned")
    slices.mapInArrow(run, made).write.parquet(path)
    assigned = spark.read.parquet(path)
    # One row per centroid.
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    whole = sum(inertia.values())
    digests = [(c, s, whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in inertia.items()]
    told = spark.createDataFrame(digests, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select(ident, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
