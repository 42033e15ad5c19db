"""Sequence packing by non-negative least squares.

Documents are tokenised and cut into full sequences and a rest. Lengths fall into classes
of ``GRID`` tokens. All combinations of up to three classes that fill a sequence
exactly are the columns of a matrix; non-negative least squares finds how often
each should be repeated to use up the histogram of classes. The counts are rounded,
and what remains is packed greedily, largest first. All that happens on the histogram,
whose size is fixed; pieces then find their sequence by their rank within their class.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import broadcast_if_small, map_texts

CAPACITY = 1024
GRID = 8
END_ID = 0
BLOCK_ROWS = 100_000

# The pre-tokenisation of the vocabulary, fixed by it; written without backtracking.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """Text to ids by the vocabulary of a ``tokenizers`` file.

    The file's vocabulary drives a faster merge loop; texts that hold one of its
    special tokens go through ``tokenizers`` itself, which gives these an id of their own.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    # Byte-level vocabularies write printable Latin-1 bytes as themselves, the others from U+0100 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = [t["content"] for t in described["added_tokens"]]
    ranks = {bytes(byte_of[c] for c in t): i for t, i in described["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("from_file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in special):
            return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return fast.encode_to_numpy(text)

    return encode


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, and ``ids`` if kept.

    Every document ends with the id 0. Only the last piece of a document is shorter than
    ``capacity``. Null texts count as empty: one piece that holds the end.
    """

    def cut(texts: list[str]) -> tuple[dict, list[int]]:
        encode = _encoder(vocabulary)
        owners, rows, kept = [], [], []
        for i, text in enumerate(texts):
            ids = np.append(encode(text), END_ID).astype("<u4")
            for start in range(0, len(ids), capacity):
                part = ids[start : start + capacity]
                owners.append(i)
                rows.append((start, len(part), zlib.crc32(part.tobytes()), len(ids)))
                if keep_ids:
                    kept.append(part.astype("int32"))
        numbers = np.array(rows, dtype=np.int64).reshape(-1, 4)
        columns = {name: pa.array(numbers[:, k]) for k, name in enumerate(("start", "length", "ids_crc32", "doc_tokens"))}
        return columns | ({"ids": pa.array(kept, pa.list_(pa.int32()))} if keep_ids else {}), owners

    made = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * keep_ids
    return map_texts(docs, "text", [F.col("doc_id").cast("bigint").alias("doc_id")], made, cut)


def combinations(classes: int) -> list[tuple[int, ...]]:
    """All ways to reach ``classes`` by one, two or three classes, largest first."""
    found: list[tuple[int, ...]] = [(classes,)]
    for a in range(classes - 1, 0, -1):
        rest = classes - a
        if rest <= a:
            found.append((a, rest))
        found += [(a, b, rest - b) for b in range(min(a, rest - 1), 0, -1) if b >= rest - b]
    return found


def nnls(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``x >= 0`` that minimises ``|matrix x - target|``, by the active-set method."""
    columns = matrix.shape[1]
    x, inside = np.zeros(columns), np.zeros(columns, dtype=bool)
    small = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(3 * columns):
        slope = matrix.T @ (target - matrix @ x)
        slope[inside] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= small:
            break
        inside[best] = True
        while True:
            tried = np.zeros(columns)
            tried[inside] = np.linalg.lstsq(matrix[:, inside], target, rcond=None)[0]
            low = inside & (tried <= small)
            if not low.any():
                break
            step = np.min(x[low] / np.maximum(x[low] - tried[low], 1e-300))
            x = x + step * (tried - x)
            inside &= x > small
            x[~inside] = 0
            if not inside.any():
                break
        x = np.where(inside, tried, 0)
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of classes and how many sequences use each; every piece of the histogram is used once.

    ``histogram[c]`` counts the pieces of class ``c``; the last class fills a sequence.
    """
    left = histogram.astype(np.int64).copy()
    full = len(left) - 1
    combos = combinations(full)
    matrix = np.zeros((full + 1, len(combos)))
    for k, combo in enumerate(combos):
        for c in combo:
            matrix[c, k] += 1
    solved = nnls(matrix, left.astype(float))
    chosen: list[tuple[tuple[int, ...], int]] = []

    def take(combo: tuple[int, ...], times: int) -> None:
        if times > 0:
            for c in combo:
                left[c] -= times
            chosen.append((combo, times))

    for k in np.argsort(-solved, kind="stable"):
        if solved[k] < 0.5:
            break
        combo = combos[k]
        take(combo, min(int(np.rint(solved[k])), *(int(left[c]) // combo.count(c) for c in combo)))
    while left.any():
        # The largest piece left, then the largest that still fits, and so on; repeated while all of them last.
        combo, space = [], full
        rest = left.copy()
        while space and (fits := np.flatnonzero(rest[: space + 1])).size:
            c = int(fits[-1])
            combo.append(c)
            rest[c] -= 1
            space -= c
        take(tuple(combo), min(int(left[c]) // combo.count(c) for c in set(combo)))
    return chosen


def _slots(chosen: list[tuple[tuple[int, ...], int]], classes: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per class: from which rank on which first sequence holds how many pieces of the class in each sequence."""
    per_class: list[list[tuple[int, int, int]]] = [[] for _ in range(classes + 1)]
    used, sequence = [0] * (classes + 1), 0
    for combo, times in chosen:
        for c in sorted(set(combo)):
            n = combo.count(c)
            per_class[c].append((used[c], sequence, n))
            used[c] += n * times
        sequence += times
    return [tuple(np.array(v, dtype=np.int64) for v in zip(*rows, strict=True)) if rows else () for rows in per_class]


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, grid: int = GRID) -> DataFrame:
    """``pieces`` (any columns beside ``doc_id``, ``start``, ``length``) with ``sequence_id`` and ``offset``.

    ``pieces`` is read several times, so it should be a stored table. Pieces of a class get ranks
    without gaps: they are cut into hash blocks, whose counts are summed along the class, and ranked
    inside their block. Nothing goes to the driver but the histogram. No pieces give no rows.
    """
    classes = capacity // grid
    kind = F.ceil(F.col("length") / grid).cast("int")
    histogram = np.zeros(classes + 1, dtype=np.int64)
    for row in pieces.groupBy(kind.alias("c")).agg(F.count("*").alias("n")).collect():
        histogram[row["c"]] = row["n"]
    slots = _slots(plan(histogram), classes)
    blocks = int(-(-int(histogram.max()) // BLOCK_ROWS)) or 1
    marked = pieces.withColumns({"_class": kind, "_block": F.pmod(F.xxhash64("doc_id", "start"), F.lit(blocks)).cast("int")})
    counts = marked.groupBy("_class", "_block").agg(F.count("*").alias("_n"))
    along = Window.partitionBy("_class").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_class", "_block", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_class", "_block").orderBy("doc_id", "start")
    ranked = marked.withColumn("_rank", F.row_number().over(inside) - 1).join(broadcast_if_small(starts), ["_class", "_block"])
    ranked = ranked.select(*[F.col(f"`{c}`") for c in pieces.columns], "_class", (F.col("_first") + F.col("_rank")).alias("_rank"))

    @F.pandas_udf("bigint")
    def sequence_of(c: pd.Series, rank: pd.Series) -> pd.Series:
        out, which = np.zeros(len(c), dtype=np.int64), c.to_numpy()
        for value in np.unique(which):
            rows = np.flatnonzero(which == value)
            first, sequence, n = slots[value]
            r = rank.to_numpy()[rows]
            at = np.searchsorted(first, r, side="right") - 1
            out[rows] = sequence[at] + (r - first[at]) // n[at]
        return pd.Series(out)

    placed = ranked.withColumn("sequence_id", sequence_of("_class", "_rank"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint")).drop("_class", "_rank")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, grid: int = GRID, keep_ids: bool = False) -> DataFrame:
    """Documents (``doc_id``, ``text``) to pieces with their place: the columns of ``token_pieces``, ``sequence_id``, ``offset``.

    Tokens are made once and stored without the texts, since several jobs use them. Null ids and
    repeated rows are packed like any others; other columns are ignored; no rows give no rows.
    """
    return pack_pieces(staged(token_pieces(docs, vocabulary, capacity, keep_ids), "packing"), capacity, grid)
