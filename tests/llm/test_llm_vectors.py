"""Hard negatives and clustering against plain Python, with ties, odd vectors and empty tables."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewell.llm import clustering, negatives
from tidewell.llm.vectors import whole_numbers

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, rank int"


def usable(v, width=None):
    return v is not None and (width is None or len(v) == width) and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "clash", 9) for i, v, l in rows], SCHEMA)


def grouped(n, seed, spread=0.05, width=8):
    draw = random.Random(seed)
    middles = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [m + draw.gauss(0, spread) for m in middles[i % 6]], draw.randrange(3)) for i in range(n)]


# Hard negatives


def plain_negatives(rows):
    rows = [(i, whole(v), l) for i, v, l in rows if i is not None and l is not None and usable(v)]
    out = []

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    for i, v, l in rows:
        if i % 100:
            continue
        near = sorted((-score(v, w), j) for j, w, m in rows if m == l and j != i)[:5]
        for p, j in near:
            p = -p
            ok = sorted((-score(v, w), k) for k, w, m in rows if m != l and 80 * p <= 100 * score(v, w) <= 100 * p)[:5]
            out += [(i, j, r + 1, k, p, -s) for r, (s, k) in enumerate(ok)]
    return sorted(out)


def mined(spark, rows):
    done = negatives.hard_negatives(frame(spark, rows).repartition(3), F.col("vec_id") % 100 == 0)
    return sorted(tuple(r) for r in done.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_negatives_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SLICE", 64)
    monkeypatch.setattr(negatives, "SEGMENT", 16)
    rows = grouped(400, 1)
    want = plain_negatives(rows)
    assert want and mined(spark, rows) == want


def test_negatives_with_shuffled_blocks(spark, monkeypatch):
    for name, value in (("SLICE", 50), ("ANCHORS", 1), ("PART", 2), ("BROADCAST_BLOCKS", 0)):
        monkeypatch.setattr(negatives, name, value)
    rows = grouped(500, 2)
    assert mined(spark, rows) == plain_negatives(rows)


def test_negatives_ties_nulls_and_hot_vector(spark):
    hot = [0.5, -0.25, 1.0]
    rows = [(i, hot, i % 2) for i in range(300)]
    rows += [(None, hot, 1), (1000, None, 1), (1001, [0.1, None, 2.0], 0), (1002, [float("nan"), 1.0, 1.0], 0), (1003, [float("inf"), 1.0, 1.0], 1)]
    rows += [(1100, hot, None), (1200, [], 0), (1300, [1.0], 1), (1400, [0.0, 0.0, 0.0], 0), (1500, [-9.0, 4.0, -3.0], 5), (7, hot, 1), (7, hot, 1)]
    assert mined(spark, rows) == plain_negatives(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, hot, 1)]) == []


def test_negatives_refuse_what_is_not_exact(spark):
    with pytest.raises(Exception, match="would not be exact"):
        mined(spark, [(0, [1e30], 1), (1, [1.0], 1)])


def test_bounds_hold_and_leave_work_out():
    rows = grouped(1200, 3, spread=0.02)
    vectors = np.array([whole(v) for _, v, _ in rows])
    labels = np.array([l for _, _, l in rows])

    def stored(pick, directions):
        s = negatives.Stored.__new__(negatives.Stored)
        norms, angles = negatives.angles_to(vectors[pick], directions)
        near = angles.argmin(axis=1)
        order = np.lexsort((angles[np.arange(len(pick)), near], near, labels[pick]))
        pick = pick[order]
        s.name, s.ids, s.labels, s.vectors, s.norms, s.angles = "x", pick, labels[pick], vectors[pick], norms[order], angles[order]
        return s

    directions = vectors[:8]
    anchors, all_rows = stored(np.arange(0, 1200, 100), directions), stored(np.arange(1200), directions)
    for start, end in all_rows.segments():
        low, high = negatives.score_bounds(anchors, all_rows, start, end)
        exact = anchors.vectors @ all_rows.vectors[start:end].T
        assert (low <= exact.min(axis=1)).all() and (exact.max(axis=1) <= high).all()
    best = negatives.Best(len(anchors.ids), 5)
    scored = negatives.find_positives(anchors, all_rows, best)
    same = sum(int((all_rows.labels == label).sum()) for label in anchors.labels)
    assert scored < 0.6 * same


def test_share_of_a_score():
    for score in (-101, -1, 0, 7, 99, 100, 101, 1 << 56):
        assert negatives.share(score, 80, True) == -(-80 * score // 100) and negatives.share(score, 100, False) == score


# Clustering


def plain_clusters(rows, width, k, rounds):
    kept = [(i, whole(v)) for i, v, _ in rows if usable(v, width)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), f in zip(kept, found) if f == n]
            if mine:
                centroids[n] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in last)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, sum(e for _, e, m in last if m == n), total, digest[n]) for i, d, n in last), key=repr)


def clustered(spark, rows, width, k, rounds):
    done = clustering.cluster_vectors(frame(spark, rows).repartition(3), width=width, k=k, rounds=rounds)
    return sorted((tuple(r) for r in done.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


@pytest.mark.parametrize("width", [1, 3, 8])
def test_clusters_against_plain_rounds(spark, monkeypatch, width):
    monkeypatch.setattr(clustering, "SLICE", 32)
    rows = grouped(150, 5, spread=0.3, width=width)
    assert clustered(spark, rows, width, 7, 4) == plain_clusters(rows, width, 7, 4)


def test_clusters_ties_odd_rows_and_few_vectors(spark):
    hot = [0.5, -0.5]
    rows = [(i, hot, 1) for i in range(90)] + [(i, [i / 7, -i / 3], None) for i in range(100, 130)]
    rows += [(None, hot, 0), (5, hot, 0), (5, hot, 0), (200, None, 0), (201, [], 0), (202, [1.0], 0), (203, [1.0, None], 0), (204, [1.0, 2.0, 3.0], 0)]
    rows += [(205, [float("nan"), 1.0], 0), (206, [1.0, float("-inf")], 0)]
    assert clustered(spark, rows, 2, 6, 5) == plain_clusters(rows, 2, 6, 5)
    few = [(1, [1.0, 2.0], 0), (2, [3.0, 4.0], 0)]
    assert clustered(spark, few, 2, 40, 5) == plain_clusters(few, 2, 40, 5)
    assert clustered(spark, [], 2, 3, 2) == []


def test_slice_is_lossless():
    vectors = np.random.default_rng(1).integers(-5, 5, (300, 7))
    made = clustering.encode(list(range(300)), vectors)
    part = clustering.Slice(300, 7, made["sizes"], made["vals"], made["codes"])
    back = np.concatenate([distinct[code] for _, distinct, code in part.blocks], axis=1)
    assert (back == vectors).all() and max(made["sizes"]) <= 100
    number = np.arange(300) % 3
    n, sums = part.sums(number, 4)
    assert n.tolist() == [100, 100, 100, 0] and (sums[:3] == [vectors[number == c].sum(axis=0) for c in range(3)]).all()


def test_whole_numbers_of_mixed_lengths():
    column = pa.array([[0.5], None, [1.0, -0.001], [float("nan")], []], pa.list_(pa.float32()))
    rows, matrix, sizes = whole_numbers(column)
    assert rows.tolist() == [0, 2, 4] and matrix.tolist() == [[128, 0], [256, -1], [0, 0]] and sizes.tolist() == [1, 2, 0]
