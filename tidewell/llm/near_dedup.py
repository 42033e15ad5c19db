"""Near-duplicates by improved consistent weighted sampling.

Texts are weighted sets of word shingles: times in the text, by the inverse document frequency.
Each of ``BANDS * ROWS`` samples picks a shingle and a level of its weight, such that two texts agree on
a sample with the probability of their weighted Jaccard similarity. Texts that agree on a whole band
meet in a bucket, and the similarity itself decides (see ``similarities``). As either of two weightings
links a pair, every text is signed by both, with samples and bands of their own.

Frequencies come from a count-min sketch over all documents. Its size is fixed, so it can be sent to
every task; it overstates rare shingles by a fixed share of the corpus, which makes them weigh
alike, and is exact to that share for the frequent ones, which are those that matter.

Copies are one node. In a bucket no pair is made that a class already implies: first every member
meets the one that meets most others; then, in buckets that still hold several classes, the members with the least of
their own meet the members of other classes, four times as many members in each round, until the bucket is
one class or all pairs between its classes have been compared or ruled out by what the two texts share
with anyone. Members with too much of their own to be near to any text take no part. Once few pairs between
classes are left, one round takes them all: everyone outside a bucket's largest class meets the other classes. So a group of
thousands of near copies costs about one comparison a member, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import broadcast_if_small
from .components import components
from .shingles import Shingles, chunks, mix, shingles

THRESHOLD = 0.8
BANDS, ROWS = 12, 3  # of each weighting: a pair at the threshold by it meets with probability 1 - (1 - 0.8**3)**12 = 0.9998
WIDTH, DEPTH = 1 << 18, 2  # of the sketch
ALL_PAIRS = 20_000_000  # pairs between classes of one bucket, either way, over all buckets, that one round may take
BROADCAST_NODES = 1_000_000  # numbers of 8 bytes that may be broadcast
SLICES = 64  # pieces in which sketches are added up
KEY_BITS = 16  # of bitmaps for each key they mark
MOST_BITS = 1 << 27  # of all bitmaps together, which every task gets; with fewer bits a key more rows meet a mark by chance


def _cells(hashes: np.ndarray, row: int) -> np.ndarray:
    return ((hashes >> np.uint64(20 * row)) % np.uint64(WIDTH)).astype(np.int64)


def frequencies(docs: DataFrame) -> np.ndarray:
    """The sketch: how many documents have a shingle, in ``DEPTH`` rows of ``WIDTH`` cells."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((DEPTH, WIDTH), dtype=np.int64)
        for batch in batches:
            for _, some in chunks(batch.column(0)):
                found = shingles(some).hash
                for row in range(DEPTH):
                    sketch[row] += np.bincount(_cells(found, row), minlength=WIDTH)
        if sketch.any():
            pieces = sketch.reshape(-1).reshape(SLICES, -1).astype("<u4" if sketch.max() < 1 << 32 else "<u8")
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())], ["slice", "counts"])

    size = DEPTH * WIDTH // SLICES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, dtype="<u4" if len(counts) == 4 * size else "<u8").astype("<u8")
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["slice", "counts"])

    schema = "slice int, counts binary"
    out = np.zeros((SLICES, size), dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema).collect():
        out[r["slice"]] += np.frombuffer(r["counts"], dtype="<u8").astype(np.int64)
    return out.reshape(DEPTH, WIDTH)


def inverse_frequencies(sketch: np.ndarray, documents: int) -> np.ndarray:
    return np.log1p(documents / np.maximum(sketch, 1)).astype(np.float32)


def weights(found: Shingles, idf: np.ndarray) -> np.ndarray:
    """Times by inverse frequency; of a shingle's cells the least loaded counts."""
    rare = np.max([idf[row][_cells(found.hash, row)] for row in range(DEPTH)], axis=0)
    return found.times.astype(np.float32) * rare


def signatures(found: Shingles, weight: np.ndarray, samples: int = BANDS * ROWS, first: int = 0) -> np.ndarray:
    """Texts x samples, numbered from ``first``. Texts without shingles have zeros."""
    out = np.zeros((found.texts, samples), dtype=np.uint64)
    if not len(found.hash):
        return out
    begins = np.flatnonzero(np.diff(found.text, prepend=-1))
    owners, level = found.text[begins], np.log(weight)
    places = np.arange(len(found.hash), dtype=np.uint64)
    low, unit = np.uint64((1 << 21) - 1), np.float32(2.0**-21)

    def uniform(x: np.ndarray, part: int) -> np.ndarray:
        return (((x >> np.uint64(21 * part)) & low).astype(np.float32) + np.float32(0.5)) * unit

    for k in range(samples):
        salt = np.uint64(2 * (first + k) + 1)
        x = mix(found.hash ^ mix(np.array([salt], dtype=np.uint64)))
        y = x * np.uint64(0xD1342543DE82EF95) + salt
        y ^= y >> np.uint64(32)
        r = -np.log(uniform(x, 0) * uniform(x, 1))  # gamma (2, 1)
        c = -np.log(uniform(x, 2) * uniform(y, 0))  # gamma (2, 1)
        beta = uniform(y, 1)
        t = np.floor(level / r + beta)
        a = np.log(c) - r * (t - beta) - r
        # The order of floats as unsigned numbers, with the place below: one minimum finds both.
        bits = a.astype(np.float32).view(np.uint32)
        bits = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))
        best = np.minimum.reduceat((bits.astype(np.uint64) << np.uint64(32)) | places, begins) & np.uint64(0xFFFFFFFF)
        best = best.astype(np.int64)
        out[owners, k] = mix(found.hash[best] + t[best].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def similarities(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """The weighted Jaccard similarity of each pair of texts, 0 if one has no words: the greater of two weightings.

    By TF-IDF, texts that differ in boilerplate only are alike. But the text of a large group of
    near copies is frequent because it was copied, and its rare edits would count for more; by
    counts alone such texts stay alike.
    """
    a, b = shingles(left), shingles(right)
    key = np.concatenate([a.key(), b.key()])
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    pair = (key[same] >> np.uint64(48)).astype(np.int64)
    best = np.zeros(len(left))
    for wa, wb in ((weights(a, idf), weights(b, idf)), (a.times, b.times)):
        weight = np.concatenate([wa, wb]).astype(float)[order]
        shared = np.bincount(pair, weights=np.minimum(weight[same], weight[same + 1]), minlength=len(left))
        whole = np.bincount(a.text, weights=wa, minlength=len(left)) + np.bincount(b.text, weights=wb, minlength=len(left))
        best = np.maximum(best, shared / np.maximum(whole - shared, 1e-12))
    return best


def bands_of(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """``doc_id``, ``node`` and ``buckets`` (one per band of each weighting, none for texts without words) of each document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for _, some in chunks(batch.column(2)):
                found = shingles(some)
                by_idf, by_count = signatures(found, weights(found, idf)), signatures(found, found.times.astype(np.float32), first=BANDS * ROWS)
                signed = np.concatenate([by_idf, by_count], axis=1).reshape(found.texts, 2 * BANDS, ROWS)
                place = np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                keys = mix((signed * (place | np.uint64(1))).sum(axis=2, dtype=np.uint64) + np.arange(2 * BANDS, dtype=np.uint64))
                some_words = np.bincount(found.text, minlength=found.texts) > 0
                kept += [row.view(np.int64) if has else None for row, has in zip(keys, some_words, strict=True)]
            buckets = pa.array(kept, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), buckets], ["doc_id", "node", "buckets"])

    known = docs.select("doc_id", F.xxhash64("text").alias("node"), "text")
    return known.mapInArrow(sign, "doc_id bigint, node bigint, buckets array<bigint>")


def compared(pairs: DataFrame, docs: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """The ``pairs`` (``a``, ``b``: nodes) at or above the threshold. Only texts in a pair are moved."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    few = 2 * pairs.count() <= BROADCAST_NODES  # there are no more nodes than ends of pairs
    texts = staged(_texts(F.broadcast(needed) if few else needed, docs), "texts")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = batch.column(3)
            near = [similarities(some, right.slice(first, len(some)), idf) for first, some in chunks(batch.column(2))]
            good = pa.array(np.concatenate(near) >= threshold) if near else pa.array([], pa.bool_())
            yield batch.select([0, 1]).filter(good)

    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    return two.select("a", "b", "left", "right").mapInArrow(keep, "a bigint, b bigint")


def nodes_of(signed: DataFrame) -> DataFrame:
    """One row per text with words."""
    return signed.filter("buckets IS NOT NULL").groupBy("node").agg(F.first("buckets").alias("buckets"))


def shared_weights(nodes: DataFrame, docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """Per node the weight of its shingles and of those that another of the nodes has too, by both weightings.

    Two texts have no more in common than the lesser of what they share with anyone. That bounds
    their similarity before they are compared: copies with too much of their own meet nobody.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in chunks(batch.column(1)):
                found = shingles(some)
                node = batch.column(0).slice(first, len(some)).take(pa.array(found.text))
                values = [node, pa.array(found.hash.view(np.int64)), pa.array(weights(found, idf).astype(float)), pa.array(found.times)]
                yield pa.RecordBatch.from_arrays(values, ["node", "shingle", "weight", "times"])

    rows = _texts(nodes, docs).mapInArrow(spread, "node bigint, shingle bigint, weight double, times bigint")
    owners = rows.groupBy("shingle").agg(F.count("*").alias("owners")).filter("owners > 1").select("shingle", F.lit(True).alias("_shared"))
    both = rows.join(owners, "shingle", "left")
    return both.groupBy("node").agg(
        F.sum("weight").alias("total"),
        F.sum(F.when(F.col("_shared"), F.col("weight")).otherwise(0.0)).alias("shared"),
        F.sum("times").cast("double").alias("total_n"),
        F.sum(F.when(F.col("_shared"), F.col("times")).otherwise(0)).cast("double").alias("shared_n"),
    )


def _may_reach(total: str, shared: str, threshold: float) -> Column:
    """Whether a pair's similarity can be at the threshold, by what each shares with anyone; a little in doubt's favour."""
    common = F.least(F.col(shared), F.col(f"hub_{shared}"))
    return common * 1.0001 >= threshold * (F.col(total) + F.col(f"hub_{total}") - common)


def _may_link(bounds: DataFrame, threshold: float) -> DataFrame:
    """The nodes that may reach the threshold with any text: what two have in common is no more than either has, so it must be enough of this one."""
    enough = [F.col(shared) * 1.0001 >= threshold * F.col(total) for total, shared in (("total", "shared"), ("total_n", "shared_n"))]
    return bounds.filter(enough[0] | enough[1])


def _texts(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The text of each of the ``nodes``; only those texts move."""
    found = docs.select(F.xxhash64("text").alias("node"), "text").join(nodes, "node", "left_semi")
    return found.groupBy("node").agg(F.first("text").alias("text"))


def _renamed(told: DataFrame, classes: DataFrame) -> DataFrame:
    """``told`` with its roots replaced by the roots of their components."""
    names = classes.select(F.col("node").alias("root"), F.col("root").alias("_new"))
    return told.join(names, "root", "left").select("node", F.coalesce("_new", "root").alias("root"))


def _split(placed: DataFrame) -> DataFrame:
    """The buckets whose members are in several classes, and how many members they have."""
    found = placed.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.max("n").alias("n"))
    return found.filter(F.col("_low") < F.col("_high")).select("bucket", "n")


def _unsettled(placed: DataFrame, first: int) -> DataFrame:
    """The buckets of ``first`` members or more in several classes: their largest class, and how many pairs stand between classes."""
    classes = placed.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    found = classes.groupBy("bucket").agg(
        F.max(F.struct("c", "root")).alias("_most"), F.count("*").alias("_classes"), F.sum("c").alias("_n"), F.sum(F.col("c") * F.col("c")).alias("_squares")
    )
    pairs = ((F.col("_n") * F.col("_n") - F.col("_squares")) / 2).cast("bigint")
    return found.filter((F.col("_classes") > 1) & (F.col("_n") >= first)).select("bucket", F.col("_most.root").alias("largest"), pairs.alias("pairs"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``class_id``, ``node``.

    A class is a connected component of the documents linked by equal texts or a similarity of at least
    ``threshold``; its id is its least ``doc_id``. ``node`` is the text's 64-bit hash. Null texts count as empty; empty
    texts are copies of each other, and other texts without words are like nothing but their copies. Repeated
    rows are copies. A class whose ids are all null has a null id. Other columns are ignored.
    """
    return _classes(docs, threshold).select("doc_id", "class_id", "node")


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """``near_duplicates``, and ``root``, which tells classes of the same id apart."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    idf = inverse_frequencies(frequencies(docs), docs.count())
    signed = staged(bands_of(docs, idf), "bands")
    nodes = nodes_of(signed).select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
    sizes = nodes.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = staged(nodes.join(sizes, "bucket"), "buckets")
    # Who meets most others is nearest to the middle of its group.
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    hubs = shared.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", "node")).alias("_hub"))
    meetings = shared.join(hubs.select("bucket", F.col("_hub.node").alias("hub")), "bucket").filter("node <> hub")

    pairs = staged(meetings.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct(), "pairs")
    links = staged(compared(pairs, docs, idf, threshold), "links")
    told = staged(_renamed(shared.select("node", F.col("node").alias("root")).distinct(), components(links)), "roots")
    # Buckets of two are done. Where others hold several classes, the members with the least of their own come first.
    placed = shared.filter("n > 2").select("bucket", "node", "n").join(told, "node")
    live = staged(placed.join(_split(placed), "bucket", "left_semi").select("bucket", "node", "n"), "live")
    bounds = staged(shared_weights(broadcast_if_small(live.select("node").distinct(), BROADCAST_NODES), docs, idf), "bounds")
    # Members that no text can be near to have met their hub and are done; the rounds take the others.
    own = nodes_of(signed).join(_may_link(bounds, threshold), "node")
    cleanest = Window.partitionBy("bucket").orderBy(F.desc(F.col("shared") / F.col("total")), "node")
    live = staged(live.select("bucket", "node").join(own, "node").withColumn("rank", F.row_number().over(cleanest)), "ranks")
    first, last = 1, 4
    while True:
        placed = live.join(told, "node")
        split = _unsettled(placed, first)
        size = split.agg(F.count("*").alias("buckets"), F.sum("pairs").alias("pairs")).first()
        if not size["buckets"]:
            break
        if first > 1 and 2 * size["pairs"] <= ALL_PAIRS:
            last = (1 << 31) - 1
        here = placed.join(split.select("bucket", "largest"), "bucket")
        columns = ["node", "root", "buckets", "total", "shared", "total_n", "shared_n"]
        meets = F.col("rank").between(first, last)
        if last == (1 << 31) - 1:
            # Of two members of different classes one is outside the largest.
            meets = meets & (F.col("root") != F.col("largest"))
        hub = here.filter(meets).select("bucket", *[F.col(c).alias(f"hub_{c}") for c in columns])
        may_link = _may_reach("total", "shared", threshold) | _may_reach("total_n", "shared_n", threshold)
        once = F.array_min(F.array_intersect("buckets", "hub_buckets")) == F.col("bucket")  # a pair meets in one of its buckets
        # Who ranks before ``first`` has met all that are in other classes now: classes only grow.
        met = here.filter(F.col("rank") >= first).join(hub, "bucket").filter((F.col("root") != F.col("hub_root")) & may_link & once)
        new = met.select(F.greatest("node", "hub_node").alias("a"), F.least("node", "hub_node").alias("b")).distinct()
        new = staged(new.join(pairs, ["a", "b"], "left_anti"), "pairs")
        more = staged(compared(new, docs, idf, threshold), "links")
        # Only the classes that the new links join are named anew.
        ends = more.join(told.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(told.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        told = staged(_renamed(told, components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))), "roots")
        first, last = last + 1, 4 * last
    found = signed.select("doc_id", "node").join(told, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = found.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return found.join(least, "root").select("doc_id", "class_id", "node", "root")


def _may_be_in(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``rows`` and ``_maybe``: false where ``key`` (long) is surely none of ``keys`` (``_key``, stored), whatever their number; rows stay where they are.

    The keys are marked in bitmaps of 2**15 bits, and the row's bit is looked up.
    """
    bits = max(1 << 15, min(MOST_BITS, KEY_BITS * keys.count()))
    place = F.pmod(key, F.lit(bits))
    marks = keys.select(F.pmod("_key", F.lit(bits)).alias("_place")).select(F.shiftright("_place", 15).alias("_bitmap"), F.col("_place").bitwiseAND((1 << 15) - 1).alias("_bit"))
    marks = marks.repartition("_bitmap").groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.substring("_bits", F.shiftright(place.bitwiseAND((1 << 15) - 1), 3).cast("int") + 1, F.lit(1))
    marked = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), place.bitwiseAND(7).cast("int")) == 1
    found = rows.join(F.broadcast(marks), F.shiftright(place, 15) == F.col("_bitmap"), "left")
    return found.withColumn("_maybe", F.coalesce(marked, F.lit(False))).drop("_bitmap", "_bits")


def first_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with the least id of their class, one each, unchanged; documents without an id in classes of their own stay.

    Only rows that go or are repeated, and the few that bitmaps cannot tell from them, are joined; the texts of all others stay where they are.
    """
    rows = staged(_classes(docs, threshold).groupBy("root", "class_id", "doc_id", "node").agg(F.count("*").alias("_rows")), "rows")
    is_first = F.col("doc_id").eqNullSafe(F.col("class_id"))
    # One text of the class, should its least id come with several.
    one = rows.filter(is_first).groupBy("root").agg(F.min("node").alias("node"))
    goes = rows.filter(~is_first).unionByName(rows.filter(is_first).join(one, ["root", "node"], "left_anti").select(rows.columns))
    again = rows.filter(is_first & (F.col("_rows") > 1)).join(one, ["root", "node"], "left_semi").select(rows.columns)
    met = goes.withColumn("_again", F.lit(False)).unionByName(again.withColumn("_again", F.lit(True)))
    met = staged(met.select(F.col("doc_id").alias("_id"), F.col("node").alias("_text"), F.xxhash64("doc_id", "node").alias("_key"), "_again"), "met")

    doc_id, node = F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce("text", F.lit("")))
    told = _may_be_in(docs, F.xxhash64(doc_id, node), met.select("_key"))
    maybe = told.filter("_maybe").drop("_maybe")
    same = doc_id.eqNullSafe(F.col("_id")) & (node == F.col("_text"))
    kept = told.filter("NOT _maybe").drop("_maybe").unionByName(maybe.join(met, same, "left_anti"))
    if not met.filter("_again").limit(1).count():
        return kept
    repeated = maybe.join(met.filter("_again"), same, "left_semi").withColumn("_text", node)
    return kept.unionByName(repeated.dropDuplicates(["doc_id", "_text"]).drop("_text"))
