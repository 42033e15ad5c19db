"""Benchmark decontamination by winnowing.

Of every run of ``WINDOW - GRAM + 1`` consecutive k-gram hashes the rightmost smallest
is a fingerprint, in documents and items alike. Two texts that share ``WINDOW`` words
share the k-grams of that span, hence its smallest one, hence a fingerprint: no
shared span of that length is missed. A fingerprint of a document that an item has
too is extended to the windows that cover it, and those are compared word by word
with the windows of the items, so nothing else is reported.

Items of fewer words are one window each. Winnowing promises nothing for them, so
documents are searched for each length that occurs, at every position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import broadcast_if_few_bytes, broadcast_if_small, words

WINDOW = 10
GRAM = 5
RUN = WINDOW - GRAM + 1


def _grams(hashes: Column) -> Column:
    """The hash of every k-gram, from the hashes of the words."""
    each = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + d) for d in range(1, GRAM)]))
    return F.slice(each, 1, F.greatest(F.size(hashes) - (GRAM - 1), F.lit(0)))


def _reach(grams: Column, at: Column, step: int) -> Column:
    """How many neighbours on one side, ``RUN - 1`` at most, the k-gram at ``at`` beats without a break."""
    mine, reach = F.get(grams, at), F.lit(0)
    for d in range(RUN - 1, 0, -1):
        other = F.get(grams, at + step * d)
        beaten = other > mine if step > 0 else other >= mine
        reach = F.when(beaten, reach + 1).otherwise(0)
    return reach


def _chosen(grams: Column, at: Column) -> Column:
    """Whether the k-gram at ``at`` is the rightmost smallest of some run."""
    return _reach(grams, at, -1) + _reach(grams, at, 1) >= RUN - 1


def _spans(w: Column, n: Column | int) -> Column:
    """All windows of ``n`` words, as (start, words joined by a space)."""
    starts = F.sequence(F.lit(0), F.size(w) - n)
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.array_join(F.slice(w, s + 1, n), " ").alias("span")))


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Windows (``span``, ``n``, ``set_id``) and sets (``set_id``, ``items``): the items, as sorted strings, with a window.

    Windows of the same items share a set, so a passage that many items hold is listed once.
    """
    w = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(WINDOW))
    flat = w.select("item", n.alias("n"), F.explode(_spans(F.col("w"), n)).alias("s")).select("item", "n", "s.span")
    grouped = flat.groupBy("span", "n").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marked = grouped.withColumn("set_id", F.sha2(F.to_json("items"), 256))
    return marked.select("span", "n", "set_id"), marked.select("set_id", "items").distinct()


def item_fingerprints(benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The fingerprints of all items of ``WINDOW`` words or more."""
    w = benchmark.select(F.transform(words(F.col(text)), lambda x: F.xxhash64(x)).alias("h")).filter(F.size("h") >= WINDOW)
    g = w.select(_grams(F.col("h")).alias("g")).select("g", F.explode(F.sequence(F.lit(0), F.size("g") - 1)).alias("i"))
    return g.filter(_chosen(F.col("g"), F.col("i"))).select(F.get("g", F.col("i")).alias("print")).distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and ``hits``.

    ``hits`` lists the hit word ranges (``start``, ``n``); ``text_hash`` tells rows of one id but different
    texts apart. Null or empty texts have no words and no hits. Repeated rows come out as often as they
    went in; an empty benchmark hits nothing; other columns are ignored. Items without an id or words are no items.
    """
    items = benchmark.filter(F.col(item_id).isNotNull())
    windows, sets = item_windows(items, item_id, text)
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most WINDOW numbers
    prints = broadcast_if_small(item_fingerprints(items, text))
    whole = broadcast_if_small(windows, 50_000)
    w = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("w"))
    w = w.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    w = w.withColumn("g", F.when(F.size("w") >= WINDOW, _grams(F.col("h"))).otherwise(F.array().cast("array<bigint>")))
    # Position -1 stands for the document itself, so that one pass gives counts and hits.
    at = w.withColumn("i", F.explode(F.concat(F.array(F.lit(-1)), F.when(F.size("g") > 0, F.sequence(F.lit(0), F.size("g") - 1)).otherwise(F.array().cast("array<int>")))))
    at = at.filter((F.col("i") < 0) | _chosen(F.col("g"), F.col("i"))).withColumn("print", F.get("g", F.col("i")))
    found = at.join(prints.withColumn("known", F.lit(True)), "print", "left").filter((F.col("i") < 0) | F.col("known"))
    starts = F.when(F.col("i") < 0, F.array(F.lit(-1))).otherwise(
        F.sequence(F.greatest(F.col("i") - (RUN - 1), F.lit(0)), F.least(F.col("i"), F.size("w") - WINDOW))
    )
    spread = found.select("_id", "text_hash", F.size("w").alias("n_words"), "w", F.explode(starts).alias("start"))
    spans = spread.select(
        "_id", "text_hash", "n_words", "start", F.lit(WINDOW).alias("n"),
        F.when(F.col("start") >= 0, F.array_join(F.slice("w", F.col("start") + 1, WINDOW), " ")).alias("span"),
    )
    hits = spans.join(whole, ["span", "n"], "left").filter((F.col("start") < 0) | F.col("set_id").isNotNull())
    hits = hits.select("_id", "text_hash", "n_words", "start", "n", "set_id")
    for n in lengths:
        if n < WINDOW:
            short = w.filter(F.size("w") >= n).select("_id", "text_hash", F.size("w").alias("n_words"), F.explode(_spans(F.col("w"), n)).alias("s"))
            short = short.select("_id", "text_hash", "n_words", "s.start", F.lit(n).alias("n"), "s.span").join(whole, ["span", "n"])
            hits = hits.unionByName(short.select("_id", "text_hash", "n_words", "start", "n", "set_id"))
    real = F.col("start") >= 0
    per_doc = hits.groupBy("_id", "text_hash", "n_words").agg(
        F.count(F.when(~real, 1)).alias("copies"),
        F.array_sort(F.collect_set(F.when(real, F.struct("start", "n")))).alias("hits"),
        F.array_sort(F.collect_set("set_id")).alias("set_ids"),
    )
    # Hit words: the length of the union of the ranges, which come sorted by their start.
    union = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["hit"] + F.greatest(x["start"] + x["n"] - F.greatest(x["start"], a["end"]), F.lit(0))).alias("hit"),
            F.greatest(a["end"], x["start"] + x["n"]).alias("end"),
        ),
        lambda a: a["hit"].cast("bigint"),
    )
    per_doc = staged(per_doc.withColumn("n_hit", union), "contamination")
    # Documents hit by the same sets of items have the same list of items: it is made once for all of them. Most
    # documents are hit by none, and stay out of the join.
    some = F.size("set_ids") > 0
    combos = per_doc.filter(some).select("set_ids").distinct()
    listed = combos.select("set_ids", F.explode("set_ids").alias("set_id")).join(sets, "set_id")
    listed = listed.groupBy("set_ids").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"))
    listed = listed.select(
        "set_ids", F.size("_items").cast("bigint").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256")
    )
    listed = broadcast_if_few_bytes(staged(listed, "listed"), 8 * F.size("set_ids") + 120)
    told = per_doc.filter(some).join(listed, "set_ids").unionByName(per_doc.filter(~some), allowMissingColumns=True)
    done = told.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return done.select(
        F.col("_id").alias(doc_id),
        F.col("n_words").cast("bigint").alias("n_words"),
        "n_hit",
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "hits",
        "text_hash",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no window of any item, unchanged."""
    dirty = contamination(docs, benchmark, doc_id, text).filter("contaminated").select(F.col(doc_id).alias("_id"), F.col("text_hash").alias("_hash"))
    dirty = dirty.distinct()
    return docs.join(dirty, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_hash")), "left_anti")
