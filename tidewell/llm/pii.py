"""Personal data, and the terms that reveal it.

Base kinds are found by pattern and checked. Every found value is a protected entity. A term
reveals an entity as far as it occurs only with it: of their pointwise mutual information,
log p(entity | term) / p(entity), counts which share of the entity's own information,
-log p(entity), it makes up. Counts are of documents, over all of them. As few surroundings say little,
p(entity | term) is drawn towards p(entity) by a prior: of ``NEAR_PRIOR`` surroundings for terms near the
entity, of ``FAR_PRIOR`` for those anywhere in its documents, which must also mean the entity more often than not.
Terms above the disclosure threshold are generalised, terms that give the entity away outright are removed,
wherever they occur.

Everything is expressions, joins and aggregates. Texts stay where they are, except those with an entity, and where a
document has a revealing term and such documents are too many to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import BROADCAST_ROWS, LOWER, UPPER, broadcast_if_small, words

REACH = 8  # words before and after an entity that count as near it
NEAR_PRIOR, FAR_PRIOR = 1.0, 2.0  # surroundings that the prior weighs
GENERALISE, REMOVE = 0.85, 0.98  # shares of an entity's information
TERM_KIND = 4
NAMES = ["email", "ip", "card", "phone", "term"]

_WORD_CHAR = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
SPANS = "array<struct<start:int,kind:int,end:int,tag:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    backwards = F.split(F.reverse(_digits(match)), "")
    backwards = F.filter(backwards, lambda d: d != "")

    def add(total: Column, x: Column) -> Column:
        return total + x

    doubled = F.transform(
        backwards,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    total = F.aggregate(doubled, F.lit(0), add)
    return F.length(_digits(match)).between(14, 19) & (total % 10 == 0)


class Kind(NamedTuple):
    pattern: str
    may_occur: Callable[[Column], Column]  # cheap, true for every text with a match
    valid: Callable[[Column], Column]


# The patterns are the contract's, in a form that does not back up: a run of characters is entered only at
# its start, or where the last match ended, as a match from its middle would also start there.
KINDS = [
    Kind(
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: t.contains("@"),
        lambda m: F.lit(True),
    ),
    Kind(
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        lambda m: m.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"),
    ),
    Kind(r"[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), _luhn),
    Kind(r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+"), lambda m: F.length(_digits(m)).between(10, 15)),
]


def matches(text: Column, pattern: Column) -> Column:
    """All matches as (start, end, match), in code points: what lies between them gives their places."""
    hits, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("match")))).alias("out"))

    pairs = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    return F.when(F.size(hits) > 0, F.aggregate(pairs, state, step, lambda a: a["out"])).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _valid_spans(text: Column, number: int, kind: Kind) -> Column:
    valid = F.filter(matches(text, F.lit(kind.pattern)), lambda m: kind.valid(m["match"]))
    rows = F.transform(valid, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), m["match"].alias("match")))
    return F.when(kind.may_occur(text), rows).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>"))


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds as (start, kind, end, match), sorted."""
    return F.array_sort(F.concat(*[_valid_spans(text, k, kind) for k, kind in enumerate(KINDS)]))


def _merged(spans: Column) -> Column:
    """The parts of a text that sorted spans cover, as disjoint (start, end)."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(out: Column, s: Column) -> Column:
        last = F.element_at(out, -1)
        one = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        joined = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(F.size(out) == 0, one).when(s["start"] >= last["end"], F.concat(out, one)).otherwise(F.concat(F.slice(out, 1, F.size(out) - 1), joined))

    return F.aggregate(spans, none, step)


def _between(text: Column, parts: Column) -> Column:
    """What lies before, between and after disjoint parts of a text; one more than there are parts."""
    starts = F.concat(F.array(F.lit(0)), F.transform(parts, lambda p: p["end"]))
    ends = F.concat(F.transform(parts, lambda p: p["start"]), F.array(F.length(text)))
    return F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.substr(text, x["a"] + 1, x["b"] - x["a"]))


def _with_base(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents with their base spans, and their words outside of these, part by part."""
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    found = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"), *kept).withColumn("base", base_spans(F.col("_text")))
    parts = F.when(F.size("base") == 0, F.array("_text")).otherwise(_between(F.col("_text"), _merged(F.col("base"))))
    return found.withColumn("parts", parts)


def _outside(parts: Column) -> Column:
    return words(F.array_join(parts, "\n"))


def _mentions(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts with an entity (``text``: a hash, ``words``, ``n`` copies), and their entities with the words near them and a hash of these."""
    found = _with_base(docs).filter(F.size("base") > 0)
    once = found.groupBy(F.xxhash64("_text").alias("text")).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("_text", "base", "parts")])
    texts = once.withColumns({"cover": _merged(F.col("base")), "words": F.transform("parts", words)})
    near = F.transform(
        "cover",
        lambda c, i: F.struct(
            F.xxhash64(F.lower(F.substr(F.col("_text"), c["start"] + 1, c["end"] - c["start"]))).alias("entity"),
            F.concat(
                F.slice(F.col("words")[i], F.greatest(F.size(F.col("words")[i]) - REACH + 1, F.lit(1)), REACH),
                F.slice(F.col("words")[i + 1], 1, REACH),
            ).alias("near"),
        ),
    )
    texts = staged(texts.select("text", "n", F.array_distinct(F.flatten("words")).alias("said"), near.alias("near")), "mentions")
    said = texts.select("text", "n", F.explode("near").alias("x")).groupBy("text", "n", "x.entity")
    said = said.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("x.near")))).alias("near"))
    return texts.select("text", F.col("said").alias("words")), staged(said.withColumn("context", F.xxhash64("near")), "entities")


def _pairs(rows: DataFrame, prior: float) -> DataFrame:
    """Per entity and term of ``rows`` the documents with both and their different surroundings."""
    found = rows.groupBy("entity", "term", "context").agg(F.sum("n").alias("n")).groupBy("entity", "term")
    return found.agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts")).withColumn("prior", F.lit(prior))


def revealing_terms(docs: DataFrame) -> DataFrame:
    """``term`` and ``strength``, the greatest share of some entity's information that it reveals, from ``GENERALISE`` on."""
    texts, said = _mentions(docs)
    total = said.agg(F.sum("n")).first()[0]
    if not total:
        return docs.sparkSession.createDataFrame([], "term string, strength double")
    entities = said.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.countDistinct("context").alias("_contexts"))
    entities = staged(entities.withColumn("own", F.log2(F.lit(float(total)) / F.col("n_entity"))).filter("own > 0"), "own")
    near = _pairs(said.select("entity", "context", "n", F.explode("near").alias("term")), NEAR_PRIOR)
    # One surrounding never outweighs the prior of two, so such entities have no terms far from them.
    told = said.join(broadcast_if_small(entities.filter("_contexts > 1").select("entity")), "entity", "left_semi").select("text", "entity", "context", "n")
    far = _pairs(texts.join(broadcast_if_small(told), "text").select("entity", "context", "n", F.explode("words").alias("term")), FAR_PRIOR)
    # The share of a term's documents that name the entity is at most 1; pairs that would not do with that are left out.
    known = near.unionByName(far.filter("contexts > 1")).join(broadcast_if_small(entities.select("entity", "n_entity", "own")), "entity")
    base = F.col("n_entity") / F.lit(float(total))

    def smoothed(share: Column) -> Column:
        return (F.col("contexts") * share + F.col("prior") * base) / (F.col("contexts") + F.col("prior"))

    def strength(chance: Column) -> Column:
        return 1 + F.log2(chance) / F.col("own")

    pairs = staged(known.filter(strength(smoothed(F.lit(1.0))) >= GENERALISE), "pairs")
    candidates = pairs.select("term").distinct()
    everywhere = _with_base(docs).select(F.explode(F.array_distinct(_outside(F.col("parts")))).alias("term"))
    few = candidates.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    often = (everywhere.join(F.broadcast(candidates), "term") if few else everywhere).groupBy("term").agg(F.count("*").alias("n_term"))
    share = F.col("n_both") / F.col("n_term")
    sure = (strength(smoothed(share)) >= GENERALISE) & ((F.col("prior") == NEAR_PRIOR) | (smoothed(share) >= 0.5))
    shown = pairs.join(often, "term").filter(sure).select("term", strength(share).alias("strength"))
    return shown.groupBy("term").agg(F.max("strength").alias("strength"))


def _tagged(base: Column) -> Column:
    tags = F.array(*[F.lit(f"[{name.upper()}]") for name in NAMES])
    return F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.get(tags, s["kind"]).alias("tag")))


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Where the terms (term, tag) stand in a text, outside of its base spans."""
    any_term = F.concat(F.lit(f"(?<!{_WORD_CHAR})(?:"), F.array_join(F.transform(terms, lambda t: t["term"]), "|"), F.lit(f")(?!{_WORD_CHAR})"))
    tags = F.map_from_entries(terms)
    hits = matches(F.translate(text, UPPER, LOWER), any_term)
    free = F.filter(hits, lambda h: ~F.exists(base, lambda b: (b["start"] < h["end"]) & (h["start"] < b["end"])))
    return F.transform(free, lambda h: F.struct(h["start"].alias("start"), F.lit(TERM_KIND).alias("kind"), h["end"].alias("end"), F.element_at(tags, h["match"]).alias("tag")))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its tag; spans that overlap share the first one's."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        added = F.when(s["start"] >= a["at"], F.array(F.substr(text, a["at"] + 1, s["start"] - a["at"]), s["tag"])).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], added).alias("out"))

    done = F.aggregate(spans, state, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def find_personal_data(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``text``, ``base`` spans, all ``spans`` and the ``clean`` text.

    With ``keep``, these columns come along. Spans are (start, kind, end, tag), sorted, in code points; kinds are numbered as in ``NAMES``. A null text counts
    as empty; repeated rows get the same spans; null ids and other columns do not
    matter; no rows give no rows. Terms are words, A-Z lower-cased, and never part of a base span.
    """
    terms = staged(revealing_terms(docs), "terms")
    tags = terms.select("term", F.when(F.col("strength") >= REMOVE, "").otherwise("[TERM]").alias("tag"))
    found = _with_base(docs, keep).withColumn("_hash", F.xxhash64("_text"))
    none = F.array().cast("array<struct<term:string,tag:string>>")
    if terms.limit(1).count():
        said = found.select("_hash", F.explode(F.array_distinct(_outside(F.col("parts")))).alias("term"))
        mine = said.join(broadcast_if_small(tags), "term").groupBy("_hash").agg(F.array_sort(F.collect_set(F.struct("term", "tag"))).alias("terms"))
        found = found.join(broadcast_if_small(staged(mine, "revealed"), 50_000), "_hash", "left").withColumn("terms", F.coalesce("terms", none))
    else:
        found = found.withColumn("terms", none)
    base = found.withColumn("base", _tagged(F.col("base")))
    extra = F.when(F.size("terms") > 0, _term_spans(F.col("_text"), F.col("terms"), F.col("base"))).otherwise(F.array().cast(SPANS))
    spans = base.withColumn("spans", F.array_sort(F.concat("base", extra)))
    clean = sanitised(F.col("_text"), F.col("spans")).alias("clean")
    return spans.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), "base", "spans", clean, *[F.col(f"_keep_{c}").alias(c) for c in keep])


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
