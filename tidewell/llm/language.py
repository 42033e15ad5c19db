"""Language identification of mixed text.

The script of a word narrows the languages it may be in; letter trigrams score it for each
of these; Viterbi over the words of a document, with a penalty for switching, labels
spans. The language with the most letters is the document's.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .viterbi import decode

SAMPLE_PER_LANGUAGE = 2000  # documents that the model is fitted on, about; everything else covers all rows
BUCKET_BITS = 16
SMOOTHING = 0.5
SWITCH_PENALTY = 12.0  # log score that a change of language costs
SCRIPT_SHARE = 0.01  # of a language's letters that a script needs to be one of the language's
CHUNK_CHARS = 1_000_000  # scored at a time
GROUP_CHARS = 5_000_000  # labelled at a time
UNKNOWN = "und"

# Code point ranges of scripts: fixed values of the character standard. Other scripts go by the first word of their letters' names.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF)],
}
PLANES = 0x30000  # code points beyond are no letters


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case, or 0 if it is no letter; and its script, 0 for letters without a name."""
    lower = np.zeros(PLANES + 1, dtype=np.uint32)
    for i in range(PLANES):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            lower[i] = ord(small) if len(small) == 1 else i
    script = np.zeros(PLANES + 1, dtype=np.int16)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = k
    numbers = {name.upper(): k for k, name in enumerate(SCRIPTS, 1)}
    for i in np.flatnonzero((lower > 0) & (script == 0)).tolist():
        name = unicodedata.name(chr(i), "")
        if name:
            script[i] = numbers.setdefault(name.split()[0], len(numbers) + 1)
    return lower, script


class Words(NamedTuple):
    """The words (runs of letters) of some texts laid end to end."""

    buckets: np.ndarray  # trigram bucket of every letter
    first: np.ndarray  # where the letters of each word begin
    letters: np.ndarray  # letters of each word
    script: np.ndarray  # script of each word's first letter
    text: np.ndarray  # which text a word is in
    start: np.ndarray  # where it starts in its text


def find_words(texts: list[str]) -> Words:
    lower, scripts = _tables()
    joined = "\n".join(texts) + "\n"
    points = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), PLANES)
    low = lower[points]
    small = np.concatenate([[0], low, [0]]).astype(np.uint64)
    at = np.flatnonzero(low)
    # The neighbours of a letter; anything that is none counts as an edge of the word.
    hashed = (small[at] * np.uint64(0x9E3779B1) + small[at + 1] * np.uint64(0x85EBCA6B) + small[at + 2] * np.uint64(0xC2B2AE35)) & np.uint64(0xFFFFFFFF)
    buckets = ((hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    where = at[begins]
    text = np.searchsorted(ends, where, side="right")
    return Words(
        buckets, begins, np.diff(begins, append=len(at)), scripts[points[where]], text, where - (ends - lengths)[text]
    )


class Model(NamedTuple):
    languages: list[str]
    table: np.ndarray  # bucket x language: log share of the trigrams
    allowed: np.ndarray  # script x language: 0, or minus infinity where the language does not use the script
    known: np.ndarray  # script: whether any language uses it


def _chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def fit(labelled: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from ``text`` and ``lang``.

    Every language contributes about ``sample`` documents, chosen by a hash of their text; their
    trigrams and scripts are counted on the executors, so the driver gets sums of a fixed size.
    """
    n_scripts = int(_tables()[1].max()) + 1
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    share: Column = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1_000_000)) < share * 1_000_000)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                for _, texts in _chunks(group["text"].tolist()):
                    w = find_words(texts)
                    grams = np.bincount(w.buckets, minlength=1 << BUCKET_BITS)
                    scripts = np.bincount(w.script, weights=w.letters, minlength=n_scripts).astype(np.int64)
                    for kind, counts in (("gram", grams), ("script", scripts)):
                        at = np.flatnonzero(counts)
                        yield pd.DataFrame({"lang": lang, "kind": kind, "at": at, "n": counts[at]})

    sums = chosen.mapInPandas(count, "lang string, kind string, at bigint, n bigint").groupBy("lang", "kind", "at").agg(F.sum("n").alias("n"))
    grams = np.zeros((1 << BUCKET_BITS, len(languages)))
    scripts = np.zeros((n_scripts, len(languages)))
    for r in sums.collect():
        (grams if r["kind"] == "gram" else scripts)[r["at"], languages.index(r["lang"])] = r["n"]
    seen = max(1, int((grams.sum(axis=1) > 0).sum()))
    table = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=0) + SMOOTHING * seen)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, table.astype(np.float32), np.where(allowed, 0.0, -1e6), allowed.any(axis=1))


def _labels(texts: list[str], model: Model, penalty: float) -> tuple[list, list, list]:
    """Language, score and spans of each text."""
    k = len(model.languages)
    parts: list[tuple[Words, np.ndarray, int]] = []
    for first, some in _chunks(texts):
        w = find_words(some)
        points = np.zeros((len(w.first), k), dtype=np.float32)
        if len(w.first):
            points = np.add.reduceat(model.table[w.buckets], w.first, axis=0)
            # No language uses the script: the word says nothing.
            points = np.where(model.known[w.script][:, None], points + model.allowed[w.script].astype(np.float32), np.float32(0))
        parts.append((w._replace(buckets=w.buckets[:0]), points, first))
    n = len(texts)
    text = np.concatenate([w.text + first for w, _, first in parts] or [np.zeros(0, int)]).astype(np.int64)
    points = np.concatenate([p for _, p, _ in parts] or [np.zeros((0, k))])
    letters, script, start = (np.concatenate([getattr(w, f) for w, _, _ in parts] or [np.zeros(0, int)]).astype(np.int64) for f in ("letters", "script", "start"))
    label = decode(points, np.bincount(text, minlength=n), -penalty * (1 - np.eye(k))).astype(np.int64)
    told = np.bincount(text * k + label, weights=letters * model.known[script], minlength=n * k).reshape(n, k)
    whole = np.bincount(text, weights=letters, minlength=n)
    best = told.argmax(axis=1)
    share = told[np.arange(n), best] / np.maximum(whole, 1)
    names = [model.languages[b] if w else UNKNOWN for b, w in zip(best, whole, strict=True)]
    cuts = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    spans: list[list] = [[] for _ in range(n)]
    for a, b in itertools.pairwise([*cuts, len(text)]):
        spans[text[a]].append((int(start[a]), int(start[b - 1] + letters[b - 1]), model.languages[label[a]]))
    return names, share.tolist(), spans


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``lang_pred``, ``score`` and ``spans`` (start, end, lang).

    With ``keep``, the text and these columns come along, as they are.

    The score is the share of all letters that the language got. Null texts and texts without a letter are
    ``und`` with score 0, as are all texts if no language was learned; letters in a script of no learned language count for
    none. Ties go to the first language by name. Only the text decides; other columns are ignored.
    """

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def label(texts: list[str]) -> tuple[dict, None]:
        names, score, spans = [], [], []
        for _, some in _chunks(texts, GROUP_CHARS):
            told = _labels(some, model, penalty) if model.languages else ([UNKNOWN] * len(some), [0.0] * len(some), [[]] * len(some))
            for all_, part in zip((names, score, spans), told, strict=True):
                all_.extend(part)
        spans = [[{"start": a, "end": b, "lang": lang} for a, b, lang in s] for s in spans]
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64()), "spans": pa.array(spans, kind)}, None

    carried = [F.col("doc_id").cast("bigint").alias("doc_id")] + ([] if keep is None else [F.col(c) for c in ("text", *keep)])
    made = "lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>"
    return map_texts(docs, "text", carried, made, label)
