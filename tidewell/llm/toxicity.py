"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score over words and word
beginnings; the document's score is the noisy-or of its sentences. Weights are trained
from document labels alone, and afterwards the scores of the sentences say where the offence is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_rows, map_texts

SAMPLE_PER_CLASS = 3000  # labelled documents that the model is fitted on, about
FEATURES = 3000
MIN_DOCUMENTS = 4  # of the sample that a feature must be in
PREFIXES = (4, 5)
START_BIAS = -6.0
STEPS, RATE, SHRINK = 250, 0.08, 2e-3

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")


def lowered(text: str) -> str:
    """Lower case of the same length, so that places in it are places in the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def features(sentence: str) -> list[str]:
    """The words of a lower-case sentence and, marked by a star, their beginnings."""
    found = WORD.findall(sentence)
    return found + [w[:n] + "*" for n in PREFIXES for w in found if len(w) >= n]


class Model(NamedTuple):
    bias: float
    words: dict[str, float]  # weight of a word together with its beginnings, as far as known alone
    starts: tuple[dict[str, float], ...]  # weights of beginnings, by length


def _evidence(counts: pd.DataFrame, toxic: int, clean: int) -> np.ndarray:
    """The likelihood-ratio statistic of each feature against the label."""
    a, b = counts["toxic"].to_numpy(float), counts["clean"].to_numpy(float)
    out = np.zeros(len(a))
    for seen, whole in ((a, toxic), (b, clean)):
        expected = (a + b) * whole / (toxic + clean)
        for x, e in ((seen, expected), (whole - seen, whole - expected)):
            out += 2 * np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)), 0)
    return out


def _learn(bags: list[tuple[int, np.ndarray, np.ndarray]], start: np.ndarray) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the noisy-or loss. A bag: label, features end to end, features of each sentence."""
    y = np.array([b[0] for b in bags])
    at = np.concatenate([b[1] for b in bags])
    sizes = np.concatenate([b[2] for b in bags])
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    bag = np.repeat(np.arange(len(bags)), [len(b[2]) for b in bags])
    w = np.append(start, START_BIAS)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, weights=w[at], minlength=len(sizes)) + w[-1]
        clean = -np.logaddexp(0, z)  # log of 1 - p
        none = np.bincount(bag, weights=clean, minlength=len(bags))
        # Slope of the loss by a sentence's score: p for clean bags, -p (1 - P) / P for toxic ones.
        odds = np.exp(none) / np.maximum(-np.expm1(none), 1e-12)
        slope = np.where(y[bag] == 1, -odds[bag], 1.0) / (1 + np.exp(-z))
        grad = np.append(np.bincount(at, weights=slope[sentence], minlength=len(start)), slope.sum()) / len(bags)
        grad[:-1] += SHRINK * w[:-1] / len(start)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w = w - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return float(w[-1]), w[:-1]


def fit(labelled: DataFrame, sample: int = SAMPLE_PER_CLASS) -> Model:
    """A model from ``text`` and ``label`` (1: toxic, 0: not).

    About ``sample`` documents of each class are taken by a hash of their text. Their features are
    counted on the executors; the driver gets the ``FEATURES`` most telling ones, and of the sample only
    the numbers of those features, sentence by sentence. Without documents of both classes nothing is toxic.
    """
    chosen = labelled_rows(labelled, sample).persist()
    try:

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                seen = (Counter(), Counter())
                for text, toxic in zip(batch["text"], batch["label"], strict=True):
                    seen[toxic].update(set(features(lowered(text))) | {""})
                keys = list(seen[0] | seen[1])
                yield pd.DataFrame({"feature": keys, "toxic": [seen[1][k] for k in keys], "clean": [seen[0][k] for k in keys]})

        counted = chosen.mapInPandas(count, "feature string, toxic bigint, clean bigint").groupBy("feature")
        counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).persist()
        total = counted.filter("feature = ''").first()  # the empty feature is in every document
        if total is None or not total["toxic"] or not total["clean"]:
            return Model(-40.0, {}, tuple({} for _ in PREFIXES))
        n_toxic, n_clean = total["toxic"], total["clean"]
        # Features that speak for toxicity, by the gap of their shares; a bounded number of candidates reaches the driver.
        gap = F.col("toxic") / n_toxic - F.col("clean") / n_clean
        told = counted.filter((F.col("feature") != "") & (F.col("toxic") + F.col("clean") >= MIN_DOCUMENTS))
        table = told.orderBy(F.desc(F.abs(gap)), "feature").limit(4 * FEATURES).toPandas()
        counted.unpersist()
        table = table.assign(evidence=_evidence(table, n_toxic, n_clean)).sort_values(["evidence", "feature"], ascending=[False, True]).head(FEATURES)
        names = table["feature"].tolist()
        number = {f: i for i, f in enumerate(names)}
        odds = np.log((table["toxic"].to_numpy(float) + 0.5) / (n_toxic + 1)) - np.log((table["clean"].to_numpy(float) + 0.5) / (n_clean + 1))

        def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for text, toxic in zip(batch["text"], batch["label"], strict=True):
                    lists = [[number[f] for f in features(s) if f in number] for s in SENTENCE.findall(lowered(text))]
                    flat = np.array([i for one in lists for i in one], dtype=np.int32)
                    out.append((toxic, flat.tobytes(), np.array([len(one) for one in lists], dtype=np.int32).tobytes()))
                yield pd.DataFrame(out, columns=["toxic", "at", "sizes"])

        sampled = chosen.mapInPandas(bags, "toxic int, at binary, sizes binary").collect()
    finally:
        chosen.unpersist()
    read = [(r["toxic"], np.frombuffer(r["at"], dtype=np.int32), np.frombuffer(r["sizes"], dtype=np.int32)) for r in sampled]
    bias, weights = _learn(read, np.clip(odds, -1, 1) * 0.5)
    words = {f: float(w) for f, w in zip(names, weights, strict=True) if not f.endswith("*")}
    starts = tuple({f[:-1]: float(w) for f, w in zip(names, weights, strict=True) if f.endswith("*") and len(f) == n + 1} for n in PREFIXES)
    return Model(bias, words, starts)


def _sentences(text: str, model: Model, known: dict[str, float]) -> list[tuple[int, int, float]]:
    """Start, end and score of every sentence. ``known`` remembers the weights of words with their beginnings."""
    out = []
    for m in SENTENCE.finditer(lowered(text)):
        z = model.bias
        for word in WORD.findall(m[0]):
            weight = known.get(word)
            if weight is None:
                weight = model.words.get(word, 0.0) + sum(s.get(word[:n], 0.0) for n, s in zip(PREFIXES, model.starts, strict=True) if len(word) >= n)
                if len(known) < 200_000:
                    known[word] = weight
            z += weight
        out.append((m.start(), m.end(), 1 / (1 + np.exp(-z)) if z > -30 else 0.0))
    return out


def score_documents(docs: DataFrame, model: Model, show: float = 0.5) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``score`` and the sentences of at least ``show`` as ``offences``.

    The whole text decides and nothing else. Null or empty texts have no sentence and score 0; repeated
    rows get the same score; other columns are ignored; no rows give no rows.
    """

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    known: dict[str, float] = {}

    def score(texts: list[str]) -> tuple[dict, None]:
        told = [_sentences(text, model, known) for text in texts]
        scores = [float(1 - np.prod([1 - p for _, _, p in t])) if t else 0.0 for t in told]
        offences = [[{"start": a, "end": b, "score": float(p)} for a, b, p in t if p >= show] for t in told]
        return {"score": pa.array(scores, pa.float64()), "offences": pa.array(offences, kind)}, None

    made = "score double, offences array<struct<start:bigint,end:bigint,score:double>>"
    return map_texts(docs, "text", [F.col("doc_id").cast("bigint").alias("doc_id")], made, score)
