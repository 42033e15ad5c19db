"""Quality rules with line labels from a linear-chain conditional random field.

Counting rules reject texts that are too short or repeat themselves. For the others every line is
described by a few shares, a conditional random field scores content against boilerplate line by line and
from line to line, Viterbi decoding labels them, and a text is kept if content makes up enough of it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_rows, map_texts
from .viterbi import decode

MIN_WORDS = 50
REPEATED_PERCENT = 50
CONTENT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"  # fixed by the task
SPACES = "\t\n\x0b\x0c\r "  # between words, fixed by the task

SAMPLE_PER_CLASS = 1500  # labelled documents that the model is fitted on, about; all lines of each
STEPS, RATE, SHRINK = 300, 0.1, 1e-3
CHUNK_CHARS = 2_000_000
PLANES = 0x30000

FEATURES = ["bias", "log_words", "word_length", "symbols", "capitals", "digits", "letters", "repeats", "closed", "seen"]


@functools.lru_cache(maxsize=1)
def _tables() -> dict[str, np.ndarray]:
    chars = [chr(i) for i in range(PLANES)]
    out = {
        "upper": np.array([c.isupper() for c in chars] + [False]),
        "letter": np.array([c.isalpha() for c in chars] + [False]),
        "digit": np.array([c.isdigit() for c in chars] + [False]),
    }
    for name, some in (("space", SPACES), ("symbol", SYMBOLS), ("close", ".!?:;")):
        out[name] = np.zeros(PLANES + 1, dtype=bool)
        out[name][[ord(c) for c in some]] = True
    return out


class Described(NamedTuple):
    base: pd.DataFrame  # n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text
    lines: np.ndarray  # lines with a word x FEATURES
    chars: np.ndarray  # of those lines, in words
    owner: np.ndarray  # the text of those lines


def _repeated(text: np.ndarray, word: np.ndarray, texts: int) -> np.ndarray:
    """Per text, the words in runs of three that it has twice or more. Words are numbered within their text."""
    hit = np.zeros(len(word), dtype=bool)
    run = np.flatnonzero(text[:-2] == text[2:]) if len(word) > 2 else np.zeros(0, dtype=np.int64)
    if len(run):
        kinds = int(word.max()) + 1
        _, pair = np.unique((text[run] * kinds + word[run]) * kinds + word[run + 1], return_inverse=True)
        _, triple, times = np.unique(pair.astype(np.int64) * kinds + word[run + 2], return_inverse=True, return_counts=True)
        again = run[times[triple] > 1]
        for d in range(3):
            hit[again + d] = True
    return np.bincount(text[hit], minlength=texts)


def describe(texts: list[str]) -> Described:
    t, n = _tables(), len(texts)
    numbers: list[int] = []
    for text in texts:
        known: dict[bytes, int] = {}
        numbers += [known.setdefault(w, len(known)) for w in text.encode("utf-8", "surrogatepass").split()]
    word = np.array(numbers, dtype=np.int64)
    points = np.minimum(np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32), PLANES)
    ends = np.cumsum(np.array([len(x) + 1 for x in texts], dtype=np.int64))
    starts = np.concatenate([[0], ends[:-1]])
    inked = ~t["space"][points]
    first = np.flatnonzero(inked & ~np.concatenate([[False], inked[:-1]]))
    owner = np.searchsorted(ends, first, side="right")
    line_start = np.concatenate([[0], np.flatnonzero(points == 10)[:-1] + 1])
    line_of_word = np.searchsorted(line_start, first, side="right") - 1

    def per_line(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, line_start, dtype=np.int64)

    count = np.bincount(line_of_word, minlength=len(line_start))
    ink = per_line(inked)
    letters, upper, digits = (per_line(t[k][points]) for k in ("letter", "upper", "digit"))
    closing = per_line(t["close"][points])
    line_owner = np.searchsorted(ends, line_start, side="right")
    seen = np.zeros(len(line_start), dtype=bool)
    dup = np.zeros(n, dtype=np.int64)
    at = 0
    for i, text in enumerate(texts):
        earlier: set[str] = set()
        for line in text.split("\n"):
            if count[at]:
                if line in earlier:
                    seen[at] = True
                    dup[i] += 1
                earlier.add(line)
            at += 1
    kinds = int(word.max(initial=0)) + 1
    distinct = np.bincount(np.unique(line_of_word * kinds + word) // kinds, minlength=len(line_start))
    base = pd.DataFrame(
        {
            "n_words": np.bincount(owner, minlength=n),
            "word_chars": np.add.reduceat(inked, starts, dtype=np.int64) if n else [],
            "n_symbols": np.add.reduceat(t["symbol"][points], starts, dtype=np.int64) if n else [],
            "n_dup_lines": dup,
            "n_repeat_words": _repeated(owner, word, n),
        }
    ).astype("int64")
    # The last character of a line that is no space.
    last = np.full(len(line_start), False)
    dark = np.flatnonzero(inked)
    if len(dark):
        line_of_ink = np.searchsorted(line_start, dark, side="right") - 1
        final = dark[np.flatnonzero(np.diff(line_of_ink, append=len(line_start)) != 0)]
        last[np.searchsorted(line_start, final, side="right") - 1] = t["close"][points[final]]
    use = np.flatnonzero(count)
    c, w = np.maximum(ink[use], 1), np.maximum(count[use], 1)
    features = np.stack(
        [
            np.ones(len(use)), np.log1p(w) / 3, np.minimum(c / w, 30) / 8, (ink[use] - letters[use] - digits[use] - closing[use]) / c,
            upper[use] / np.maximum(letters[use], 1), digits[use] / c, letters[use] / c, 1 - distinct[use] / w, last[use], seen[use],
        ],
        axis=1,
    ).astype(np.float64)
    return Described(base, features, ink[use], line_owner[use])


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


class Model(NamedTuple):
    weights: np.ndarray  # FEATURES x (boilerplate, content)
    moves: np.ndarray  # from label to label


# Without labels of both kinds every line is content.
PLAIN = Model(np.stack([np.zeros(len(FEATURES)), np.eye(len(FEATURES))[0]], axis=1), np.zeros((2, 2)))


def train(sequences: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Maximum likelihood, by forward and backward sums over all sequences (lines x features, labels) at once.

    Lines are laid out by their place in the sequence, the longest sequences first, so nothing is padded: step t takes the
    t-th line of all sequences that have one. Sums are scaled to 1 line by line.
    """
    sequences = sorted(sequences, key=lambda s: -len(s[1]))
    sizes = np.array([len(labels) for _, labels in sequences])
    rank = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(rank)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((rank, place))
    x, y = (np.concatenate([s[i] for s in sequences])[order] for i in (0, 1))
    ends = np.cumsum(np.bincount(place))
    begins = ends - np.bincount(place)
    later = np.arange(ends[0], len(order))  # lines that have one before them
    before = begins[place[order][later] - 1] + rank[order][later]
    told = np.eye(2)[y]
    seen_moves = told[before].T @ told[later]
    params = [np.zeros((len(FEATURES), 2)), np.zeros((2, 2))]
    mean, square = [0 * p for p in params], [0 * p for p in params]
    for step in range(1, STEPS + 1):
        w, m = params
        s = x @ w
        e, moves = np.exp(s - s.max(axis=1, keepdims=True)), np.exp(m)
        alpha, beta, scale = e.copy(), np.ones_like(e), np.empty((len(e), 1))
        for k, (first, last) in enumerate(zip(begins, ends, strict=True)):
            here = alpha[first:last]
            if k:
                here *= alpha[begins[k - 1] : begins[k - 1] + last - first] @ moves
            scale[first:last] = here[:, :1] + here[:, 1:]
            here /= scale[first:last]
        for k in range(len(ends) - 1, 0, -1):
            first, last = begins[k], ends[k]
            beta[first:last] *= e[first:last] / scale[first:last]  # with its line, as those before need it
            beta[begins[k - 1] : begins[k - 1] + last - first] = beta[first:last] @ moves.T
        moved = moves * (alpha[before].T @ beta[later])
        beta[later] *= scale[later] / np.maximum(e[later], 1e-300)
        grads = [
            x.T @ (alpha * beta - told) / len(x) + SHRINK * w,
            (moved - seen_moves) / max(len(later), 1) + SHRINK * m,
        ]
        for p, g in enumerate(grads):
            mean[p] = 0.9 * mean[p] + 0.1 * g
            square[p] = 0.99 * square[p] + 0.01 * g**2
            params[p] = params[p] - RATE * (mean[p] / (1 - 0.9**step)) / (np.sqrt(square[p] / (1 - 0.99**step)) + 1e-8)
    return Model(*params)


def fit(labelled: DataFrame, sample: int = SAMPLE_PER_CLASS) -> Model:
    """A model from ``text`` and ``label`` (1: good, 0: poor), fitted on about ``sample`` texts of each label.

    The label of a text is taken for those of its lines. So that the chain learns to change, half of
    the poor texts are spliced into good ones.
    """

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found = describe([text]).lines
                if len(found):
                    out.append((int(label), found.astype("<f8").tobytes()))
            yield pd.DataFrame(out, columns=["label", "lines"])

    rows = labelled_rows(labelled, sample).mapInPandas(lines, "label int, lines binary").collect()
    read = sorted((r["label"], bytes(r["lines"])) for r in rows)
    groups = [[np.frombuffer(b, dtype="<f8").reshape(-1, len(FEATURES)) for label, b in read if label == k] for k in (0, 1)]
    if not groups[0] or not groups[1]:
        return PLAIN
    sequences = [(x, np.full(len(x), k)) for k in (0, 1) for x in groups[k]]
    for i, poor in enumerate(groups[0][::2]):
        good = groups[1][i % len(groups[1])]
        cut = len(good) // 2
        sequences.append((np.concatenate([good[:cut], poor, good[cut:]]), np.concatenate([np.ones(cut, int), np.zeros(len(poor), int), np.ones(len(good) - cut, int)])))
    return train(sequences)


def judge(docs: DataFrame, model: Model, content_share: float = CONTENT_SHARE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): the counts, ``base_failed``, ``content_share``, ``line_labels`` and ``kept``.

    ``line_labels`` has one character per line with a word, ``1`` for content. Null texts count as empty; a text without
    words has no lines and fails the base rules. Repeated rows get the same verdict; other columns are ignored.
    """

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(texts: list[str]) -> tuple[dict, None]:
        bases, shares, labels = [], [np.zeros(0)], []
        for some in _chunks(texts):
            d = describe(some)
            found = decode(d.lines @ model.weights, np.bincount(d.owner, minlength=len(some)), model.moves)
            good = np.bincount(d.owner, weights=d.chars * found, minlength=len(some))
            shares.append(good / np.maximum(np.bincount(d.owner, weights=d.chars, minlength=len(some)), 1))
            marks = (found + 48).astype(np.uint8).tobytes().decode()
            ends = np.cumsum(np.bincount(d.owner, minlength=len(some)))
            labels += [marks[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]
            bases.append(d.base)
        base = pd.concat(bases, ignore_index=True) if bases else pd.DataFrame(columns=counts, dtype="int64")
        share = np.concatenate(shares)
        failed = ((base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > REPEATED_PERCENT * base["n_words"])).to_numpy(bool)
        out = {c: pa.array(base[c].to_numpy("int64")) for c in counts}
        out |= {"base_failed": pa.array(failed), "content_share": pa.array(share), "line_labels": pa.array(labels, pa.string())}
        return out | {"kept": pa.array(~failed & (share >= content_share))}, None

    made = ", ".join(f"{c} bigint" for c in counts) + ", base_failed boolean, content_share double, line_labels string, kept boolean"
    return map_texts(docs, "text", [F.col("doc_id").cast("bigint").alias("doc_id")], made, run)
