"""Sorted runs of equally long strings: front coding, and merging word by word behind the prefix that is known to be equal."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

WORD = 8  # bytes that are compared at a time
AT_ONCE = 1 << 16  # rows that are coded at a time


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """For sorted rows of bytes (n x length), how many first bytes each shares with the row before; 0 for the first."""
    n, length = rows.shape
    out = np.zeros(n, np.uint8)
    if n > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return out


def front_coded(rows: np.ndarray, prefixes: np.ndarray) -> bytes:
    """What each row adds to the prefix it shares with the row before, one after the other."""
    column = np.arange(rows.shape[1])[None, :]
    return b"".join(rows[a : a + AT_ONCE][column >= prefixes[a : a + AT_ONCE, None]].tobytes() for a in range(0, len(rows), AT_ONCE))


def decoded_rows(prefixes: np.ndarray, tails: np.ndarray, length: int) -> np.ndarray:
    """The rows of front-coded runs again; the runs stand one after the other, each begins with a prefix of 0."""
    if not len(prefixes):
        return np.zeros((0, length), np.uint8)
    known = prefixes.astype(np.int64)
    added = length - known
    # A row's own bytes lie where its prefix would end if it stood there; the prefix itself is that of a row before.
    rows = sliding_window_view(tails, length)[np.cumsum(added) - length]
    open_ = np.flatnonzero(known)
    column = 0
    while len(open_):
        new = np.concatenate([[True], open_[1:] != open_[:-1] + 1])
        rows[open_, column] = rows[np.maximum.accumulate(np.where(new, open_ - 1, 0)), column]
        column += 1
        open_ = open_[known[open_] > column]
    return rows


def front_decoded(prefixes: Sequence[int], tails: bytes, length: int) -> list[bytes]:
    """The rows again as strings, one after the other."""
    whole = decoded_rows(np.array(prefixes, np.uint8), np.frombuffer(tails, np.uint8), length).tobytes()
    return [whole[at : at + length] for at in range(0, len(whole), length)]


def merge_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows of sorted runs that stand one after the other, and how many bytes each shares with the one before in it.

    The first words of the runs are merged by a stable sort, which takes the runs as it finds them. Neighbours that are equal
    so far form stretches; only those in which the next word falls are put in order by it. No word before is looked at again,
    nor any behind the one that tells neighbours apart.
    """
    n, length = rows.shape
    shared = np.full(n, length, np.int64)
    shared[:1] = 0
    if n < 2:
        return np.arange(n), shared
    words = []
    for at in range(0, length, WORD):
        part = np.zeros((n, WORD), np.uint8)
        part[:, : min(WORD, length - at)] = rows[:, at : at + WORD]
        words.append(part.view(">u8").ravel().astype(np.uint64))
    order = np.argsort(words[0], kind="stable")
    tied = np.ones(n - 1, bool)
    for number, values in enumerate(words):
        word = values[order]
        falls = tied & (word[1:] < word[:-1])
        if falls.any():
            stretch = np.concatenate([[0], np.cumsum(~tied)])
            wrong = np.zeros(stretch[-1] + 1, bool)
            wrong[stretch[1:][falls]] = True
            at = np.flatnonzero(wrong[stretch])
            by = np.argsort(word[at], kind="stable")
            by = at[by[np.argsort(stretch[at][by], kind="stable")]]
            order[at], word[at] = order[by], word[by]
        differ = np.flatnonzero(tied & (word[1:] != word[:-1]))
        apart = word[differ + 1] ^ word[differ]
        shared[differ + 1] = WORD * number + sum((apart < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, WORD))
        tied[differ] = False
        if not tied.any():
            break
    return order, shared


def merge_runs(runs: Sequence[tuple[Sequence[bytes] | np.ndarray, Sequence[int] | np.ndarray]], length: int) -> tuple[list[int], list[int]]:
    """All strings of sorted runs in order: the run of each, and how many bytes it shares with the string before.

    A run is its strings, or the rows of their bytes, and how many bytes each shares with the one before.
    """
    rows = [s if isinstance(s, np.ndarray) else np.frombuffer(b"".join(s), np.uint8).reshape(-1, length) for s, _ in runs]
    order, shared = merge_rows(np.concatenate([np.zeros((0, length), np.uint8), *rows]))
    which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return which[order].tolist(), shared.tolist()
