"""Hashed word shingles of many texts at once, from their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5  # words
CHUNK_BYTES = 1_500_000  # of text that is hashed at a time
CHUNK_TEXTS = 60_000  # fewer than 2**16, as the number of a text is packed above 48 bits of hash

_RANDOM = np.random.default_rng(20_240_607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
# Words as everywhere in this subpackage: separators are the ASCII characters that are no digits or letters.
_IS_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
for _upper in range(65, 91):
    _BYTE[_upper] = _BYTE[_upper + 32]
_PLACE = _RANDOM.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * (out[done - 1 : done] * _STEP)
        done += more
    return out


class Shingles(NamedTuple):
    """Distinct shingles of some texts, sorted by text and hash."""

    text: np.ndarray  # number of the text
    hash: np.ndarray
    times: np.ndarray  # how often the text has it
    texts: int

    def key(self) -> np.ndarray:
        return (self.text.astype(np.uint64) << np.uint64(48)) | (self.hash >> np.uint64(16))


def shingles(texts: pa.Array) -> Shingles:
    """A text of one to four words has one shingle of them all; a null text, or one without words, none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    if not n or bounds[-1] == bounds[0]:
        return Shingles(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), n)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    opens = np.zeros(len(data) + 1, dtype=bool)
    opens[bounds[:-1]] = True
    at = np.flatnonzero(_IS_WORD[data])
    first = np.flatnonzero((np.diff(at, prepend=-2) != 1) | opens[at])
    if not len(first):
        return Shingles(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), n)
    sizes = np.diff(first, append=len(at))
    inside = np.arange(len(at)) - np.repeat(first, sizes)
    word = mix(np.add.reduceat(_BYTE[data[at]] * _powers(int(sizes.max()))[inside], first))
    owner = np.searchsorted(bounds, at[first], side="right") - 1
    counts = np.bincount(owner, minlength=n)
    run = np.flatnonzero(owner[: -(SHINGLE - 1)] == owner[SHINGLE - 1 :]) if len(owner) >= SHINGLE else np.zeros(0, int)
    total = np.zeros(len(run), dtype=np.uint64)
    for d in range(SHINGLE):
        total += word[run + d] * _PLACE[d]
    text, hashes = owner[run], mix(total)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        begin = (np.cumsum(counts) - counts)[short]
        total = counts[short].astype(np.uint64) * _PLACE[SHINGLE]
        for d in range(SHINGLE - 1):
            has = counts[short] > d
            total[has] += word[begin[has] + d] * _PLACE[d]
        text, hashes = np.concatenate([text, short]), np.concatenate([hashes, mix(total)])
    order = np.argsort((text.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)), kind="stable")
    text, hashes = text[order], hashes[order]
    new = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(hashes, prepend=0) != 0) | (np.arange(len(text)) == 0))
    return Shingles(text[new], hashes[new], np.diff(new, append=len(text)), n)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive pieces of an array, of about ``limit`` bytes; each with its first place."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        done = sizes[first - 1] if first else 0
        last = int(np.searchsorted(sizes, done + limit)) + 1
        last = min(max(last, first + 1), first + CHUNK_TEXTS, len(texts))
        yield first, texts.slice(first, last - first)
        first = last
