"""Viterbi decoding of many sequences at once."""

from __future__ import annotations

import numpy as np


def decode(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best label of every item, for sequences laid end to end.

    ``scores`` (items x labels) are log scores, ``lengths`` the sequence lengths, which may be 0,
    and ``moves[a, b]`` the log score of going from label a to b. Sequences are ordered by length, so
    that step t treats the t-th item of all that have one. Ties go to the lower label.
    """
    items, labels = scores.shape
    kind = np.min_scalar_type(max(labels - 1, 0))
    out = np.zeros(items, dtype=kind)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not order.size:
        return out
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    steps = int(sizes[0])
    # How many sequences are longer than t.
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
    came = np.zeros((items, labels), dtype=kind)
    best = scores[starts].astype(np.float64)
    final = np.zeros(len(sizes), dtype=kind)
    for t in range(1, steps):
        n, m = int(active[t]), len(best)
        if n < m:
            final[n:m] = best[n:].argmax(axis=1)
            best = best[:n]
        ways = best[:, :, None] + moves
        at = starts[:n] + t
        back = ways.argmax(axis=1)
        came[at] = back
        best = np.take_along_axis(ways, back[:, None, :], axis=1)[:, 0, :] + scores[at]
    final[: len(best)] = best.argmax(axis=1)
    label = final
    for t in range(steps - 1, -1, -1):
        n = int(active[t])
        at = starts[:n] + t
        out[at] = label[:n]
        if t:
            label = np.concatenate([came[at, label[:n]], label[n:]])
    return out
