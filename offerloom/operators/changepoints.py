"""Exact penalised changepoint search (PELT with squared-error cost) on one-dimensional series."""

from __future__ import annotations

import numpy as np


def segments(x: np.ndarray, penalty: float) -> list[int]:
    """Ends of the segments that minimise the squared error around each segment's mean plus penalty per change.

    Exact: candidates are pruned only where they can never be optimal again. No change is searched where the whole
    series' squared error is below one penalty, as no split could pay. An empty series has no segments.
    """
    n = len(x)
    if n == 0:
        return []
    s, q = np.concatenate(([0.0], np.cumsum(x))), np.concatenate(([0.0], np.cumsum(x * x)))
    if q[n] - s[n] * s[n] / n <= penalty:
        return [n]
    best, last = np.empty(n + 1), np.zeros(n + 1, dtype=np.int64)
    best[0] = -penalty
    starts = np.zeros(1, dtype=np.int64)
    for t in range(1, n + 1):
        d = s[t] - s[starts]
        cost = best[starts] + (q[t] - q[starts]) - d * d / (t - starts)
        k = int(np.argmin(cost))
        best[t], last[t] = cost[k] + penalty, starts[k]
        starts = np.append(starts[cost <= best[t]], t)
    ends = [n]
    while last[ends[-1]]:
        ends.append(int(last[ends[-1]]))
    return ends[::-1]


def levels(x: np.ndarray, penalty: float) -> np.ndarray:
    """The mean of its segment for each value of x."""
    out, start = np.empty(len(x)), 0
    for end in segments(x, penalty):
        out[start:end] = x[start:end].mean()
        start = end
    return out
