"""The textbook solver in one process, to which the auction is held."""

from __future__ import annotations

import numpy as np


def assignment(weights: list[list[float]]) -> list[int]:
    """For each row its column in the heaviest one-to-one assignment (-1: none); weights of 0 or less are no candidates.

    The textbook method of shortest augmenting paths with potentials, one for each row of the shorter side, over whole numpy rows; on equal
    weight, rows and then columns come first.
    """
    n, m = len(weights), max((len(r) for r in weights), default=0)
    if not n or not m:
        return [-1] * n
    if n > m:
        of_column = assignment([[r[j] if j < len(r) else 0.0 for r in weights] for j in range(m)])
        at = {i: j for j, i in enumerate(of_column) if i >= 0}
        return [at.get(i, -1) for i in range(n)]
    full = np.zeros((n, m))
    for i, r in enumerate(weights):
        full[i, : len(r)] = np.maximum(r, 0.0)
    cost = full.max() - full
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, np.int64)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, via, used = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            slack = cost[i0 - 1] - u[i0] - v[1:]
            nearer = ~used[1:] & (slack < least[1:])
            least[1:][nearer], via[1:][nearer] = slack[nearer], j0
            j1 = int(np.where(used[1:], np.inf, least[1:]).argmin()) + 1
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[via[j0]]
            j0 = via[j0]
    out = [-1] * n
    for j in range(1, m + 1):
        i = int(match[j]) - 1
        if i >= 0 and full[i, j - 1] > 0:
            out[i] = j - 1
    return out
