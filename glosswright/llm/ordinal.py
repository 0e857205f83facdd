"""Cumulative-link (proportional odds) regression on hashed sparse features, several outcomes at once.

P(y >= k) = sigmoid(x·w - b_k): one weight vector per outcome, shared by all of its thresholds
b_1 < b_2. Fitted by maximum a posteriori around prior weights. A row may be known only up to
an interval of grades, and a row whose grade is doubted pulls less the less the model believes it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class OrdinalModel:
    #: features x outcomes, and outcomes x thresholds
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, eta: np.ndarray) -> np.ndarray:
        """Expected grade of each outcome for etas (..., outcomes)."""
        return sigmoid(eta[..., None] - self.thresholds).sum(-1)


@dataclass
class Rows:
    """Sparse rows: features *index* with *value*, row after row; *start* is where each begins.

    low and high (rows x outcomes) bound the grade; doubt is 0 for rows that are sure.
    """

    index: np.ndarray
    value: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doubt: np.ndarray


def fit(rows: Rows, prior: OrdinalModel, strength: float = 1.0, steps: int = 40, rate: float = 0.12, begin: OrdinalModel | None = None) -> OrdinalModel:
    """Maximum a posteriori with Adam; *strength* is the precision around *prior*, *begin* where to start."""
    used, col = np.unique(rows.index, return_inverse=True)
    # outcomes come first in every array, so that sums run over contiguous memory
    low, high = np.ascontiguousarray(rows.low.T), np.ascontiguousarray(rows.high.T)
    n_out = len(low)
    order = np.argsort(col, kind="stable")  # the rows again by feature, for the gradient
    by_row = np.repeat(np.arange(len(rows.low)), np.diff(np.append(rows.start, len(rows.index))))[order]
    by_value, by_start = rows.value[order], np.searchsorted(col[order], np.arange(len(used)))
    w0 = np.ascontiguousarray(prior.weights[used].T, dtype=float)
    w = np.array((begin or prior).weights[used].T, dtype=float, order="C")
    gaps, start = (np.column_stack([t[:, :1], np.log(np.diff(t, axis=1))]) for t in ((begin or prior).thresholds, prior.thresholds))
    m, v = [np.zeros_like(w), np.zeros_like(gaps)], [np.zeros_like(w), np.zeros_like(gaps)]
    out = np.arange(n_out)[:, None]
    for step in range(1, steps + 1):
        b = np.column_stack([gaps[:, :1], gaps[:, :1] + np.cumsum(np.exp(gaps[:, 1:]), axis=1)])
        edges = np.column_stack([np.full(n_out, -np.inf), b, np.full(n_out, np.inf)])
        eta = np.stack([np.add.reduceat(x[col] * rows.value, rows.start) for x in w])
        hi, lo = (np.where(np.isinf(e), e > 0, sigmoid(np.nan_to_num(e, posinf=0, neginf=0) - eta)) for e in (edges[out, high + 1], edges[out, low]))
        p = np.maximum(hi - lo, 1e-9)
        trust = p / (p + rows.doubt)
        d_hi, d_lo = hi * (1 - hi) / p * trust, lo * (1 - lo) / p * trust
        g_w = np.stack([np.add.reduceat(d[by_row] * by_value, by_start) for d in d_lo - d_hi]) - strength * (w - w0)
        g_b = np.stack([(d_hi * (high == k)).sum(1) - (d_lo * (low == k + 1)).sum(1) for k in range(b.shape[1])], axis=1)
        g_gap = np.column_stack([g_b.sum(1), *[np.exp(gaps[:, k]) * g_b[:, k:].sum(1) for k in range(1, b.shape[1])]]) - 4.0 * strength * (gaps - start)
        for k, (x, g) in enumerate(((w, g_w), (gaps, g_gap))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g**2
            x += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    weights = prior.weights.copy()
    weights[used] = w.T
    return OrdinalModel(weights, np.column_stack([gaps[:, :1], gaps[:, :1] + np.cumsum(np.exp(gaps[:, 1:]), axis=1)]))
