"""Mergeable sketches of scores: metrics of every boosting round without a curve over its rows
(LRN8, LRN9, MET10).

A sketch counts the rows of each class in ``BINS`` equal bins of the range that the scores can have,
and sums the loss exactly. Sketches add up, so a task sends one of fixed size, however
many rows it saw. Scores in one bin count as ties, which is the only difference from the exact curve.
"""

from __future__ import annotations

import numpy as np

#: Bins of a sketch.
BINS = 8192
#: Probabilities are clipped for the loss as in ``metrics.log_loss``.
EPS = 1e-15
#: Numbers of a sketch: loss, weight, then the rows of class 0 and of class 1 by bin.
SIZE = 2 + 2 * BINS


def sketch(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, low: float, high: float, scale: float = 1.0) -> np.ndarray:
    """Sketch of some rows; the probability is ``1 / (1 + exp(-scale * margin))``."""
    out = np.zeros(SIZE)
    p = np.clip(1.0 / (1.0 + np.exp(-scale * margin)), EPS, 1.0 - EPS)
    out[0] = -np.sum(weight * np.where(y == 1, np.log(p), np.log(1.0 - p)))
    out[1] = weight.sum()
    place = np.zeros(len(margin), dtype=np.int64)
    if high > low:
        place = np.clip((margin - low) / (high - low) * BINS, 0, BINS - 1).astype(np.int64)
    out[2:] = np.bincount(place + BINS * (y == 1), minlength=2 * BINS)
    return out


def log_loss(total: np.ndarray) -> float | None:
    return float(total[0] / total[1]) if total[1] > 0 else None


def areas(total: np.ndarray) -> tuple[float | None, float | None]:
    """(PR-AUC, ROC-AUC) with the conventions of ``metrics.curve_metrics``; None without rows, ROC-AUC
    also with one class only."""
    fp, tp = total[2 : 2 + BINS][::-1], total[2 + BINS :][::-1]
    some = (fp + tp) > 0
    if not some.any():
        return None, None
    tps, fps = np.cumsum(tp[some]), np.cumsum(fp[some])
    before_tp, before_fp = np.r_[0, tps[:-1]], np.r_[0, fps[:-1]]
    roc = float(np.sum((fps - before_fp) * (tps + before_tp)) / 2 / (tps[-1] * fps[-1])) if tps[-1] and fps[-1] else None
    if tps[-1] == 0:
        return 0.5, roc
    precision = tps / (tps + fps)
    previous = np.r_[1.0, precision[:-1]]
    return float(np.sum((tps - before_tp) * (precision + previous)) / 2 / tps[-1]), roc
