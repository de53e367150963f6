"""Weighted quantile summaries that merge: the cut points of the histogram booster (LRN2).

Published method: the weighted quantile sketch of Chen & Guestrin (KDD 2016, appendix). A summary
lists values with the least and greatest rank, in weight, that the value can have. Two
summaries merge without loss; pruning to ``size`` entries adds at most ``1 / size`` of the total weight to
the rank error. Batches of a task merge like the carries of a binary counter, tasks in two steps, so a
value passes few prunings and the error stays within ``(log2(batches) + 3) / size``, whatever the
number of partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a summary for each bin that is wanted.
ENTRIES_PER_BIN = 16
#: Summaries of a feature that one task merges at most, about.
MERGE = 64
#: Rows of a batch that are looked at together, in cells.
CELLS = 4_000_000


@dataclass
class Summary:
    """Sorted distinct ``values`` with weights and rank bounds; ``exact`` while nothing was pruned."""

    values: np.ndarray
    weight: np.ndarray
    rmin: np.ndarray
    rmax: np.ndarray
    exact: bool = True

    @classmethod
    def of(cls, values: np.ndarray, weights: np.ndarray) -> Summary:
        found, place = np.unique(values, return_inverse=True)
        weight = np.bincount(place, weights=weights, minlength=len(found)) if len(found) else np.zeros(0)
        up_to = np.cumsum(weight)
        return cls(found, weight, up_to - weight, up_to)

    @property
    def total(self) -> float:
        return float(self.rmax[-1]) if len(self.rmax) else 0.0

    def _around(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least and greatest rank of ``x`` among these entries, and its own weight."""
        left, right = np.searchsorted(self.values, x, side="left"), np.searchsorted(self.values, x, side="right")
        same = right > left
        before = np.r_[0.0, self.rmin + self.weight][left]
        after = np.r_[self.rmax - self.weight, self.total][right]
        at = np.minimum(left, len(self.values) - 1)
        return np.where(same, self.rmin[at], before), np.where(same, self.rmax[at], after), np.where(same, self.weight[at], 0.0)

    def merge(self, other: Summary) -> Summary:
        if not len(self.values) or not len(other.values):
            return self if len(self.values) else other
        values = np.union1d(self.values, other.values)
        a, b = self._around(values), other._around(values)
        return Summary(values, a[2] + b[2], a[0] + b[0], a[1] + b[1], self.exact and other.exact)

    def prune(self, size: int) -> Summary:
        if len(self.values) <= size:
            return self
        middle = (self.rmin + self.rmax) / 2
        wanted = np.linspace(0, self.total, size)
        at = np.unique(np.r_[0, np.clip(np.searchsorted(middle, wanted), 0, len(middle) - 1), len(middle) - 1])
        return Summary(self.values[at], self.weight[at], self.rmin[at], self.rmax[at], False)

    def cuts(self, bins: int) -> list[float]:
        """Values that start a bin: every value but the first where there are few, else those at even ranks."""
        if self.exact and len(self.values) <= bins:
            return self.values[1:].tolist()
        ranks = np.arange(1, bins) * self.total / bins
        at = np.clip(np.searchsorted((self.rmin + self.rmax) / 2, ranks), 0, max(0, len(self.values) - 1))
        return sorted(set(self.values[at].tolist())) if len(self.values) else []

    def to_bytes(self) -> bytes:
        return np.vstack([self.values, self.weight, self.rmin, self.rmax, np.full(len(self.values), float(self.exact))]).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Summary:
        rows = np.frombuffer(raw).reshape(5, -1)
        return cls(*rows[:4], exact=bool(rows[4].all()))


class Counter:
    """Summaries of batches, merged like the digits of a binary counter."""

    def __init__(self, size: int):
        self.size = size
        self.digits: list[Summary | None] = []

    def add(self, one: Summary) -> None:
        one = one.prune(self.size)
        for i, held in enumerate(self.digits):
            if held is None:
                self.digits[i] = one
                return
            one = one.merge(held).prune(self.size)
            self.digits[i] = None
        self.digits.append(one)

    def total(self) -> Summary:
        return merged([d for d in self.digits if d is not None], self.size)


def merged(parts: list[Summary], size: int) -> Summary:
    out = Summary.of(np.zeros(0), np.zeros(0))
    for part in parts:
        out = out.merge(part)
    return out.prune(size)


def cells_of(cols: list[str]) -> Column:
    """All cells of a row as one array of doubles; missing ones are NaN."""
    nan = F.lit(float("nan"))
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), nan) for c in cols]).cast("array<double>")


def cell_slices(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[slice, np.ndarray]]:
    """A batch's cells as matrices of at most ``CELLS`` cells, without a Python object per row."""
    step = max(1, CELLS // max(1, width))
    for at in range(0, batch.num_rows, step):
        rows = slice(at, min(at + step, batch.num_rows))
        flat = batch.column(column).slice(rows.start, rows.stop - rows.start).flatten()
        yield rows, flat.to_numpy(zero_copy_only=False).reshape(rows.stop - rows.start, width)


def quantile_cuts(df: DataFrame, cols: list[str], bins: int, weight: str | None = None) -> dict[str, list[float]]:
    """Cut points of each column: bins of about equal weight. NULL and NaN cells, and rows without a
    positive weight, do not count; a column without values has no cuts."""
    size = ENTRIES_PER_BIN * bins
    width = len(cols)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter(size) for _ in range(width)]
        for batch in batches:
            w = batch.column("w").to_numpy(zero_copy_only=False)
            for rows, x in cell_slices(batch, "x", width):
                part, counts = w[rows], w[rows] > 0
                for j in range(width):
                    some = counts & ~np.isnan(x[:, j])
                    held[j].add(Summary.of(x[some, j], part[some]))
        raw = [h.total().to_bytes() for h in held]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(raw, pa.binary())], ["feature", "summary"])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        one = merged([Summary.from_bytes(raw) for raw in group["summary"]], size)
        return pd.DataFrame({"feature": [group["feature"].iloc[0]], "summary": [one.to_bytes()]})

    w = F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    parts = df.select(w.alias("w"), cells_of(cols).alias("x")).mapInArrow(scan, "feature int, summary binary")
    salted = parts.withColumn("_g", F.floor(F.spark_partition_id() / MERGE).cast("int"))
    once = salted.groupBy("feature", "_g").applyInPandas(join, "feature int, summary binary")
    rows = once.groupBy("feature").applyInPandas(join, "feature int, summary binary").collect()  # one row per column
    found = {cols[r["feature"]]: Summary.from_bytes(bytes(r["summary"])).cuts(bins) for r in rows}
    return {c: found.get(c, []) for c in cols}
