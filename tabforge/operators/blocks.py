"""Column blocks: the training layout of the histogram booster, and its split search (LRN2, LRN4, LRN5).

Rows are packed once into blocks, one row of a table per block: the bins of every column side by side (one, two
or four bytes a cell), label, weight, key hash and margin. A level of a tree is one pass over the
blocks and one shuffle of sums:

* each task routes its blocks' rows down the tree so far, adds gradients and hessians per
  (node, feature, bin) and sends them feature chunk by feature chunk;
* one group per chunk adds the tasks' sums, scores every split there and returns the best one of
  each node; the driver takes the best chunk (at most nodes x chunks rows);
* a node with few rows (a block's, or in large tables some blocks') needs no more passes: its rows go to one group, which grows
  the whole subtree (Panda et al., PLANET, VLDB 2009: the in-memory build of small nodes). Deep levels would
  otherwise cost one pass each, with sums for thousands of nodes that hold few rows.

The same pass sketches the scores of all rows under the trees so far (``score_sketch``), so a round
needs no job of its own for its metrics. Blocks hold the margins of the trees up to the last
write; later trees are walked again, until the blocks are written anew.

One pass serves any number of boosters that train on the same rows (``trial``): a search scans the table once
for a step of all its trials.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, scratch_dir
from . import score_sketch
from .wquantile import cell_slices, cells_of

#: Rows of a block at most, and its cells at most (which bounds a block by bytes for wide tables).
BLOCK_ROWS = 65_536
BLOCK_CELLS = 16_000_000
#: Rows of a node that one group finishes at most; in tables of less than four times as many, a quarter of them or a block.
SMALL_ROWS = 262_144
#: Sums (nodes x bins) of one feature chunk, about.
CHUNK_SUMS = 262_144
#: Sums of all boosters of a pass that a task keeps while it reads its blocks, and bytes of blocks and gradients that it
#: holds where there are more.
KEPT_SUMS = 2_000_000
HELD_BYTES = 128 << 20
#: Bytes of an Arrow batch of blocks or sums, about: a task holds one on each side of Python, and copies of it.
BATCH_BYTES = 8 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: How block tables are written. A row is up to some MB, but Parquet's writer looks at the size of what it holds after a
#: hundred rows first, and a task holds a whole row group when it writes one and when it reads one.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1",
              "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}
#: Partial sums of a chunk that one task adds up at most, about.
MERGE = 64
#: Splits of random row sampling.
UNIT = float(1 << 53)
TRAIN, EVAL = 0, 1
#: Chunk numbers from here downwards carry the rows of a small node.
ROWS_OF_NODE = -100
#: From so many rows on, a small node's sums are kept by bin, below by sorted row.
DENSE_ROWS = 1024

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


@dataclass
class Layout:
    """How the cells of each column become bins. ``edges[j]``: cut points, or None for a column whose cells are
    codes already; ``slots[j]``: its bins and one more, the last, for missing cells."""

    edges: list
    slots: list

    def __post_init__(self):
        self.edges = [None if e is None else np.asarray(e, dtype=np.float64) for e in self.edges]
        self.types = [np.dtype(np.uint8 if s <= 1 << 8 else np.uint16 if s <= 1 << 16 else np.uint32) for s in self.slots]
        self.byte_at = np.cumsum([0, *(t.itemsize for t in self.types)])

    @classmethod
    def of(cls, cuts: list, codes: list) -> Layout:
        """``codes[j]``: number of codes of a column without cut points."""
        return cls(cuts, [(k if c is None else len(c) + 1) + 1 for c, k in zip(cuts, codes, strict=True)])

    def code(self, x: np.ndarray, j: int) -> np.ndarray:
        """Bins of the cells of column ``j``; NaN, and codes that are not known, are missing."""
        missing = self.slots[j] - 1
        if self.edges[j] is None:
            known = (x >= 0) & (x < missing)
            return np.where(known, x, missing).astype(self.types[j])
        bins = np.searchsorted(self.edges[j], x, side="right")
        return np.where(np.isnan(x), missing, bins).astype(self.types[j])

    def column(self, raw: bytes, rows: int, j: int) -> np.ndarray:
        return np.frombuffer(raw, dtype=self.types[j], count=rows, offset=int(self.byte_at[j]) * rows)


BLOCK = "part int, n int, bins binary, y binary, w binary, k binary, m binary"
NAMES = ["part", "n", "bins", "y", "w", "k", "m"]


def thin(values: np.ndarray) -> bytes:
    """Numbers as bytes: how many distinct ones there are, these, and a byte for each number; or 0 and the numbers, where
    they are many. Labels, class weights and the base margin take a byte a row and pass."""
    distinct, place = np.unique(values.view(np.int64), return_inverse=True)
    if len(distinct) > 256:
        return raw_numbers(values)
    return np.array([len(distinct)]).tobytes() + distinct.tobytes() + place.astype(np.uint8).tobytes()


def raw_numbers(values: np.ndarray) -> bytes:
    return np.array([0]).tobytes() + values.tobytes()


def numbers(raw) -> np.ndarray:
    distinct = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    if not distinct:
        return np.frombuffer(raw, offset=8)
    return np.frombuffer(raw, count=distinct, offset=8)[np.frombuffer(raw, dtype=np.uint8, offset=8 + 8 * distinct)]


def pack(df: DataFrame, cols: list[str], layout: Layout, key: str, label: str, weight: str | None, part: int,
         base: float) -> DataFrame:
    """Blocks of the rows with a label and, if weighted, a weight."""
    width = len(cols)
    limit = int(max(256, min(BLOCK_ROWS, BLOCK_CELLS // max(1, width))))

    def block(held: list) -> pa.RecordBatch:
        k, y, w = (np.concatenate([h[i] for h in held]) for i in range(3))
        bins = b"".join(np.concatenate([h[3][j] for h in held]).tobytes() for j in range(width))
        row = [part, len(k), bins, thin(y), thin(w), k.tobytes(), thin(np.full(len(k), base))]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], NAMES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            k, y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "y", "w"))
            for rows, x in cell_slices(batch, "x", width):
                for at in range(0, len(x), limit):
                    some = slice(at, min(at + limit, len(x)))
                    place = slice(rows.start + some.start, rows.start + some.stop)
                    if size + some.stop - some.start > limit:
                        yield block(held)
                        held, size = [], 0
                    held.append((k[place], y[place], w[place], [layout.code(x[some, j], j) for j in range(width)]))
                    size += some.stop - some.start
        if held:
            yield block(held)

    w = F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    rows = df.select(F.xxhash64(F.col(f"`{key}`")).alias("k"), F.col(f"`{label}`").cast("double").alias("y"), w.alias("w"),
                     cells_of(cols).alias("x"))
    return rows.filter(F.col("y").isNotNull() & F.col("w").isNotNull()).mapInArrow(scan, BLOCK)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs in here gets Arrow batches of about ``BATCH_BYTES``, a row at least: the session's setting counts rows
    by thousands and bytes by some 100 MB, which each running task would hold several times."""
    was = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_CONF) if was is None else spark.conf.set(BATCH_CONF, was)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A block table in the shared folder: one task's blocks are lost with no executor."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.options(**ROW_GROUPS).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@dataclass
class PackedTree:
    """Heap-ordered arrays of one tree: feature (-1: leaf), bin, missing direction, leaf value; a category set
    as one bit per code."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    sets: dict = field(default_factory=dict)

    @classmethod
    def of(cls, splits: dict, leaves: dict, depth: int) -> PackedTree:
        size = 2 ** (depth + 1) - 1
        tree = cls(np.full(size, -1, np.int32), np.zeros(size, np.int64), np.zeros(size, bool), np.zeros(size))
        for n, (f, b, left, _) in splits.items():
            tree.feature[n], tree.missing_left[n] = f, left
            if isinstance(b, (list, tuple)):
                bits = np.zeros(max(b) + 1, dtype=np.uint8)
                bits[list(b)] = 1
                tree.sets[n] = np.packbits(bits, bitorder="little")
            else:
                tree.bin[n] = b
        for n, v in leaves.items():
            tree.value[n] = v
        return tree

    def nodes(self, column, missing: list[int], rows: int, depth: int) -> np.ndarray:
        """The node that each row reaches; ``column(j)`` gives the bins of feature ``j``. Level by level, and there
        feature by feature: a row is looked at once for each level, however many nodes the level has."""
        node = np.zeros(rows, dtype=np.int32)
        start, size, bits = self.packed_sets()
        limit, feature = self.bin.astype(np.int32), self.feature.astype(np.int16 if len(missing) < 1 << 15 else np.int32)
        for level in range(depth):
            here = slice(2**level - 1, 2 ** (level + 1) - 1)
            split_on = np.unique(feature[here])
            if split_on[-1] < 0:
                break
            asked = feature[node] if level else None   # rows in leaves are asked nothing
            for f in split_on[split_on >= 0].tolist():
                at = np.flatnonzero(asked == f) if level else slice(None)
                n, v = node[at], column(f)[at]
                if self.sets and size[here][feature[here] == f].any():
                    byte, bytes_of = v >> 3, size[n]
                    in_set = (bits[start[n] + np.minimum(byte, np.maximum(bytes_of, 1) - 1)] >> (v & 7).astype(np.uint8)) & 1
                    left = np.where(bytes_of > 0, (in_set == 1) & (byte < bytes_of), v <= limit[n])
                else:
                    left = v <= limit[n]
                gone = np.flatnonzero(v == missing[f])
                left[gone] = self.missing_left[n[gone]]
                node[at] = 2 * n + 2 - left
        return node

    def packed_sets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bits of all category sets in one array; where each node's start, and how many bytes it has (0: none)."""
        start, size = (np.zeros(len(self.feature), dtype=np.int64) for _ in range(2))
        at = 0
        for n, bits in self.sets.items():
            start[n], size[n] = at, len(bits)
            at += len(bits)
        return start, size, np.concatenate([*self.sets.values(), np.zeros(1, np.uint8)])


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-m))


@dataclass
class Splitting:
    """What the split search needs of the booster's parameters."""

    reg_lambda: float
    reg_alpha: float
    gamma: float
    min_child_weight: float

    def score(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        t = np.sign(g) * np.maximum(np.abs(g) - self.reg_alpha, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + self.reg_lambda > 0, t * t / (h + self.reg_lambda), 0.0)

    def gains(self, g: np.ndarray, h: np.ndarray, is_set: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of sums (node, bin) whose last bin is the missing one: the order of the bins, and by (node, place in that
        order, missing left) the gain (-inf: not allowed) and the left sums. The bins of a category set
        are ranked once by their gradient ratio; a place stands for the set of all up to it."""
        gb, hb = g[:, :-1], h[:, :-1]
        here = hb > 0
        order = np.broadcast_to(np.arange(gb.shape[1]), gb.shape)
        if is_set:
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(here, gb / (hb + self.reg_lambda + 1e-12), np.inf)
            order = np.argsort(ratio, axis=1, kind="stable")
            gb, hb, here = (np.take_along_axis(x, order, axis=1) for x in (gb, hb, here))
        total_g, total_h = g.sum(axis=1)[:, None, None], h.sum(axis=1)[:, None, None]
        left_g = np.cumsum(gb, axis=1)[:, :, None] + np.stack([np.zeros(len(g)), g[:, -1]], axis=1)[:, None, :]
        left_h = np.cumsum(hb, axis=1)[:, :, None] + np.stack([np.zeros(len(h)), h[:, -1]], axis=1)[:, None, :]
        right_g, right_h = total_g - left_g, total_h - left_h
        # The library's scale: no factor 1/2 before gamma is taken off.
        gain = self.score(left_g, left_h) + self.score(right_g, right_h) - self.score(total_g, total_h) - self.gamma
        allowed = here[:, :, None] & (left_h >= self.min_child_weight) & (right_h >= self.min_child_weight)
        return order, np.where(allowed, gain, -np.inf), left_g, left_h


@dataclass
class Pass:
    """One pass over the blocks: the trees since the blocks were written, the tree in growth and its open nodes,
    the features, the row sampling, and the range of the margins if the scores are to be sketched."""

    layout: Layout
    splitting: Splitting
    depth: int
    recent: list
    growing: PackedTree | None = None
    active: list = field(default_factory=list)
    small: list = field(default_factory=list)   # open nodes that one group finishes
    features: list | None = None
    sets: frozenset = frozenset()
    sample: float = 1.0
    salt: int = 0
    sketch_range: tuple | None = None
    every: bool = False     # all candidates instead of the best ones
    slot: int = 0           # place of this booster's margins in the blocks
    positive: float = 1.0   # factor on the weight of positive rows

    def chunks(self) -> list[list[int]]:
        """Features in chunks of about ``CHUNK_SUMS`` sums."""
        out, size = [], CHUNK_SUMS + 1
        for f in self.chosen():
            cells = self.layout.slots[f] * max(1, len(self.active))
            if size + cells > CHUNK_SUMS:
                out.append([])
                size = 0
            out[-1].append(f)
            size += cells
        return out

    def chosen(self) -> list[int]:
        return list(range(len(self.layout.slots)) if self.features is None else self.features)

    def margins(self, row, rows: int, column) -> np.ndarray:
        held = numbers(row["m"]).reshape(-1, rows)
        # Until the first write all boosters share the base margin.
        m = held[self.slot if len(held) > 1 else 0].copy()
        missing = [s - 1 for s in self.layout.slots]
        for tree in self.recent:
            m += tree.value[tree.nodes(column, missing, rows, self.depth)]
        return m

    def taken(self, k: np.ndarray) -> np.ndarray:
        """Rows of this round's sample, by the hash of their keys."""
        if self.sample >= 1.0:
            return np.ones(len(k), dtype=bool)
        with np.errstate(over="ignore"):
            draw = mix(k.view(np.uint64) ^ mix(np.array([self.salt], dtype=np.uint64) * U64(0x9E3779B97F4A7C15)))
        return (draw >> U64(11)) / UNIT < self.sample


SUMS = "trial int, chunk int, g int, sums binary"
#: kind 0: a node with its best split (b: its bin, or the last code of a set; cl and c: rows on the left and in the
#: node), or with no split but its sums; kind 1: metrics of one part.
FOUND = ("trial int, kind int, node int, f int, b int, missing_left boolean, gain double, gl double, hl double, "
         "cl long, g double, h double, c long, codes binary")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() if c in ("part", "n") else batch.column(c)[i].as_buffer() for c in NAMES}


def sums_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """(trial, chunk, sums) as a batch."""
    trial, chunk, raw = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
    ints = [pa.array(x, pa.int32()) for x in (trial, chunk, [0] * len(rows))]
    return pa.RecordBatch.from_arrays([*ints, pa.array(raw, pa.binary())], ["trial", "chunk", "g", "sums"])


class TaskSums:
    """What one task adds up for one booster."""

    def __init__(self, work: Pass):
        self.work = work
        self.place_of = np.full(2 ** (work.depth + 1) - 1, -1)
        self.place_of[list(work.active)] = np.arange(len(work.active))
        self.place_of[list(work.small)] = len(work.active) + np.arange(len(work.small))
        self.chunks = work.chunks() if work.active else []
        self.held: list[tuple] = []
        self.total: list[np.ndarray] | None = None
        self.sketches: dict[int, np.ndarray] = {}

    def add(self, row: dict, column, y: np.ndarray, w: np.ndarray, k: np.ndarray) -> list[tuple[int, bytes]]:
        """Take a block in. Its rows in small nodes are handed on at once: (node, rows)."""
        work, n = self.work, row["n"]
        grows = row["part"] == TRAIN and len(work.active) + len(work.small) > 0
        if not grows and work.sketch_range is None:
            return []
        m = work.margins(row, n, column)
        if work.sketch_range is not None:
            one = score_sketch.sketch(m, y, w, *work.sketch_range)
            self.sketches[row["part"]] = self.sketches.get(row["part"], 0.0) + one
        if not grows:
            return []
        place = np.zeros(n, dtype=np.int64)
        if work.growing is not None:
            place = self.place_of[work.growing.nodes(column, [s - 1 for s in work.layout.slots], n, work.depth)]
        at = np.flatnonzero((place >= 0) & work.taken(k))
        p = sigmoid(m[at])
        w = w * np.where(y == 1, work.positive, 1.0)
        place, gs, hs = place[at], w[at] * (p - y[at]), w[at] * p * (1.0 - p)
        few = self.rows(column, at, place, gs, hs) if work.small else []
        if work.active:
            big = np.flatnonzero(place < len(work.active)) if work.small else slice(None)
            self.held.append((column, at[big], place[big], gs[big], hs[big]))
        return few

    def sums(self, features: list[int]) -> np.ndarray:
        """Gradients and hessians of a chunk, of the blocks held: for each feature by node and bin."""
        out = []
        nodes = len(self.work.active)
        for f in features:
            slots = self.work.layout.slots[f]
            sums = np.zeros((3, nodes * slots))
            for column, at, place, gs, hs in self.held:
                cell = place * slots + column(f)[at]
                sums[0] += np.bincount(cell, weights=gs, minlength=nodes * slots)
                sums[1] += np.bincount(cell, weights=hs, minlength=nodes * slots)
                sums[2] += np.bincount(cell, minlength=nodes * slots)
            out.append(sums.ravel())
        return np.concatenate(out)

    def keep(self) -> None:
        """Add the blocks held to the totals, and let go of them."""
        if self.held:
            if self.total is None:
                self.total = [self.sums(features) for features in self.chunks]
            else:
                for total, features in zip(self.total, self.chunks, strict=True):
                    total += self.sums(features)
            self.held = []

    def flush(self) -> Iterator[tuple[int, bytes]]:
        """(chunk, sums) of what was added up, or is held, since the last time."""
        if self.total is not None or self.held:
            for c, features in enumerate(self.chunks):
                yield c, (self.sums(features) if self.total is None else self.total[c]).tobytes()
        self.held, self.total = [], None

    def rows(self, column, at: np.ndarray, place: np.ndarray, gs: np.ndarray, hs: np.ndarray) -> list[tuple[int, bytes]]:
        """A block's rows in small nodes, by node: their number, gradients, hessians, and bins column by column."""
        nodes, active = self.work.small, len(self.work.active)
        order = np.argsort(place, kind="stable")
        at, g, h = at[order], gs[order], hs[order]
        bins = [column(f)[at] for f in self.work.chosen()]
        stops = np.searchsorted(place[order], active + np.arange(len(nodes) + 1))
        return [(node, b"".join([np.array([b - a]).tobytes(), g[a:b].tobytes(), h[a:b].tobytes(), *(x[a:b].tobytes() for x in bins)]))
                for node, a, b in zip(nodes, stops[:-1].tolist(), stops[1:].tolist(), strict=True) if b > a]


def block_sums(works: list[Pass]):
    """Per task and booster: sums by feature chunk (chunk 0, 1, ...) and sketches of the parts (chunk -1, -2). A task
    holds a block at a time and the sums, or, where these are many, some blocks and the sums of one chunk."""
    cells = sum(len(w.active) * sum(w.layout.slots[f] for f in w.chosen()) for w in works)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tasks = [TaskSums(work) for work in works]
        held = 0
        for row in rows_of(batches):
            n, layout = row["n"], works[0].layout

            def column(j: int, row=row, n=n, layout=layout) -> np.ndarray:
                return layout.column(row["bins"], n, j)

            y, w, k = numbers(row["y"]), numbers(row["w"]), np.frombuffer(row["k"], dtype=np.int64)
            for trial, task in enumerate(tasks):
                few = [(trial, ROWS_OF_NODE - node, raw) for node, raw in task.add(row, column, y, w, k)]
                if few:
                    yield sums_batch(few)
            if cells <= KEPT_SUMS:
                for task in tasks:
                    task.keep()
                continue
            held += row["bins"].size + 32 * n * len(tasks)
            if held > HELD_BYTES:
                for trial, task in enumerate(tasks):
                    for c, raw in task.flush():
                        yield sums_batch([(trial, c, raw)])
                held = 0
        for trial, task in enumerate(tasks):
            yield sums_batch([(trial, -1 - part, total.tobytes()) for part, total in task.sketches.items()])
            for c, raw in task.flush():
                yield sums_batch([(trial, c, raw)])

    return scan


def added(raw: pd.Series) -> np.ndarray:
    total = np.frombuffer(raw.iloc[0]).copy()
    for other in raw.iloc[1:]:
        total += np.frombuffer(other)
    return total


def plus(total: np.ndarray | None, batch: pa.RecordBatch) -> np.ndarray:
    """The total with the sums of a batch, which are let go of."""
    for raw in batch.column("sums"):
        one = np.frombuffer(raw.as_buffer())
        if total is None:
            total = one.copy()
        else:
            total += one
    return total


def place_of_group(batch: pa.RecordBatch) -> tuple[int, int]:
    return batch.column("trial")[0].as_py(), batch.column("chunk")[0].as_py()


def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some tasks' sums of a chunk as one; rows of a small node as they are."""
    total = None
    for batch in batches:
        trial, chunk = place_of_group(batch)
        if chunk <= ROWS_OF_NODE:
            yield batch
        else:
            total = plus(total, batch)
    if total is not None:
        yield sums_batch([(trial, chunk, total.tobytes())])


def best_of_chunk(works: list[Pass]):
    """The chunk's best split of every open node (all of them if ``every``), or the metrics of a part. A group comes
    batch by batch: its sums, a part from each task, are never held together."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, parts = None, []
        for batch in batches:
            trial, chunk = place_of_group(batch)
            if chunk <= ROWS_OF_NODE:
                parts += [raw.as_buffer() for raw in batch.column("sums")]
            else:
                total = plus(total, batch)
        work = works[trial]
        if chunk <= ROWS_OF_NODE:
            rows = subtree(work, trial, ROWS_OF_NODE - chunk, parts)
        elif chunk < 0:
            pr, roc = score_sketch.areas(total)
            rows = [(trial, 1, -1 - chunk, None, None, None, score_sketch.log_loss(total), pr, roc, None, None, None, None, None)]
        else:
            rows = splits_of(work, trial, work.chunks()[chunk], total)
        columns = zip(*rows, strict=True) if rows else [[]] * len(FOUND_TYPES)
        yield pa.RecordBatch.from_arrays([pa.array(c, t, from_pandas=True) for c, t in zip(columns, FOUND_TYPES.values(), strict=True)],
                                         list(FOUND_TYPES))

    return join


def set_bits(order: np.ndarray, rank: int, codes: int) -> bytes:
    """One bit for each code of the set that goes left."""
    bits = np.zeros(codes, dtype=np.uint8)
    bits[order[: rank + 1]] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def splits_of(work: Pass, trial: int, features: list[int], total: np.ndarray) -> list[tuple]:
    nodes = len(work.active)
    best: list = [None] * nodes
    every = []
    at = 0
    for f in features:
        cells = nodes * work.layout.slots[f]
        g, h, c = total[at : at + 3 * cells].reshape(3, nodes, -1)
        at += 3 * cells
        order, gain, left_g, left_h = work.splitting.gains(g, h, f in work.sets)
        left_c = np.cumsum(np.take_along_axis(c[:, :-1], order, axis=1), axis=1)
        for i in range(nodes):
            sums = float(g[i].sum()), float(h[i].sum()), int(c[i].sum())
            if best[i] is None:
                best[i] = (trial, 0, work.active[i], None, None, None, None, None, None, None, *sums, None)
            if gain.shape[1] == 0:
                continue
            for flat in np.flatnonzero(np.isfinite(gain[i].ravel())) if work.every else [int(np.argmax(gain[i]))]:
                rank, left = divmod(int(flat), 2)
                value = float(gain[i, rank, left])
                if not math.isfinite(value) or (not work.every and best[i][6] is not None and value <= best[i][6]):
                    continue
                codes = set_bits(order[i], rank, gain.shape[1]) if f in work.sets and not work.every else None
                row = (trial, 0, work.active[i], f, int(order[i, rank]), bool(left), value, float(left_g[i, rank, left]),
                       float(left_h[i, rank, left]), int(left_c[i, rank] + left * c[i, -1]), *sums, codes)
                if work.every:
                    every.append(row)
                else:
                    best[i] = row
    return every if work.every else best


def best_by_bins(work: Pass, f: int, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple | None:
    """Best split (gain, bin, missing left, left G and H, set) of one node on one feature, from sums by bin."""
    slots = work.layout.slots[f]
    gs, hs = (np.bincount(bins, weights=x, minlength=slots)[None, :] for x in (g, h))
    order, gain, left_g, left_h = work.splitting.gains(gs, hs, f in work.sets)
    if gain.shape[1] == 0:
        return None
    rank, left = divmod(int(np.argmax(gain[0])), 2)
    codes = set_bits(order[0], rank, slots - 1) if f in work.sets else None
    return float(gain[0, rank, left]), int(order[0, rank]), bool(left), float(left_g[0, rank, left]), float(left_h[0, rank, left]), codes


def best_by_rows(work: Pass, features: list[int], bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple | None:
    """The same over several features with cut points, from the rows sorted by bin: for nodes with fewer rows than bins."""
    order = np.argsort(bins, axis=0, kind="stable")
    ranked = np.take_along_axis(bins, order, axis=0)
    up_g, up_h = np.cumsum(g[order], axis=0), np.cumsum(h[order], axis=0)
    present = ranked < np.array([work.layout.slots[f] - 1 for f in features])
    ends = np.vstack([ranked[1:] != ranked[:-1], np.ones((1, len(features)), dtype=bool)]) & present
    n_present = present.sum(axis=0)
    total_g, total_h = up_g[-1], up_h[-1]
    last = np.maximum(n_present - 1, 0)
    every = np.arange(len(features))
    gone_g = np.where(n_present > 0, total_g - up_g[last, every], total_g)
    gone_h = np.where(n_present > 0, total_h - up_h[last, every], total_h)
    left_g = np.stack([up_g, up_g + gone_g], axis=2)
    left_h = np.stack([up_h, up_h + gone_h], axis=2)
    right_g, right_h = total_g[None, :, None] - left_g, total_h[None, :, None] - left_h
    sp = work.splitting
    gain = sp.score(left_g, left_h) + sp.score(right_g, right_h) - sp.score(total_g, total_h)[None, :, None] - sp.gamma
    allowed = ends[:, :, None] & (left_h >= sp.min_child_weight) & (right_h >= sp.min_child_weight)
    # Lower feature first, then lower bin, then missing right.
    gain = np.where(allowed, gain, -np.inf).transpose(1, 0, 2)
    at = int(np.argmax(gain))
    j, i, left = np.unravel_index(at, gain.shape)
    return float(gain[j, i, left]), features[j], int(ranked[i, j]), bool(left), float(left_g[i, j, left]), float(left_h[i, j, left])


def subtree(work: Pass, trial: int, root: int, parts: list) -> list[tuple]:
    """All nodes below a small one, with its rows at hand."""
    features = work.chosen()
    types = [work.layout.types[f] for f in features]
    g, h, columns = [], [], [[] for _ in features]
    for raw in parts:
        n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
        g.append(np.frombuffer(raw, count=n, offset=8))
        h.append(np.frombuffer(raw, count=n, offset=8 + 8 * n))
        at = 8 + 16 * n
        for column, t in zip(columns, types, strict=True):
            column.append(np.frombuffer(raw, dtype=t, count=n, offset=at))
            at += n * t.itemsize
    g, h = np.concatenate(g), np.concatenate(h)
    bins = [np.concatenate(c) for c in columns]
    place = {f: i for i, f in enumerate(features)}
    plain = [f for f in features if f not in work.sets]
    matrix = np.stack([bins[place[f]].astype(np.int32) for f in plain], axis=1) if plain else None
    missing = [s - 1 for s in work.layout.slots]
    found = []
    todo = [(root, np.arange(len(g)))]
    while todo:
        node, at = todo.pop()
        gs, hs = g[at], h[at]
        best = (-math.inf,)
        if len(at) < DENSE_ROWS and plain:
            value, *rest = best_by_rows(work, plain, matrix[at], gs, hs)
            best = (value, *rest, None)
        for f in features if len(at) >= DENSE_ROWS else [f for f in features if f in work.sets]:
            one = best_by_bins(work, f, bins[place[f]][at], gs, hs)
            # Equal gains: the lower feature.
            if one and (one[0] > best[0] or (one[0] == best[0] and len(best) > 1 and f < best[1])):
                best = (one[0], f, *one[1:])
        sums = float(gs.sum()), float(hs.sum()), len(at)
        if not math.isfinite(best[0]):
            found.append((trial, 0, node, None, None, None, None, None, None, None, *sums, None))
            continue
        value, f, b, left, left_g, left_h, codes = best
        split = PackedTree.of({0: (f, bits_to_codes(codes) if codes else b, left, value)}, {}, 1)
        side = split.nodes(lambda j, at=at: bins[place[j]][at], missing, len(at), 1)
        go_left = at[side == 1]
        found.append((trial, 0, node, f, b, left, value, left_g, left_h, len(go_left), *sums, codes))
        if value > 0 and 2 * node + 1 < 2 ** work.depth - 1:
            todo += [(2 * node + 1, go_left), (2 * node + 2, at[side == 2])]
    return found


def bits_to_codes(raw: bytes) -> list[int]:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bytes(raw), np.uint8), bitorder="little")).tolist()


ARROW = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
FOUND_TYPES = {c: ARROW[t] for c, t in (field.split() for field in FOUND.split(", "))}


def found(blocks: DataFrame, works: list[Pass], tasks: int) -> DataFrame:
    """Candidates and metrics of one pass (``FOUND``); ``trial`` is the place in ``works``. Beyond ``MERGE``
    tasks their sums are added in two steps."""
    sums = blocks.mapInArrow(block_sums(works), SUMS)
    if tasks > MERGE:
        dealt = sums.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(int(math.sqrt(tasks)))))
        sums = dealt.groupBy("trial", "chunk", "g").applyInArrow(partial, SUMS)
    # A group may be few bytes and much work: as many tasks as groups, which no size estimate folds into one.
    groups = sum(2 + len(w.small) + (len(w.chunks()) if w.active else 0) for w in works)
    reducers = min(groups, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = sums.repartition(reducers, "trial", "chunk")
    # The trees are walked by now.
    bare = [replace(w, recent=[], growing=None) for w in works]
    return dealt.groupBy("trial", "chunk").applyInArrow(best_of_chunk(bare), FOUND)


def advanced(blocks: DataFrame, works: list[Pass]) -> DataFrame:
    """The blocks with margins for each of ``works``, their recent trees added."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block at a time: with the margins of many boosters it is several times as large as before.
        for one in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            for row in rows_of(iter([one])):
                n = row["n"]

                def column(j: int, row=row, n=n) -> np.ndarray:
                    return works[0].layout.column(row["bins"], n, j)

                margins = raw_numbers(np.concatenate([work.margins(row, n, column) for work in works]))
                yield one.set_column(NAMES.index("m"), "m", pa.array([margins], pa.binary()))

    return blocks.mapInArrow(scan, BLOCK)


def forget(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        delete_folder(spark, path)
