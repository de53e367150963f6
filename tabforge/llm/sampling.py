"""Sampled SentencePiece segmentations without replacement, and decoding.

Every segmentation of a text has the probability of a unigram model at a temperature. Gumbel
noise on the log-probabilities and the ``k`` largest sums draw ``k`` distinct segmentations
without replacement. They are found by a best-first (A-star) search over the lattice from its end.
An open region of the search is a path from the end of the text to a position, edges that are
excluded there, and everything before it; its key is the largest perturbed log-probability among
the segmentations it stands for, with the exact forward sums as heuristic. Taking the region with
the largest key draws its best segmentation (edge by edge backwards, by the forward sums) and splits
the rest of the region where it leaves that path; the parts' keys are Gumbel values of their exact
masses, conditioned on lying below the region's key (top-down sampling). No more regions than
samples still wanted, and one for the threshold, need to be kept. The key of the next best
segmentation is the threshold behind the inclusion probability of each sample.

The best segmentations of a batch of texts are drawn together: texts are cut into chunks wherever no
piece holds the two characters at the cut, the lattices of the distinct chunks lie in flat arrays,
one numpy step takes one edge in every chunk of every text, and the paths of all texts lie one after
the other when keys and results are taken from them.

Noise is a hash of the row's key, the sample's number and the position in the text, so a row's
samples depend neither on its task nor on its batch. Cases: a null or empty text has the empty
segmentation alone; a text with fewer segmentations than ``k`` gives them all, with inclusion 1;
repeated rows give equal samples; null key parts are keys like others; equal keys of regions (ties)
are taken in any order, the same in each run; a very long text is drawn whole, with its lattice and paths
in its task's memory; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import exp, expm1, inf, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import U64, mix
from tabforge.llm.unigram import BLANK, Matcher, Vocabulary, decode_array, default_model, load_vocabulary

SAMPLES = 2
#: The vocabulary's scores are merge ranks; this turns them into moderate log-probabilities.
TEMPERATURE = 0.002
#: Scores below this one mark pieces without a rank; they weigh as little as unknown characters.
LEAST_SCORE = -1e8
#: Characters of text that are drawn together, and handed on together.
BATCH_CHARS = 1 << 18
#: Lattice edges that a task keeps; the store is emptied between batches when it is fuller.
KEPT_EDGES = 3 << 21
#: Lattices of chunks of up to this many characters are made together, position by position.
SHORT = 48
#: With fewer chunks than this still open, edges are taken one at a time.
FEW = 12

#: Pairs of characters are looked up in so many places; pairs that share one only leave chunks longer.
PAIRS = 1 << 24
#: Stands between chunks; no character, so that no match reaches over it.
GAP = sys.maxunicode + 1

MASK = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15
ALONE = 2.0  # bound of the last edge into a position: above every uniform value


def log_sum(values: list[float]) -> float:
    top = max(values)
    return top + log(sum(exp(v - top) for v in values))


def noise(seeds: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """Uniform values between 0 and 1, one for each seed and counter."""
    h = mix(seeds + counters.astype(U64) * U64(STEP))
    return ((h >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def noise_of(seed: int, counter: int) -> float:
    return float(noise(np.array([seed], U64), np.array([counter]))[0])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values begin, and how long they are."""
    heads = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return heads, np.diff(np.append(heads, len(values)))


def places_of(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of stretches that lie somewhere, stretch by stretch."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Column:
    """A flat array that grows at its end, with room for some values to begin with."""

    def __init__(self, kind: str, room: int = 1 << 16):
        self.data, self.size = np.empty(room, kind), 0

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at):
        return self.data[: self.size][at]

    @property
    def values(self) -> np.ndarray:
        return self.data[: self.size]

    def extend(self, values) -> None:
        size = self.size + len(values)
        if size > len(self.data):
            grown = np.empty(max(size, 2 * len(self.data)), self.data.dtype)
            grown[: self.size] = self.values
            self.data = grown
        self.data[self.size : size] = values
        self.size = size


class Chunks:
    """The distinct chunks seen so far, numbered: a hash table in flat arrays, in which many chunks are
    looked up at once. Chunks with equal hashes are told apart by their characters."""

    def __init__(self):
        self.table = np.full(1 << 16, -1)  # place -> number of a chunk, or -1
        self.key, self.start, self.width = Column("u8"), Column("i8"), Column("i8")
        self.points = Column("u4")
        self.node = Column("i8")  # last node of a chunk's lattice; set by the sampler

    def __getitem__(self, chunk: str) -> int:
        """The last node of a chunk that is there."""
        points = code_points(chunk)
        return int(self.node[self.number(points, np.zeros(1, np.int64), np.array([len(points)]))[0]])

    @staticmethod
    def keys(points: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """Hashes of chunks that lie one after the other."""
        within = np.arange(len(points)) - np.repeat(starts, widths)
        return np.add.reduceat(mix(points + (within.astype(U64) << U64(21))), starts)

    def same(self, numbers: np.ndarray, keys: np.ndarray, points: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """Which chunks are those of the numbers."""
        same = (self.key.values[numbers] == keys) & (self.width.values[numbers] == widths)
        at = np.flatnonzero(same)
        starts, widths = starts[at], widths[at]
        places = places_of(starts, widths)
        other = self.points.values[places + np.repeat(self.start.values[numbers[at]] - starts, widths)] != points[places]
        if other.any():
            same[at] = ~np.logical_or.reduceat(other, np.cumsum(widths) - widths)
        return same

    def number(self, points: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """The numbers of chunks that lie one after the other; new ones are added."""
        keys = self.keys(points, starts, widths)
        if 2 * (len(self.key) + len(keys)) > len(self.table):
            self.table = np.full(1 << int(4 * (len(self.key) + len(keys))).bit_length(), -1)
            known = np.arange(len(self.key))
            place = (self.key.values & U64(len(self.table) - 1)).astype(np.int64)
            while len(known):
                free = np.flatnonzero(self.table[place] < 0)
                self.table[place[free]] = known[free]
                on = np.flatnonzero(self.table[place] != known)
                known, place = known[on], (place[on] + 1) & (len(self.table) - 1)
        numbers = np.full(len(keys), -1)
        place = (keys & U64(len(self.table) - 1)).astype(np.int64)
        who = np.arange(len(keys))
        while len(who):
            free = who[self.table[place[who]] < 0]
            # Of the chunks that meet at a free place one gets it, as a new chunk.
            self.table[place[free]] = -2 - free
            new = free[self.table[place[free]] == -2 - free]
            numbers[new] = self.table[place[new]] = len(self.key) + np.arange(len(new))
            self.start.extend(len(self.points) + np.cumsum(widths[new]) - widths[new])
            self.points.extend(points[places_of(starts[new], widths[new])])
            self.key.extend(keys[new])
            self.width.extend(widths[new])
            who = who[numbers[who] < 0]
            found = self.table[place[who]]
            same = self.same(found, keys[who], points, starts[who], widths[who])
            numbers[who[same]] = found[same]
            who = who[~same]
            place[who] = (place[who] + 1) & (len(self.table) - 1)
        return numbers


class Sampler:
    def __init__(self, vocabulary: Vocabulary, temperature: float = TEMPERATURE):
        self.vocabulary = vocabulary
        self.temperature = temperature
        usual = [vocabulary.scores[i] for i in vocabulary.ids.values() if vocabulary.scores[i] > LEAST_SCORE]
        self.unknown = temperature * (min(usual) - 10.0)
        self.strange = np.ones(GAP + 1, bool)  # by code point
        self.strange[[ord(p) for p in vocabulary.ids if len(p) == 1] + [GAP]] = False
        scores = np.array(vocabulary.scores)
        self.weights = np.where(scores > LEAST_SCORE, temperature * scores, self.unknown)
        self.matcher = Matcher(vocabulary.ids)
        #: Pairs of characters that some piece holds; no edge reaches over the middle of any other pair.
        self.pairs = np.zeros(PAIRS, bool)
        self.characters = int(self.matcher.number.max()) + 1
        pairs = {piece[i : i + 2] for piece in vocabulary.ids for i in range(len(piece) - 1)}
        self.pairs[self.pair_places(self.matcher.number[code_points("".join(pairs))])[::2]] = True
        self.empty()

    def empty(self) -> None:
        self.kept = Chunks()
        # The node before a node is the position before it.
        self.first = Column("i8")  # node -> its first edge
        self.length, self.piece = Column("i4", KEPT_EDGES), Column("i4", KEPT_EDGES)  # edge -> characters, piece id or -1 - unknown
        self.bound = Column("f8", KEPT_EDGES)  # edge -> upper bound of its uniform values
        self.own, self.others = Column("f8", KEPT_EDGES), Column("f8", KEPT_EDGES)  # edge -> log-probability, that of the others
        self.unknowns: list[tuple[int, ...]] = []  # ids of characters that more than one byte stands for

    def pair_places(self, number: np.ndarray) -> np.ndarray:
        """Where the pairs of neighbouring characters are looked up."""
        return (number[:-1].astype(np.int64) * self.characters + number[1:]) & (PAIRS - 1)

    def chunks(self, points: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Where the chunks of texts begin that begin at ``texts`` and lie one after the other."""
        begins = np.ones(len(points), bool)
        begins[1:] = ~self.pairs[self.pair_places(self.matcher.number[points])]
        begins[texts] = True
        return np.flatnonzero(begins)

    def stand_in(self, character: str) -> int:
        """The piece of a character that has none of its own: its byte, or a number for its bytes."""
        ids = tuple(self.vocabulary.byte_ids[b] for b in character.encode()) if self.vocabulary.byte_ids else (0,)
        if len(ids) == 1:
            return ids[0]
        self.unknowns.append(ids)
        return -len(self.unknowns)

    def edges(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Last character, length, piece and log-weight of the edges in chunks that each end with the
        gap: by their last character, the longest first."""
        strange = self.strange[points]
        alone = np.flatnonzero(strange)
        found = self.matcher.matches(points)
        into = strange.astype(np.int64)
        for size, (start, _) in enumerate(found):
            into[start + size] += 1
        free = np.cumsum(into) - into
        end, length = np.repeat(np.arange(len(points)), into), np.empty(int(into.sum()), np.int64)
        piece, weight = np.empty(len(end), np.int64), np.empty(len(end))
        for size, (start, pieces) in reversed([*enumerate(found, 1)]):
            at = free[start + size - 1]
            free[start + size - 1] += 1
            length[at], piece[at], weight[at] = size, pieces, self.weights[pieces]
        if len(alone):
            at = free[alone]
            characters, which = np.unique(points[alone], return_inverse=True)
            length[at], weight[at] = 1, self.unknown
            piece[at] = np.array([self.stand_in(chr(c)) for c in characters.tolist()])[which]
        return end, length, piece, weight

    def lattice(self, chunk: str) -> list[list[tuple[int, int, float]]]:
        """Edges into each position: (characters, piece, log-weight)."""
        into: list[list] = [[] for _ in range(len(chunk) + 1)]
        for end, *edge in zip(*(x.tolist() for x in self.edges(np.append(code_points(chunk), GAP))), strict=True):
            into[end + 1].append(tuple(edge))
        return into

    def last_node(self, chunk: str) -> int:
        """The last node of a chunk's lattice, which is made by itself and stored."""
        forward, first = [0.0], []
        length, piece, bound, own, others = [], [], [], [], []
        for end, into in enumerate(self.lattice(chunk)[1:], 1):
            first.append(len(self.length) + len(length))
            sums = [forward[end - size] + w for size, _, w in into]
            total = sums[0] if len(sums) == 1 else log_sum(sums)
            forward.append(total)
            upto = 0.0
            for i in range(len(into)):
                upto += exp(sums[i] - total)
                length.append(into[i][0])
                piece.append(into[i][1])
                bound.append(upto)
                own.append(sums[i] - total)
                others.append(log_sum(sums[:i] + sums[i + 1 :]) - total if len(sums) > 1 else -inf)
            bound[-1] = ALONE
        self.store(first, length, piece, bound, own, others)
        return len(self.first) - 1

    def store(self, first, length, piece, bound, own, others) -> None:
        self.first.extend(first)
        self.length.extend(length)
        self.piece.extend(piece)
        self.bound.extend(bound)
        self.own.extend(own)
        self.others.extend(others)

    def add(self, new: list[str]) -> None:
        """Store the lattices of chunks that are new."""
        widths = np.fromiter(map(len, new), np.int64, len(new))
        self.nodes(code_points("".join(new)), np.cumsum(widths) - widths, widths)

    def nodes(self, points: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """The last nodes of chunks that lie one after the other; lattices of new chunks are stored."""
        if not len(starts):
            return starts
        numbers = self.kept.number(points, starts, widths)
        if (known := len(self.kept.node)) < len(self.kept.key):
            starts, widths = self.kept.start[known:], self.kept.width[known:]
            last = np.empty(len(widths), np.int64)
            for i in np.flatnonzero(widths > SHORT).tolist():
                long = self.kept.points[starts[i] : starts[i] + widths[i]]
                last[i] = self.last_node(long.tobytes().decode("utf-32-le"))
            if len(short := np.flatnonzero(widths <= SHORT)):
                last[short] = self.last_nodes(self.kept.points[places_of(starts[short], widths[short])], widths[short])
            self.kept.node.extend(last)
        return self.kept.node.values[numbers]

    def last_nodes(self, points: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """The last nodes of chunks that lie one after the other, whose lattices are made together and stored."""
        chunk = np.repeat(np.arange(len(widths)), widths)
        spaced = np.full(len(points) + len(widths), GAP, np.uint32)
        spaced[np.arange(len(points)) + chunk] = points
        end, size, piece, weight = self.edges(spaced)
        gaps = np.cumsum(widths + 1) - 1
        # ``forward[i]`` stands before character ``i``; it stays 0 where a chunk starts.
        level = (np.arange(len(spaced)) - np.repeat(gaps - widths, widths + 1)).astype(np.int16)[end]
        order = np.argsort(level, kind="stable")
        ends, begins, weight = end[order], (end + 1 - size)[order], weight[order]
        forward, own = np.zeros(len(spaced) + 1), np.empty(len(end))
        heads, into = runs(ends)
        after = ends[heads] + 1
        stops = np.cumsum(np.bincount(level))
        nodes = np.searchsorted(heads, stops).tolist()
        for a, b, i, j in zip([0, *stops.tolist()], stops.tolist(), [0, *nodes], nodes, strict=False):
            sums = forward[begins[a:b]] + weight[a:b]
            at, width = heads[i:j] - a, into[i:j]
            top = np.maximum.reduceat(sums, at)
            total = top + np.log(np.add.reduceat(np.exp(sums - np.repeat(top, width)), at))
            forward[after[i:j]] = total
            own[order[a:b]] = sums - np.repeat(total, width)
        heads, into = runs(end)
        share = np.exp(own)
        bound = share.copy()
        wide = np.flatnonzero(into > 1)
        for r in range(1, int(into.max())):
            wide = wide[into[wide] > r]
            at = heads[wide] + r
            bound[at] += bound[at - 1]
        bound[heads + into - 1] = ALONE
        # What the edge with most of the mass leaves to the others is added up, as it may be tiny. Of edges
        # that tie at one half, both may lie just above it.
        most = np.flatnonzero(share > 0.75)
        share[most] = 0.0
        others = np.log1p(-share)
        node = end[most] - np.repeat(np.arange(len(widths)), widths + 1)[end[most]]
        with np.errstate(divide="ignore"):
            others[most] = np.log(np.add.reduceat(share, heads)[node])
        base = len(self.first)
        self.store(heads + len(self.length), size, piece, bound, own, others)
        return base + np.cumsum(widths) - 1

    def edges_of(self, node: int) -> range:
        return range(self.first[node], self.first[node + 1] if node + 1 < len(self.first) else len(self.length))

    def draw(self, seeds: np.ndarray, node: np.ndarray, left: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw the part of each chunk before a node: ``left`` characters of the chunk, which end
        at ``at`` in their text. The edges, last first, chunk by chunk, and their number by chunk."""
        first, length, bound = self.first.values, self.length.values, self.bound.values
        counts, steps, alone = np.zeros(len(node), np.int64), [], []
        who = np.flatnonzero(left > 0)
        seeds, node, left, at = seeds[who], node[who], left[who], at[who]
        while len(who) > FEW:
            edge = first[node]
            many = np.flatnonzero(bound[edge] < 1)
            u, taken = noise(seeds[many], 2 * at[many]), edge[many]
            beyond = np.flatnonzero(u >= bound[taken])
            while len(beyond):
                taken[beyond] += 1
                beyond = beyond[u[beyond] >= bound[taken[beyond]]]
            edge[many] = taken
            steps.append((who, edge))
            counts[who] += 1
            size = length[edge]
            left = left - size
            on = np.flatnonzero(left)
            who, seeds, node, left, at = who[on], seeds[on], (node - size)[on], left[on], (at - size)[on]
        first, length, bound = memoryview(first), memoryview(length), memoryview(bound)
        for w, seed, n, rest, place in zip(*(x.tolist() for x in (who, seeds, node, left, at)), strict=True):
            path = []
            uniform = noise(np.full(rest, seed, U64), 2 * np.arange(place - rest + 1, place + 1))
            while rest:
                edge = first[n]
                while uniform[rest - 1] >= bound[edge]:
                    edge += 1
                path.append(edge)
                n, rest = n - length[edge], rest - length[edge]
            alone.append((w, path))
        done = counts.copy()
        for w, path in alone:
            counts[w] += len(path)
        offset = np.cumsum(counts) - counts
        edges = np.empty(int(counts.sum()), np.int64)
        for step, (w, e) in enumerate(steps):
            edges[offset[w] + step] = e
        for w, path in alone:
            edges[offset[w] + done[w] : offset[w] + counts[w]] = path
        return edges, counts

    def split(self, paths: "Paths", regions: list["Region"], wanted: int) -> list[list["Region"]]:
        """For each path, drawn in its region, the ``wanted`` parts with the largest keys of what else
        the region holds, each of which leaves the path at another place."""
        others, length = self.others.values[paths.edges], self.length.values[paths.edges]
        mass = paths.behind - paths.own + others
        # Places before the one where a region begins are its own path; nothing leaves there.
        begins = paths.starts[:-1] + [region.place for region in regions]
        for region, at in zip(regions, begins.tolist(), strict=True):
            if region.without:
                without = (*region.without, int(paths.edges[at]))
                left = [self.own[e] for e in self.edges_of(region.node) if e not in without]
                mass[at] = paths.behind[at] - paths.own[at] + (log_sum(left) if left else -inf)
        widths = np.diff(paths.starts)
        within = np.arange(len(mass)) >= np.repeat(begins, widths)
        places = np.flatnonzero(within & (mass > -inf))
        row = np.repeat(np.arange(len(regions)), widths)[places]
        before = np.cumsum(length) - length
        ends = (np.append(before, 0)[paths.starts[:-1]] + paths.sizes)[row] - before[places]
        mass = mass[places]
        waits = -np.log(noise(paths.seeds[row], 2 * ends + 1))
        # Gumbel values of the masses; given that they lie below the region's key, their order is the same.
        free = mass - np.log(waits)
        stops = np.searchsorted(places, paths.starts).tolist()
        parts, first = [], self.first.values
        for n, (region, a, b) in enumerate(zip(regions, stops, stops[1:], strict=False)):
            if b - a > wanted:
                best = a + np.argpartition(-free[a:b], wanted)[:wanted] if wanted > 1 else (a + int(free[a:b].argmax()),)
            else:
                best = range(a, b)
            path, start = paths.path(n), int(paths.starts[n])
            parts.append([])
            for i in best:
                place = int(places[i]) - start
                edge = int(path[place])
                key = float(mass[i] - np.log(np.exp(mass[i] - region.key) + waits[i]))
                without = (*region.without, edge) if place == region.place else (edge,)
                parts[-1].append(Region(key, path, place, int(ends[i]), int(first.searchsorted(edge, "right")) - 1, without))
        return parts

    def leave(self, region: "Region", seed: int) -> int:
        """The edge by which the best segmentation of a region goes on at its place."""
        open_edges = [e for e in self.edges_of(region.node) if e not in region.without]
        weights = [self.own[e] for e in open_edges]
        u = noise_of(seed, 2 * region.end) * exp(log_sum(weights))
        for edge, w in zip(open_edges, weights, strict=True):
            u -= exp(w)
            if u < 0:
                return edge
        return open_edges[0]

    def draw_batch(self, texts: list[str], seeds: list[int], k: int) -> "Drawn":
        """For each text up to ``k`` distinct segmentations, by falling key."""
        if len(self.length) > KEPT_EDGES:
            self.empty()
        points = code_points("".join([BLANK + text for text in texts if text]).replace(" ", BLANK))
        bases = np.cumsum([0, *(len(text) + 1 if text else 0 for text in texts)])  # text -> characters before it
        starts = self.chunks(points, bases[:-1][np.diff(bases) > 0])
        sizes = np.diff(np.append(starts, len(points)))
        nodes, upto = self.nodes(points, starts, sizes), starts + sizes
        begins = np.searchsorted(starts, bases)  # text -> its first chunk
        seeds = np.array([seed & MASK for seed in seeds], U64)
        open_regions = [
            [Region(-log(-log(u)), np.empty(0, np.int64), 0, size, -1, ())]
            for u, size in zip(noise(seeds, np.zeros(len(seeds), np.int64)).tolist(), np.diff(bases).tolist(), strict=True)
        ]
        rounds = []
        for n in range(k):
            who = np.array([i for i, regions in enumerate(open_regions) if regions], np.int64)
            if not len(who):
                break
            taken = [open_regions[i].pop(0) for i in who.tolist()]
            streams = seeds[who] ^ mix(np.array([n + 1], U64))
            prefixes, node, at = [], np.full(len(who), -1), np.array([region.end for region in taken], np.int64)
            for i, region in enumerate(taken):
                prefix = region.path[: region.place]
                if region.without:
                    edge = self.leave(region, int(streams[i]))
                    prefix = np.append(prefix, edge)
                    node[i], at[i] = region.node - self.length[edge], region.end - self.length[edge]
                prefixes.append(prefix)
            # What is left of a region's own chunk, and the chunks before it, the last first.
            whole = np.searchsorted(upto, bases[who] + at, "right")
            whole = np.maximum(whole, begins[who])
            width = whole - begins[who] + 1
            heads = np.cumsum(width) - width
            chunk = np.repeat(whole + heads, width) - np.arange(int(width.sum()))
            own = np.append(upto, 0)[whole - 1]
            chunk[heads] = 0
            walkers = [x[chunk] if len(x) else np.zeros(len(chunk), np.int64) for x in (nodes, sizes, upto)]
            walkers[2] -= np.repeat(bases[who], width)
            walkers[0][heads], walkers[2][heads] = node, at
            walkers[1][heads] = at - np.where(whole > begins[who], own - bases[who], 0)
            edges, counts = self.draw(np.repeat(streams, width), *walkers)
            stops = np.cumsum(np.add.reduceat(counts, heads)).tolist()
            pieces = [x for prefix, a, b in zip(prefixes, [0, *stops], stops, strict=False) for x in (prefix, edges[a:b])]
            starts = np.cumsum([0, *(len(a) + len(b) for a, b in zip(pieces[::2], pieces[1::2], strict=True))])
            paths = Paths(who, np.concatenate(pieces), starts, streams, np.diff(bases)[who], self)
            rounds.append(paths)
            for i, found in zip(who.tolist(), self.split(paths, taken, k - n), strict=True):
                open_regions[i] = sorted(open_regions[i] + found, key=lambda r: -r.key)[: k - n]
        return self.drawn(rounds, [regions[0].key if regions else -inf for regions in open_regions])

    def drawn(self, rounds: list["Paths"], thresholds: list[float]) -> "Drawn":
        found = sorted((i, n, place) for n, paths in enumerate(rounds) for place, i in enumerate(paths.who.tolist()))
        log_prob = [float(rounds[n].log_prob[place]) for _, n, place in found]
        gaps = [p - thresholds[i] for p, (i, _, _) in zip(log_prob, found, strict=True)]
        edges = [rounds[n].path(place)[::-1] for _, n, place in found]
        ids = self.piece.values[np.concatenate(edges)] if edges else np.empty(0, np.int32)
        offsets = np.cumsum([0, *map(len, edges)])
        if len(ids) and ids.min() < 0:
            number = -1 - ids[ids < 0]
            bytes_of = np.array([len(b) for b in self.unknowns])
            width = np.ones(len(ids), np.int64)
            width[ids < 0] = bytes_of[number]
            behind = np.append(0, np.cumsum(width))
            place = np.flatnonzero(np.repeat(ids < 0, width))
            ids = np.repeat(ids, width)
            ids[place] = list(chain.from_iterable(self.unknowns[i] for i in number.tolist()))
            offsets = behind[offsets]
        inclusion = [1.0 if gap > 700 else -expm1(-exp(gap)) for gap in gaps]
        return Drawn([i for i, _, _ in found], [n + 1 for _, n, _ in found], ids, offsets, log_prob, inclusion)

    def batch(self, texts: list[str], seeds: list[int], k: int) -> list[list[tuple[list[int], float, float]]]:
        """For each text up to ``k`` distinct (ids, log-probability, inclusion), by falling key."""
        out: list[list] = [[] for _ in texts]
        drawn = self.draw_batch(texts, seeds, k)
        for n, i in enumerate(drawn.owner):
            ids = drawn.ids[drawn.offsets[n] : drawn.offsets[n + 1]].tolist()
            out[i].append((ids, drawn.log_prob[n], drawn.inclusion[n]))
        return out

    def sample(self, text: str, k: int, seed: int) -> list[tuple[list[int], float, float]]:
        return self.batch([text], [seed], k)[0]


class Region(NamedTuple):
    """Segmentations that end with ``path[:place]`` and whose edge into the node there, at position
    ``end`` of the text, is none of ``without`` (empty: every segmentation of the text)."""

    key: float
    path: np.ndarray
    place: int
    end: int
    node: int
    without: tuple[int, ...]


class Paths:
    """Paths through the lattices of several texts, one after the other, each from its text's end."""

    def __init__(self, who: np.ndarray, edges: np.ndarray, starts: np.ndarray, seeds: np.ndarray, sizes: np.ndarray, sampler: Sampler):
        self.who, self.edges, self.starts, self.seeds, self.sizes = who, edges, starts, seeds, sizes
        self.own = sampler.own.values[edges]
        #: Log-probability of a path as far as an edge; added up path by path, so that it does not depend on the batch.
        self.behind = np.empty(len(edges))
        bounds = starts.tolist()
        for a, b in zip(bounds, bounds[1:], strict=False):
            self.own[a:b].cumsum(out=self.behind[a:b])
        self.log_prob = np.where(np.diff(starts) > 0, np.append(self.behind, 0.0)[starts[1:] - 1], 0.0)

    def path(self, n: int) -> np.ndarray:
        return self.edges[self.starts[n] : self.starts[n + 1]]


class Drawn(NamedTuple):
    """Samples of a batch, one after the other: their text, number, place of their ids, and figures."""

    owner: list[int]
    sample: list[int]
    ids: np.ndarray
    offsets: np.ndarray
    log_prob: list[float]
    inclusion: list[float]


@lru_cache(maxsize=1)
def sampler_of(model: str) -> Sampler:
    return Sampler(load_vocabulary(model))


def sample_segmentations(
    rows: DataFrame, key: list[str], text: str = "text", k: int = SAMPLES, model_file: str | None = None
) -> DataFrame:
    """One row per sample: the key columns, ``sample`` (from 1, by falling perturbed
    log-probability), ``ids``, ``log_prob``, ``inclusion`` and the ``decoded`` text."""
    model = model_file or default_model()
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in key)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = sampler_of(model)
        for batch in batches:
            upto = np.cumsum(pc.utf8_length(batch["_text"]).to_numpy(zero_copy_only=False)) // BATCH_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(upto)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                found = sampler.draw_batch(part["_text"].to_pylist(), part["_seed"].to_pylist(), k)
                owner = pa.array(found.owner, pa.int32())
                columns = [part.column(i).take(owner) for i in range(len(key))]
                columns.append(pa.array(found.sample, pa.int32()))
                columns.append(pa.ListArray.from_arrays(pa.array(found.offsets, pa.int32()), pa.array(found.ids, pa.int32())))
                columns += [pa.array(found.log_prob, pa.float64()), pa.array(found.inclusion, pa.float64())]
                columns.append(decode_array(sampler.vocabulary, found.ids, found.offsets))
                yield pa.RecordBatch.from_arrays(columns, [*key, "sample", "ids", "log_prob", "inclusion", "decoded"])

    seeded = rows.select(
        *key, F.coalesce(F.col(text), F.lit("")).alias("_text"), F.xxhash64(*[F.col(c).cast("string") for c in key]).alias("_seed")
    )
    return seeded.mapInArrow(draw, f"{schema}, sample int, ids array<int>, log_prob double, inclusion double, decoded string")


def op7_sampled_segmentations(spark, sf_dir: str) -> DataFrame:
    """Samples of every whole text of ``documents`` (``turn`` is NULL) and of every turn of ``conversations``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.lit("documents").alias("source"), F.col("doc_id").cast("string").alias("id"), F.lit(None).cast("int").alias("turn"), "text"
    )
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.lit("conversations").alias("source"), F.col("conv_id").cast("string").alias("id"), F.col("turn").cast("int").alias("turn"), "text"
    )
    drawn = sample_segmentations(documents.unionByName(turns), ["source", "id", "turn"])
    return drawn.select(
        "source", "id", "turn", "sample", F.size("ids").alias("n_pieces"), ids_digest("ids").alias("ids_crc32"),
        "log_prob", "inclusion", F.length("decoded").alias("n_chars"),
    )


def ids_digest(column: str):
    return F.crc32(F.concat_ws(",", F.col(column).cast("array<string>")))
