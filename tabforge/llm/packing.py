"""Best-fit packing of token pieces by a grouping genetic algorithm on islands.

Pieces of a whole sequence's length stand alone. The others are dealt evenly into groups of
bounded size; every group is evolved on several islands, each with its own population, as one
Spark task per (group, island). Crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold duplicates of their items, and best-fits the displaced
items. Between epochs each island's elite migrates to the next island of its group. Bins that
stay poorly filled are dissolved and packed again together with those of other groups.

Cases: a null text is empty and gives the end token alone; repeated rows and null ids are packed
row by row; an empty table gives an empty result; extra columns stay out of the result; texts of any length are
encoded whole, runs of white space of any length included.
"""

from __future__ import annotations

import base64
import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import materialize

CAPACITY = 1024
END_ID = 2
#: Items of a group, islands of a group, solutions of an island.
GROUP_ITEMS = 4096
ISLANDS = 2
POPULATION = 3
EPOCHS = 2
GENERATIONS = 2
#: A bin this full may be injected whole; bins of the final packing below it are dissolved once.
WELL_FILLED = 0.995
#: Rounds in which poorly filled bins of all groups are packed again.
REPACK_ROUNDS = 2
SPECIAL_TOKEN = "<|endoftext|>"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def load_tokenizer(vocabulary: str, special: str | None = SPECIAL_TOKEN):
    """The byte-level BPE of a tiktoken rank file; ``special`` gets the id after the last rank,
    as in the JSON form of the same vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={special: len(ranks)} if special else {},
    )


def id_encoder(vocabulary: str, model: str | None = None) -> Callable[[str], list[int]]:
    """Text to ids. The rank file's library is the faster one; its pattern matcher runs out of stack on very long runs
    of white space, and such a text is read by the JSON form of the same vocabulary (``model``), with the same ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    fast = load_tokenizer(vocabulary)
    whole: list = []

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:
            if not whole:
                whole.append(Tokenizer.from_file(model or public_tokenizers.path("byte_bpe_50k.json")))
            return whole[0].encode(text, add_special_tokens=False).ids

    return encode


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ids of a document, then the end id, cut into whole sequences; a
    remainder stands first."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = id_encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*encode(text), end_id], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                raw = ids.tobytes()
                rows.extend(
                    (doc_id, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b]))
                    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pd.DataFrame(
                {
                    "doc_id": pd.array([None if pd.isna(d) else int(d) for d in columns[0]], dtype="Int64"),
                    "piece": columns[1],
                    "start": columns[2],
                    "length": columns[3],
                    "ids_crc32": columns[4],
                }
            )

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(cut, PIECES)


def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put ``items`` one by one into the open bin with the least sufficient room, or a new bin.
    ``room`` is indexed by bin and grows; ``bins`` gets each item's bin."""
    free = sorted((r, b) for b, r in enumerate(room) if r > 0)
    for item in items.tolist():
        size = int(sizes[item])
        at = bisect_left(free, (size, -1))
        if at == len(free):
            left, target = capacity, len(room)
            room.append(capacity)
        else:
            left, target = free.pop(at)
        bins[item] = target
        room[target] = left - size
        if left > size:
            insort(free, (left - size, target))


def by_size(sizes: np.ndarray, items: np.ndarray, noise: float, rng: np.random.Generator) -> np.ndarray:
    """Items from large to small, with some noise so that solutions differ."""
    return items[np.argsort(-(sizes[items] + rng.uniform(0, noise, len(items))), kind="stable")]


def packed_anew(sizes: np.ndarray, noise: float, capacity: int, rng: np.random.Generator) -> np.ndarray:
    bins = np.empty(len(sizes), dtype=np.int64)
    best_fit(sizes, by_size(sizes, np.arange(len(sizes)), noise, rng), bins, [], capacity)
    return bins


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the fuller bins (mean squared fill)."""
    fill = np.bincount(bins, weights=sizes)
    fill = fill[fill > 0]
    return -len(fill), float(((fill / capacity) ** 2).mean()) if len(fill) else 0.0


def cross(sizes: np.ndarray, mother: np.ndarray, father: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject whole well-filled bins of ``father`` into ``mother``."""
    fill = np.bincount(father, weights=sizes)
    good = np.flatnonzero(fill >= WELL_FILLED * capacity)
    if len(good) == 0:
        return mother.copy()
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[rng.choice(good, max(1, len(good) // 2), replace=False)] = True
    injected = chosen[father]
    hit = np.zeros(mother.max() + 1, dtype=bool)
    hit[mother[injected]] = True  # bins of the mother that hold an injected item
    displaced = hit[mother] & ~injected
    # Poorly filled bins of the mother join the displaced items, which gives them room to fit.
    loose = np.bincount(mother, weights=sizes) < WELL_FILLED * capacity
    displaced |= loose[mother] & ~injected
    child = np.empty_like(mother)
    kept = ~injected & ~displaced
    names, child[kept] = np.unique(mother[kept], return_inverse=True)
    more, child[injected] = np.unique(father[injected], return_inverse=True)
    child[injected] += len(names)
    placed = kept | injected
    filled = np.bincount(child[placed], weights=sizes[placed], minlength=len(names) + len(more))
    room = [capacity - int(f) for f in filled]
    best_fit(sizes, by_size(sizes, np.flatnonzero(displaced), 8.0, rng), child, room, capacity)
    return child


def evolve(sizes: np.ndarray, population: list[np.ndarray], generations: int, capacity: int, rng) -> list[np.ndarray]:
    """Best first."""
    ranked = sorted(population, key=lambda b: fitness(sizes, b, capacity), reverse=True)
    floor = math.ceil(int(sizes.sum()) / capacity)
    for _ in range(generations):
        if -fitness(sizes, ranked[0], capacity)[0] <= floor:
            break
        children = []
        for k in range(1, len(ranked)):
            children.append(cross(sizes, ranked[0], ranked[k], capacity, rng))
            children.append(cross(sizes, ranked[k], ranked[0], capacity, rng))
        ranked = sorted([*ranked, *children], key=lambda b: fitness(sizes, b, capacity), reverse=True)[: len(population)]
    return ranked


STATE = "g long, island int, rows array<long>, sizes array<int>, elite array<int>, others array<array<int>>"


def start_islands(items: DataFrame, capacity: int) -> DataFrame:
    """``items`` (g, row, length) to one state row per group and island."""

    def build(key, batch: pd.DataFrame) -> pd.DataFrame:
        g, island = (int(x) for x in key)
        batch = batch.sort_values("row", kind="stable")
        sizes = batch["length"].to_numpy().astype(np.int64)
        rng = np.random.default_rng([g % (1 << 32), island])
        noises = [0.0 if island == 0 else 4.0, *(8.0 * 2.0**k for k in range(POPULATION - 1))]
        population = evolve(sizes, [packed_anew(sizes, n, capacity, rng) for n in noises], GENERATIONS, capacity, rng)
        return state_row(g, island, batch["row"].to_numpy(), sizes, population)

    return (
        items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
        .groupBy("g", "island")
        .applyInPandas(build, STATE)
    )


def state_row(g: int, island: int, rows, sizes, population: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "g": [g],
            "island": [island],
            "rows": [np.asarray(rows)],
            "sizes": [np.asarray(sizes, dtype=np.int32)],
            "elite": [population[0].astype(np.int32)],
            "others": [[b.astype(np.int32) for b in population[1:]]],
        }
    )


def next_epoch(state: DataFrame, epoch: int, capacity: int) -> DataFrame:
    """Every island gets the elite of the island before it and evolves on."""
    migrants = state.select(
        "g", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elite").alias("migrant")
    )

    def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                sizes = np.asarray(r.sizes, dtype=np.int64)
                population = [np.asarray(b, dtype=np.int64) for b in (r.elite, r.migrant, *r.others)]
                rng = np.random.default_rng([r.g % (1 << 32), r.island, epoch])
                yield state_row(r.g, r.island, r.rows, sizes, evolve(sizes, population, GENERATIONS, capacity, rng)[:POPULATION])

    return state.join(migrants, ["g", "island"]).mapInPandas(go_on, STATE)


def pack_groups(items: DataFrame, capacity: int, name: str) -> DataFrame:
    """``items`` (row, length) to (row, length, g, bin, offset, fill) of each group's best island."""
    n = items.count()
    groups = max(1, math.ceil(n / GROUP_ITEMS))
    dealt = items.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)))
    state = start_islands(dealt, capacity)
    for epoch in range(1, EPOCHS):
        state = next_epoch(materialize(state, f"{name}-islands"), epoch, capacity)

    def best(key, batch: pd.DataFrame) -> pd.DataFrame:
        ranked = [
            (fitness(np.asarray(r.sizes, dtype=np.int64), np.asarray(r.elite, dtype=np.int64), capacity), -r.island, r)
            for r in batch.itertuples()
        ]
        chosen = max(ranked, key=lambda x: x[:2])[2]
        rows, sizes, bins = (np.asarray(x, dtype=np.int64) for x in (chosen.rows, chosen.sizes, chosen.elite))
        order = np.lexsort((rows, bins))
        rows, sizes, bins = rows[order], sizes[order], bins[order]
        before = np.cumsum(sizes) - sizes
        first = np.r_[True, bins[1:] != bins[:-1]]
        offset = before - np.maximum.accumulate(np.where(first, before, 0))
        fill = np.bincount(bins, weights=sizes).astype(np.int64)[bins]
        return pd.DataFrame({"row": rows, "length": sizes, "g": int(key[0]), "bin": bins, "offset": offset, "fill": fill})

    return state.groupBy("g").applyInPandas(best, "row long, length long, g long, bin long, offset long, fill long")


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset`` in that sequence."""
    cut = token_pieces(docs, vocabulary or default_vocabulary(), capacity, end_id)
    # Written once, so that row numbers hold for every later use.
    pieces = materialize(cut.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    whole = pieces.filter(F.col("length") == capacity).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    left = pieces.filter(F.col("length") < capacity).select("row", "length")
    placed = whole
    for k in range(REPACK_ROUNDS + 1):
        packed = materialize(pack_groups(left, capacity, f"pack-{k}"), "pack-bins")
        done = F.col("fill") >= WELL_FILLED * capacity if k < REPACK_ROUNDS else F.lit(True)
        numbered = F.shiftleft(F.col("g") * (REPACK_ROUNDS + 1) + k, 24) + F.col("bin")
        placed = placed.unionByName(packed.filter(done).select("row", numbered.alias("sequence_id"), "offset"))
        left = packed.filter(~done).select("row", "length")
        if k < REPACK_ROUNDS and left.isEmpty():
            break
    return pieces.join(placed, "row").drop("row")


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
