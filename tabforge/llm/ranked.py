"""Ranked lexical search with range-maximum sparse tables over posting lists.

1. One pass over the documents builds an index in shards of at most ``SHARD_DOCS`` documents: for
   each term of the queries its documents with the number of occurrences, and the totals that the
   weights need. The query set is read in blocks of about ``BLOCK_ITEMS`` items; a block's terms
   are known to every task.
2. In a shard, documents are put in the order of their rarest term, so that documents with much
   in common are neighbours. Each posting list gets a sparse table of the places of its range
   maxima. For an interval of documents the sum of the maxima of an item's terms bounds
   the score of every document in it.
3. Intervals are taken best bound first, ``STEP`` of each item at a time. The document with the greatest
   single impact of an interval is scored exactly and splits it; both sides come back with their
   own bounds while these reach the item's tenth best score.
4. A first search of a few steps gives every item a score that its tenth best document reaches at least;
   the whole search starts from it. The best of all shards are ranked by a window.

All arithmetic after the weights is in 64-bit integers. Terms are compared by 64-bit hashes.

Cases: a null text has no terms; documents without terms count nowhere, items without terms or whose
terms no document holds get no rows; rows without ``doc_id`` take no part; rows that repeat a ``doc_id`` are documents of
their own, as are items that repeat an ``item_id``; equal scores are ordered by ``doc_id``; texts of
any length are hashed in blocks; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.bytehash import blocks_of, cut_at, run_hashes
from tabforge.llm.common import materialize

#: Documents of a shard at most, and queries that are answered at once, about.
SHARD_DOCS = 8192
BLOCK_ITEMS = 1024
#: Intervals of one item that are split at once.
STEP = 16
#: Steps of the first search.
FIRST_STEPS = 2

#: Letters and digits of ASCII, and every byte of other characters.
IS_TERM = np.ones(256, dtype=bool)
for _first, _last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    IS_TERM[_first : _last + 1] = False
BETWEEN_TERMS = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts in order, and the text of each."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    hashes, start, _ = run_hashes(b"\n".join(texts) + b"\n", IS_TERM)
    return hashes, np.searchsorted(np.cumsum(sizes), start, side="right")


@dataclass(frozen=True)
class Queries:
    """A block of queries: ``items`` as given, the hashes of their distinct terms in order, and for each
    item (from ``at[i]`` to ``at[i + 1]``) its terms and how often each occurs."""

    items: list
    known: np.ndarray
    at: np.ndarray
    term: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Queries:
        hashes, owner = term_hashes([(text or "").encode() for _, text in rows])
        known, term = np.unique(hashes, return_inverse=True)
        pair, times = np.unique(owner * max(1, len(known)) + term, return_counts=True)
        of_item = pair // max(1, len(known))
        at = np.searchsorted(of_item, np.arange(len(rows) + 1))
        return cls([item for item, _ in rows], known, at, pair % max(1, len(known)), times)


INDEX = "shard long, n_docs long, n_terms long, docs binary, sizes binary, term binary, place binary, tf binary"


def build_index(docs: DataFrame, queries: Queries) -> DataFrame:
    """Shards of posting lists of the queries' terms over ``docs`` (doc_id, text)."""
    known = queries.known

    def shard(number: int, ids: list, sizes: list, parts: list) -> tuple:
        size, doc_ids = np.concatenate(sizes), np.concatenate(ids)
        term, place, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Documents without any of the terms only count.
        used, place = np.unique(place, return_inverse=True)
        order = np.lexsort((place, term))
        arrays = (doc_ids[used], size[used], term[order].astype(np.int32), place[order].astype(np.int32), tf[order].astype(np.int32))
        return (number, int((size > 0).sum()), int(size.sum()), *(a.tobytes() for a in arrays))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids, sizes, parts, held = [], [], [], 0
        for batch in batches:
            for first in range(0, len(batch), 1024):
                rows = batch.iloc[first : first + 1024]
                cuts = [list(cut_at(t.encode(), BETWEEN_TERMS)) for t in rows["text"]]
                owner = np.repeat(np.arange(len(rows)), [len(c) for c in cuts])
                size = np.zeros(len(rows), dtype=np.int64)
                found = []
                for at, block in blocks_of(piece for c in cuts for piece in c):
                    hashes, text = term_hashes(block)
                    doc = owner[at + text]
                    size += np.bincount(doc, minlength=len(rows))
                    term = np.searchsorted(known, hashes)
                    hit = np.flatnonzero(known[np.minimum(term, len(known) - 1)] == hashes) if len(known) else []
                    found.append(doc[hit] * len(known) + term[hit])
                pair, tf = np.unique(np.concatenate([*found, np.zeros(0, dtype=np.int64)]), return_counts=True)
                ids.append(rows["doc_id"].to_numpy(dtype=np.int64))
                sizes.append(size)
                parts.append((pair % max(1, len(known)), pair // max(1, len(known)) + held, tf))
                held += len(rows)
                if held + 1024 > SHARD_DOCS:
                    yield pd.DataFrame([shard(number, ids, sizes, parts)])
                    ids, sizes, parts, held = [], [], [], 0
                    number += 1
        if held:
            yield pd.DataFrame([shard(number, ids, sizes, parts)])

    plain = docs.filter(F.col("doc_id").isNotNull())
    plain = plain.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(plain.mapInPandas(scan, INDEX), "ranked-index")


def document_counts(index: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total = np.zeros(terms, dtype=np.int64)
            for raw in batch["term"]:
                total += np.bincount(np.frombuffer(raw, dtype=np.int32), minlength=terms)
            term = np.flatnonzero(total)
            yield pd.DataFrame({"term": term, "df": total[term]})

    df = np.zeros(terms, dtype=np.int64)
    for row in index.select("term").mapInPandas(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return df


def range_maxima(impact: np.ndarray) -> list[np.ndarray]:
    """Level ``k`` holds, for each place, that of the greatest impact among the ``2 ** k`` from there on (the
    first of equal ones)."""
    levels = [np.arange(len(impact), dtype=np.int32)]
    while 2 << (len(levels) - 1) <= len(impact):
        half = 1 << (len(levels) - 1)
        a, b = levels[-1][:-half], levels[-1][half:]
        levels.append(np.where(impact[a] >= impact[b], a, b))
    return levels


class Shard:
    """Posting lists of one shard with their impacts and sparse tables."""

    def __init__(self, row, weight: np.ndarray, df: np.ndarray, n_docs: int, n_terms: int):
        docs, sizes = (np.frombuffer(row[c], dtype=np.int64) for c in ("docs", "sizes"))
        term, place, tf = (np.frombuffer(row[c], dtype=np.int32).astype(np.int64) for c in ("term", "place", "tf"))
        # Order of the documents: by rarest term.
        rarest = np.full(len(docs), np.iinfo(np.int64).max)
        np.minimum.at(rarest, place, df[term] * len(df) + term)
        order = np.lexsort((docs, rarest))
        new = np.empty_like(order)
        new[order] = np.arange(len(order))
        self.docs = docs[order]
        self.n = len(docs)
        key = term * self.n + new[place]
        ranked = np.argsort(key, kind="stable")
        self.key = key[ranked]
        length = 100 - 75 + (75 * sizes * n_docs) // n_terms
        value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[place]))
        self.impact = np.r_[value[ranked], 0]
        self.levels = range_maxima(value[ranked])
        # All levels one after another, so that one look-up serves ranges of any length.
        self.level_at = np.cumsum([0, *(len(x) for x in self.levels)])[:-1]
        self.table = np.concatenate(self.levels) if len(value) else np.zeros(0, dtype=np.int32)

    def best_in(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Place of the greatest impact of each non-empty range of postings."""
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        a = self.table[self.level_at[k] + lo]
        b = self.table[self.level_at[k] + hi - (np.int64(1) << k)]
        return np.where(self.impact[a] >= self.impact[b], a, b)


def summed(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of neighbouring runs of the given sizes, in integers."""
    total = np.r_[0, np.cumsum(values)]
    end = np.cumsum(size)
    return total[end] - total[end - size]


class Search:
    """Best-first search of all items of a block in one shard."""

    def __init__(self, shard: Shard, queries: Queries, floor: np.ndarray, k: int):
        self.shard, self.q, self.k = shard, queries, k
        self.floor = np.maximum(floor, 1)
        self.top = np.zeros((3, 0), dtype=np.int64)  # item, score, document's place
        every = np.arange(len(queries.items))
        self.open = np.zeros((5, 0), dtype=np.int64)  # item, first, end, bound, document that splits
        self.push(every, np.zeros_like(every), np.full_like(every, shard.n))

    def pairs(self, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All terms of each entry's item: entry, term, repeats; and the number of terms per entry."""
        size = self.q.at[item + 1] - self.q.at[item]
        entry = np.repeat(np.arange(len(item)), size)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size) + self.q.at[item][entry]
        return entry, self.q.term[place], self.q.times[place], size

    def push(self, item: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
        """Open the intervals whose bound reaches their item's floor."""
        some = first < end
        item, first, end = item[some], first[some], end[some]
        entry, term, times, size = self.pairs(item)
        lo = np.searchsorted(self.shard.key, term * self.shard.n + first[entry])
        hi = np.searchsorted(self.shard.key, term * self.shard.n + end[entry])
        held = np.flatnonzero(lo < hi)
        best = np.full(len(entry), len(self.shard.impact) - 1)
        best[held] = self.shard.best_in(lo[held], hi[held])
        impact = self.shard.impact[best] * times
        bound = summed(impact, size)
        live = np.flatnonzero((bound >= self.floor[item]) & (size > 0))
        if len(live) == 0:
            return
        # The posting with the greatest impact splits the interval.
        chosen = np.lexsort((impact, entry))[np.cumsum(size)[live] - 1]
        split = self.shard.key[best[chosen]] % self.shard.n
        self.open = np.hstack([self.open, np.vstack([*(x[live] for x in (item, first, end, bound)), split])])

    def step(self) -> bool:
        """Split the best intervals of every item; whether there were any."""
        item, bound = self.open[0], self.open[3]
        live = np.flatnonzero(bound >= self.floor[item])
        if len(live) == 0:
            return False
        order = live[np.lexsort((-bound[live], item[live]))]
        ranked = item[order]
        rank = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        taken, left = self.open[:, order[rank < STEP]], self.open[:, order[rank >= STEP]]
        self.open = left
        item, first, end, _, doc = taken
        self.score(item, doc)
        self.push(np.r_[item, item], np.r_[first, doc + 1], np.r_[doc, end])
        return True

    def score(self, item: np.ndarray, doc: np.ndarray) -> None:
        """Exact scores of documents; the best of each item stay and raise its floor."""
        entry, term, times, size = self.pairs(item)
        wanted = term * self.shard.n + doc[entry]
        at = np.minimum(np.searchsorted(self.shard.key, wanted), len(self.shard.key) - 1)
        scores = summed(np.where(self.shard.key[at] == wanted, self.shard.impact[at] * times, 0), size)
        found = np.hstack([self.top, np.vstack([item, scores, doc])])
        order = np.lexsort((self.shard.docs[found[2]], -found[1], found[0]))
        ranked = found[0][order]
        rank = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        self.top = found[:, order[rank < self.k]]
        last = order[rank == self.k - 1]
        self.floor[found[0][last]] = np.maximum(self.floor[found[0][last]], found[1][last])

    def best(self) -> pd.DataFrame:
        item, score, doc = self.top
        kept = score >= self.floor[item]
        return pd.DataFrame({"item": item[kept], "doc_id": self.shard.docs[doc[kept]], "score": score[kept]})


def search_index(index: DataFrame, queries: Queries, weight: np.ndarray, df: np.ndarray, totals: tuple[int, int],
                 floor: np.ndarray, k: int, steps: int | None = None) -> DataFrame:
    """(item, doc_id, score) of the best documents of each shard; only of the first ``steps`` steps, if given."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                if len(row["docs"]) == 0:
                    continue
                search = Search(Shard(row, weight, df, *totals), queries, floor.copy(), k)
                done = 0
                while (steps is None or done < steps) and search.step():
                    done += 1
                yield search.best()

    return index.mapInPandas(scan, "item long, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    results = None
    for b in range(blocks):
        # About BLOCK_ITEMS rows.
        rows = items.filter(block == b).select("item_id", "text").collect()
        queries = Queries.of([(r["item_id"], r["text"]) for r in rows])
        found = search_block(docs, queries, k)
        numbered = list(enumerate(queries.items))
        names = spark.createDataFrame(numbered, f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = found.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        results = part if results is None else results.unionByName(part)
    return results


def search_block(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    index = build_index(docs, queries)
    facts = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l"), F.count("*").alias("shards")).first()
    n, total = facts["n"] or 0, facts["l"] or 0
    df = document_counts(index, len(queries.known))
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    dealt = index.repartition(max(1, facts["shards"]), "shard")
    floor = np.zeros(len(queries.items), dtype=np.int64)
    args = (queries, weight, df, (n, total))
    first = ranked(search_index(dealt, *args, floor, k, FIRST_STEPS), k).filter(F.col("rank") == k)
    for row in first.select("item", "score").collect():  # one number per item
        floor[row["item"]] = row["score"]
    return ranked(search_index(dealt, *args, floor, k), k)


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return rank_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def _sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = (
        rf"unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t"
    )
    return rf"""
WITH words AS (SELECT doc_id, {terms} FROM documents WHERE doc_id IS NOT NULL),
tfs AS (SELECT doc_id, t, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM sizes),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, {terms} FROM benchmark) GROUP BY ALL),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tfs CROSS JOIN totals WHERE t IN (SELECT t FROM q) GROUP BY t, nd),
impacts AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l))) AS i
            FROM tfs JOIN weights USING (t) JOIN sizes USING (doc_id) CROSS JOIN totals),
scores AS (SELECT item_id, doc_id, CAST(sum(times * i) AS BIGINT) AS score FROM q JOIN impacts USING (t) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


#: The registered query in DuckDB SQL.
SQL = _sql()
