"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

1. Words are counted first (whole table, per language). The few most frequent words, whose share
   bounds their number, become known.
2. Every word starts a suffix of at most ``max_words`` words of its piece. Suffixes are numbered and
   equal ones added up in each task, then routed globally by their leading words: by
   two words, by three where both are among the most frequent words, by four where all three
   are, so that no route holds a large share of the suffixes.
3. The suffix pointers of one route are sorted by a multikey three-way quicksort to the maximum depth,
   breadth first: one round splits every open partition at its pivot word into less, equal and
   greater. The size of an equal partition is the count of its phrase; partitions that are
   too small for any frequent phrase are abandoned. Phrases shorter than their
   routes are counted in parts, which are added up.
4. Counts, cuts, scores and the removal of phrases inside longer ones are joins on word hashes.

Words are compared by 64-bit hashes inside a language (two of a million words collide with a probability
of about 1 in 37 million).

Cases: a null text has no words, a null language is ``und``; rows without words count nowhere; ``doc_id``
is not used, so repeated rows count each; a text of any length is cut into blocks only between
pieces and words are never cut; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.bytehash import LOWER, blocks_of, cut_at, run_hashes
from tabforge.llm.common import U64, materialize, mix

PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
PIECE_END = re.compile(f"[{PIECE_ENDS}]".encode())
#: 0 inside a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, dtype=np.uint8)
KIND[[ord(c) for c in BLANKS]] = 1
KIND[[ord(c) for c in PIECE_ENDS]] = 2
#: Words that a task collects before it adds up equal suffixes.
CHUNK_WORDS = 1_500_000
#: Suffixes of one route, about.
ROUTE_SUFFIXES = 1_500_000
#: A word is among the most frequent ones with more than this share of all words (so fewer than 4,096 are).
HOT_SHARE = 1 / 4096


@dataclass(frozen=True)
class Rule:
    min_count: int = 30
    max_words: int = 4
    top: int = 2000
    #: A phrase goes when a longer one that holds it has at least this percentage of its count.
    within_percent: int = 80


def words_in(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Hash, start, end and piece number of each word of some texts, and the bytes they lie in."""
    raw = b"\n".join(texts) + b"\n"
    hashes, start, end = run_hashes(raw, KIND == 0)
    # 0 stands for the end of a piece.
    hashes[hashes == 0] = 1
    lowered = LOWER[np.frombuffer(raw, dtype=np.uint8)]
    return hashes, start, end, np.cumsum(KIND[lowered] == 2)[start], lowered.tobytes()


def by_language(batch: pd.DataFrame) -> Iterator[tuple[str, list[bytes]]]:
    for lang, rows in batch.groupby("lang", sort=False):
        for _, block in blocks_of(b for t in rows["text"] for b in cut_at(t.encode(), PIECE_END)):
            yield lang, block


COUNTED = "lang string, h long, word string, n long"


def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, block in by_language(batch):
            hashes, start, end, _, raw = words_in(block)
            if len(hashes):
                found, first, n = np.unique(hashes, return_index=True, return_counts=True)
                words = [raw[s:e].decode() for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
                yield pd.DataFrame({"lang": lang, "h": found.view(np.int64), "word": words, "n": n})


def suffix_codes(codes: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """For each word, the codes of the ``depth`` words from it on; 0 after its piece."""
    out = np.zeros((len(codes), depth), dtype=np.int64)
    for d in range(depth):
        inside = np.flatnonzero(left > d)
        out[inside, d] = codes[inside + d]
    return out


def added_up(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order, and how often each occurs."""
    order = np.lexsort(suffixes.T[::-1])
    ranked = suffixes[order]
    head = np.flatnonzero(np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)][: len(ranked)])
    return ranked[head], np.diff(np.r_[head, len(ranked)])


def route_depth(suffixes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Leading words by which a suffix is routed: two, and one more as long as all are hot."""
    depth = np.full(len(suffixes), min(2, suffixes.shape[1]))
    run = hot[suffixes[:, 0]]
    for d in range(1, suffixes.shape[1] - 1):
        run = run & hot[suffixes[:, d]]
        depth[run] = d + 2
    return depth


ROUTED = "lang string, route int, depth int, words binary, rows binary, wide boolean"


def route_suffixes(routes: int, hot_words: np.ndarray, rule: Rule):
    """Suffixes by route: for each the hashes of its words, then the suffixes as columns of places in
    that list (0: end of the piece) and their counts."""

    def flush(lang: str, hashes: np.ndarray, left: np.ndarray) -> Iterator[pd.DataFrame]:
        known, codes = np.unique(hashes, return_inverse=True)
        known = np.r_[U64(0), known]
        suffixes, n = added_up(suffix_codes(codes + 1, left, rule.max_words))
        depth = route_depth(suffixes, np.isin(known, hot_words))
        with np.errstate(over="ignore"):
            key = np.zeros(len(suffixes), dtype=np.uint64)
            for d in range(rule.max_words):
                key = np.where(d < depth, mix(key * U64(3) + known[suffixes[:, d]]), key)
        place = (key % U64(routes)).astype(np.int64) * (rule.max_words + 1) + depth
        order = np.argsort(place, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(place[order]) != 0])
        out = []
        for rows in np.split(order, cuts[1:]):
            used, local = np.unique(suffixes[rows], return_inverse=True)
            wide = len(used) > 65535 or n[rows].max() > 65535
            cells = np.vstack([local.reshape(len(rows), -1).T, n[rows][None, :]])
            route, by = divmod(int(place[rows[0]]), rule.max_words + 1)
            # The place 0 is the end in every list, whether a suffix ends here or not.
            if used[0] != 0:
                used = np.r_[0, used]
                cells[:-1] += 1
            out.append((lang, route, by, known[used].tobytes(), cells.astype(np.uint32 if wide else np.uint16).tobytes(), wide))
        yield pd.DataFrame(out, columns=["lang", "route", "depth", "words", "rows", "wide"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for lang, block in by_language(batch):
                hashes, _, _, piece, _ = words_in(block)
                if len(hashes) == 0:
                    continue
                last = np.flatnonzero(np.r_[piece[1:] != piece[:-1], True])
                ends = last[np.searchsorted(last, np.arange(len(piece)))]
                left = np.minimum(ends - np.arange(len(piece)) + 1, rule.max_words).astype(np.int8)
                held.setdefault(lang, []).append((hashes, left))
                size += len(hashes)
                if size >= CHUNK_WORDS:
                    for name, parts in held.items():
                        yield from flush(name, *(np.concatenate(x) for x in zip(*parts, strict=True)))
                    held, size = {}, 0
        for name, parts in held.items():
            yield from flush(name, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    return scan


def quicksort_counts(suffixes: np.ndarray, n: np.ndarray, depth: int, least: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(pointers, counts, words): one pointer of every equal partition of two words or more and its size.

    Partitions below ``least`` are abandoned once their next phrases are complete here, which phrases
    of ``depth`` words or more are.
    """
    found = []
    deepest = suffixes.shape[1]
    pointers = np.arange(len(suffixes))
    size = np.array([len(suffixes)])
    level = np.array([0])
    while len(pointers):
        start = np.cumsum(size) - size
        part = np.repeat(np.arange(len(size)), size)
        key = suffixes[pointers, level[part]]
        a, b, c = key[start], key[start + size // 2], key[start + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        at = pivot[part]
        side = (key >= at).astype(np.int64) + (key > at)
        child = part * 3 + side
        weight = np.bincount(child, weights=n[pointers], minlength=3 * len(size))
        rows = np.bincount(child, minlength=3 * len(size))
        equal = np.arange(len(size)) * 3 + 1
        words = level + 1
        phrase = (pivot > 0) & (words >= 2) & ((weight[equal] >= least) | (words < depth))
        # The first pointer of each equal partition stands for its phrase.
        first = np.empty(len(size), dtype=np.int64)
        same = np.flatnonzero(side == 1)[::-1]
        first[part[same]] = pointers[same]
        for w in range(2, deepest + 1):
            chosen = phrase & (words == w)
            if chosen.any():
                found.append((first[chosen], weight[equal][chosen].astype(np.int64), w))
        next_level = np.repeat(level, 3)
        next_level[equal] += 1
        live = (rows > 0) & ((weight >= least) | (next_level + 1 < depth))
        live[equal] &= (pivot > 0) & (words < deepest)
        # Stable counting order: less, equal and greater of each partition side by side.
        keep = live[child]
        kept_rows = np.where(live, rows, 0)
        goes_to = np.cumsum(kept_rows) - kept_rows
        order = np.empty(int(kept_rows.sum()), dtype=np.int64)
        for s in range(3):
            mine = np.flatnonzero(keep & (side == s))
            c_of = child[mine]
            run = np.arange(len(mine)) - np.searchsorted(c_of, c_of)
            order[goes_to[c_of] + run] = pointers[mine]
        pointers, size, level = order, rows[live], next_level[live]
    return found


def count_phrases(rule: Rule):
    columns = [f"h{i}" for i in range(rule.max_words)]

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(w, dtype=np.uint64) for w in batch["words"]]
        known = np.unique(np.concatenate(lists))
        out = []
        for depth, rows in batch.assign(_i=range(len(batch))).groupby("depth"):
            cells, counts = [], []
            for i, raw, wide in zip(rows["_i"], rows["rows"], rows["wide"], strict=True):
                table = np.frombuffer(raw, dtype=np.uint32 if wide else np.uint16).reshape(rule.max_words + 1, -1)
                cells.append(np.searchsorted(known, lists[i]).astype(np.int32)[table[:-1]].T)
                counts.append(table[-1].astype(np.int64))
            # The end of a piece is the smallest hash.
            suffixes, n = np.concatenate(cells), np.concatenate(counts)
            for first, total, words in quicksort_counts(suffixes, n, int(depth), rule.min_count):
                hashes = known[suffixes[first]].view(np.int64)
                hashes[:, words:] = 0
                out.append(pd.DataFrame(hashes, columns=columns).assign(lang=batch["lang"].iloc[0], f=total))
        empty = pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in [*columns, "f"]}).assign(lang="")
        return pd.concat(out or [empty])[["lang", *columns, "f"]]

    return count


def phrase_counts(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(lang, h0, ..., f) of all phrases of 1 to ``max_words`` words with ``min_count`` occurrences, and
    (lang, h, word, n) of all words."""
    plain = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = plain.mapInPandas(count_words, COUNTED).groupBy("lang", "h", "word").agg(F.sum("n").alias("n"))
    words = materialize(counted, "collocations-words")
    total = words.agg(F.sum("n")).first()[0] or 0
    # Fewer than 1 / HOT_SHARE words.
    hot = words.filter(F.col("n") > total * HOT_SHARE).select("h").distinct().collect()
    hot_words = np.array([r["h"] for r in hot], dtype=np.int64).view(np.uint64)
    routes = max(1, -(-total // ROUTE_SUFFIXES))
    columns = [f"h{i}" for i in range(rule.max_words)]
    routed = plain.mapInPandas(route_suffixes(routes, hot_words, rule), ROUTED)
    parts = routed.groupBy("lang", "route").applyInPandas(
        count_phrases(rule), "lang string, " + ", ".join(f"{c} long" for c in columns) + ", f long"
    )
    longer = parts.groupBy("lang", *columns).agg(F.sum("f").alias("f")).filter(F.col("f") >= rule.min_count)
    frequent = words.filter(F.col("n") >= rule.min_count)
    single = frequent.select("lang", F.col("h").alias("h0"), *[F.lit(0).cast("long").alias(c) for c in columns[1:]], F.col("n").alias("f"))
    return materialize(longer.unionByName(single), "collocations-counts"), words


def part(at: int, to: int, width: int, prefix: str) -> list:
    """Columns of the words ``at`` to ``to`` (without) of a phrase, as a phrase of its own."""
    names = [F.col(f"h{i}") for i in range(at, to)] + [F.lit(0).cast("long")] * (width - (to - at))
    return [c.alias(f"{prefix}{i}") for i, c in enumerate(names)]


def collocations(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    m = rule.max_words
    counts, words = phrase_counts(docs, rule)
    columns = [f"h{i}" for i in range(m)]
    key = ["lang", *columns]
    size = reduce(lambda x, c: x + (F.col(c) != 0).cast("int"), columns, F.lit(0))
    sized = counts.withColumn("size", size)
    phrases = sized.filter("size > 1")

    def counts_as(prefix: str, value: str) -> DataFrame:
        return counts.select("lang", *[F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(columns)], F.col("f").alias(value))

    # Every cut of every phrase with the counts of both sides.
    cuts = [(s, k) for s in range(2, m + 1) for k in range(1, s)]
    cut = F.array(*[
        F.when(F.col("size") == s, F.struct(F.lit(k).alias("k"), *part(0, k, m, "x"), *part(k, s, m, "y"))) for s, k in cuts
    ])
    halves = phrases.select(*key, "f", F.explode(F.filter(cut, lambda c: c.isNotNull())).alias("c")).select(*key, "f", "c.*")
    sides = halves.join(counts_as("x", "l"), ["lang", *[f"x{i}" for i in range(m)]])
    sides = sides.join(counts_as("y", "r"), ["lang", *[f"y{i}" for i in range(m)]])
    exact = "cast(2000000 as decimal(7,0)) * cast(f as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    scored = sides.withColumn("score", F.expr(exact)).groupBy(*key).agg(
        F.first("f").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    # What lies inside a longer phrase, with the greatest count of those.
    inner = [(s, at, to) for s in range(3, m + 1) for at in range(s) for to in range(at + 2, s + 1) if to - at < s]
    inside = F.array(*[F.when(F.col("size") == s, F.struct(*part(at, to, m, "i"))) for s, at, to in inner])
    held = phrases.select("lang", "f", F.explode(F.filter(inside, lambda c: c.isNotNull())).alias("c")).select("lang", "f", "c.*")
    held = held.withColumnsRenamed({f"i{i}": c for i, c in enumerate(columns)}).groupBy(*key).agg(F.max("f").alias("_longer"))
    covered = F.expr(f"cast(100 as decimal(3,0)) * _longer >= cast({rule.within_percent} as decimal(3,0)) * a")
    kept = materialize(scored.join(held, key, "left").filter(F.coalesce(~covered, F.lit(True))).drop("_longer"), "collocations-kept")
    # Hashes back to words.
    listed = kept.select(*key, F.posexplode(F.filter(F.array(*columns), lambda h: h != 0)).alias("pos", "h"))
    named = listed.join(words.filter(F.col("n") >= rule.min_count).select("lang", "h", "word"), ["lang", "h"])
    spelt = named.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"]), " ").alias("phrase")
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    # Only the first rows of each task and language go to the window's task.
    ranked = kept.join(spelt, key).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rule.top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"),
        "n", F.col("best.score").cast("long").alias("score"),
    )


def op13_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


def _sql(rule: Rule = Rule()) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    m = rule.max_words
    grams = " UNION ALL ".join(
        f"SELECT lang, {s} AS size, array_to_string(ws[i:i + {s - 1}], ' ') AS p FROM "
        f"(SELECT lang, ws, unnest(range(1, len(ws) - {s - 2})) AS i FROM pieces)" for s in range(1, m + 1)
    )
    return rf"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS ws
           FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
f AS (SELECT lang, size, p, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {rule.min_count}),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
cand AS (SELECT lang, size, p, f AS a, string_split(p, ' ') AS ws FROM f WHERE size > 1),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
sides AS (SELECT c.lang, c.size, c.p, c.a, c.k, x.f AS l, y.f AS r,
                 CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
          FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = array_to_string(c.ws[1:k], ' ')
                      JOIN f y ON y.lang = c.lang AND y.p = array_to_string(c.ws[k + 1:], ' ')),
best AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_ AS (SELECT lang, a, ws, size, s, unnest(range(1, size - s + 2)) AS i
           FROM (SELECT *, unnest(range(2, size)) AS s FROM cand)),
longer AS (SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS p, max(a) AS f FROM inner_ GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, p)
         WHERE longer.f IS NULL OR CAST(100 AS HUGEINT) * longer.f < CAST({rule.within_percent} AS HUGEINT) * a)
SELECT lang, rank, p AS phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= {rule.top}
"""


#: The registered query in DuckDB SQL.
SQL = _sql()
