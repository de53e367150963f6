"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digit substitutions to plain
letters, and turns punctuation into blanks. The lexicon holds whole words and word beginnings
with weights learned from labelled rows; exception phrases cancel the hits inside them. The
weight sum of a text is divided by its length before it becomes a score.

Cases: a null text counts as empty; an empty text has no hits and gets the lowest score; rows
without a usable label (null ``toxic``, null ``doc_id``) teach nothing; several labels of one
document count as toxic if one of them is; without any labelled row the lexicon is empty and
every score is below 0.5. Every row of ``docs`` gives one row, repeated rows and null ids too;
extra columns stay, and a column that has the name of a result is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that the lexicon is learned from, at most (smallest hashes first).
FIT_ROWS_PER_CLASS = 12_000
#: Lexicon entries at most: the strongest ones are broadcast to the tasks.
MAX_ENTRIES = 20_000
#: A pattern needs this many toxic rows.
MIN_TOXIC_ROWS = 3
#: Least weights of an entry that are tried; the one with the fewest errors is kept.
FLOORS = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5)
#: The weight is the log-odds ratio less so many of its standard errors.
STANDARD_ERRORS = 2.0
#: Word beginnings of these lengths (letters) are patterns as well as whole words.
STEM_LENGTHS = range(4, 9)
#: Words added to a text's length, so that a short text's single hit is not over-weighted.
LENGTH_PRIOR = 20
STEEPNESS = 4.0

# Letters of other scripts that look like Latin ones, and digits and signs used
# in the place of letters.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ӏ": "l",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Fixed phrases in which a lexicon word is harmless.
EXCEPTION_PHRASES = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "sore loser")


def fold_table() -> dict[int, str]:
    """For str.translate: look-alikes and substitutes, full-width forms, and blanks for signs."""
    table = {i: " " for i in range(128) if not chr(i).isalnum()}
    table |= {i: " " for i in (*range(0xA0, 0xC0), *range(0x2000, 0x2070), *range(0x3000, 0x3020))}
    table |= {0xAD: "", 0x200B: "", 0x200C: "", 0x200D: "", 0xFEFF: ""}
    table |= {0xFF41 + i: chr(0x61 + i) for i in range(26)}
    table |= {ord(a): b for a, b in (LOOK_ALIKES | SUBSTITUTES).items()}
    return table


FOLD = fold_table()


def fold(text: str) -> str:
    return text.lower().translate(FOLD)


def patterns_of(folded: str) -> set[str]:
    """Whole words as `` word `` and word beginnings as `` stem``."""
    found: set[str] = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in STEM_LENGTHS if n <= len(word))
    return found


@dataclass
class Lexicon:
    """Weights of patterns, exception phrases, and the length-normalised cut of the score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTION_PHRASES
    cut: float = 1.0

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            machine.add_word(pattern, (len(pattern.rstrip()), weight))
        for phrase in self.exceptions:
            machine.add_word(f" {fold(phrase)} ", (len(phrase) + 1, -1.0))
        if len(machine):
            machine.make_automaton()
        return machine


def text_hits(machine: ahocorasick.Automaton, folded: str) -> tuple[float, int, int]:
    """Weight sum, number of words hit (each with its heaviest pattern), words of the text."""
    words = folded.split()
    if not words or not len(machine):
        return 0.0, 0, len(words)
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    line = f" {' '.join(words)} "
    for end, (length, weight) in machine.iter(line):
        start = end - length + (0 if line[end] == " " else 1)
        if weight < 0:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if spared:
        best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in spared)}
    return sum(best.values()), len(best), len(words)


def normalised(weight: float, words: int) -> float:
    return math.log1p(1000.0 * weight / (words + LENGTH_PRIOR))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable) -> DataFrame:
    """At most ``FIT_ROWS_PER_CLASS`` labelled rows of each class, by the smallest hashes."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable)
    one = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("_toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [one.filter(F.col("_toxic") == y).orderBy(*order).limit(FIT_ROWS_PER_CLASS) for y in (0, 1)]
    # Bounded by FIT_ROWS_PER_CLASS rows a class of two numbers each, so it may be broadcast.
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(sample, "doc_id").select("text", "_toxic")


def weight_of(n1: float, n0: float, toxic: int, rest: int) -> float:
    """Log-odds ratio of a pattern seen in ``n1`` toxic and ``n0`` other rows, less its error."""
    n1, n0 = max(n1, 0), max(n0, 0)
    odds = math.log(((n1 + 0.5) / (toxic + 1)) / ((n0 + 0.5) / (rest + 1)))
    return odds - STANDARD_ERRORS * math.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))


def fit_lexicon(docs: DataFrame, labels: DataFrame, usable=None) -> Lexicon:
    """Learn from the labelled rows for which ``usable`` (a Column) holds."""
    sample = labelled_sample(docs, labels, F.lit(True) if usable is None else usable)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(batch["text"], batch["_toxic"], strict=True):
                seen[y > 0].update(patterns_of(fold(text)))
            keys = list(seen[0].keys() | seen[1].keys())
            pattern = pd.Series(keys, dtype=object)
            yield pd.DataFrame({"pattern": pattern, "n0": [seen[0][k] for k in keys], "n1": [seen[1][k] for k in keys]})

    counted = sample.mapInPandas(count, "pattern string, n0 long, n1 long").groupBy("pattern")
    toxic, rest = sample.agg(F.sum("_toxic"), F.count("*") - F.sum("_toxic")).first()
    toxic, rest = toxic or 0, rest or 0
    share = (F.col("n1") + 0.5) / (F.col("n0") + 0.5)
    chosen = (
        counted.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .filter((F.col("n1") >= MIN_TOXIC_ROWS) & (share > math.e * (toxic + 1) / (rest + 1)))
        .orderBy(F.desc(F.log(share) * F.sqrt("n1")), "pattern")
        .limit(MAX_ENTRIES)
        .collect()
    )
    counts = {r["pattern"]: (r["n1"], r["n0"]) for r in chosen}
    floor, cut = fit_cut(sample, counts, toxic, rest)
    weights = {p: weight_of(*n, toxic, rest) for p, n in counts.items()}
    return Lexicon({p: w for p, w in weights.items() if w >= floor}, cut=cut)


def fit_cut(sample: DataFrame, counts: dict, toxic: int, rest: int) -> tuple[float, float]:
    """The least weight of an entry and the length-normalised cut that together separate the
    labelled rows with the fewest errors (each class weighs the same). A row is left out of the
    counts behind its own weights."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def without(y: int) -> dict[str, float]:
            return {p: max(weight_of(n1 - y, n0 - (1 - y), toxic, rest), 0.0) for p, (n1, n0) in counts.items()}

        machines = []
        for y in (0, 1):
            weights = without(y)
            machines.append([Lexicon({p: w for p, w in weights.items() if w >= f}).automaton() for f in FLOORS])
        for batch in batches:
            rows = []
            for text, y in zip(batch["text"], batch["_toxic"], strict=True):
                folded = fold(text)
                found = (text_hits(m, folded) for m in machines[int(y)])
                rows.extend((k, int(y), round(normalised(w, n), 3)) for k, (w, _, n) in enumerate(found))
            yield pd.DataFrame(rows, columns=["k", "y", "x"])

    placed = sample.mapInPandas(weigh, "k int, y int, x double").groupBy("k", "y", "x").count().toPandas()  # at most the sample
    if not toxic or not rest:
        return FLOORS[-1], 1.0
    tried = []
    for k, part in placed.groupby("k"):
        x, y = part["x"].to_numpy(), part["y"].to_numpy() > 0
        n = part["count"].to_numpy() / np.where(y, toxic, rest)
        edges = np.unique(x[x > 0])
        errors = [n[y & (x < e)].sum() + n[~y & (x >= e)].sum() for e in edges]
        if errors:
            best = int(np.argmin(errors))
            below = edges[best - 1] if best else 0.0
            tried.append((round(errors[best], 4), FLOORS[int(k)], float((edges[best] + below) / 2)))
    return min(tried)[1:] if tried else (FLOORS[-1], 1.0)


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1), ``predicted`` (score >= 0.5), ``n_hits``."""

    @F.pandas_udf("score double, n_hits long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = lexicon.automaton()
        for texts in batches:
            found = [text_hits(machine, fold(t)) if t else (0.0, 0, 0) for t in texts]
            x = np.array([normalised(w, n) for w, _, n in found])
            yield pd.DataFrame(
                {"score": 1.0 / (1.0 + np.exp(-STEEPNESS * (x - lexicon.cut))), "n_hits": [h for _, h, _ in found]}
            )

    return (
        docs.withColumn("_t", weigh(F.coalesce("text", F.lit(""))))
        .withColumns({"score": F.col("_t.score"), "n_hits": F.col("_t.n_hits")})
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .drop("_t")
    )


def fold_of(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    lexicon = fit_lexicon(docs, labels, usable=fold_of() != 0)
    return score_toxicity(docs, lexicon).select(
        "doc_id", F.coalesce(fold_of() == 0, F.lit(False)).alias("held_out"), "score", "predicted", "n_hits"
    )
