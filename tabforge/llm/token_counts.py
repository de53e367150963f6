"""Token counts by count-only Viterbi segmentation.

Aho-Corasick enumerates the vocabulary's matches in a chunk, by end and, for one end, from the
longest to the shortest. The dynamic programme carries the best score and the number of pieces
only. Tie rule of the tokenizer: of equal scores the longest last piece stays (a later candidate
must be better); an unknown character counts its UTF-8 bytes. Scores are added in double
precision, chunk by chunk, so the count is that of the best segmentation; the library adds
single-precision numbers along the whole text, and can miss it where its sums pass 2**24.

Cases: a null or empty text has no tokens; every row gives one row, repeated rows and null ids
too; extra columns stay, and columns that have the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.unigram import KEPT_CHUNKS, Vocabulary, chunks, default_model, load_vocabulary


class Counter:
    """Counts the pieces of texts; results of chunks are kept while the store has room."""

    def __init__(self, vocabulary: Vocabulary):
        self.matches = vocabulary.automaton().iter
        self.known = {p for p in vocabulary.ids if len(p) == 1}
        self.unknown_score = vocabulary.unknown_score
        #: Pieces (upper half) and bytes among them (lower half) of chunks seen so far.
        self.kept: dict[str, int] = {}

    def chunk(self, chunk: str) -> tuple[int, int]:
        """Pieces of the best segmentation, and how many of them are bytes."""
        n = len(chunk)
        lost = [i for i, c in enumerate(chunk) if c not in self.known]
        best = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        if not lost:
            for end, (length, score, _) in self.matches(chunk):
                score += best[end + 1 - length]
                if score > best[end + 1]:
                    best[end + 1] = score
                    count[end + 1] = count[end + 1 - length] + 1
            return count[n], 0
        ends: list[list] = [[] for _ in range(n + 1)]
        for end, (length, score, _) in self.matches(chunk):
            ends[end + 1].append((length, score, 1, 0))
        for i in lost:
            size = len(chunk[i].encode())
            ends[i + 1].append((1, self.unknown_score, size, size))
        raw = [0] * (n + 1)
        for end in range(1, n + 1):
            for length, score, size, byte in ends[end]:
                score += best[end - length]
                if score > best[end]:
                    best[end] = score
                    count[end] = count[end - length] + size
                    raw[end] = raw[end - length] + byte
        return count[n], raw[n]

    def text(self, text: str) -> tuple[int, int]:
        parts = chunks(text)
        found = list(map(self.kept.get, parts))
        if None in found:
            if len(self.kept) >= KEPT_CHUNKS:
                self.kept.clear()
            for i, (part, known) in enumerate(zip(parts, found, strict=True)):
                if known is None:
                    pieces, raw = self.chunk(part)
                    found[i] = self.kept[part] = (pieces << 32) | raw
        total = sum(found)
        return total >> 32, total & 0xFFFFFFFF


def count_tokens(docs: DataFrame, text: str = "text", model_file: str | None = None) -> DataFrame:
    """``docs`` plus ``n_tokens`` and ``n_byte_tokens``."""
    model = model_file or default_model()

    @F.pandas_udf("n_tokens long, n_byte_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(load_vocabulary(model))
        for texts in batches:
            yield pd.DataFrame([counter.text(t) for t in texts], columns=["n_tokens", "n_byte_tokens"])

    found = docs.withColumn("_t", counted(F.coalesce(F.col(text), F.lit(""))))
    return found.withColumns({c: F.col("_t")[c] for c in ("n_tokens", "n_byte_tokens")}).drop("_t")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).drop("text")
