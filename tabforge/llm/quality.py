"""Line-first quality rules, in built-in functions only.

Every line is judged on its own (punctuation, navigation, boilerplate); failing lines are
removed and a document that loses too much of its text is rejected. The document measures of
the base rules come from the whole text.

Cases: a null text counts as empty; an empty text has no words, fails the base rules and is
not kept; null or repeated ``doc_id`` values pass through row by row (no shuffle, no key is
used); extra columns stay, and a column that has the name of a result is replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import SEPARATOR_RUN, SEPARATORS, text_or_empty

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: A line fails when more than this share of its word characters are symbols.
MAX_SYMBOL_SHARE = 0.1
#: A line fails when it has at least this share of ``!!`` or repeated neighbour words.
MAX_NOISE_SHARE = 0.3
#: A document is rejected when fewer than this share of its words are in passing lines.
MIN_KEPT_SHARE = 0.5
#: Lines of at most this many words must end in terminal punctuation.
SHORT_LINE_WORDS = 3
TERMINAL = r"""[.!?…:;。！？]["'”’»)\]]*$"""
#: Fixed phrases of page furniture; a short line that holds one is boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "cookie settings",
    "enable javascript",
    "click here",
    "sign up",
    "log in",
    "subscribe",
    "lorem ipsum",
    "skip to content",
)
BOILERPLATE_WORDS = 25


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside nested lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """The words of a text. Single-spaced text splits on the literal blank, which avoids
    the pattern matcher and gives the same words."""
    trimmed = F.btrim(text, F.lit(SEPARATORS))
    general = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATOR_RUN))
    plain = (text != "") & ~text.startswith(" ") & ~text.endswith(" ")
    for run in ("  ", "\t", "\n", "\x0b", "\x0c", "\r"):
        plain = plain & ~text.contains(run)
    return F.when(plain, F.split(text, " ")).otherwise(general)


def n_symbols(text: Column) -> Column:
    """Occurrences of the symbols; each is one byte long."""
    left = text
    for symbol in SYMBOLS:
        left = F.replace(left, F.lit(symbol), F.lit(""))
    return F.octet_length(text) - F.octet_length(left)


def repeat_words(words: Column) -> Column:
    """Words covered by the windows of eight words that the text holds twice or more."""

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda a, s: F.struct(s.alias("last"), (a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def repeated(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda p: F.filter(
            p, lambda x, k: (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"])
        )
        starts = bound(placed, lambda p: F.sort_array(F.transform(twice(p), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(starts)).otherwise(F.lit(0))

    windows = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(bound(windows(words), repeated))


def holds_boilerplate(lowered: Column) -> Column:
    return reduce(or_, (lowered.contains(phrase) for phrase in BOILERPLATE))


def judged_line(line: Column) -> Column:
    """Struct of a line, its words and measures, and whether it passes every line rule."""

    def measured(words: Column) -> Column:
        return F.struct(
            words.alias("words"),
            F.size(words).alias("n"),
            F.length(F.array_join(words, "")).alias("chars"),
            n_symbols(line).alias("symbols"),
        )

    def judged(m: Column) -> Column:
        words, n = m["words"], m["n"]
        shouts = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
        echoes = F.size(F.filter(words, lambda w, i: w == F.get(words, i + 1)))
        punctuation = (m["symbols"] > m["chars"] * MAX_SYMBOL_SHARE) | (
            (n >= 3) & ((shouts >= n * MAX_NOISE_SHARE) | ((F.upper(line) == line) & (F.lower(line) != line)))
        )
        navigation = ((n <= SHORT_LINE_WORDS) & ~line.rlike(TERMINAL)) | (
            F.size(F.filter(words, lambda w: w.isin("|", "»", "›", "•", "·"))) >= n * MAX_NOISE_SHARE
        )
        boilerplate = ((n <= BOILERPLATE_WORDS) & bound(F.lower(line), holds_boilerplate)) | (
            (n >= 5) & (echoes >= n * MAX_NOISE_SHARE)
        )
        return F.struct(
            line.alias("line"),
            words.alias("words"),
            n.alias("n"),
            m["chars"].alias("chars"),
            m["symbols"].alias("symbols"),
            ((n > 0) & ~(punctuation | navigation | boilerplate)).alias("ok"),
        )

    return bound(bound(words_of(line), measured), judged)


def judged_document(lines: Column) -> Column:
    """Struct of the document measures and the passing lines, from its judged lines."""

    def total(rows: Column, field: str) -> Column:
        return F.aggregate(rows, F.lit(0), lambda a, x: a + x[field])

    def passing(rows: Column) -> Column:
        # Later copies of a line are removed as boilerplate.
        return bound(
            F.array_distinct(F.transform(rows, lambda x: x["line"])),
            lambda kept: F.struct(
                F.array_join(kept, "\n").alias("text"),
                F.when(F.size(kept) == F.size(rows), total(rows, "n"))
                .otherwise(F.aggregate(kept, F.lit(0), lambda a, x: a + F.size(words_of(x))))
                .alias("n"),
            ),
        )

    worded = F.transform(F.filter(lines, lambda x: x["n"] > 0), lambda x: x["line"])
    return F.struct(
        total(lines, "n").alias("n_words"),
        total(lines, "chars").alias("word_chars"),
        total(lines, "symbols").alias("n_symbols"),
        bound(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        bound(F.flatten(F.transform(lines, lambda x: x["words"])), repeat_words).alias("n_repeat_words"),
        bound(F.filter(lines, lambda x: x["ok"]), passing).alias("kept"),
    )


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the base measures, ``clean_text`` (passing lines, first copy of each),
    ``n_kept_words``, ``base_failed`` and ``kept``."""
    lines = F.transform(F.split(text_or_empty(text), "\n", -1), judged_line)
    measured = docs.withColumn("_q", bound(lines, judged_document))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return (
        measured.withColumns(
            {c: F.col("_q")[c].cast("long") for c in counts}
            | {"clean_text": F.col("_q.kept.text"), "n_kept_words": F.col("_q.kept.n").cast("long")}
        )
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_kept_words") >= F.col("n_words") * MIN_KEPT_SHARE))
        .drop("_q")
    )


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select(*RESULT)


def _sql() -> str:
    words = r"list_filter(regexp_split_to_array({}, '[\x09-\x0D ]+'), lambda x: x <> '')"
    boilerplate = " OR ".join(f"contains(lower(line), '{phrase}')" for phrase in BOILERPLATE)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {words.format("t")} AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x09-\x0D ]')) AS ls FROM d),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM twice)
            GROUP BY doc_id),
lines AS (SELECT doc_id, line, {words.format("line")} AS lw FROM (SELECT doc_id, unnest(list_distinct(ls)) AS line FROM w)),
passing AS (SELECT doc_id, sum(len(lw)) AS n FROM lines WHERE NOT (
    length(line) - length(regexp_replace(line, '[{SYMBOLS}]', '', 'g')) > length(array_to_string(lw, '')) * {MAX_SYMBOL_SHARE}
    OR (len(lw) >= 3 AND ((length(line) - length(replace(line, '!!', ''))) / 2 >= len(lw) * {MAX_NOISE_SHARE}
                          OR (upper(line) = line AND lower(line) <> line)))
    OR (len(lw) <= {SHORT_LINE_WORDS} AND NOT regexp_matches(line, '{TERMINAL.replace("'", "''")}'))
    OR len(list_filter(lw, lambda x: x IN ('|', '»', '›', '•', '·'))) >= len(lw) * {MAX_NOISE_SHARE}
    OR (len(lw) <= {BOILERPLATE_WORDS} AND ({boilerplate}))
    OR (len(lw) >= 5 AND len(list_filter(range(1, len(lw)), lambda i: lw[i] = lw[i + 1])) >= len(lw) * {MAX_NOISE_SHARE}))
  GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, coalesce(passing.n, 0) AS n_kept
      FROM w LEFT JOIN repeats USING (doc_id) LEFT JOIN passing USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_kept >= n_words * {MIN_KEPT_SHARE} AS kept
FROM m
"""


#: The registered query in DuckDB SQL.
SQL = _sql()
