"""I-Match fingerprints over randomised lexicon subsets, in built-in functions only.

The lexicon holds the terms whose number of documents lies in a band (an inverse document
frequency band: neither too common nor too rare). A text keeps its terms of the lexicon,
distinct and sorted. Random subsets of the lexicon give one hash each, that of the kept
terms in it. A subset of a fixed share changes with nearly every edit of a long text and
holds nothing of a short one, so a text of ``n`` kept terms is hashed at the levels ``floor(log2(n))``
and the next one: a level ``g`` cuts the lexicon at random into ``2 ** g`` subsets, as
often as it takes to have ``subsets`` of them, and uses so many. Two fingerprints are compared at a level that
both have; the likeness is the share of equal hashes among the subsets that hold a term of either text.

The lower edge of the band bounds the lexicon at any number of documents: a term needs
more than ``1 / max_terms`` of all (document, term) pairs, so fewer than ``max_terms`` terms can
have that. The lexicon is therefore looked up in a hash table that is a constant of the plan.

Cases: a null text is empty. A text without lexicon terms is fingerprinted by all its terms, one
without any term by itself, so equal texts always have equal fingerprints, and texts whose sizes are
more than about two to four times apart have likeness 0. Rows without ``doc_id`` come last in descending
order; rows that repeat a ``doc_id`` with another text are documents of their own, ordered by the
hash of the text (``doc_id`` must be a number); rows equal in ``doc_id`` and text are one document and come back once. The next
document of a single document is itself. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import materialize, partitions, text_or_empty
from tabforge.llm.quality import bound

#: Everything else is part of a term.
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


#: Ranges of ``doc_id`` for each shuffle partition; they even out.
RANGES_PER_PARTITION = 8


@dataclass(frozen=True)
class Band:
    """Terms with more than ``1 / max_terms`` of all (document, term) pairs, in two documents at
    least and in at most the share ``high`` of them."""

    high: float = 0.1
    max_terms: int = 1 << 18
    subsets: int = 32


def terms(text: Column) -> Column:
    """64-bit hashes of the distinct lower-case terms of a text."""
    found = F.filter(F.split(F.lower(text), NO_TERM), lambda t: t != "")
    return F.array_distinct(F.transform(found, lambda t: F.xxhash64(t)))


def slot(term: Column, band: Band) -> Column:
    """Place of a term in the lexicon's table, from 1."""
    return (term.bitwiseAND(F.lit(band.max_terms // 2 - 1)) + 1).cast("int")


def fit_lexicon(docs: DataFrame, band: Band, text: str = "text") -> DataFrame:
    """(term) of the band, counted over all documents."""
    listed = docs.select(F.explode(terms(text_or_empty(text))).alias("term"))
    counted = materialize(listed.groupBy("term").agg(F.count("*").alias("df")), "imatch-counts")
    pairs, n_docs = counted.agg(F.sum("df")).first()[0] or 0, docs.count()
    kept = (F.col("df") > 1) & (F.col("df") * band.max_terms > pairs) & (F.col("df") <= band.high * n_docs)
    return materialize(counted.filter(kept).select("term"), "imatch-lexicon")


def lexicon_table(lexicon: DataFrame, band: Band) -> Column:
    """The lexicon as one constant, an array of ``max_terms / 2`` short arrays by ``slot``. Its fewer than
    ``max_terms`` numbers pass through the driver, which writes them as text that Spark parses once."""
    rows = lexicon.groupBy(slot(F.col("term"), band).alias("slot")).agg(F.collect_list("term").alias("terms")).collect()
    slots: list[list[int]] = [[] for _ in range(band.max_terms // 2)]
    for row in rows:
        slots[row["slot"] - 1] = row["terms"]
    return F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<array<bigint>>")


def fingerprint(found: Column, bare: Column, table: Column, band: Band) -> Column:
    """Struct of a text's level, its hashes there and at the next level (0: subset without a term), and
    a hash of the whole text for one without lexicon terms, from its terms and its own hash ``bare``."""
    kept = F.sort_array(F.filter(found, lambda t: F.array_contains(F.element_at(table, slot(t, band)), t)))
    none = F.array().cast("array<bigint>")

    def at(ts: Column, level: Column) -> Column:
        """Hashes of the subsets at one level."""
        two = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))
        rounds = F.sequence(F.lit(0), F.greatest(F.lit(1), (F.lit(band.subsets) / two(level)).cast("int")) - 1)

        def cut(r: Column, size: Column) -> Column:
            """(subset, term) of one random cut."""
            placed = F.transform(ts, lambda t: F.struct((r * size + F.xxhash64(t, r).bitwiseAND(size - 1)).alias("s"), t.alias("t")))
            return F.filter(placed, lambda e: e["s"] < band.subsets)

        def hashed(subset: Column) -> Column:
            return F.when(F.size(subset) == 0, F.lit(0).cast("long")).otherwise(
                F.xxhash64(F.transform(subset, lambda e: e["t"])).bitwiseAND(F.lit((1 << 32) - 1))
            )

        entries = bound(two(level), lambda size: F.flatten(F.transform(rounds, lambda r: cut(r, size))))
        every = F.sequence(F.lit(0), F.lit(band.subsets - 1))
        return bound(entries, lambda es: F.transform(every, lambda s: bound(F.filter(es, lambda e: e["s"] == s), hashed)))

    def made(f: Column) -> Column:
        level, ts = f["level"], f["terms"]
        worded = lambda hashes: F.when(level < 0, none).otherwise(hashes)
        whole = F.when(F.size(found) == 0, bare).otherwise(F.xxhash64(F.sort_array(found)))
        return F.struct(
            level.alias("level"),
            worded(at(ts, F.greatest(level, F.lit(0)))).alias("here"),
            worded(at(ts, level + 1)).alias("next"),
            F.when(level < 0, whole).alias("whole"),
        )

    def levelled(ts: Column) -> Column:
        level = F.when(F.size(ts) > 0, F.floor(F.log2(F.size(ts))).cast("int")).otherwise(F.lit(-1))
        return bound(F.struct(ts.alias("terms"), level.alias("level")), made)

    return bound(kept, levelled)


def as_text(print_: Column) -> Column:
    """A fingerprint as a string: level, then the hashes of both levels."""
    row = lambda hashes: F.array_join(
        F.transform(hashes, lambda x: F.when(x == 0, F.lit("")).otherwise(F.lower(F.hex(x)))), "."
    )
    return F.when(print_["level"] < 0, F.concat(F.lit("whole:"), F.lower(F.hex(print_["whole"])))).otherwise(
        F.concat_ws(":", print_["level"].cast("string"), row(print_["here"]), row(print_["next"]))
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that hold a term of either text, at the finest level that
    both fingerprints have; 0 where they have none in common."""
    level = F.least(a["level"], b["level"]) + 1
    at = lambda p: F.when(p["level"] == level, p["here"]).otherwise(p["next"])

    def share(z: Column) -> Column:
        held = F.size(F.filter(z, lambda e: (e["x"] != 0) | (e["y"] != 0)))
        equal = F.size(F.filter(z, lambda e: (e["x"] != 0) & (e["x"] == e["y"])))
        # Equal fingerprints whose finer subsets hold no term.
        same = (a["level"] == b["level"]) & (a["here"] == b["here"])
        return F.when(held > 0, equal / held).otherwise(same.cast("double"))

    return (
        F.when((a["level"] < 0) & (b["level"] < 0), (a["whole"] == b["whole"]).cast("double"))
        .when((a["level"] < 0) | (b["level"] < 0) | (F.abs(a["level"] - b["level"]) > 1), F.lit(0.0))
        .otherwise(bound(F.arrays_zip(at(a).alias("x"), at(b).alias("y")), share))
    )


def range_of(value: Column, bounds: list) -> Column:
    """Number of the sorted ``bounds`` that are greater than ``value``, by binary search; null counts as smallest."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])

    def halve(at: Column, _: Column) -> Column:
        middle = F.call_function("div", at["lo"] + at["hi"], F.lit(2)).cast("int")
        below = F.element_at(table, middle + 1) <= value
        more = at["lo"] < at["hi"]
        return F.struct(
            F.when(more & below, middle + 1).otherwise(at["lo"]).alias("lo"),
            F.when(more & ~below, middle).otherwise(at["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    found = F.aggregate(steps, start, halve, lambda at: F.lit(len(bounds)) - at["lo"])
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise(found)


def edited_texts(docs: DataFrame) -> DataFrame:
    """(_k, doc_id, n, next_k, text, edited) of ``docs`` (doc_id, text): the last ``n div 2`` code points
    replaced by the first as many of the next document.

    Texts are shuffled once, by ranges of ``doc_id``; inside a range a window brings each row the
    next one, and the first row of each range (one row a range) goes to the range before.
    """
    key = F.concat_ws(":", F.hex(F.xxhash64("text")), F.col("doc_id").cast("string"))
    keyed = docs.select("doc_id", text_or_empty().alias("text")).withColumn("_k", key)
    ranges = RANGES_PER_PARTITION * partitions(docs.sparkSession)
    cuts = F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)
    bounds = sorted(set(keyed.agg(cuts).first()[0] or []))
    dealt = keyed.withColumn("_range", range_of(F.col("doc_id"), bounds))
    order = [F.desc_nulls_last("doc_id"), F.asc("_k")]
    # The first row of every range, then its text.
    heads = dealt.groupBy("_range").agg(F.min(F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), "_k"))["_k"].alias("_k"))
    heads = materialize(heads, "imatch-heads")
    first_rows = materialize(keyed.join(heads, "_k").select("_range", "_k", "text").dropDuplicates(["_range"]), "imatch-firsts")
    names = [r["_range"] for r in heads.select("_range").orderBy("_range").collect()]  # one number a range
    before = dict(zip(names, [*names[-1:], *names[:-1]], strict=True))
    taken = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("_range")] if before else F.lit(0)
    later = first_rows.select(taken.alias("_range"), F.col("_k").alias("_head_k"), F.col("text").alias("_head"))
    inside = Window.partitionBy("_range").orderBy(*order)
    placed = dealt.repartition(partitions(docs.sparkSession), "_range")
    once = placed.withColumn("_same", F.lag("_k").over(inside)).filter(F.col("_same").isNull() | (F.col("_same") != F.col("_k")))
    led = once.select("*", F.lead("_k").over(inside).alias("_next_k"), F.lead("text").over(inside).alias("_next"))
    both = led.join(later, "_range").select(
        "_k", "doc_id", "text", F.length("text").alias("n"),
        F.coalesce("_next_k", "_head_k").alias("next_k"), F.when(F.col("_next_k").isNull(), F.col("_head")).otherwise(F.col("_next")).alias("_next"),
    )
    half = F.expr("n div 2").cast("int")
    return both.withColumn("edited", F.concat(F.left("text", F.col("n") - half), F.left("_next", half))).drop("_next")


def fingerprints(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """Per document (doc_id, text): ``n_chars``, ``edited_sha256``, both fingerprints as structs and as
    strings, and their likeness to the edited text's and to the next document's."""
    table = lexicon_table(fit_lexicon(docs, band), band)
    sides = (("text", "own"), ("edited", "edited"))
    worded = edited_texts(docs).select(
        "_k", "doc_id", "n", "next_k", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
        *[terms(F.col(c)).alias(side) for c, side in sides],
        *[F.xxhash64(c).alias(f"{side}_bare") for c, side in sides],
    )
    made = materialize(
        worded.select(
            "_k", "doc_id", "n", "next_k", "sha",
            *[fingerprint(F.col(s), F.col(f"{s}_bare"), table, band).alias(f"{s}_print") for _, s in sides],
        ),
        "imatch-prints",
    )
    following = made.select(F.col("_k").alias("next_k"), F.col("own_print").alias("next_print"))
    return made.join(following, "next_k").select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        as_text(F.col("own_print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("own_print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("own_print"), F.col("next_print")).alias("near_next"),
    )


def op12_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
