"""N-gram Jaccard join with adaptive multi-match prefixes.

Exact links between documents whose sets of word shingles have a Jaccard similarity of at least
``num / den``:

1. Equal sets are one class; only classes are joined. A first pass over all texts also counts
   how many sets hold a shingle, in a table of fixed size (the counts of a slot's shingles add up).
2. The shingles of a set are ordered by that count, rarest first. Similar sets share at least
   ``l`` of their ``l``-prefixes (``size - least overlap + l`` shingles), for every ``l``. Each set
   takes an ``l`` that grows with its prefix and with its estimated candidate cost, the counts in
   its prefix; a pair must share as many shingles of the prefixes that its two sizes leave before
   it is verified, and a set that shares too few shingles with any other leaves at once. Parity
   bits of the whole sets bound their difference from below and spare most verifications.
3. Groups of near copies are linked first through one member each: sets that share one of their
   first shared shingles are verified against the smallest of them, then, round after round, against other members of
   the largest component of their shingles, as long as that joins components. Only prefix shingles that still lie
   in several components make pairs, and only between different components; every member of the
   components that are not the shingle's largest is paired with the others. Verification intersects
   the whole sets.
4. Components come from the links by contraction.

Cases: a null text is empty; documents without words have an empty set and no link; a text with
fewer words than a shingle has its whole word sequence as its one shingle; rows without
``doc_id`` take no part and get a null component; rows of one ``doc_id`` are linked by their own
texts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.bytehash import blocks_of, group_sizes, shingle_set, word_hashes
from tabforge.llm.common import materialize, mix, partitions
from tabforge.llm.components import connected_components

#: Slots of the shingle counts (the table that is broadcast: eight megabytes at any input size).
SLOTS = 1 << 21
SLOT_BLOCK = 1 << 15
#: Merging groups of the count tables of single tasks.
MERGE_GROUPS = 64
#: A set asks for one more shared shingle per so many prefix shingles, up to a limit, and for up
#: to EXTRA_MATCH more if its prefix is costly.
PREFIX_PER_MATCH = 6
MAX_MATCH = 16
EXTRA_MATCH = 3
#: A shingle with more sets than this in one batch of prefixes counts as frequent.
FREQUENT = 64
#: First shared shingles of each set through which near copies find their common member.
HUB_KEYS = 3
#: Rounds of common members end when more than this share of the rows stays outside the largest components.
LEAST_FALL = 0.8
#: Words of the parity bits of a set: every shingle flips one of 64 * PARITY_WORDS bits, so two
#: sets differ in at least as many shingles as their bits differ.
PARITY_WORDS = 16
PARITY = [f"b{i}" for i in range(PARITY_WORDS)]
#: Stands for a missing ``doc_id`` inside the join.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; similarity of at least ``num / den``."""

    words: int = 5
    num: int = 8
    den: int = 10

    def prefix(self, size: int, match: int) -> int:
        """Length of the ``match``-prefix of a set of ``size``."""
        least = -(-self.num * size // self.den)
        return min(size, size - least + match)

    def match(self, size: int) -> int:
        """Shared prefix shingles that sets of this size ask for at least; grows with the size."""
        return max(1, min(MAX_MATCH, 1 + self.prefix(size, 1) // PREFIX_PER_MATCH))

    def least_match(self, size: int) -> int:
        """What the smallest set that is similar to one of this size asks for at least."""
        return self.match(-(-self.num * size // self.den))

    def can_differ(self, size: int) -> bool:
        """Whether a different set can be similar to one of ``size`` (at best one shingle more)."""
        return self.num * (size + 1) <= self.den * size


def set_class(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def text_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    for _, block in blocks_of(t.encode() for t in texts):
        hashes, counts = word_hashes(block)
        for part in np.split(hashes, np.cumsum(counts)[:-1]):
            yield shingle_set(part, words)


PROFILE = "doc_id long, n_shingles long, cls binary, slot int, counts array<int>"


def profile(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per document (size and class of its set) and, with a null class, the shingle
    counts of each task in blocks of slots."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(SLOTS, dtype=np.int32)
        for batch in batches:
            sets = list(text_sets(batch["text"].tolist(), rule.words))
            slots = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]) % np.uint64(SLOTS)
            counts += np.bincount(slots.astype(np.int64), minlength=SLOTS).astype(np.int32)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": [len(x) for x in sets],
                    "cls": [set_class(x) for x in sets],
                    "slot": -1,
                    "counts": None,
                }
            )
        blocks = range(0, SLOTS, SLOT_BLOCK)
        yield pd.DataFrame(
            {
                "doc_id": np.zeros(len(blocks), dtype=np.int64),
                "n_shingles": np.zeros(len(blocks), dtype=np.int64),
                "cls": None,
                "slot": list(blocks),
                "counts": pd.Series([counts[b : b + SLOT_BLOCK] for b in blocks], dtype=object),
            }
        )

    return docs.mapInPandas(scan, PROFILE)


def shingle_counts(profiled: DataFrame) -> np.ndarray:
    """The tasks' count tables, added up in two steps."""

    def merge(batch: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(batch["counts"].tolist(), axis=0, dtype=np.int64)
        return pd.DataFrame({"slot": [batch["slot"].iloc[0]], "counts": pd.Series([total], dtype=object)})

    tables = profiled.filter(F.col("cls").isNull()).select("slot", "counts")
    dealt = tables.withColumn("_g", F.pmod(F.monotonically_increasing_id(), F.lit(MERGE_GROUPS)))
    partial = dealt.groupBy("slot", "_g").applyInPandas(merge, "slot int, counts array<long>")
    rows = partial.groupBy("slot").applyInPandas(merge, "slot int, counts array<long>").collect()  # SLOTS numbers
    total = np.zeros(SLOTS, dtype=np.int64)
    for row in rows:
        total[row["slot"] : row["slot"] + SLOT_BLOCK] = row["counts"]
    return np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)


PREFIXES = "cls binary, n int, l int, tokens array<long>, parity array<long>"


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    bits = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % (64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def least_difference(left: str, right: str) -> Column:
    """A lower bound on the shingles that are in one of two sets only."""
    return reduce(add, (F.bit_count(F.col(left + b).bitwiseXOR(F.col(right + b))) for b in PARITY))


def may_be_similar(left: str, right: str, rule: Rule) -> Column:
    """Whether the sizes and parity bits of two sets allow the similarity."""
    x, y = F.col(left + "n"), F.col(right + "n")
    overlap = F.ceil(rule.num * (x + y) / (rule.num + rule.den))
    sizes = rule.den * F.least(x, y) >= rule.num * F.greatest(x, y)
    return sizes & (least_difference(left, right) <= x + y - 2 * overlap)


def prefixes(docs: DataFrame, counts: np.ndarray, rule: Rule) -> DataFrame:
    """One row per class and task: size, number of matches it asks for, prefix shingles in order."""
    usual = max(1.0, float(np.median(counts)))
    table = docs.sparkSession.sparkContext.broadcast(counts)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = table.value
        for batch in batches:
            seen: dict[bytes, tuple] = {}
            for shingles in text_sets(batch["text"].tolist(), rule.words):
                size = len(shingles)
                if not rule.can_differ(size):
                    continue
                cls = set_class(shingles)
                if cls in seen:
                    continue
                cost = held[(shingles % np.uint64(SLOTS)).astype(np.int64)]
                order = np.lexsort((shingles, cost))
                excess = np.maximum(cost[order[: rule.prefix(size, 1)]] / usual - 1.0, 0.0).sum()
                match = rule.match(size) + min(EXTRA_MATCH, int(np.log2(1.0 + excess)))
                match = max(1, min(match, size - rule.prefix(size, 1) + 1))
                prefix = shingles[order[: rule.prefix(size, match)]].view(np.int64)
                seen[cls] = (size, match, prefix, parity_bits(shingles))
            yield pd.DataFrame(
                {
                    "cls": list(seen),
                    "n": np.array([s[0] for s in seen.values()], dtype=np.int32),
                    "l": np.array([s[1] for s in seen.values()], dtype=np.int32),
                    "tokens": pd.Series([s[2] for s in seen.values()], dtype=object),
                    "parity": pd.Series([s[3] for s in seen.values()], dtype=object),
                }
            )

    once = docs.select("text").mapInPandas(scan, PREFIXES).dropDuplicates(["cls"])
    return once.withColumn("id", F.monotonically_increasing_id())


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_sb"))
    shared = F.size(F.array_intersect("_sa", "_sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("_shared", shared)
    union = F.size("_sa") + F.size("_sb") - F.col("_shared")
    return both.filter(rule.den * F.col("_shared") >= rule.num * union).select("a", "b")


def needed_sets(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(id, shingles) of the wanted (id, cls, doc_id), from the text of each class's first
    document. The join brings repeated rows of a document to one task, which keeps one of them."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for batch in batches:
            ids, kept = [], []
            sets = text_sets(batch["text"].tolist(), rule.words)
            for i, cls, shingles in zip(batch["id"].tolist(), batch["cls"], sets, strict=True):
                if i not in done and set_class(shingles) == bytes(cls):
                    done.add(i)
                    ids.append(i)
                    kept.append(shingles.view(np.int64))
            yield pd.DataFrame({"id": np.array(ids, dtype=np.int64), "shingles": pd.Series(kept, dtype=object)})

    texts = docs.join(wanted, "doc_id").select("id", "cls", "text")
    return texts.mapInPandas(scan, "id long, shingles array<long>")


def hub_pairs(tokens: DataFrame, traits: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of each set with the smallest one that has one of its first shared shingles there
    too, if sizes and parity bits allow a link."""
    order = Window.partitionBy("id").orderBy("i")  # one set's prefix
    heads = tokens.select("id", "token", F.row_number().over(order).alias("_k")).filter(F.col("_k") <= HUB_KEYS)
    hubs = heads.groupBy("token").agg(F.min("id").alias("b"))
    pairs = heads.join(hubs, "token").filter(F.col("id") != F.col("b")).select(F.col("id").alias("a"), "b").distinct()
    kept = pairs.join(prefixed(traits, "x_", "a"), "a").join(prefixed(traits, "y_", "b"), "b")
    return kept.filter(may_be_similar("x_", "y_", rule)).select("a", "b")


def prefixed(traits: DataFrame, prefix: str, key: str) -> DataFrame:
    return traits.select(F.col("id").alias(key), *[F.col(c).alias(prefix + c) for c in ("n", *PARITY)])


def mixed_tokens(tokens: DataFrame, roots: DataFrame) -> DataFrame:
    """Prefix shingles that lie in several components, with the component of each row and the shingle's
    largest one (``major``)."""
    named = roots.withColumnRenamed("node", "id")
    placed = tokens.join(named, "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = materialize(placed, "jaccard-placed")
    sizes = placed.groupBy("token", "root").agg(F.count("*").alias("_n"))
    mixed = (
        sizes.groupBy("token")
        .agg(F.count("*").alias("_roots"), F.max_by("root", F.struct("_n", "root")).alias("major"))
        .filter(F.col("_roots") > 1)
        .select("token", "major")
    )
    return materialize(placed.join(mixed, "token"), "jaccard-mixed")


def major_pairs(mixed: DataFrame, traits: DataFrame, rule: Rule, number: int) -> DataFrame:
    """Pairs of each set outside the largest component of some of its shingles with one member of that component,
    another one each round, if sizes and parity bits allow a link."""
    drawn = F.xxhash64("id", "token", F.lit(number))
    members = mixed.filter(F.col("root") == F.col("major")).groupBy("token").agg(F.min_by("id", drawn).alias("b"))
    order = Window.partitionBy("id").orderBy(F.xxhash64("token", F.lit(number)))  # one set's prefix
    outside = mixed.filter(F.col("root") != F.col("major")).select("id", "token", F.row_number().over(order).alias("_k"))
    pairs = outside.filter(F.col("_k") <= HUB_KEYS).join(members, "token").select(F.col("id").alias("a"), "b").distinct()
    kept = pairs.join(prefixed(traits, "x_", "a"), "a").join(prefixed(traits, "y_", "b"), "b")
    return kept.filter(may_be_similar("x_", "y_", rule)).select("a", "b")


def cross_pairs(mixed: DataFrame, traits: DataFrame, rule: Rule) -> DataFrame:
    """Candidate pairs of different components that share enough prefix shingles."""
    rows = materialize(mixed.drop("n").join(traits, "id"), "jaccard-rows")
    sides = ("id", "root", "n", "l", "i", *PARITY)
    x = rows.filter(F.col("root") != F.col("major")).select("token", *[F.col(c).alias(f"x_{c}") for c in sides])
    y = rows.select("token", "major", *[F.col(c).alias(f"y_{c}") for c in sides])
    match = F.least("x_l", "y_l")
    # Similar sets of these sizes overlap in so many shingles; each one's prefix for that.
    overlap = F.ceil(rule.num * (F.col("x_n") + F.col("y_n")) / (rule.num + rule.den))
    found = x.join(y, "token").filter(
        (F.col("x_root") != F.col("y_root"))
        # Two sets outside the major component meet twice; one of the two counts.
        & ((F.col("y_root") == F.col("major")) | (F.col("x_id") < F.col("y_id")))
        & (F.col("x_i") < F.col("x_n") - overlap + match)
        & (F.col("y_i") < F.col("y_n") - overlap + match)
        & may_be_similar("x_", "y_", rule)
    )
    # Which side is outside the major component differs by shingle: count both orders together.
    return (
        found.groupBy(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"))
        .agg(F.count("*").alias("_shared"), F.first(match).alias("_match"))
        .filter(F.col("_shared") >= F.col("_match"))
        .select("a", "b")
    )


def joined_components(tokens: DataFrame, traits: DataFrame, sets: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Links through common members, round after round, until few new ones come: the links, and the shingles that
    still lie in several components."""
    links = materialize(verified(hub_pairs(tokens, traits, rule), sets, rule), "jaccard-near")
    number, before = 0, None
    while True:
        mixed = mixed_tokens(tokens, connected_components(links))
        outside = mixed.filter(F.col("root") != F.col("major")).count()
        # Rounds go on while they take away a fifth of the rows that would make pairs.
        if outside == 0 or (before is not None and outside > LEAST_FALL * before):
            return links, mixed
        number, before = number + 1, outside
        found = materialize(verified(major_pairs(mixed, traits, rule, number), sets, rule), "jaccard-near")
        links = links.unionByName(found)


ENTRIES = "pid int, kind int, token array<long>, id array<long>, p array<long>"
TOKENS = "token long, id long, p long"
ENTRY, SHARED, MARK = 0, 1, 2


def token_entries(pids: int):
    """The prefix shingles of a batch, dealt by shingle. Frequent ones are known to be shared:
    their entries are dealt evenly, and a mark tells it to the shingle's partition."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            size = batch["tokens"].map(len).to_numpy()
            token = np.concatenate(batch["tokens"].tolist()).astype(np.int64)
            owner = np.repeat(np.arange(len(batch)), size)
            place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
            ids = batch["id"].to_numpy()[owner]
            # Size, place and matches travel as one number.
            p = (batch["n"].to_numpy().astype(np.int64)[owner] << 32) | (place << 8) | batch["l"].to_numpy()[owner]
            frequent = group_sizes(token) > FREQUENT
            told = np.unique(token[frequent])
            yield dealt_by(pids, ENTRY, token[~frequent], token[~frequent], ids[~frequent], p[~frequent])
            yield dealt_by(pids, SHARED, ids[frequent] + place[frequent], token[frequent], ids[frequent], p[frequent])
            yield dealt_by(pids, MARK, told, told, told, told)

    return emit


def dealt_by(pids: int, kind: int, by: np.ndarray, *columns: np.ndarray) -> pd.DataFrame:
    """Entries grouped by the partition number of ``by``, as one row of arrays each."""
    pid = mix(by.view(np.uint64)) % np.uint64(pids)
    order = np.argsort(pid, kind="stable")
    pid = pid[order]
    cuts = np.flatnonzero(np.r_[True, pid[1:] != pid[:-1]][: len(pid)])
    split = [pd.Series(np.split(c[order], cuts[1:]) if len(cuts) else [], dtype=object) for c in columns]
    return pd.DataFrame(
        {"pid": pid[cuts].astype(np.int32), "kind": np.full(len(cuts), kind, dtype=np.int32)}
        | dict(zip(("token", "id", "p"), split, strict=True))
    )


def keep_shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of one partition of shingles, the entries of those that several sets hold."""
    held: dict[int, list] = {ENTRY: [], MARK: []}
    for batch in batches:
        for kind, *row in batch[["kind", "token", "id", "p"]].itertuples(index=False):
            arrays = [np.asarray(x, dtype=np.int64) for x in row]
            if kind == SHARED:
                yield pd.DataFrame(dict(zip(("token", "id", "p"), arrays, strict=True)))
            else:
                held[kind].append(arrays)
    if held[ENTRY]:
        token, ids, p = (np.concatenate(x) for x in zip(*held[ENTRY], strict=True))
        shared = group_sizes(token) > 1
        if held[MARK]:
            shared |= np.isin(token, np.concatenate([x[0] for x in held[MARK]]))
        yield pd.DataFrame({"token": token[shared], "id": ids[shared], "p": p[shared]})


def shared_tokens(found: DataFrame, rule: Rule) -> DataFrame:
    """Prefix shingles that several sets hold: (token, id, i, n, l), ``i`` the place in the
    prefix. Sets that share fewer shingles than any partner would ask for are gone."""
    parts = partitions(found.sparkSession)
    entries = found.select("id", "n", "l", "tokens").mapInPandas(token_entries(16 * parts), ENTRIES)
    shared = materialize(entries.repartition(parts, "pid").mapInPandas(keep_shared, TOKENS), "jaccard-shared")
    n = F.shiftright("p", 32).cast("int")
    least = F.ceil(n * rule.num / rule.den).cast("int")
    smallest = F.ceil(least * rule.num / rule.den).cast("int")
    asked = F.least(F.lit(MAX_MATCH), 1 + F.floor((least - smallest + 1) / PREFIX_PER_MATCH))
    open_sets = shared.groupBy("id").agg(F.count("*").alias("_shared"), F.first(asked).alias("_asked"))
    open_sets = open_sets.filter(F.col("_shared") >= F.col("_asked")).select("id")
    place = F.shiftright("p", 8).bitwiseAND(F.lit((1 << 24) - 1)).cast("int")
    return (
        shared.join(open_sets, "id")
        .withColumns({"n": n, "i": place, "l": F.col("p").bitwiseAND(F.lit(255)).cast("int")})
        .drop("p")
    )


def similar_classes(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Documents as (doc_id, n_shingles, cls), and (cls, component_id) of every class."""
    plain = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    profiled = materialize(profile(plain, rule), "jaccard-profile")
    members = profiled.filter(F.col("cls").isNotNull()).select("doc_id", "n_shingles", "cls")
    usable = members.filter((F.col("n_shingles") > 0) & (F.col("doc_id") != NO_ID))
    classes = usable.groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    plain = plain.filter(F.col("doc_id") != NO_ID)
    found = materialize(prefixes(plain, shingle_counts(profiled), rule), "jaccard-prefixes")
    tokens = materialize(shared_tokens(found, rule), "jaccard-tokens")
    named = materialize(classes.join(found.select("cls", "id"), "cls", "left"), "jaccard-classes")
    wanted = named.join(tokens.select("id").distinct(), "id", "left_semi")
    sets = materialize(needed_sets(plain, wanted, rule), "jaccard-sets")
    traits = found.select("id", "n", *[F.element_at("parity", i + 1).alias(b) for i, b in enumerate(PARITY)])
    near, mixed = joined_components(tokens, traits, sets, rule)
    rest = verified(cross_pairs(mixed, traits, rule), sets, rule)
    roots = connected_components(near.unionByName(rest)).withColumnRenamed("node", "id")
    rooted = named.join(roots, "id", "left")
    # Linked classes take their component's smallest document, the others their own.
    linked = rooted.filter(F.col("root").isNotNull())
    first = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = linked.join(first, "root").select("cls", "component_id")
    alone = rooted.filter(F.col("root").isNull()).select("cls", F.col("doc_id").alias("component_id"))
    return members, placed.unionByName(alone)


def jaccard_components(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``."""
    members, components = similar_classes(docs, rule)
    own_id = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    # Empty sets link with nothing: each such document is a component of its own.
    empty = members.filter((F.col("n_shingles") == 0) | (F.col("doc_id") == NO_ID))
    worded = members.filter((F.col("n_shingles") > 0) & (F.col("doc_id") != NO_ID)).join(components, "cls")
    columns = ["doc_id", "n_shingles", "component_id"]
    return worded.select(*columns).unionByName(empty.select(own_id.alias("doc_id"), "n_shingles", own_id.alias("component_id")))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, Rule(words=3, num=90, den=100))
