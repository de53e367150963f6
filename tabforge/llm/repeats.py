"""Exact removal of long repeats by suffix buckets that are refined with bucket pointers.

A string of ``LENGTH`` bytes that also starts earlier is removed. Every string is sorted into
buckets, coarse ones first, and only what is still undecided is refined:

1. Initial buckets are q-grams. Of the q-grams inside a string, the one with the smallest bucket
   number points to the string (neighbouring strings share their pointer, so a run of strings
   costs one entry). Equal strings have equal pointers: a bucket with one entry is done.
2. Buckets are refined by the bucket numbers at later offsets over the run's whole extent. All
   but the first entry of a refined bucket repeat it; a first entry whose q-gram bucket holds
   other entries too stays undecided.
3. The undecided runs' single strings are refined by the bucket numbers at the offsets 25, 50
   and 75, recursively reusing those of shorter strings. All but the first of such a bucket are
   repeats.

Buckets are dealt to partitions by their number. Each task first reduces equal entries of its own
texts to the first; a q-gram that is frequent in a task skips step 2, and its strings are dealt
one by one, so that no bucket gathers an unbounded number of entries. Bucket numbers have 64
bits and are compared together with the q-gram's own number.

Cases: a null text is empty; the order of texts is that of ``doc_id``, null first; rows with equal
``doc_id`` and text count as one document and get the same result; texts shorter than ``LENGTH``
keep all bytes; an empty table gives an empty result; extra columns are ignored by the removal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.bytehash import BYTE_VALUE, blocks_of, group_sizes, refine
from tabforge.llm.common import U64, materialize, mix, partitions, runs_to_spans

LENGTH = 100
#: The q-gram of the initial buckets; four of them make a string of LENGTH bytes.
GRAM = 25
#: Strings that may point to one q-gram.
REACH = LENGTH - GRAM + 1
#: Longer texts are cut into overlapping segments of so many string starts.
SEGMENT = 1 << 22
PLACE_BITS = 24
#: Bytes hashed at once; the working arrays stay in the processor's cache.
BLOCK = 1 << 17
#: A q-gram with more distinct surroundings than this in one block skips step 2.
FREQUENT = 64
NULL_ID = -(1 << 63)

ENTRIES = "pid int, kind int, a array<long>, b array<long>, doc array<long>, at array<long>"
#: Kinds: a repeated run, an undecided run (SPREAD: of a frequent q-gram), the mark of a frequent
#: q-gram, and an entry that step 2 decides.
REPEATED, UNDECIDED, SPREAD, MARK, ENTRY = 0, 1, 2, 3, 4


def gram_buckets(raw: np.ndarray) -> np.ndarray:
    """Bucket number of the q-gram at each offset, built from those of shorter strings."""
    one = BYTE_VALUE[raw]
    two = refine(one[:-1], one[1:])
    four = refine(two[:-2], two[2:])
    eight = refine(four[:-4], four[4:])
    sixteen = refine(eight[:-8], eight[8:])
    n = len(raw) - GRAM + 1
    return refine(refine(sixteen[:n], eight[16 : 16 + n]), one[24 : 24 + n])


def string_buckets(grams: np.ndarray) -> np.ndarray:
    """Bucket number of the LENGTH-byte string at each offset, from the bucket pointers of its
    later offsets."""
    n = len(grams) - (LENGTH - GRAM)
    half = refine(grams[: n + 2 * GRAM], grams[GRAM : n + 3 * GRAM])
    return refine(half[:n], half[2 * GRAM :])


def pointers(grams: np.ndarray) -> np.ndarray:
    """For each string start, the offset of the smallest bucket number among its q-grams (the
    leftmost of equals)."""
    place = np.uint64((1 << PLACE_BITS) - 1)
    key = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= REACH:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < REACH:
        key = np.minimum(key[: len(key) - (REACH - width)], key[REACH - width :])
    return (key & place).astype(np.int64)


def segments(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Blocks of text segments with each segment's text and its offset there."""
    parts, owner, base = [], [], []
    for i, raw in enumerate(texts):
        for at in range(0, max(0, len(raw) - LENGTH + 1), SEGMENT):
            parts.append(raw[at : at + SEGMENT + LENGTH - 1])
            owner.append(i)
            base.append(at)
    for first, block in blocks_of(parts, BLOCK):
        at = slice(first, first + len(block))
        yield block, np.array(owner[at], dtype=np.int64), np.array(base[at], dtype=np.int64)


def string_runs(block: list[bytes]):
    """Of a block of segments: gram buckets, string buckets, and the runs of neighbouring strings
    with one pointer: (first start, strings, pointer, segment)."""
    raw = np.frombuffer(b"".join(block), dtype=np.uint8)
    sizes = np.fromiter(map(len, block), dtype=np.int64, count=len(block))
    grams = gram_buckets(raw)
    strings = string_buckets(grams)
    point = pointers(grams)
    begin = np.cumsum(sizes) - sizes
    inside = np.ones(len(point), dtype=bool)
    for at in (begin + sizes - LENGTH + 1)[:-1].tolist():
        inside[at : at + LENGTH - 1] = False
    change = np.r_[True, point[1:] != point[:-1]]
    change[begin] = True
    change &= inside
    first = np.flatnonzero(change)
    stop = np.r_[first[1:], len(point)]
    segment = np.searchsorted(begin, first, "right") - 1
    count = np.minimum(stop, begin[segment] + sizes[segment] - LENGTH + 1) - first
    return grams, strings, first, count, point[first], segment, begin


def packed_at(lo: np.ndarray, n: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Start (32 bits), strings of the run (8 bits) and text fingerprint (24 bits) in one number."""
    return (lo << 32) | (n << 24) | mark


def first_of_equal(a: np.ndarray, b: np.ndarray, doc: np.ndarray, at: np.ndarray):
    """Indexes of the first entry (by doc, then place) of each bucket (a, b), and of the entries
    that repeat it. An entry at the very place of the first is the same string, and in neither."""
    key = refine(a.view(np.uint64), b.view(np.uint64))
    order = np.argsort(key)
    sorted_key = key[order]
    head = np.r_[True, sorted_key[1:] != sorted_key[:-1]][: len(key)]
    group = np.cumsum(head) - 1
    alone = (np.bincount(group) == 1)[group] if len(key) else head
    some = order[~alone]
    some = some[np.lexsort((at[some], doc[some], b[some], a[some]))]
    sa, sb, sd, lo = a[some], b[some], doc[some], at[some] >> 32
    head = np.r_[True, (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])][: len(some)]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(some)), 0))
    repeat = ~head & ((sd != sd[lead]) | (lo != lo[lead]))
    return np.concatenate([order[alone], some[head]]), some[repeat]


def dealt(kind: int, by: np.ndarray, a, b, doc, at, pids: int) -> pd.DataFrame:
    """Entries grouped by the partition number of ``by``; decided ones need no buckets."""
    pid = mix(by.view(np.uint64)) % U64(pids)
    order = np.argsort(pid, kind="stable")
    pid = pid[order]
    cuts = np.flatnonzero(np.r_[True, pid[1:] != pid[:-1]]) if len(pid) else np.zeros(0, dtype=np.int64)
    lists = lambda x: pd.Series(x, dtype=object)
    split = lambda x: lists(np.split(x[order], cuts[1:]) if len(cuts) else [])
    none = lists([np.zeros(0, dtype=np.int64)] * len(cuts))
    return pd.DataFrame(
        {
            "pid": pid[cuts].astype(np.int32),
            "kind": np.full(len(cuts), kind, dtype=np.int32),
            "a": none if kind == REPEATED else split(a),
            "b": split(b) if kind == ENTRY else none,
            "doc": split(doc) if kind != MARK else none,
            "at": split(at) if kind != MARK else none,
        }
    )


def own_ids(batch: pd.DataFrame) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    return (
        batch["_doc"].to_numpy().astype(np.int64),
        [t.encode() for t in batch["_text"]],
        batch["_mark"].to_numpy().astype(np.int64),
    )


def run_entries(pids: int):
    """Step 1 on a batch of texts: entries for step 2, and what is decided at once."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts, marks = own_ids(batch)
            found = []
            for block, owner, base in segments(texts):
                grams, strings, first, count, point, segment, begin = string_runs(block)
                last = first + count - 1
                extent = refine(refine(strings[first], strings[last]), count.astype(np.uint64))
                lo = first - begin[segment] + base[segment]
                text = owner[segment]
                found.append((grams[point].view(np.int64), extent.view(np.int64), ids[text], packed_at(lo, count, marks[text])))
            if not found:
                continue
            a, b, doc, at = (np.concatenate(x) for x in zip(*found, strict=True))
            first, repeat = first_of_equal(a, b, doc, at)
            frequent = group_sizes(a[first]) > FREQUENT
            often, rest = first[frequent], first[~frequent]
            told = often[np.unique(a[often], return_index=True)[1]]
            for kind, some in ((REPEATED, repeat), (SPREAD, often), (MARK, told), (ENTRY, rest)):
                by = doc if kind < MARK else a
                yield dealt(kind, by[some], a[some], b[some], doc[some], at[some], pids)

    return emit


PLACES = "doc long, mark int, lo int, n int, kind int, bucket long"


def places(kind: int, bucket: np.ndarray | None, doc: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "doc": doc,
            "mark": (at & 0xFFFFFF).astype(np.int32),
            "lo": (at >> 32).astype(np.int32),
            "n": ((at >> 24) & 0xFF).astype(np.int32),
            "kind": np.full(len(doc), kind, dtype=np.int32),
            "bucket": np.zeros(len(doc), dtype=np.int64) if bucket is None else bucket,
        }
    )


def decide_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Step 2 on one partition of buckets: the runs that repeat, and those still undecided."""
    entries: dict[int, list] = {ENTRY: [], MARK: []}
    for batch in batches:
        for kind, *row in batch[["kind", "a", "b", "doc", "at"]].itertuples(index=False):
            a, b, doc, at = (np.asarray(x, dtype=np.int64) for x in row)
            if kind in entries:
                entries[kind].append((a, b, doc, at))
            else:
                yield places(kind, a if kind == SPREAD else None, doc, at)
    if not entries[ENTRY]:
        return
    a, b, doc, at = (np.concatenate(x) for x in zip(*entries[ENTRY], strict=True))
    first, repeat = first_of_equal(a, b, doc, at)
    yield places(REPEATED, None, doc[repeat], at[repeat])
    marked = np.concatenate([x[0] for x in entries[MARK]]) if entries[MARK] else np.zeros(0, dtype=np.int64)
    spread = np.isin(a[first], marked)
    yield places(SPREAD, a[first[spread]], doc[first[spread]], at[first[spread]])
    first = first[~spread]
    first = first[group_sizes(a[first]) > 1]
    yield places(UNDECIDED, a[first], doc[first], at[first])


#: Undecided runs: the bytes of all strings of the run, dealt by the run's q-gram or, for SPREAD
#: runs, string by string.
RUNS = "pid int, doc long, at long, bytes binary"


def run_bytes(pids: int):
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            doc, texts, marks = own_ids(batch)
            pid, owner, at, parts = [], [], [], []
            for i, raw in enumerate(texts):
                lo, hi = run_ranges(batch["_runs"].iloc[i])
                bucket = np.asarray(batch["_buckets"].iloc[i], dtype=np.int64)
                spread = np.asarray(batch["_spread"].iloc[i], dtype=np.int64) > 0
                begin, count = lo[~spread], (hi - lo)[~spread]
                deal = mix(bucket[~spread].view(np.uint64))
                single = [np.arange(a, b) for a, b in zip(lo[spread].tolist(), hi[spread].tolist(), strict=True)]
                if single:
                    alone = np.concatenate(single)
                    hashes = string_buckets(gram_buckets(np.frombuffer(raw, dtype=np.uint8)))[alone]
                    begin, count = np.r_[begin, alone], np.r_[count, np.ones_like(alone)]
                    deal = np.r_[deal, mix(hashes)]
                pid.append((deal % U64(pids)).astype(np.int32))
                at.append(packed_at(begin, count, marks[i]))
                owner.append(np.full(len(begin), doc[i]))
                parts.extend(raw[s : s + n + LENGTH - 1] for s, n in zip(begin.tolist(), count.tolist(), strict=True))
            if pid:
                yield pd.DataFrame(
                    {"pid": np.concatenate(pid), "doc": np.concatenate(owner), "at": np.concatenate(at), "bytes": parts}
                )

    return emit


def decide_strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Step 3 on one partition of undecided runs: the strings that start earlier as well."""
    found, runs = [], 0
    for batch in batches:
        doc, at = batch["doc"].to_numpy(), batch["at"].to_numpy()
        for begin, block in blocks_of(batch["bytes"].tolist(), BLOCK):
            raw = np.frombuffer(b"".join(block), dtype=np.uint8)
            grams = gram_buckets(raw)
            strings = string_buckets(grams)
            own = slice(begin, begin + len(block))
            count = (at[own] >> 24) & 0xFF
            start = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
            run = np.repeat(np.arange(len(block)), count)
            step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            place = start[run] + step
            lo = packed_at((at[own] >> 32)[run] + step, np.ones_like(step), (at[own] & 0xFFFFFF)[run])
            found.append((strings[place].view(np.int64), grams[place].view(np.int64), doc[own][run], lo, runs + run))
            runs += len(block)
    if not found:
        return
    a, b, doc, at, run = (np.concatenate(x) for x in zip(*found, strict=True))
    _, repeat = first_of_equal(a, b, doc, at)
    if len(repeat) == 0:
        return
    # Neighbouring strings of one run make one place again.
    repeat = np.sort(repeat)
    run, at, doc = run[repeat], at[repeat], doc[repeat]
    lo = at >> 32
    head = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (lo[1:] != lo[:-1] + 1)])
    count = np.diff(np.r_[head, len(lo)])
    yield places(REPEATED, None, doc[head], packed_at(lo[head], count, at[head] & 0xFFFFFF))


def run_ranges(runs) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the string starts in a text's list of runs."""
    packed = np.zeros(0, dtype=np.int64) if runs is None else np.asarray(runs, dtype=np.int64)
    return packed >> 8, (packed >> 8) + (packed & 0xFF)


def runs_by_text(found: DataFrame, **also: str) -> DataFrame:
    """The runs of each text as a list (no longer than the text), with lists of other columns."""
    run = F.shiftleft(F.col("lo").cast("long"), 8) + F.col("n")
    lists = [F.collect_list(run).alias("_runs")]
    lists += [F.collect_list(F.expr(value).cast("long")).alias(name) for name, value in also.items()]
    return found.groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark")).agg(*lists)


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id`` and ``text`` as ``_doc`` (the order number) and ``_text``, and the fingerprint
    ``_mark`` that entries carry together with the order number."""
    named = docs.withColumns(
        {"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), "_text": F.coalesce(text, F.lit(""))}
    )
    return named.withColumn("_mark", F.xxhash64("_text").bitwiseAND(F.lit((1 << 24) - 1)).cast("int")).drop("doc_id", text)


def with_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` keyed, plus ``_runs``: the runs of strings that start earlier as well."""
    parts = partitions(docs.sparkSession)
    pids = 16 * parts
    whole = keyed(docs, text)
    entries = whole.select("_doc", "_mark", "_text").mapInPandas(run_entries(pids), ENTRIES).repartition(parts, "pid")
    found = materialize(entries.mapInPandas(decide_runs, PLACES), "repeats-runs")
    undecided = runs_by_text(found.filter(F.col("kind") > REPEATED), _buckets="bucket", _spread=f"int(kind = {SPREAD})")
    # Both joins read all columns of the texts, so that they share one shuffle of them.
    waiting = whole.join(undecided, ["_doc", "_mark"]).mapInPandas(run_bytes(pids), RUNS)
    strings = waiting.repartition(parts, "pid").mapInPandas(decide_strings, PLACES)
    repeated = runs_by_text(found.filter(F.col("kind") == REPEATED).unionByName(strings))
    return whole.join(repeated, ["_doc", "_mark"], "left")


def kept_bytes(raw: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    at = [0, *np.column_stack([start, end]).ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(at[0::2], at[1::2], strict=True))


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``, plus ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept_sha256``. A cut through a character leaves its bytes out of the text
    (they count as kept in the digest)."""
    results = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    columns = [f for f in docs.schema.fields if f.name not in results]

    @F.pandas_udf("text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for t, runs in zip(texts, lists, strict=True):
            raw = t.encode()
            first, last = run_ranges(runs)
            start, end = runs_to_spans(first, last + LENGTH - 1)
            kept = kept_bytes(raw, start, end)
            digest = hashlib.sha256(kept).hexdigest()
            rows.append((kept.decode("utf-8", "ignore"), len(raw), len(raw) - len(kept), len(start), digest))
        return pd.DataFrame(rows, columns=["text", *results])

    whole = with_repeats(docs.select(*[F.col(f"`{f.name}`") for f in columns]), text)
    done = whole.withColumn("_cut", cut("_text", "_runs"))
    doc_id = F.when(F.col("_doc") != NULL_ID, F.col("_doc")).cast(docs.schema["doc_id"].dataType)
    made = {"doc_id": doc_id, text: F.col("_cut.text")}
    return done.select(
        *[made.get(f.name, F.col(f"`{f.name}`")).alias(f.name) for f in columns], *[F.col(f"_cut.{c}") for c in results]
    )


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).drop("text")
