"""Jaccard join, components and suffix-bucket removal against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabforge.llm import jaccard, repeats
from tabforge.llm.components import connected_components
from tabforge.llm.jaccard import Rule, jaccard_components
from tabforge.llm.repeats import remove_repeats

SCHEMA = "doc_id long, text string"


def brute_components(rows, n, num, den):
    sets = {}
    for doc, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        whole = {tuple(words)} if words else set()
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else whole
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for doc, shingles in sets.items():
        for s in shingles:
            holders[s].append(doc)
    shared = Counter((a, b) for docs in holders.values() for i, b in enumerate(docs) for a in docs[:i])
    for (a, b), c in shared.items():
        if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies(seed=5, docs=250):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 9, 12, 40, 80]))] for _ in range(20)]
    rows = []
    for d in range(docs):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            i = rng.randrange(len(words))
            words[i : i + 1] = rng.choice([[rng.choice(vocabulary)], [words[i], rng.choice(vocabulary)], [words[i], "x"]])
        rows.append((d, " ".join(words)))
    return rows


def by_id(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize(("rule", "frequent"), [(Rule(3, 90, 100), 64), (Rule(3, 80, 100), 64), (Rule(3, 80, 100), 2)])
def test_components_equal_brute_force(spark, monkeypatch, rule, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "PREFIX_PER_MATCH", 2)
    rows = [*near_copies(), (900, ""), (901, None), (902, " \n\t"), (903, "A"), (904, "a")]
    extra = [*rows[:3], (None, "a b c")]
    frame = spark.createDataFrame(rows + extra, SCHEMA)
    result = jaccard_components(frame, rule)
    assert result.count() == len(rows) + len(extra)
    got = by_id(result)
    expected = brute_components(rows, rule.words, rule.num, rule.den)
    assert {d: got[d] for d in expected} == expected
    assert got[None] == (1, None)


def test_components_of_documents(spark, documents):
    got = by_id(jaccard_components(spark.createDataFrame(documents, SCHEMA), Rule(3, 90, 100)))
    assert got == brute_components(documents, 3, 90, 100)


def test_components_of_an_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA), Rule()).collect() == []


def test_prefix_never_asks_for_more_than_the_least_overlap():
    rule = Rule(3, 90, 100)
    for size in range(1, 300):
        least = -(-90 * size // 100)
        for match in (1, 2, 3, rule.match(size)):
            if match <= least:
                assert rule.prefix(size, match) == size - least + match
        # Every similar partner asks for at least as many matches as the early filter supposes.
        for partner in range(least, size * 100 // 90 + 1):
            assert rule.match(partner) >= rule.least_match(size)
    assert not rule.can_differ(8) and rule.can_differ(9)


def test_contraction_finds_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    names = rng.sample(range(1000), 120)
    edges = [*zip(names[:40], names[1:41]), *((names[60], x) for x in names[61:90]), (5000, 5000)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[x] for x in names[:41]} == {min(names[:41])}
    assert {got[x] for x in names[60:90]} == {min(names[60:90])}
    assert 5000 not in got


def brute_removal(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = text.encode()
        marked = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                marked[p : p + 100] = b"\1" * 100
            else:
                seen.add(raw[p : p + 100])
        kept = bytes(c for c, m in zip(raw, marked) if not m)
        spans = sum(1 for i, m in enumerate(marked) if m and (i == 0 or not marked[i - 1]))
        out[doc] = (len(raw), sum(marked), spans, hashlib.sha256(kept).hexdigest())
    return out


def removal(frame):
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in remove_repeats(frame).collect()}


def repeated_texts(seed):
    rng = random.Random(seed)
    base = ["xy" * 80, "the quick " * 30, "Zürich äöü " * 20, "a" * 400]
    rows = []
    for d in range(80):
        parts = [rng.choice(base)[rng.randrange(50) : rng.randrange(60, 300)] for _ in range(rng.randrange(4))]
        parts.append("".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(200))))
        rng.shuffle(parts)
        rows.append((d, "".join(parts)))
    return rows


@pytest.mark.parametrize("frequent", [0, 64])
def test_removal_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)  # 0: every shared q-gram takes the path of frequent ones
    rows = repeated_texts(1)
    extra = [*rows[:5], (None, None), (1000, ""), (1001, None)]
    got = removal(spark.createDataFrame(rows + extra, SCHEMA))
    expected = brute_removal([*rows, (1000, ""), (1001, "")])
    assert {d: got[d] for d in expected} == expected
    assert got[None][:3] == (0, 0, 0)


def test_removal_of_documents_and_extra_columns(spark, documents):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in documents], SCHEMA + ", n_bytes string, _x int")
    assert removal(frame) == brute_removal(documents)
    assert "_x" in remove_repeats(frame).columns


def test_removal_from_an_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts_are_cut_into_overlapping_segments(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 150)
    rows = repeated_texts(3)[:30]
    assert removal(spark.createDataFrame(rows, SCHEMA)) == brute_removal(rows)


def test_string_buckets_depend_on_the_string_alone():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 100, 700, dtype=np.uint8)
    raw[400:550] = raw[100:250]
    buckets = repeats.string_buckets(repeats.gram_buckets(raw))
    assert len(buckets) == len(raw) - 99
    assert (buckets[400:451] == buckets[100:151]).all()
    assert len(np.unique(buckets)) == len({raw[i : i + 100].tobytes() for i in range(601)})


def test_pipeline_keeps_other_texts_of_a_reused_id(spark):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, b + " more"), (3, c), (3, c), (1, "short"), (1, "other"), (None, a), (4, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = [(1, a), (1, b), (3, c), (1, "short"), (1, "other"), (None, a)]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
