"""Ranked search, lexicon fingerprints and phrase collocations against brute force."""

import hashlib
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabforge.llm import collocations, imatch, ranked
from tabforge.llm.collocations import Rule
from tabforge.llm.imatch import Band
from tabforge.llm.ranked import rank_documents

LOWER = {c: c + 32 for c in range(65, 91)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def texts_of(seed, docs, words=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", *[f"w{i}" for i in range(150)], "Über", "ñandú", "x"]
    weights = [60, 40, 30, *[1 + 40 / (1 + i) for i in range(150)], 2, 2, 2]
    return [
        (d, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, words))).replace(" w7", ". w7").replace(" w3 ", "\tw3\n"))
        for d in range(docs)
    ]


# ---- 11


def brute_ranks(docs, items, k=10):
    counts = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs if d is not None]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        asked = TERM.findall((text or "").translate(LOWER))
        scores = []
        for d, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            s = 0
            for t in asked:
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                s += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, d))
        found += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def ranks(spark, docs, items):
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, score string")
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    return sorted(tuple(r) for r in rank_documents(frame.repartition(3), asked).collect())


@pytest.mark.parametrize("shard", [16, 4096])
def test_ranks_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(ranked, "SHARD_DOCS", shard + 1024)
    docs = texts_of(1, 2500)
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(docs)[1].split()[:12])) for i in range(12)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, "the the w5 W5 ñandú"), (104, "of")]
    assert ranks(spark, docs, items) == brute_ranks(docs, items)


def test_ranks_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 4)
    docs, items = texts_of(3, 300), [(i, t) for i, t in texts_of(4, 14, 9)]
    assert ranks(spark, docs, items) == brute_ranks(docs, items)


def test_ranks_of_odd_rows(spark):
    long_text = "alpha beta " * 300_000
    docs = [(1, None), (2, ""), (3, "... !"), (4, "alpha"), (5, "alpha"), (5, "alpha"), (None, "alpha alpha"), (6, long_text), (7, "Alpha beta")]
    items = [(1, "alpha"), (2, "beta alpha ALPHA"), (3, None)]
    assert ranks(spark, docs, items) == brute_ranks(docs, items)
    assert ranks(spark, [], items) == [] and ranks(spark, docs, []) == []


def test_range_maxima():
    rng = np.random.default_rng(5)
    row = {"term": np.zeros(200, np.int32), "place": np.arange(200, dtype=np.int32), "tf": rng.integers(1, 9, 200).astype(np.int32)}
    row |= {"docs": np.arange(200), "sizes": rng.integers(9, 99, 200)}
    shard = ranked.Shard({k: v.tobytes() for k, v in row.items()}, np.array([700]), np.array([200]), 200, 9000)
    lo, hi = np.array([(a, b) for a in range(200) for b in range(a + 1, 201)]).T
    best = shard.best_in(lo, hi)
    assert all(shard.impact[p] == shard.impact[a:b].max() and a <= p < b for p, a, b in zip(best, lo, hi, strict=True))


# ---- 12


def xx(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed & (2**64 - 1))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def brute_terms(text):
    return sorted({signed(xx(t.encode())) for t in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower()) if t})


def chained(values, seed=42):
    for v in values:
        seed = xx(struct.pack("<q", v), seed)
    return seed


def brute_print(text, lexicon, band):
    found = brute_terms(text)
    kept = [t for t in found if t in lexicon]
    if not kept:
        return -1, chained(found) if found else xx(text.encode()), None
    level = len(kept).bit_length() - 1

    def at(g):
        subsets = [[] for _ in range(band.subsets)]
        for r in range(max(1, band.subsets >> g)):
            for t in kept:
                s = (r << g) + (xx(struct.pack("<i", r), xx(struct.pack("<q", t))) & ((1 << g) - 1))
                if s < band.subsets:
                    subsets[s].append(t)
        return [chained(s) & 0xFFFFFFFF if s else 0 for s in subsets]

    return level, at(level), at(level + 1)


def brute_likeness(a, b):
    if a[0] < 0 or b[0] < 0 or abs(a[0] - b[0]) > 1:
        return float(a[0] == b[0] == -1 and a[1] == b[1])
    level = min(a[0], b[0]) + 1
    x, y = (p[1] if p[0] == level else p[2] for p in (a, b))
    held = sum(i != 0 or j != 0 for i, j in zip(x, y))
    if held == 0:
        return float(a == b)
    return sum(i != 0 and i == j for i, j in zip(x, y)) / held


def brute_text(p):
    row = lambda hs: ".".join(f"{h:x}" if h else "" for h in hs)
    return f"whole:{p[1]:x}" if p[0] < 0 else f"{p[0]}:{row(p[1])}:{row(p[2])}"


def brute_fingerprints(docs, band):
    df = Counter(t for _, text in docs for t in brute_terms(text))
    lexicon = {t for t, n in df.items() if n > 1 and n * band.max_terms > sum(df.values()) and n <= band.high * len(docs)}
    ordered = sorted(docs, reverse=True)
    out = {}
    for (d, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        p, e, q = (brute_print(t, lexicon, band) for t in (text, edited, after))
        out[d] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), brute_text(p), brute_text(e), brute_likeness(p, e), brute_likeness(p, q))
    return out


def fingerprint_rows(spark, docs, band):
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n long, term string")
    return [tuple(r) for r in imatch.fingerprints(frame.repartition(3), band).collect()]


@pytest.mark.parametrize("band", [Band(high=0.5), Band(high=0.3, max_terms=64, subsets=8)])
def test_fingerprints_equal_brute_force(spark, band):
    docs = texts_of(6, 150) + [(500, "the"), (501, ""), (502, "?!"), (503, "nobody else says this"), (504, "Ünïcode 😀 tail")]
    docs += [(600 + i, docs[i][1]) for i in range(5)]
    found = {r[0]: r[1:] for r in fingerprint_rows(spark, docs, band)}
    expected = brute_fingerprints(docs, band)
    assert found.keys() == expected.keys()
    for d, row in expected.items():
        assert found[d][:4] == row[:4] and found[d][4:] == pytest.approx(row[4:])


def test_fingerprints_of_odd_rows(spark):
    long_text = " ".join(f"t{i}" for i in range(60_000))
    docs = [(1, None), (2, "same words here"), (2, "same words here"), (2, "other words there"), (None, "same words here"), (9, long_text), (8, long_text)]
    rows = fingerprint_rows(spark, docs, Band(high=1.0))
    assert len(rows) == 6  # the repeated row comes back once
    same = {r[3] for r in rows if r[1] == len("same words here") and r[0] != 2} | {r[3] for r in rows if r[0] == 2}
    by_id = {r[0]: r for r in rows}
    assert by_id[9][3] == by_id[8][3] and by_id[9][6] == 1.0
    assert by_id[None][3] in same and by_id[1][1] == 0
    assert fingerprint_rows(spark, [], Band()) == []
    assert fingerprint_rows(spark, [(1, "alone")], Band())[0][5:] == (0.0, 1.0)


def test_edited_texts_are_nearer_than_the_next_document(spark):
    rows = imatch.op12_document_fingerprints(spark, "/root/testdata/sf0.001").filter("n_chars > 1000")
    means = rows.agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert means[0] > 10 * means[1]


# ---- 13


def brute_collocations(rows, rule):
    pieces = [
        (lang or "und", re.findall(r"[^\x20\x09]+", p))
        for lang, text in rows
        for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    ]
    f, n = Counter(), Counter()
    for lang, words in pieces:
        n[lang] += len(words)
        for i in range(len(words)):
            for s in range(1, rule.max_words + 1):
                if i + s <= len(words):
                    f[lang, tuple(words[i : i + s])] += 1
    cand = {k: a for k, a in f.items() if a >= rule.min_count and len(k[1]) > 1}
    out = []
    for (lang, p), a in cand.items():
        inside = [b for (other, q), b in cand.items() if other == lang and len(q) > len(p)
                  and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= rule.within_percent * a for b in inside):
            continue
        score, _, left, right = min(
            (2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))
        )
        out.append((lang, -score, -a, " ".join(p).encode(), left, right))
    result = []
    for lang in n:
        for r, (_, s, a, p, left, right) in enumerate(sorted(x for x in out if x[0] == lang)[: rule.top]):
            result.append((lang, r + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(result)


def found_collocations(spark, rows, rule):
    frame = spark.createDataFrame([(lang, t, 1, 2) for lang, t in rows], "lang string, text string, n long, h0 long")
    return sorted(tuple(r) for r in collocations.collocations(frame.repartition(4), rule).collect())


@pytest.mark.parametrize("rule", [Rule(min_count=5, top=40), Rule(min_count=12), Rule(min_count=3, max_words=3, within_percent=60)])
@pytest.mark.parametrize("small", [True, False])
def test_collocations_equal_brute_force(spark, monkeypatch, rule, small):
    if small:  # many chunks and routes, and most words hot: every routing depth occurs
        monkeypatch.setattr(collocations, "CHUNK_WORDS", 500)
        monkeypatch.setattr(collocations, "ROUTE_SUFFIXES", 700)
        monkeypatch.setattr(collocations, "HOT_SHARE", 1 / 60)
    rows = [(["en", "de", None][d % 3], t + " New York City. new york CITY") for d, t in texts_of(8, 250)]
    assert found_collocations(spark, rows, rule) == brute_collocations(rows, rule)


def test_collocations_of_odd_rows(spark):
    long_text = "a b c d, " * 300_000
    rows = [(None, None), ("en", ""), ("en", " \t "), ("xx", "...;;!"), ("en", "same same same same same " * 10), ("de", long_text)]
    rows += [("fr", "rien ici")] * 31
    got = found_collocations(spark, rows, Rule())
    assert ("fr", 1, "rien ici", 31, 31, 31, 62, 1000000) in got
    assert ("de", 1, "a b c d", 300_000, 300_000, 300_000, 1_200_000, 1000000) in got
    assert [r for r in got if r[0] == "en"] == [r for r in brute_collocations(rows[:5], Rule()) if r[0] == "en"]
    assert found_collocations(spark, [], Rule()) == []


def test_three_way_quicksort_counts_every_phrase():
    rng = np.random.default_rng(9)
    suffixes = rng.integers(0, 5, (3000, 4)).astype(np.int32)
    for d in range(1, 4):
        suffixes[suffixes[:, d - 1] == 0, d] = 0
    n = rng.integers(1, 4, 3000)
    for depth, least in ((2, 20), (4, 20), (2, 1)):
        got = {tuple(suffixes[p][:w].tolist()): c for ps, cs, w in collocations.quicksort_counts(suffixes, n, depth, least) for p, c in zip(ps, cs)}
        want = Counter()
        for row, c in zip(suffixes.tolist(), n.tolist()):
            for w in range(2, 5):
                if 0 not in row[:w]:
                    want[tuple(row[:w])] += c
        assert got == {p: c for p, c in want.items() if c >= least or len(p) < depth}
