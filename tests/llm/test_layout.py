"""Packing, shards, neighbours and the pipeline."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tabforge.llm import neighbours, packing, sharding
from tabforge.llm.jaccard import jaccard_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


# packing -----------------------------------------------------------------------------------


def test_long_runs_of_white_space_are_encoded(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a" + " " * 1_000_000 + "b", "\n" * 1_000_000, "\t \n" * 300_000]
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    for doc, text in enumerate(texts):
        ids = [*reference.encode(text, add_special_tokens=False).ids, 2]
        own = sorted((r for r in got if r["doc_id"] == doc), key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == len(ids)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())


def test_pieces_hold_the_tokenizer_ids_and_fill_sequences(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = [(5000, None), (5001, ""), (5002, "a <|endoftext|> b\r\n\u0085 ｱ ½ ٣​"), (5003, "x" * 30_000), (5001, ""), (None, "null id")]
    rows = documents + odd
    got = packing.pack(spark.createDataFrame(rows, SCHEMA)).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    for doc, text in documents + odd[:4]:
        if doc == 5001:
            continue
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024)]
        for r in own:
            raw = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(raw)
    assert len(pieces[5001]) == 2 and len(pieces[None]) == 1
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 1024
    floor = -(-sum(r["length"] for r in got) // 1024)
    assert len(sequences) <= 1.02 * floor + 2


def test_evolution_never_worsens_and_keeps_every_item():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1024, 300)
    start = [packing.packed_anew(sizes, n, 1024, rng) for n in (0.0, 16.0, 64.0)]
    best = packing.evolve(sizes, start, 4, 1024, rng)[0]
    assert packing.fitness(sizes, best, 1024) >= max(packing.fitness(sizes, b, 1024) for b in start)
    child = packing.cross(sizes, start[0], start[1], 1024, rng)
    for bins in (best, child):
        assert np.bincount(bins, weights=sizes).max() <= 1024 and len(bins) == len(sizes)


def test_packing_an_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


# shards ------------------------------------------------------------------------------------


def check_shards(out, limit):
    fill = defaultdict(list)
    for r in out:
        fill[r["shard_id"]].append(r["n_bytes"])
    for sizes in fill.values():
        assert sum(sizes) <= limit or len(sizes) == 1
    return fill


def test_only_oversized_buckets_split(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randrange(200), "e") for i in range(500)]
    rows += [(7, "y" * 90, "e")] * 150 + [(None, None, "e"), (8, "z" * 5000, "e")] + [(9, f"{i:050d}", "e") for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, local_depth string")
    out = sharding.shard(frame, limit=2000).collect()
    assert len(out) == len(rows)
    fill = check_shards(out, 2000)
    assert [r["doc_id"] for r in out if r["oversized"]] == [8]
    buckets = {r["shard_id"]: r["local_depth"] for r in out if "-" not in r["shard_id"]}
    for bits, depth in buckets.items():
        assert len(bits) == depth
    # A parent bucket of two shards would not fit.
    for bits in buckets:
        if bits and bits[:-1] not in buckets:
            inside = [s for b, sizes in fill.items() if b.split("-")[0].startswith(bits[:-1]) for s in sizes]
            assert sum(inside) > 2000 or len(inside) == 1 or bits[:-1] == ""


def test_shards_equal_their_sql(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for limit in (sharding.SHARD_BYTES, 20_000):
        sql = sharding.SQL.replace(str(sharding.SHARD_BYTES), str(limit))
        docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
        got = sharding.shard(docs, limit=limit).select("doc_id", "shard_id", "local_depth", "n_bytes", "oversized")
        assert sorted(map(tuple, got.collect())) == sorted(con.sql(sql).fetchall())
    sharding.write_shards(sharding.shard(docs, limit=100_000).drop("text"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


def test_shards_of_an_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).collect() == []


# neighbours --------------------------------------------------------------------------------


def brute_nearest(rows, k=5, step=50):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None for x in v):
            continue
        a = np.array(v, dtype=float)
        if len(a) == 8 and np.isfinite(a).all() and a.any():
            good[i] = a / np.sqrt((a * a).sum())
    ids = np.array(sorted(good))
    units = np.array([good[i] for i in ids.tolist()])
    out = {}
    for i in ids[ids % step == 0].tolist():
        score = (units * good[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_and_scores_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8))
    rows = [(i, (centres[i % 20] + rng.normal(size=8)).tolist()) for i in range(2500)]
    rows += [(3000 + i, [1.0] * 8) for i in range(700)]  # a group of equal vectors
    rows += [(9000, None), (9050, []), (9100, [0.0] * 8), (9150, [float("nan")] * 8), (9200, [1.0, None] * 4), (9250, [1.0, 2.0]), (None, [1.0] * 8)]
    rows += rows[:40]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in neighbours.nearest(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = brute_nearest(rows)
    assert set(got) == set(want) and all(len(got[q]) == 5 for q in want)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found / (5 * len(want)) >= 0.9
    true = {(q, i): s for q, w in want.items() for i, s in w}
    assert all(abs(s - true[q, i]) < 1e-12 for q, g in got.items() for i, s in g if (q, i) in true)
    assert [i for i, _ in got[3050]] == [3000, 3001, 3002, 3003, 3004]


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], schema)
    assert [tuple(r) for r in neighbours.nearest(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 0.0)]
    assert neighbours.nearest(two.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_hilbert_keys_are_a_walk():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = neighbours.hilbert_key(grid, 3)
    walk = grid[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


# pipeline ----------------------------------------------------------------------------------


def test_stages_keep_columns_and_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= before, name
        if stage is not corpus_pipeline.packing:
            assert docs.columns == columns, name
        if stage is corpus_pipeline.near_duplicates:
            again = jaccard_components(docs, corpus_pipeline.NEAR_DUPLICATES)
            assert again.filter("doc_id <> component_id").count() == 0
    assert docs.agg(F.countDistinct("doc_id")).first()[0] > 0


def test_stages_take_odd_rows(spark):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", "s", 0)]
    odd = spark.createDataFrame(rows, plain.schema).unionByName(plain.limit(30)).unionByName(plain.limit(30))
    for table in (odd, plain.limit(0)):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, SF).count()
            docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        assert (docs.count() > 0) == (table is odd)


def test_stages_leave_clashing_columns_alone(spark):
    text = " ".join(f"w{i}" for i in range(40)) + "."
    rows = [(2**60 + i, f"{text} n{i}.", i, None if i else 2**60 + 1, f"s{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, n_removed long, score string")
    for stage in (corpus_pipeline.quality, corpus_pipeline.toxicity, corpus_pipeline.repeats):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["score"]) for r in out.collect()) == [
            (r[0], r[2], r[3], r[4]) for r in rows
        ]


def test_near_duplicates_keep_one_row_of_each_group(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(5, words), (5, words), (3, words + " end"), (9, "other text of seven words is here"), (None, words), (None, words)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 0, 3, 9]
