"""Column blocks, weighted bins, score sketches, trials in step, Parzen estimator and halving."""

import math
import time
import tracemalloc
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabforge.operators import blocks, hist, metrics, score_sketch, tune, wquantile
from tabforge.operators.wquantile import Counter, Summary, merged, quantile_cuts


def rank_error(cuts, values, weights, bins):
    """Greatest distance, in shares of the weight, of a cut's ranks from the wanted one."""
    order = np.argsort(values)
    v, up_to = values[order], np.cumsum(weights[order]) / weights.sum()
    errors = []
    for k in range(1, bins):
        c = cuts[min(range(len(cuts)), key=lambda i: abs(np.interp(cuts[i], v, up_to) - k / bins))]
        low = up_to[np.searchsorted(v, c, side="left") - 1] if c > v[0] else 0.0
        high = up_to[np.searchsorted(v, c, side="right") - 1]
        errors.append(max(0.0, low - k / bins, k / bins - high))
    return max(errors)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_weighted_summary_holds_its_bound(parts):
    rng = np.random.default_rng(3)
    values = np.round(rng.lognormal(0, 2, 40_000), 2)  # many repeated values
    weights = 10.0 ** rng.uniform(-3, 3, 40_000)
    size, bins = 512, 32
    done = []
    for part in np.array_split(np.arange(40_000), parts):
        counter = Counter(size)
        for batch in np.array_split(part, 9):
            counter.add(Summary.of(values[batch], weights[batch]))
        done.append(counter.total())
    total = merged(done, size)
    assert total.total == pytest.approx(weights.sum()) and len(total.values) <= size + 2
    bound = (math.log2(9) + 3) / size
    assert rank_error(total.cuts(bins), values, weights, bins) <= bound
    assert rank_error(Summary.from_bytes(total.to_bytes()).cuts(bins), values, weights, bins) <= bound


def test_weighted_cuts_on_spark(spark):
    rng = np.random.default_rng(4)
    rows = [(float(i % 50), float(x), 1.0 if i % 2 else 9.0) for i, x in enumerate(rng.normal(size=6000))] + [(None, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "few double, many double, w double")
    a = quantile_cuts(df.repartition(2), ["few", "many"], 16, "w")
    b = quantile_cuts(df.repartition(11), ["few", "many"], 16, "w")
    x, w = np.array([r[1] for r in rows[:-1]]), np.array([r[2] for r in rows[:-1]])
    assert rank_error(a["many"], x, w, 16) < 0.02 and rank_error(b["many"], x, w, 16) < 0.02
    assert quantile_cuts(df, ["few"], 64)["few"] == [float(i) for i in range(1, 50)]  # each value its own bin


def test_sketch_equals_the_exact_curve(spark):
    rng = np.random.default_rng(5)
    y = (rng.random(20_000) < 0.05).astype(int)
    m = rng.normal(size=20_000) + 2 * y
    m[:5000] = np.round(m[:5000], 1)
    parts = [score_sketch.sketch(m[i::3], y[i::3], np.ones(len(y[i::3])), m.min(), m.max()) for i in range(3)]
    pr, roc = score_sketch.areas(sum(parts))
    df = spark.createDataFrame([(int(a), float(b), float(1 / (1 + math.exp(-b)))) for a, b in zip(y, m)], "y int, m double, p double")
    exact = metrics.curve_metrics(df, "y", "m").first()
    assert abs(pr - exact["pr_auc"]) < 1e-3 and abs(roc - exact["roc_auc"]) < 1e-3
    assert score_sketch.log_loss(sum(parts)) == pytest.approx(metrics.log_loss(df, "y", "p").first()[0])
    assert score_sketch.areas(np.zeros(score_sketch.SIZE)) == (None, None)


def toy(spark, n=3000, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[rng.random((n, 4)) < 0.1] = np.nan
    c = rng.integers(0, 30, n)
    y = (np.nan_to_num(x[:, 0]) + 0.5 * np.nan_to_num(x[:, 1]) ** 2 + (c % 3 == 0) + rng.normal(size=n) > 1.2).astype(int)
    rows = [(i, *[None if math.isnan(v) else float(v) for v in x[i]], int(c[i]), int(y[i]), float(1 + i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, d double, e double, c int, y int, w double")


COLS = ["a", "b", "d", "e", "c"]


def test_small_nodes_split_alike_by_rows_and_by_bins():
    rng = np.random.default_rng(8)
    layout = blocks.Layout.of([list(range(1, 9)), list(range(1, 200)), [0.5]], [0, 0, 0])
    work = blocks.Pass(layout=layout, splitting=blocks.Splitting(1.0, 0.1, 0.05, 0.5), depth=2, recent=[])
    for n in (1, 2, 5, 40, 700):
        bins = np.stack([rng.integers(0, s, n) for s in layout.slots], axis=1).astype(np.int32)
        g, h = rng.normal(size=n), rng.random(n)
        by_rows = blocks.best_by_rows(work, [0, 1, 2], bins, g, h)
        by_bins = max(((one[0], -f, *one[1:5]) for f in range(3) if (one := blocks.best_by_bins(work, f, bins[:, f], g, h))), default=None)
        assert by_rows[0] == pytest.approx(by_bins[0])
        if math.isfinite(by_rows[0]):
            assert by_rows[1:4] == (-by_bins[1], *by_bins[2:4]) and by_rows[4:] == pytest.approx(by_bins[4:])


@pytest.fixture(scope="module")
def halves(spark):
    df = toy(spark).checkpoint(eager=True)
    return df.filter("id % 4 > 0"), df.filter("id % 4 = 0")


def brute_root(train, model, cols, lam=1.0):
    """Best first split by brute force over the bins of all rows."""
    rows = train.select(*cols, "y", "w").collect()
    layout = model.layout()
    x = np.array([[np.nan if r[c] is None else r[c] for c in cols] for r in rows], dtype=float)
    y, w = np.array([r["y"] for r in rows]), np.array([r["w"] for r in rows])
    g, h = w * (0.5 - y), w * 0.25
    best = (-1,)
    for j in range(len(cols)):
        bins = layout.code(x[:, j], j)
        gone = bins == layout.slots[j] - 1
        for b in range(layout.slots[j] - 1):
            for left_gone in (False, True):
                left = (~gone & (bins <= b)) | (gone & left_gone)
                if h[left].sum() >= 1 and h[~left].sum() >= 1:
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + lam) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + lam)
                    best = max(best, (gain, -j, -b, not left_gone))
    return best


def test_a_tree_equals_brute_force_whatever_the_blocks(spark, halves, monkeypatch):
    train, val = halves
    monkeypatch.setattr(wquantile, "ENTRIES_PER_BIN", 200)  # exact cut points
    p = hist.HistParams(n_rounds=3, max_depth=3, max_bins=16, subsample=0.7, colsample_bytree=0.9)
    whole = hist.fit_hist(train, COLS, "y", "id", "w", p, val, ["c"])
    # Small blocks: nodes of more than 300 rows are split by passes, over many chunks and in two steps.
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 300)
    monkeypatch.setattr(blocks, "CHUNK_SUMS", 40)
    monkeypatch.setattr(blocks, "MERGE", 2)
    cut = hist.fit_hist(train.repartition(5), COLS, "y", "id", "w", p, val, ["c"])
    assert [t.splits.keys() for t in whole.trees] == [t.splits.keys() for t in cut.trees]
    for s, t in zip(whole.trees, cut.trees):
        assert {n: (v[0], v[1]) for n, v in s.splits.items()} == {n: (v[0], v[1]) for n, v in t.splits.items()}
        assert t.leaves == pytest.approx(s.leaves)
    plain = hist.fit_hist(train, COLS[:4], "y", "id", "w", hist.HistParams(n_rounds=1, max_depth=1, max_bins=16))
    f, b, left, gain = plain.trees[0].splits[0]
    want = brute_root(train, plain, COLS[:4])
    assert gain == pytest.approx(want[0]) and (-f, -b, not left) == want[1:]


def block_row(rows, seed, number=lambda v: v.tobytes()):
    """A block of two columns with 9 bins, as one batch."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, rows).astype(float)
    cells = [blocks.TRAIN, rows, rng.integers(0, 9, 2 * rows).astype(np.uint8).tobytes(), number(y), number(np.ones(rows)),
             rng.integers(0, 1 << 60, rows).tobytes(), number(np.zeros(rows))]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], blocks.NAMES)


@pytest.mark.parametrize("kept", [True, False])
def test_a_task_holds_few_blocks_however_many_it_reads(monkeypatch, kept):
    number = getattr(blocks, "thin", lambda v: v.tobytes())
    layout = blocks.Layout([None, None], [9, 9])
    grown = blocks.PackedTree.of({0: (0, 4, True, 1.0)}, {}, 2)
    work = blocks.Pass(layout=layout, splitting=blocks.Splitting(1.0, 0.0, 0.0, 1.0), depth=2, recent=[], growing=grown, active=[1], small=[2])
    if not kept:
        monkeypatch.setattr(blocks, "KEPT_SUMS", 0)
        monkeypatch.setattr(blocks, "HELD_BYTES", 200_000)

    def run(n):
        tracemalloc.start()
        total, few, peak = 0.0, 0, 0
        for batch in blocks.block_sums([work])(block_row(5000, i, number) for i in range(n)):
            for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist()):
                if chunk == 0:
                    total = total + np.frombuffer(raw)
                else:
                    few += int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
            peak = max(peak, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        return total, few, peak

    one, few_one, peak_one = run(4)
    total, few, peak = run(60)
    # All rows, each in its node, with the sums of the single blocks.
    singles = [next(b for b in blocks.block_sums([work])(iter([block_row(5000, i, number)])) if 0 in b.column("chunk").to_pylist()) for i in range(60)]
    want = sum(np.frombuffer(b.column("sums")[0].as_py()) for b in singles)
    assert total.reshape(2, 3, 9) == pytest.approx(want.reshape(2, 3, 9))
    assert few + total.reshape(2, 3, 9)[0, 2].sum() == 60 * 5000
    assert peak < 2 * peak_one


def test_history_and_margins_equal_the_scores(spark, halves):
    train, val = halves
    p = hist.HistParams(n_rounds=9, max_depth=2, max_bins=16, patience=9, checkpoint_every=2)
    model = hist.fit_hist(train, COLS, "y", "id", "w", p, val, ["c"])
    assert len(model.history) == 9 and len(model.rounds) == 9 * 2 * 3
    assert model.best_value == pytest.approx(dict(model.history)[model.best_iteration], abs=1e-3)
    for part, name in ((train, "train"), (val, "eval")):
        scored = model.predict_proba(part, ["id", "y", "w"], use_best=False)
        last = {m: v for t, s, m, v in model.rounds if t == 8 and s == name}
        assert last["logloss"] == pytest.approx(metrics.log_loss(scored, "y", "p", weight="w").first()[0])
        assert last["aucpr"] == pytest.approx(metrics.pr_auc(scored, "y", "p").first()[0], abs=1e-3)
    losses = [v for t, s, m, v in model.rounds if s == "train" and m == "logloss"]
    assert losses == sorted(losses, reverse=True)


@pytest.mark.parametrize("depth", [1, 4, 9])
def test_rows_reach_the_nodes_of_a_walk_by_hand(depth):
    rng = np.random.default_rng(depth)
    slots = [300, 9, 8, 30]
    cols = [rng.integers(0, s, 700).astype(np.uint16 if s > 256 else np.uint8) for s in slots]
    splits, todo = {}, [(0, 0)]
    while todo:
        n, level = todo.pop()
        if level < depth and rng.random() < 0.85:
            f = int(rng.integers(0, 4))
            # Feature 2 splits by sets, feature 3 by both.
            b = sorted(set(rng.integers(0, slots[f] - 1, 4).tolist())) if f == 2 or (f == 3 and n % 2) else int(rng.integers(0, slots[f] - 1))
            splits[n] = (f, b, bool(rng.random() < 0.5), 1.0)
            todo += [(2 * n + 1, level + 1), (2 * n + 2, level + 1)]

    def walk(i):
        n = 0
        while n in splits:
            f, b, missing_left, _ = splits[n]
            v = int(cols[f][i])
            left = missing_left if v == slots[f] - 1 else v in b if isinstance(b, list) else v <= b
            n = 2 * n + 2 - left
        return n

    tree = blocks.PackedTree.of(splits, {}, depth)
    missing = [s - 1 for s in slots]
    assert tree.nodes(lambda j: cols[j], missing, 700, depth).tolist() == [walk(i) for i in range(700)]
    assert tree.nodes(lambda j: cols[j][:0], missing, 0, depth).tolist() == []


def test_writes_in_between_change_no_tree_and_last_until_the_next(spark, halves, monkeypatch):
    train, val = halves
    params = [hist.HistParams(n_rounds=8, max_depth=d, eta=0.3, max_bins=16, subsample=0.8, checkpoint_every=5) for d in (2, 3)]
    fits, scans = {}, {}
    for often in (False, True):
        if often:
            # The costs of a large table.
            monkeypatch.setattr(hist, "WRITE", (0, 0.5, 0))
        written, gone, recent = [], [], []
        for module, name, seen in ((blocks, "written", lambda got: written.append(got[1])), (blocks, "forget", None), (blocks, "found", None)):
            real = getattr(module, name)

            def spy(*args, real=real, name=name, seen=seen):
                if name == "forget":
                    gone.extend(args[1])
                if name == "found":
                    recent.append(max(len(w.recent) for w in args[1]))
                got = real(*args)
                if seen:
                    seen(got)
                return got

            monkeypatch.setattr(module, name, spy)
        table = hist.TrainingTable.of(train, COLS, "y", "id", "w", val, ["c"], 16)
        fits[often] = hist.fit_on(table, params)
        assert set(written) == set(gone) | set(table.paths)
        table.forget()
        scans[often] = max(recent)
        monkeypatch.undo()
    assert scans == {False: 5 - 1, True: 0}
    for one, other in zip(*fits.values()):
        assert one.trees == other.trees and one.history == other.history and one.rounds == other.rounds


def test_numbers_of_a_block_come_back(spark):
    for values in (np.ones(1000), np.array([0.0, -0.0, 2.5, np.nan, np.inf] * 60), np.arange(1000) / 7, np.arange(256.0), np.arange(257.0), np.zeros(0)):
        back = blocks.numbers(blocks.thin(values))
        assert back.view(np.int64).tolist() == values.view(np.int64).tolist()
    assert len(blocks.thin(np.ones(1000))) == 1016


def test_trials_in_step_equal_single_fits(spark, halves):
    train, val = halves
    params = [hist.HistParams(n_rounds=4, max_depth=d, eta=e, max_bins=16, checkpoint_every=2, subsample=0.8) for d, e in ((1, 0.3), (3, 0.1), (2, 0.5))]
    table = hist.TrainingTable.of(train, COLS, "y", "id", "w", val, ["c"], 16)
    together = hist.fit_on(table, params)
    table.forget()
    for p, model in zip(params, together):
        alone = hist.fit_hist(train, COLS, "y", "id", "w", p, val, ["c"])
        assert [v for _, v in model.history] == pytest.approx([v for _, v in alone.history])
        assert [t.splits for t in model.trees] == [t.splits for t in alone.trees]


def test_parzen_density_by_hand():
    centres, widths = tune.parzen([0.2, 0.6])
    assert centres == [0.2, 0.5, 0.6] and widths == pytest.approx([1 / 3, 1.0, 0.4])
    n = NormalDist()
    x = 0.3
    want = sum(NormalDist(c, w).pdf(x) / (n.cdf((1 - c) / w) - n.cdf(-c / w)) for c, w in zip(centres, widths)) / 3
    assert tune.parzen_density(x, centres, widths) == pytest.approx(want)
    grid = np.linspace(0, 1, 2001)
    assert np.trapezoid([tune.parzen_density(g, centres, widths) for g in grid], grid) == pytest.approx(1, abs=1e-4)
    for kind, lo, hi, v in (("int", 3, 10, 7), ("logfloat", 1e-3, 0.2, 0.05), ("float", -1.0, 5.0, 2.0)):
        assert tune.from_unit(kind, lo, hi, tune.to_unit(kind, lo, hi, v)) == pytest.approx(v)


def test_parzen_search_beats_random_search():
    space = {"x": ("float", -5.0, 5.0), "n": ("int", 0, 20), "r": ("logfloat", 1e-4, 1.0)}

    def surface(p):
        return -((p["x"] - 1.3) ** 2) - 0.05 * (p["n"] - 13) ** 2 - math.log10(p["r"] / 0.01) ** 2

    tpe, drawn = [], []
    for seed in range(15):
        seen = []
        for t in range(40):
            p = tune.tpe_suggest(space, seen, t, seed)
            seen.append((p, surface(p)))
        assert all(-5 <= p["x"] <= 5 and 0 <= p["n"] <= 20 and 1e-4 <= p["r"] <= 1 + 1e-9 for p, _ in seen)
        tpe.append(max(v for _, v in seen))
        drawn.append(max(surface(tune.suggest(space, t, seed)) for t in range(40)))
    assert np.median(tpe) > np.median(drawn)


def test_halving_keeps_the_best_history():
    rng = np.random.default_rng(7)
    for _ in range(50):
        histories = {i: [(t, float(v)) for t, v in enumerate(rng.random(rng.integers(1, 9)))] for i in range(rng.integers(1, 20))}
        stay = tune.halving(4)(5, histories)
        best = {i: max(v for t, v in h if t < 5) for i, h in histories.items()}
        assert max(best, key=best.get) in stay and len(stay) == math.ceil(len(histories) / 4)


def test_search_on_the_booster(spark, halves):
    train, val = halves
    table = hist.TrainingTable.of(train, COLS, "y", "id", "w", val, ["c"], 16)
    space = {"learning_rate": ("logfloat", 0.01, 0.5), "max_depth": ("int", 1, 3)}
    rows = tune.search_boosters(table, space, 6, batch=4, rungs=(2, 4), reduction=2, n_rounds=6, patience=3, max_bins=16).collect()
    table.forget()
    assert [r["trial"] for r in rows] == list(range(6)) and len({r["rounds"] for r in rows}) > 1
    assert sum(r["pruned"] for r in rows) >= 2
    best = max(rows, key=lambda r: r["objective"])
    assert not best["pruned"] and all(1 <= r["params"]["max_depth"] <= 3 for r in rows)


def test_four_thousand_columns_train(spark):
    width = 4000
    df = spark.range(1500).select("id", (F.col("id") % 2).cast("int").alias("y"), *[
        (F.when(F.xxhash64("id", F.lit(j)) % 5 != 0, F.pmod(F.xxhash64("id", F.lit(-j)), F.lit(97)).cast("double")
                + (F.col("id") % 2 * 60 if j == 1234 else 0))).alias(f"c{j}") for j in range(width)])
    df = df.checkpoint(eager=True)
    began = time.time()
    model = hist.fit_hist(df, [f"c{j}" for j in range(width)], "y", "id", params=hist.HistParams(n_rounds=1, max_depth=2, max_bins=32))
    assert model.trees[0].splits[0][0] == 1234 and time.time() - began < 180


def test_fifty_thousand_categories_train(spark):
    k = 50_000
    df = spark.range(100_000).select("id", F.when(F.col("id") % 101 != 0, F.col("id") % k).cast("int").alias("c"),
                                     (F.xxhash64(F.col("id") % k) % 2 == 0).cast("int").alias("y"))
    began = time.time()
    model = hist.fit_hist(df, ["c"], "y", "id", params=hist.HistParams(n_rounds=2, max_depth=1, eta=1.0, min_child_weight=0.0), categorical=["c"])
    assert time.time() - began < 60
    left = model.trees[0].splits[0][1]
    assert 0.4 * k < len(left) < 0.6 * k
    scored = model.predict_proba(df.filter("c is not null"), ["id", "y"], use_best=False)
    assert metrics.roc_auc(scored, "y", "p").first()[0] == 1.0


def test_a_row_group_holds_few_blocks(spark, tmp_path):
    def megabytes(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                raw = np.random.default_rng(i).bytes(1 << 20)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([raw], pa.binary())], ["id", "raw"])

    df, path = blocks.written(spark.range(30).coalesce(1).mapInArrow(megabytes, "id long, raw binary"), "test-blocks")
    assert df.agg(F.count("*"), F.sum("id"), F.min(F.length("raw"))).first()[:] == (30, 435, 1 << 20)
    groups = [meta.row_group(g) for f in df.inputFiles() for meta in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in range(meta.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 30
    assert max(g.total_byte_size for g in groups) <= 10 << 20
    blocks.forget(spark, [path])


def test_margins_are_written_a_block_at_a_time():
    layout = blocks.Layout([None, None], [9, 9])
    trees = [blocks.PackedTree.of({0: (f, 4, True, 1.0)}, {1: -1.0 - f, 2: 1.0 + f}, 2) for f in (0, 1)]
    works = [blocks.Pass(layout=layout, splitting=blocks.Splitting(1.0, 0.0, 0.0, 1.0), depth=2, recent=[t]) for t in trees]
    several = pa.Table.from_batches([block_row(500, i, blocks.thin) for i in range(7)]).combine_chunks().to_batches()
    assert [b.num_rows for b in several] == [7]

    class Blocks:
        def mapInArrow(self, scan, schema):
            return list(scan(iter(several)))

    out = blocks.advanced(Blocks(), works)
    assert [b.num_rows for b in out] == [1] * 7
    for i, b in enumerate(out):
        bins = np.frombuffer(block_row(500, i).column("bins")[0].as_py(), np.uint8).reshape(2, 500)
        want = [np.where((bins[f] <= 4) | (bins[f] == 8), -1.0 - f, 1.0 + f) for f in (0, 1)]
        assert blocks.numbers(b.column("m")[0].as_buffer()).reshape(2, 500) == pytest.approx(np.stack(want))
        assert b.column("k")[0] == several[0].column("k")[i]


def test_a_group_adds_its_sums_up_as_they_come():
    layout = blocks.Layout([None, None], [20_001, 20_001])
    work = blocks.Pass(layout=layout, splitting=blocks.Splitting(1.0, 0.0, 0.0, 1.0), depth=2, recent=[], active=[0])
    sums = np.random.default_rng(8).random((2, 3, 20_001))
    sums[0, 0, :7000] -= 5.0   # where the best split is

    def batches(n):
        for _ in range(n):
            yield blocks.sums_batch([(0, 0, (sums / n).tobytes())])

    def run(n):
        before = pa.total_allocated_bytes()
        tracemalloc.start()
        most = 0

        def watched():
            nonlocal most
            for batch in batches(n):
                most = max(most, pa.total_allocated_bytes() - before)
                yield batch

        once = list(blocks.partial(watched()))
        [found] = list(blocks.best_of_chunk([work])(watched()))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return once, found.to_pylist(), most + peak

    once, found, few = run(3)
    again, same, many = run(60)
    for part in (once, again):
        assert len(part) == 1 and part[0].num_rows == 1
        assert np.frombuffer(part[0].column("sums")[0].as_py()) == pytest.approx(sums.ravel())
    assert [(r["f"], r["b"]) for r in found] == [(0, 6999)] == [(r["f"], r["b"]) for r in same]
    assert same[0]["g"] == pytest.approx(sums[0, 0].sum()) and same[0]["gain"] == pytest.approx(found[0]["gain"])
    assert many < 1.5 * few
    # Rows of small nodes are no sums: they go on as they are.
    rows = [blocks.sums_batch([(0, blocks.ROWS_OF_NODE - 1, bytes([i] * 8))]) for i in range(3)]
    assert list(blocks.partial(iter(rows))) == rows


def test_batches_are_small_only_inside(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BATCH_BYTES", 1)

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    was = spark.conf.get(blocks.BATCH_CONF)
    ids = spark.range(10).coalesce(1)
    with blocks.small_batches(spark):
        inside = [r["n"] for r in ids.mapInArrow(rows, "n long").collect()]
    assert inside == [1] * 10 and spark.conf.get(blocks.BATCH_CONF) == was
    with pytest.raises(ValueError), blocks.small_batches(spark):
        raise ValueError
    assert spark.conf.get(blocks.BATCH_CONF) == was
    assert [r["n"] for r in ids.mapInArrow(rows, "n long").collect()] == [10]
