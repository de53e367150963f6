"""Quality rules, toxicity, page text, token counts and sampled segmentations."""

import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import html, quality, sampling, toxicity, unigram
from tabforge.llm.token_counts import Counter, count_tokens

SF = "/root/testdata/sf0.01"


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


# quality rules -----------------------------------------------------------------------------


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_measures_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t\x0b", "a" * 5000, "x " * 2000, "é ü #| <b>\n\nq\n q\nq", "one two three four five six seven eight"]
    for _ in range(40):
        texts.append("".join(rng.choice(["a ", "b ", "c\n", "d  ", "\r", "# ", "É"]) for _ in range(rng.randrange(60))))
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(0, None, 7), (None, "a b", 7)]
    out = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, n_words int"))
    assert out.count() == len(rows) and "n_words" in out.columns
    got = by_id(out)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_quality(t), t
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
    assert not got[0]["kept"]


def test_lines_are_judged_before_documents(spark):
    prose = "\n".join(f"Line number {i} says w{i}, x{i}, y{i} and z{i} in plain text {i}." for i in range(6))
    noisy = prose + "\nHome | News | Sport | About\nMENU\n### *** ### $$$\nClick here to subscribe today!\nBUY NOW!! CHEAP!! GOOD!!"
    junk = "\n".join("a | b | c | d" for _ in range(9)) + "\nOne single good sentence stands here."
    frame = spark.createDataFrame([(1, prose), (2, noisy), (3, junk)], "doc_id long, text string")
    got = by_id(quality.quality_rules(frame))
    assert got[1]["kept"] and got[2]["kept"] and got[2]["clean_text"] == prose and not got[3]["kept"]


def test_quality_keeps_good_and_drops_bad_labelled_documents(spark):
    got = quality.op9_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rates = {r["quality"]: r["rate"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rates[0] == 0 and rates[1] > 0.95


# toxicity ----------------------------------------------------------------------------------


def test_folding_maps_look_alikes_and_substitutes():
    assert toxicity.fold("IDI0T, іdіоt! ​s©um") .split()[:2] == ["idiot", "idiot"]


def test_exceptions_cancel_hits():
    machine = toxicity.Lexicon({" trash ": 2.0, " idio": 3.0}).automaton()
    assert toxicity.text_hits(machine, toxicity.fold("the trash can"))[1] == 0
    assert toxicity.text_hits(machine, toxicity.fold("trash, idiotic")) == (5.0, 2, 2)
    assert toxicity.text_hits(machine, "") == (0.0, 0, 0)


def labelled(spark, n=400):
    rng = random.Random(1)
    vocabulary = [f"word{i}" for i in range(80)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Badling", "b4dlet", "awful"])
        docs.append((i, " ".join(words), "e"))
        labels.append((i, int(toxic)))
    schema = "doc_id long, text string, score string"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    lexicon = toxicity.fit_lexicon(docs, labels, usable=toxicity.fold_of() != 0)
    out = toxicity.score_toxicity(docs, lexicon).join(labels, "doc_id").collect()
    assert len(out) == 400
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.97


def test_toxicity_without_labels_texts_or_rows(spark):
    docs, labels = labelled(spark, 20)
    odd = docs.unionByName(spark.createDataFrame([(None, "idiot", "x"), (3, None, "x"), (3, "", "x")], docs.schema))
    lexicon = toxicity.fit_lexicon(odd, labels.limit(0))
    out = toxicity.score_toxicity(odd, lexicon).collect()
    assert len(out) == 23 and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in out)
    nulls = labels.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    assert toxicity.fit_lexicon(odd, nulls).weights == {}
    assert toxicity.score_toxicity(odd.limit(0), lexicon).collect() == []


# page text ---------------------------------------------------------------------------------

PAGE = (
    "<html><head><title>T</title><style>p{x}</style></head><body><header><p>Site</p></header><nav><ul><li>"
    "<a href=/>Home</a></li></ul></nav><div class=\"ad\"><p>Buy!</p></div><article><h1>Head &amp; line</h1>"
    "<p>One\n  <b>two</b>.<br>three.<p>Four &lt;5&gt;.<!-- x --><script>var a='<p>';</script></p></article>"
    "<div id='comments'><p>First comment.</p></div><footer><p>&copy; me</p></footer></body></html>"
)
TEXT = "Head & line\nOne two. three.\nFour <5>."


@pytest.fixture(scope="module")
def labeller(spark):
    return html.fit_labeller(spark.read.parquet(f"{SF}/pages.parquet"))


def test_blocks_and_landmarks():
    page = html.read_page(PAGE)
    kept = [t for t, p in zip(page.texts, page.paths) if html.landmark_label(p)]
    assert "\n".join(kept) == TEXT


def test_page_text_equals_the_landmarks_on_all_pages(spark, labeller):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extract_text(pages, labeller).collect()}
    for r in pages.collect():
        page = html.read_page(r["html"])
        assert got[r["page_id"]] == "\n".join(t for t, p in zip(page.texts, page.paths) if html.landmark_label(p))


def test_odd_pages(spark, labeller):
    cut = PAGE[: PAGE.index("Four") + 6]
    odd = [None, "", "<", "</", "<p", "<script>", "<!-- x", "text only", "<article><p>a" * 300, cut, cut, "&amp;" * 2000]
    frame = spark.createDataFrame([(i, h, "x") for i, h in enumerate(odd)], "page_id long, html string, text string")
    out = {r["page_id"]: r for r in html.extract_text(frame, labeller).collect()}
    assert len(out) == len(odd) and out[0]["text"] == out[1]["text"] == out[2]["text"] == ""
    assert out[9]["text"] == out[10]["text"] and all(r["n_chars"] == len(r["text"]) for r in out.values())
    assert html.extract_text(frame.limit(0), labeller).collect() == []
    assert isinstance(html.fit_labeller(frame.limit(0)), html.Labeller)


def test_gradients_equal_differences():
    import numpy as np

    rng = np.random.default_rng(0)
    width = 5
    model = html.Labeller.fresh(width)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = html.stacked([rng.normal(size=(4, width)), rng.normal(size=(2, width))])
    x = x.astype(np.float64)
    y = (rng.random(mask.shape) < 0.5).astype(float)

    def loss():
        z = model.logits(x, mask)[0]
        return (np.logaddexp(0, z) - y * z)[mask].sum() / mask.sum()

    grads = model.gradients(x, mask, y)
    for key, g in grads.items():
        at = tuple(rng.integers(0, s) for s in g.shape)
        old = model.p[key][at]
        model.p[key][at] = old + 1e-3
        up = loss()
        model.p[key][at] = old - 1e-3
        down = loss()
        model.p[key][at] = old
        assert abs((up - down) / 2e-3 - g[at]) < 2e-4, key


def test_unclosed_elements_do_not_swallow_the_page():
    page = "<article><p>one<svg viewBox='0' /> two</p><p>three <math><mi>x</mi></math></p><object data='a'><p>four</p></article>"
    assert html.read_page(page).texts == ["one two", "three x", "four"]
    assert html.read_page("<p>a<svg><text>b</text></svg>c</p><script>d<p>e").texts == ["a c"]


# token counts and samples --------------------------------------------------------------------


@pytest.fixture(scope="module")
def unigram_model(tmp_path_factory):
    """The public pieces as a unigram model that the library reads; its float sums stay exact."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(unigram.default_model(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


ODD_TEXTS = ["", "a", " a", "  a   b ", "Hello  world\n\tx", "日本語テスト 😀 x", "▁a", "a ", "  ", "zzzzqqqq" * 40, "\u0000é"]


def test_counts_equal_the_library(spark, unigram_model, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=unigram_model)
    texts = ODD_TEXTS + [t for _, t in documents if len(t) < 5000]
    counter = Counter(unigram.load_vocabulary(unigram_model))
    assert [counter.text(t)[0] for t in texts] == [len(library.encode(t)) for t in texts]


def test_counting_rows(spark):
    rows = [(1, "the cat"), (1, "the cat"), (None, None), (2, "")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_tokens string")
    got = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in count_tokens(frame).collect())
    pieces = Counter(unigram.load_vocabulary(unigram.default_model())).text("the cat")[0]
    assert got == [(0, 0), (1, pieces), (1, pieces), (2, 0)] and pieces >= 2
    assert count_tokens(frame.limit(0)).collect() == []


def test_samples_decode_to_the_text_and_are_distinct(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD_TEXTS) if "▁" not in t] + [(90, None, "x"), (0, "", "x"), (None, "q r", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sampling.sample_segmentations(frame, ["doc_id"], k=3).collect()
    texts = {i: t or "" for i, t, _ in rows}
    assert all(r["decoded"] == texts[r["doc_id"]] for r in out)
    drawn = [(r["doc_id"], tuple(r["ids"])) for r in out if r["doc_id"] != 0]
    assert len(set(drawn)) == len(drawn)
    assert all(0 < r["inclusion"] <= 1 for r in out)
    again = sampling.sample_segmentations(frame.repartition(3), ["doc_id"], k=3).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert sampling.sample_segmentations(frame.limit(0), ["doc_id"]).collect() == []


def test_op7_reads_every_whole_document(spark, documents):
    small = "/root/testdata/sf0.001"
    out = sampling.op7_sampled_segmentations(spark, small).collect()
    chars = {r["id"]: r["n_chars"] for r in out if r["source"] == "documents"}
    assert chars == {str(i): len(t or "") for i, t in documents}
    turns = {(r["id"], r["turn"]) for r in out if r["source"] == "conversations"}
    assert len(turns) == spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn").distinct().count()


def test_inclusion_weights_are_unbiased():
    sampler = sampling.Sampler(unigram.load_vocabulary(unigram.default_model()), 0.0005)
    first, estimate, exact, runs = {}, {}, {}, 1500
    for seed in range(runs):
        for n, (ids, log_prob, inclusion) in enumerate(sampler.sample("tion the", 3, seed)):
            key = tuple(ids)
            exact[key] = math.exp(log_prob)
            estimate[key] = estimate.get(key, 0) + exact[key] / inclusion / runs
            first[key] = first.get(key, 0) + (n == 0) / runs
    top = sorted(exact, key=exact.get)[-2:]
    assert all(abs(first[k] - exact[k]) < 0.05 and abs(estimate[k] - exact[k]) < 0.05 for k in top)


def test_quality_sql_reads(spark):
    """The oracle parses and equals the query on the smallest tables."""
    small = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(map(str, con.sql(quality.SQL).fetchall()))
    got = sorted(str(tuple(r)) for r in quality.op9_quality_rules(spark, small).collect())
    assert want == got


def every_segmentation(sampler, text):
    """Brute force: ids -> log-probability over all segmentations of a text, by recursion on its start."""
    voc = sampler.vocabulary
    whole = "▁" + text.replace(" ", "▁")

    def weight(piece):
        score = voc.scores[voc.ids[piece]]
        return sampler.temperature * score if score > sampling.LEAST_SCORE else sampler.unknown

    def from_place(at):
        if at == len(whole):
            return [((), 0.0)]
        steps = [((voc.ids[whole[at:e]],), e, weight(whole[at:e])) for e in range(at + 1, len(whole) + 1) if whole[at:e] in voc.ids]
        if whole[at] not in voc.ids:
            steps.append((tuple(voc.byte_ids[b] for b in whole[at].encode()), at + 1, sampler.unknown))
        return [(ids + behind, w + v) for ids, e, w in steps for behind, v in from_place(e)]

    found = from_place(0)
    total = math.log(sum(math.exp(w) for _, w in found))
    return {ids: w - total for ids, w in found}


@pytest.mark.parametrize("text", ["tion th", "a ☃ be", "the the"])
def test_samples_against_every_segmentation(text):
    sampler = sampling.Sampler(unigram.load_vocabulary(unigram.default_model()), 0.0005)
    exact = every_segmentation(sampler, text)
    runs, drawn = 6000, {}
    for samples in sampler.batch([text] * runs, list(range(runs)), 2):
        for ids, log_prob, _ in samples:
            assert abs(log_prob - exact[tuple(ids)]) < 1e-9
        pair = tuple(tuple(ids) for ids, _, _ in samples)
        drawn[pair] = drawn.get(pair, 0) + 1
    # The chance of a first and then a second segmentation, without replacement.
    for (a, b), n in drawn.items():
        p = math.exp(exact[a] + exact[b]) / (1 - math.exp(exact[a]))
        assert abs(n - runs * p) < 5 * math.sqrt(runs * p) + 3
    everything = sampler.sample(text, len(exact) + 5, 3)
    assert {tuple(ids) for ids, _, _ in everything} == set(exact)
    assert all(inclusion == 1.0 for _, _, inclusion in everything)


def test_samples_do_not_depend_on_the_batch_and_long_texts_pass():
    sampler = sampling.Sampler(unigram.load_vocabulary(unigram.default_model()))
    texts = ["word " * 40_000, "a" * 60_000, " " * 30_000, "é☃" * 500, "", "plain text", "plain text"]
    together = sampler.batch(texts, [1, 2, 3, 4, 5, 6, 6], 3)
    assert together[5] == together[6]
    for text, seed, samples in zip(texts, [1, 2, 3, 4, 5, 6, 6], together, strict=True):
        alone = sampler.sample(text, 3, seed)
        assert [ids for ids, _, _ in alone] == [ids for ids, _, _ in samples]
        assert all(unigram.decode(sampler.vocabulary, ids) == text for ids, _, _ in samples if ids)
        assert len({tuple(ids) for ids, _, _ in samples}) == len(samples)


def test_lattices_made_together_equal_those_made_one_by_one():
    voc = unigram.load_vocabulary(unigram.default_model())
    one, many = sampling.Sampler(voc), sampling.Sampler(voc)
    new = ["▁international", "☃▁", "▁" * 7, "▁a", "▁héllo☃x"]
    many.add(new)
    for chunk in new:
        a, b = one.last_node(chunk), many.kept[chunk]
        for _ in chunk:
            x, y = one.edges_of(a), many.edges_of(b)
            mine = sorted((one.length[e], round(one.own[e], 9), round(max(one.others[e], -1e9), 6)) for e in x)
            assert mine == sorted((many.length[e], round(many.own[e], 9), round(max(many.others[e], -1e9), 6)) for e in y)
            a, b = a - 1, b - 1


def test_matcher_finds_every_piece():
    pieces = ["a", "ab", "abc", "b", "bca", "cab", "é☃", "x" * 20, "▁", "▁a", "▁ab"] + [f"q{i}" for i in range(40)]
    ids = {p: 3 * n for n, p in enumerate(pieces)}
    texts = ["▁abcab", "☃é☃é", "x" * 45, "zzz", "q17q3q", "▁▁a"]
    joined = "\uf8ff".join(texts) + "\uf8ff"
    found = unigram.Matcher(ids).matches(np.frombuffer(joined.encode("utf-32-le"), np.uint32))
    got = [(int(at), int(i)) for at, words in found for at, i in zip(at, words, strict=True)]
    want = [(at, i) for p, i in ids.items() for at in range(len(joined)) if joined.startswith(p, at)]
    assert sorted(got) == sorted(want)
    for size, (at, words) in enumerate(found, 1):
        assert (np.diff(at) > 0).all() and all(len(pieces[i // 3]) == size for i in words.tolist())
    assert unigram.Matcher({}).matches(np.array([97, 98])) == []


def test_texts_drawn_and_decoded_together_equal_those_done_one_by_one():
    """A batch gives its ids, and decodes them, in flat arrays, with no step for each text's pieces."""
    voc = unigram.load_vocabulary(unigram.default_model())
    sampler, texts = sampling.Sampler(voc), [*ODD_TEXTS, "日本語 \U0001f600" * 3, "", "plain text"]
    drawn = sampler.draw_batch(texts, list(range(len(texts))), 3)
    decoded = unigram.decode_all(voc, drawn.ids, drawn.offsets)
    assert len(decoded) == len(drawn.owner) == len(drawn.log_prob) == len(drawn.offsets) - 1
    samples = [sampler.sample(text, 3, seed) for seed, text in enumerate(texts)]
    want = [(i, n, *sample) for i, found in enumerate(samples) for n, sample in enumerate(found, 1)]
    ids = [drawn.ids[a:b].tolist() for a, b in zip(drawn.offsets, drawn.offsets[1:], strict=False)]
    assert want == list(zip(drawn.owner, drawn.sample, ids, drawn.log_prob, drawn.inclusion, strict=True))
    assert decoded == [unigram.decode(voc, i) if i else "" for i in ids]
    assert decoded == [texts[i].replace("▁", " ") for i in drawn.owner]
    nothing = sampler.draw_batch([], [], 2)
    assert nothing.owner == [] and unigram.decode_all(voc, nothing.ids, nothing.offsets) == []


def test_chunks_are_runs_of_blanks_with_a_word():
    for text in [*ODD_TEXTS, "a b", "a  b", "▁ a", "a▁", "x y z "]:
        whole = unigram.BLANK + text.replace(" ", unigram.BLANK)
        assert unigram.chunks(text) == (unigram.CHUNK.findall(whole) if text else [])


def test_ties_at_one_half_keep_both_segmentations():
    sampler = sampling.Sampler(unigram.load_vocabulary(unigram.default_model()))
    text = "☃a\x00hb☃日▁ \n本e\tthb☃%\n\n.☃😀😀ttt.!\t\n"
    for seed in range(5):
        samples = sampler.sample(text, 2, seed)
        assert [round(log_prob, 6) for _, log_prob, _ in samples] == [round(math.log(0.5), 6)] * 2
    sampler.add(chunks := ["☃\n.😀" * n + "ttt" for n in range(1, 11)])
    for chunk in chunks:
        edges = sampler.edges_of(sampler.kept[chunk])
        assert sum(sampler.others[e] > math.log(0.4) for e in edges) >= 2


def test_characters_of_private_use_are_like_others():
    sampler = sampling.Sampler(unigram.load_vocabulary(unigram.default_model()))
    texts = ["a \uf8ff b\uf8ff", "\uf8fe\U0010ffff", "\uf8ff" * 60, "plain"]
    for text, samples in zip(texts, sampler.batch(texts, [1, 2, 3, 4], 2), strict=True):
        assert samples and all(unigram.decode(sampler.vocabulary, ids) == text for ids, _, _ in samples)


def test_texts_are_cut_where_no_piece_goes_on_and_chunks_are_kept_once(monkeypatch):
    voc = unigram.load_vocabulary(unigram.default_model())
    sampler, texts = sampling.Sampler(voc), ["the☃the ☃", "☃the the", "", "the", *ODD_TEXTS, "the"]
    points = sampling.code_points("▁the☃the▁☃")
    assert sampler.chunks(points, np.array([0])).tolist() == [0, 4, 5, 8, 9]
    want = sampler.batch(texts, list(range(len(texts))), 3)
    known = len(sampler.kept.key)
    assert sampler.batch(texts, list(range(len(texts))), 3) == want and len(sampler.kept.key) == known
    # Chunks with equal hashes, also where many are looked up in a small table.
    monkeypatch.setattr(sampling.Chunks, "keys", staticmethod(lambda points, starts, widths: np.full(len(starts), 7, np.uint64)))
    assert sampling.Sampler(voc).batch(texts, list(range(len(texts))), 3) == want


def test_many_chunks_outgrow_the_table():
    words = [f"{i:x}" for i in range(120_000)]
    points, widths = sampling.code_points("".join(words)), np.array([len(w) for w in words])
    kept = sampling.Chunks()
    numbers = [kept.number(points[: widths[:n].sum()], np.cumsum(widths[:n]) - widths[:n], widths[:n]) for n in (1000, len(words))]
    assert sorted(numbers[1].tolist()) == list(range(len(words))) and (numbers[0] == numbers[1][:1000]).all()


def test_lists_of_bytes_decode_as_one_by_one():
    voc = unigram.load_vocabulary(unigram.default_model())
    blank = [voc.byte_ids[b] for b in unigram.BLANK.encode()]
    word = voc.ids["▁the"]
    for lists in ([[word, *blank, word], [], [word]], [[*blank, word]], [[word, blank[0]], [blank[1], word]], [[word, word], [], [voc.ids["é"], word]]):
        ids, offsets = np.array([i for found in lists for i in found], np.int32), np.cumsum([0, *map(len, lists)])
        assert unigram.decode_all(voc, ids, offsets) == [unigram.decode(voc, found) for found in lists]
