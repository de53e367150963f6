"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks, the texts of its leaf block elements in page order. A bidirectional
LSTM in numpy reads, for each block, a vector of its tag path (hashed names of the open elements
with their class and id words), hashed words and a few measures, and labels every block with the
context of the whole page. The blocks labelled as content make the text.

There are no labelled pages, so the network is trained on a bounded sample of pages whose blocks
are labelled by their landmarks (``article``, ``main``, ``nav``, ``footer`` and the like, class words such as
"ad" or "comment"). Sites differ in structure and a sample may hold one template only, so every epoch reads
the pages in another shape (``varied``): containers and text elements exchanged, class words replaced, asides, forms and
comments put into the article, landmarks taken away; the labels follow the shape. In some pages
landmarks are hidden from the network, so that it learns from the other signs too.

Cases: a null or empty page, and one without content blocks, gives an empty text; broken or cut
off markup is read as far as it goes; every row gives one row, repeated rows and null ids too; an
empty table gives an empty result; extra columns stay, and columns that have the names of
results are replaced.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.bytehash import word_hashes

#: Pages that the network is trained on, at most (smallest hashes first), and blocks of a training page.
FIT_PAGES = 400
EPOCHS = 30
BATCH_PAGES = 64
HIDDEN = 12
PATH_SLOTS = 48
WORD_SLOTS = 16
MEASURES = 9
RATE = 0.02
#: Chance that a training page's landmarks are hidden.
HIDE = 0.1
#: Chance that a training page is read in another shape.
VARY = 0.7
#: Blocks times pages of one network run, so that the working arrays stay small.
RUN_STEPS = 1 << 15

# Elements by their role in a page.
#: Without an end tag, the first run to the end of the page; the others hide nothing then, nor when closed by "/>".
RAW_TO_END = "script|style|textarea"
RAW_IF_CLOSED = "noscript|template|svg|iframe|object|select"
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT_MARKS = frozenset("article main".split())
WHOLE = frozenset("html body main".split())
BOILERPLATE_MARKS = frozenset("head title nav header footer aside form button menu dialog".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement banner promo sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs "
    "header footer sidebar cookie consent notice alert popup modal comment comments reply replies respond share "
    "social related widget login signup subscribe newsletter copyright".split()
)

#: Attributes: a value in quotes may hold ">"; a quote that is never closed is an ordinary character.
ATTRIBUTES = r"""(?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*"""
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW_TO_END})\b{ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<({RAW_IF_CLOSED})\b(?:{ATTRIBUTES}[^/>])?>.*?</\2\s*>"
    rf"|<[!?][^>]*(?:>|\Z)|</?\Z|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})(?:>|\Z)",
    re.S | re.I,
)
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Page:
    """Block texts, and for each block its path: (element, class words) from the outside in."""

    texts: list[str]
    paths: list[tuple]
    linked: list[int]  # characters inside links


def marks_of(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = (w for m in MARKS.finditer(attributes) for w in WORDS.findall("".join(filter(None, m.groups())).lower()))
    return tuple(dict.fromkeys(found))


def read_page(markup: str) -> Page:
    page = Page([], [], [])
    stack: list[tuple[str, tuple]] = []
    pieces: list[str] = []
    links = link_chars = 0

    def close_block() -> None:
        nonlocal link_chars
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                page.texts.append(text)
                page.paths.append(tuple(stack))
                page.linked.append(link_chars)
            pieces.clear()
        link_chars = 0

    at = 0
    for m in MARKUP.finditer(markup):
        if m.start() > at:
            pieces.append(markup[at : m.start()])
            link_chars += (m.start() - at) * (links > 0)
        at = m.end()
        name = m[4]
        if name is None:
            if m[1] or m[2]:
                pieces.append(" ")
            continue
        name = name.lower()
        if name in VOID:
            if name in BLOCKS:
                close_block()
            else:
                pieces.append(" " if name == "br" else "")
        elif name == "a":
            links = max(0, links + (-1 if m[3] else 1))
        elif name in BLOCKS:
            close_block()
            if m[3]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == name:
                        del stack[depth:]
                        break
            else:
                if stack and (stack[-1][0] == "p" or (name == stack[-1][0] and name in ("li", "dt", "dd", "tr", "td", "th", "option"))):
                    stack.pop()
                stack.append((name, marks_of(m[5])))
    if at < len(markup):
        pieces.append(markup[at:])
    close_block()
    return page


def is_boilerplate(path: tuple) -> bool:
    """Whether an element or class word around a block says that it is not content. The words of the page's own
    elements (a ``body`` or ``main`` "with sidebar") say nothing about it."""
    return any(name in BOILERPLATE_MARKS - {"header"} or (name not in WHOLE and not BOILERPLATE_WORDS.isdisjoint(marks)) for name, marks in path)


def is_marked(path: tuple) -> bool:
    return any(name in CONTENT_MARKS for name, _ in path)


def landmark_label(path: tuple, marked: bool = False, linked: float = 0.0) -> int:
    """1 if the landmarks around a block make it content: inside the page's ``article`` or ``main``, if it has one
    (``marked``), else anything that is neither in a page header nor mostly links."""
    if is_boilerplate(path):
        return 0
    if is_marked(path):
        return 1
    return int(not marked and linked <= 0.5 and all(name != "header" for name, _ in path))


def page_labels(page: Page) -> np.ndarray:
    marked = has_marks(page)
    return np.array([landmark_label(p, marked, n / len(t)) for t, p, n in zip(page.texts, page.paths, page.linked, strict=True)], dtype=np.float32)


def has_marks(page: Page) -> bool:
    return any(is_marked(p) and not is_boilerplate(p) for p in page.paths)


def varied(page: Page, rng: np.random.Generator) -> Page:
    """The page in another shape: its paths with other elements, class words and containers."""
    pick = lambda options: options[rng.integers(len(options))]
    word = lambda: (pick(sorted(BOILERPLATE_WORDS)),)
    content = pick([(("article", ()),), (("main", ()),), (("main", ()), ("article", ())), (("section", ()),), (("div", ("story",)),), ()])
    swapped = {
        "nav": pick([("nav", ()), ("div", ("menu",)), ("ul", ("navbar",)), ("aside", ()), ("div", ())]),
        "footer": pick([("footer", ()), ("div", ("footer",)), ("div", ("copyright",))]),
        "p": pick([("p", ()), ("p", ()), ("div", ()), ("li", ()), ("blockquote", ()), ("td", ()), ("pre", ()), ("dd", ())]),
        "h1": pick([("h1", ()), ("h2", ()), ("h3", ()), ("div", ("title",))]),
    }
    paths = []
    for path in page.paths:
        new: list[tuple] = []
        for name, marks in path:
            if name in CONTENT_MARKS:
                new += content
            elif not BOILERPLATE_WORDS.isdisjoint(marks):
                new.append((name, word()))
            else:
                new.append((swapped[name][0], swapped[name][1] or marks) if name in swapped else (name, marks))
        if is_marked(path) and not is_boilerplate(path):
            draw = rng.random()
            if draw < 0.15:
                new.insert(len(new) - 1, pick([("aside", ()), ("form", ()), ("nav", ()), ("div", word()), ("section", word()), ("footer", ())]))
            elif draw < 0.35:
                new.insert(len(new) - 1, pick([("section", ()), ("div", ("text",)), ("ul", ()), ("table", ()), ("header", ()), ("div", ("wide", "column"))]))
        elif rng.random() < 0.1:
            new = [*new[:2], pick([("p", ()), ("div", ()), ("h2", ()), ("li", ())])]
        paths.append(tuple(new))
    return Page(page.texts, paths, page.linked)


def slot(word: str, slots: int) -> int:
    return zlib.crc32(word.encode()) % slots


def path_vector(path: tuple, hide: bool) -> np.ndarray:
    v = np.zeros(PATH_SLOTS, dtype=np.float32)
    for name, marks in path:
        if hide and (name in CONTENT_MARKS or name in BOILERPLATE_MARKS):
            name = "div"
        v[slot(name, PATH_SLOTS)] += 1.0
        if not hide and name not in WHOLE:
            for word in marks:
                v[slot("." + word, PATH_SLOTS)] += 1.0
    return np.minimum(v, 2.0)


def features(pages: list[Page], hide: list[bool] | None = None) -> list[np.ndarray]:
    """One matrix per page: a row of path, words and measures per block."""
    texts = [t for p in pages for t in p.texts]
    width = PATH_SLOTS + WORD_SLOTS + MEASURES
    if not texts:
        return [np.zeros((0, width), dtype=np.float32) for _ in pages]
    hashes, counts = word_hashes([t.encode() for t in texts])
    owner = np.repeat(np.arange(len(texts)), counts)
    cells = owner * WORD_SLOTS + (hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
    words = np.bincount(cells, minlength=len(texts) * WORD_SLOTS).reshape(-1, WORD_SLOTS)
    x = np.zeros((len(texts), width), dtype=np.float32)
    x[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = words / np.maximum(counts, 1)[:, None]
    chars = np.fromiter(map(len, texts), dtype=np.float32, count=len(texts))
    linked = np.array([n for p in pages for n in p.linked], dtype=np.float32)
    ends = np.array([t[-1] in ".!?:;…" for t in texts], dtype=np.float32)
    x[:, -MEASURES:-4] = np.column_stack(
        [np.log1p(chars) / 6, np.log1p(counts) / 5, np.minimum(linked / chars, 1), ends, chars < 30]
    )
    known: dict[tuple, np.ndarray] = {}
    signs: dict[tuple, tuple] = {}
    at = 0
    out = []
    for i, page in enumerate(pages):
        hidden = bool(hide and hide[i])
        marked = has_marks(page)
        for k, path in enumerate(page.paths):
            if not hidden:
                if (path, marked) not in signs:
                    plain = landmark_label(path, marked)
                    signs[path, marked] = (is_boilerplate(path), is_marked(path), marked, plain)
                x[at + k, -4:] = signs[path, marked]
            v = known.get((path, hidden))
            if v is None:
                v = known[path, hidden] = path_vector(path, hidden)
            x[at + k, :PATH_SLOTS] = v
        out.append(x[at : at + len(page.texts)])
        at += len(page.texts)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Labeller:
    """A bidirectional LSTM with a logistic output per step; parameters are a dict of arrays."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @classmethod
    def fresh(cls, width: int, seed: int = 3) -> Labeller:
        rng = np.random.default_rng(seed)
        p = {}
        for side in "fb":
            p[f"w{side}"] = rng.normal(0, 0.2, (width + HIDDEN, 4 * HIDDEN)).astype(np.float32)
            p[f"c{side}"] = np.r_[np.ones(HIDDEN), np.zeros(3 * HIDDEN)].astype(np.float32)
        p["v"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
        p["o"] = np.zeros(1, dtype=np.float32)
        return cls(p)

    def side(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """Hidden states (steps x pages x HIDDEN) and what the backward pass needs."""
        steps, pages, width = x.shape
        w, c = self.p[f"w{side}"], self.p[f"c{side}"]
        driven = x @ w[:width] + c
        h = np.zeros((pages, HIDDEN), dtype=np.float32)
        cell = np.zeros_like(h)
        states = np.zeros((steps, pages, HIDDEN), dtype=np.float32)
        trace = []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = driven[t] + h @ w[width:]
            gates = sigmoid(z[:, : 3 * HIDDEN])
            forget, take, show = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            new = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            after = forget * cell + take * new
            squashed = np.tanh(after)
            trace.append((t, h, cell, forget, take, show, new, squashed, m))
            cell = np.where(m, after, cell)
            h = np.where(m, show * squashed, h)
            states[t] = h
        return states, trace

    def logits(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list, list, np.ndarray]:
        forward, tf = self.side(x, mask, "f")
        backward, tb = self.side(x, mask, "b")
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["v"] + self.p["o"], tf, tb, both

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        logit, tf, tb, both = self.logits(x, mask)
        d = np.where(mask, sigmoid(logit) - y, 0.0).astype(np.float32) / max(1, mask.sum())
        g = {"v": np.einsum("tp,tph->h", d, both), "o": d.sum(keepdims=True).ravel()}
        d_states = d[:, :, None] * self.p["v"]
        for side, trace, part in (("f", tf, d_states[..., :HIDDEN]), ("b", tb, d_states[..., HIDDEN:])):
            g |= self.side_gradients(x, side, trace, part)
        return g

    def side_gradients(self, x, side: str, trace: list, d_states: np.ndarray) -> dict[str, np.ndarray]:
        width = x.shape[2]
        w = self.p[f"w{side}"]
        gw, gc = np.zeros_like(w), np.zeros_like(self.p[f"c{side}"])
        dh = np.zeros(d_states.shape[1:], dtype=np.float32)
        dc = np.zeros_like(dh)
        for t, h, cell, forget, take, show, new, squashed, m in reversed(trace):
            total = dh + d_states[t]
            own = total * m
            d_after = dc * m + own * show * (1 - squashed * squashed)
            dz = np.concatenate(
                [
                    d_after * cell * forget * (1 - forget),
                    d_after * new * take * (1 - take),
                    own * squashed * show * (1 - show),
                    d_after * take * (1 - new * new),
                ],
                axis=1,
            )
            gw[:width] += x[t].T @ dz
            gw[width:] += h.T @ dz
            gc += dz.sum(axis=0)
            dh = np.where(m, dz @ w[width:].T, total)
            dc = np.where(m, d_after * forget, dc)
        return {f"w{side}": gw, f"c{side}": gc}


def stacked(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages padded to one length: (steps x pages x width) and the mask of real steps."""
    steps = max((len(p) for p in pages), default=0)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), dtype=np.float32)
    mask = np.zeros((steps, len(pages)), dtype=bool)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
        mask[: len(p), i] = True
    return x, mask


def train(pages: list[Page], seed: int = 3) -> Labeller:
    pages = [p for p in pages if p.texts]
    model = Labeller.fresh(PATH_SLOTS + WORD_SLOTS + MEASURES, seed)
    if not pages:
        return model
    rng = np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    step = 0
    for _ in range(EPOCHS):
        shaped = [varied(p, rng) if rng.random() < VARY else p for p in pages]
        labels = [page_labels(p) for p in shaped]
        inputs = features(shaped, list(rng.random(len(pages)) < HIDE))
        order = rng.permutation(len(pages))
        for at in range(0, len(order), BATCH_PAGES):
            chosen = order[at : at + BATCH_PAGES]
            x, mask = stacked([inputs[i] for i in chosen])
            y, _ = stacked([labels[i][:, None] for i in chosen])
            step += 1
            for k, g in model.gradients(x, mask, y[:, :, 0]).items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model.p[k] = model.p[k] - (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(
                    np.float32
                )
    return model


def label_pages(model: Labeller, pages: list[Page]) -> list[np.ndarray]:
    """For each page, which blocks are content. Pages of like length run together."""
    inputs = features(pages)
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(inputs[i])), key=lambda i: len(inputs[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(inputs[order[end]]) * (end + 1 - at) <= RUN_STEPS:
            end += 1
        x, mask = stacked([inputs[i] for i in order[at:end]])
        positive = model.logits(x, mask)[0] > 0
        for k, i in enumerate(order[at:end]):
            out[i] = positive[: len(inputs[i]), k]
        at = end
    return out


def fit_labeller(pages: DataFrame, column: str = "html") -> Labeller:
    """Train on a bounded sample of the pages."""
    hashed = pages.select(F.xxhash64(column).alias("_h"), F.col(column).alias("_p")).filter(F.col("_p").isNotNull())
    smallest = hashed.select("_h").distinct().orderBy("_h").limit(FIT_PAGES).agg(F.max("_h")).first()[0]
    if smallest is None:
        return train([])
    sample = hashed.filter(F.col("_h") <= smallest).dropDuplicates(["_h"]).select("_p").collect()  # FIT_PAGES pages
    return train([read_page(r["_p"]) for r in sample])


def extract_text(pages: DataFrame, model: Labeller, column: str = "html") -> DataFrame:
    """``pages`` plus ``text`` (content blocks joined by line feeds) and ``n_chars``."""
    parameters = model.p

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller = Labeller(parameters)
        for batch in batches:
            texts: list[str] = []
            for at in range(0, len(batch), 256):
                read = [read_page(markup) for markup in batch.iloc[at : at + 256]]
                for page, keep in zip(read, label_pages(labeller, read), strict=True):
                    texts.append("\n".join(t for t, k in zip(page.texts, keep.tolist(), strict=True) if k))
            yield pd.Series(texts, dtype=object)

    found = pages.withColumn("text", extracted(F.coalesce(F.col(column), F.lit(""))))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages, fit_labeller(pages)).drop("html")
