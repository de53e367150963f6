"""A SentencePiece vocabulary read as a unigram model: pieces, scores, and the lattice rules.

White space is escaped as U+2581, a dummy prefix stands before a text, characters without a piece
of their own are unknown and fall back to their UTF-8 bytes. No piece of the vocabulary goes on
past a blank that follows a word, so the lattice of a text falls apart into chunks, each a run of
blanks and the word behind it; texts are handled chunk by chunk.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = "▁"
CHUNK = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
#: Distinct chunks whose results a task keeps; the store is emptied when it is full.
KEPT_CHUNKS = 400_000
#: Places that a node of the double array is tried at together.
WINDOW = 1 << 13


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[str]  # normal, byte, or other
    ids: dict[str, int] = field(default_factory=dict)
    byte_ids: list[int] = field(default_factory=list)
    raw: pa.Array | None = None  # bytes of the pieces, made when texts are first decoded together

    def __post_init__(self):
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == "normal"}
        self.byte_ids = [i for i, k in enumerate(self.kinds) if k == "byte"]
        #: What a piece stands for; bytes above 127 as escapes that encode to that byte.
        self.texts = list(self.pieces)
        for byte, i in enumerate(self.byte_ids):
            self.texts[i] = bytes([byte]).decode("utf-8", "surrogateescape")
        crossing = [p for p in self.ids if re.search(f"[^{BLANK}]{BLANK}", p)]
        if crossing:
            raise ValueError(f"pieces go on past a blank, chunks would not be exact: {crossing[:3]}")
        #: As the library has it: ten below the least score.
        self.unknown_score = min(self.scores[i] for i in self.ids.values()) - 10.0

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            machine.add_word(piece, (len(piece), self.scores[i], i))
        machine.make_automaton()
        return machine


class Matcher:
    """Finds the pieces in a string by walking a trie from all its positions at once. The trie is a
    double array: the child of a node by a character lies at the node's base plus the character's
    number, and names the node as its parent."""

    def __init__(self, ids: dict[str, int]):
        characters = sorted(set().union(*ids))
        #: Number of a character; 0 for those of no piece, over which no match reaches, and for one past the last.
        self.number = np.zeros(sys.maxunicode + 2, np.int32)
        self.number[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        number = {c: n for n, c in enumerate(characters, 1)}
        children: list[dict[int, int]] = [{}]
        words = [-1]
        for piece, i in ids.items():
            node = 0
            for c in piece:
                node = children[node].setdefault(number[c], len(children))
                if node == len(children):
                    children.append({})
                    words.append(-1)
            words[node] = i
        base, slot = np.zeros(len(children), np.int64), np.zeros(len(children), np.int64)
        free = np.ones(len(children) + len(characters) + 2 * WINDOW, bool)
        free[0] = False
        start, width = 1, 0
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            below = np.fromiter(children[node], np.int64, len(children[node]))
            if len(below) < 2:
                break
            if len(below) != width:
                start, width = 1, len(below)
            while True:
                if start + WINDOW + len(characters) >= len(free):
                    free = np.r_[free, np.ones(len(free), bool)]
                fits = free[start + below[0] : start + below[0] + WINDOW].copy()
                for c in below[1:].tolist():
                    fits &= free[start + c : start + c + WINDOW]
                if fits.any():
                    break
                start += WINDOW
            base[node] = start + int(fits.argmax())
            free[base[node] + below] = False
            slot[list(children[node].values())] = base[node] + below
        alone = [(node, *item) for node, below in enumerate(children) if len(below) == 1 for item in below.items()]
        if alone:
            nodes, steps, ends = np.array(alone).T
            if free[len(characters) + 1 :].sum() < len(nodes):
                free = np.r_[free, np.ones(len(nodes), bool)]
            slot[ends] = len(characters) + 1 + np.flatnonzero(free[len(characters) + 1 :])[: len(nodes)]
            base[nodes] = slot[ends] - steps
        size = int(max(slot.max(), base.max())) + len(characters) + 1
        self.base, self.parent, self.word = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        self.base[slot], self.word[slot] = base, words
        for node, below in enumerate(children):
            if below:
                self.parent[slot[list(below.values())]] = slot[node]

    def matches(self, points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The pieces of 1, 2, 3 ... characters in code points that end with one of no piece: where
        they start, in rising order, and their ids."""
        number = self.number[points].astype(np.int64)
        at = np.flatnonzero(number)
        node, base = np.zeros(len(at), np.int64), np.full(len(at), self.base[0])
        found = []
        while len(at):
            child = base + number[at + len(found)]
            on = np.flatnonzero(self.parent[child] == node)
            at, node = at[on], child[on]
            word = self.word[node]
            hit = np.flatnonzero(word >= 0)
            found.append((at[hit], word[hit]))
            base = self.base[node]
            on = np.flatnonzero(base)
            at, node, base = at[on], node[on], base[on]
        return found


def load_vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    kinds = [
        "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) else "normal"
        for i in range(n)
    ]
    return Vocabulary([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], kinds)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def chunks(text: str) -> list[str]:
    """The chunks of a text with its dummy prefix; an empty text has none."""
    if not text:
        return []
    words = text.replace(" ", BLANK).split(BLANK)
    return [BLANK + word for word in words] if all(words) else CHUNK.findall(BLANK + BLANK.join(words))


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of piece ids: bytes are joined, blanks restored, the dummy prefix removed."""
    joined = "".join([vocabulary.texts[i] for i in ids])
    return joined.encode("utf-8", "surrogateescape").decode("utf-8", "replace").replace(BLANK, " ")[1:]


def decode_array(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """``decode`` of many lists of ids, which lie one after the other from ``offsets[i]`` to ``offsets[i + 1]``."""
    if vocabulary.raw is None:
        vocabulary.raw = pa.array([t.replace(BLANK, " ").encode("utf-8", "surrogateescape") for t in vocabulary.texts], pa.binary())
    joined = vocabulary.raw.take(pa.array(ids))
    _, starts, data = joined.buffers()
    cuts = np.frombuffer(starts, np.int32)[joined.offset + offsets] if len(ids) else np.zeros(len(offsets), np.int32)
    data = memoryview(data or b"")[: int(cuts[-1])]
    # Bytes can make up a blank, or what is no text; such lists are decoded one by one.
    if BLANK.encode() not in bytes(data):
        try:
            texts = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
            return pc.utf8_slice_codeunits(texts.cast(pa.string()), 1)
        except pa.ArrowInvalid:
            pass
    cuts = cuts.tolist()
    return pa.array([str(data[a:b], "utf-8", "replace").replace(BLANK, " ")[1:] for a, b in zip(cuts, cuts[1:], strict=False)], pa.string())


def decode_all(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    return decode_array(vocabulary, ids, offsets).to_pylist()
