"""Vectorised hashes over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

from tabforge.llm.common import SEPARATORS, U64, mix

#: Random 64-bit value of each byte, from a fixed seed.
BYTE_VALUE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SEPARATOR = np.zeros(256, dtype=bool)
IS_SEPARATOR[[ord(c) for c in SEPARATORS]] = True
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse modulo 2**64, for i below ``n``; kept per process."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"], _POWERS["down"]


def blocks_of(texts: Iterable[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts in blocks of about ``limit`` bytes, each with its first place."""
    block: list[bytes] = []
    size = first = 0
    for i, raw in enumerate(texts):
        if block and size + len(raw) > limit:
            yield first, block
            block, size, first = [], 0, i
        block.append(raw)
        size += len(raw)
    if block:
        yield first, block


def cut_at(raw: bytes, pattern: re.Pattern[bytes], limit: int = 1 << 20) -> Iterator[bytes]:
    """A long text in blocks of about ``limit`` bytes, cut behind matches of ``pattern``."""
    at = 0
    while len(raw) - at > limit and (end := pattern.search(raw, at + limit)):
        yield raw[at : end.end()]
        at = end.end()
    yield raw[at:]


def run_hashes(raw: bytes, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each maximal run of the bytes that ``inside`` marks, A-Z lower-cased."""
    lowered = LOWER[np.frombuffer(raw, dtype=np.uint8)]
    apart = ~inside[lowered]
    edge = np.flatnonzero(np.diff(apart.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    start, end = edge[0::2], edge[1::2]
    up, down = powers(len(lowered))
    with np.errstate(over="ignore"):
        total = np.zeros(len(lowered) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUE[lowered] * up[: len(lowered)], out=total[1:])
        return mix((total[end] - total[start]) * down[start]), start, end


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word (maximal run of bytes that are no separators) of all texts in
    order, and the number of words of each text."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    apart = IS_SEPARATOR[raw]
    if lower:
        raw = LOWER[raw]
    edge = np.flatnonzero(np.diff(apart.view(np.int8), prepend=np.int8(1)))
    start, end = edge[0::2], edge[1::2]
    up, down = powers(len(raw))
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUE[raw] * up[: len(raw)], out=total[1:])
        hashes = mix((total[end] - total[start]) * down[start])
    return hashes, np.diff(np.searchsorted(start, np.r_[0, np.cumsum(sizes)]))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` neighbouring words."""
    with np.errstate(over="ignore"):
        h = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            h = mix(h * BASE + words[k : len(words) - n + 1 + k])
        return h


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of one text's ``n``-word shingles; of a shorter text, the one hash
    of its whole word sequence; of no words, nothing."""
    if len(words) >= n:
        return np.unique(shingle_hashes(words, n))
    if len(words) == 0:
        return words
    with np.errstate(over="ignore"):
        return mix(shingle_hashes(words, len(words)) + U64(len(words)))


def refine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bucket numbers of pairs of bucket numbers."""
    with np.errstate(over="ignore"):
        z = x * U64(0xD6E8FEB86659FD93) + y
        z ^= z >> U64(32)
        z *= U64(0xBF58476D1CE4E5B9)
        z ^= z >> U64(29)
    return z


def group_sizes(values: np.ndarray) -> np.ndarray:
    """For each value, how often it occurs."""
    order = np.argsort(values)
    ranked = values[order]
    head = np.r_[True, ranked[1:] != ranked[:-1]][: len(values)]
    group = np.cumsum(head) - 1
    sizes = np.empty(len(values), dtype=np.int64)
    sizes[order] = np.bincount(group)[group] if len(values) else 0
    return sizes
