"""Hashes of words and word shingles of many texts at once, with array operations.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.  A text's set
is its distinct shingles of five words; with fewer words, the whole
sequence as one; without words, empty.  A hash has 64 bits.
"""

from __future__ import annotations

import numpy as np

from .workers import kept

WORDS = 5
# Entries by which the tables of powers grow.
POWERS_STEP = 1 << 18

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + _U(1)
_LOWER[ord("A"):ord("Z") + 1] += _U(32)

# Odd multipliers: a hash is a polynomial in BASE modulo 2 ** 64, then mixed.
BASE = 0x9E3779B97F4A7C15
_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, for i below ``n`` (kept for the next call)."""
    tables = kept("powers", lambda: {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    if len(tables["up"]) < n:
        size = -(-n // POWERS_STEP) * POWERS_STEP
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            out = np.empty(size, np.uint64)
            out[0], have = 1, 1
            while have < size:
                step = min(have, size - have)
                out[have:have + step] = out[:step] * _U(pow(b, have, 1 << 64))
                have += step
            tables[name] = out
    return tables["up"][:n], tables["down"][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums: entry i covers the values before i."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    doc_ends = np.cumsum([len(r) + 1 for r in raws])
    space = _SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    sums = prefix_sums(_LOWER[data])
    _, down = powers(len(data) + 1)
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    firsts = np.searchsorted(starts, np.concatenate([[0], doc_ends]))
    shingles = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for i in range(WORDS):
        shingles += words[i:i + len(shingles)] * _STEPS[i]
    shingles = mix(shingles)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= WORDS:
            own = np.sort(shingles[a:b - WORDS + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            # fewer words: their number is part of the hash
            few = mix((words[a:b] * _STEPS[:b - a]).sum(keepdims=True) + _U(b - a))
            out.append(few)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def slices(batches, rows: int = 500):
    """Batches of few rows, which bound the Python objects that are alive."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def chunked(texts: list[str | None], chars: int = 500_000):
    """Positions (from, to) of runs of texts of about ``chars`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
