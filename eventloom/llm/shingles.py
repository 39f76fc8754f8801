"""Word and shingle hashes of many texts at once, in numpy over UTF-8 bytes.

Separators are ASCII, so words can be cut in the bytes. A word's hash is a polynomial over
its bytes (each byte through a table of random 64-bit numbers) taken from running sums, and
then mixed; a shingle's hash is the same over its words' hashes.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
#: Bytes hashed at a time; a longer text makes a longer run of its own.
BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Keeps the powers of the base between blocks, as many as the longest block needed."""

    def __init__(self, lower: bool):
        self.lower = lower
        self.up, self.down = powers(BASE, 1), powers(INVERSE, 1)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts joined by separators: each word's hash, first byte, end and text number."""
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        if len(data) > len(self.up):
            self.up, self.down = powers(BASE, 2 * len(data)), powers(INVERSE, 2 * len(data))
        space = SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        start, end = edge[0::2], edge[1::2]
        if len(end) < len(start):
            end = np.append(end, len(data))
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(BYTE[LOWER[data] if self.lower else data] * self.up[: len(data)], dtype=np.uint64)))
        hashes = mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
        ends = np.cumsum([len(t) + 1 for t in texts])
        return hashes, start, end, np.searchsorted(ends, start, side="right")


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by its first word."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
    for j in range(size):
        out = out * BASE + hashes[j : len(hashes) - size + 1 + j]
    return mix(out + np.uint64(size))


def blocks(texts: list[str | None]):
    """(first number, UTF-8 texts) of about BLOCK bytes each; null is empty."""
    held, size, first = [], 0, 0
    for k, t in enumerate(texts):
        data = t.encode("utf-8", "replace") if t else b""
        if held and size + len(data) > BLOCK:
            yield first, held
            held, size, first = [], 0, k
        held.append(data)
        size += len(data) + 1
    if held:
        yield first, held


def shingle_sets(texts: list[str | None], size: int, hasher: Hasher) -> list[np.ndarray]:
    """Of each text, lower-cased: its distinct shingles' hashes, sorted; a text of fewer words has one of them all."""
    out: list[np.ndarray] = []
    for _, some in blocks(texts):
        hashes, _, _, owner = hasher.words(some)
        runs = grams(hashes, size)
        cut = np.searchsorted(owner, np.arange(len(some) + 1))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b - a >= size:
                out.append(np.unique(runs[a : b - size + 1]))
            elif b > a:
                out.append(grams(hashes[a:b], b - a))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out
