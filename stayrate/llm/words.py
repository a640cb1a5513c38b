"""Words of texts as flat numpy arrays, hashed a block of texts at a time.

Everything here works on a block of texts whose size in bytes is bounded by the caller (see
`blocks`), so memory does not depend on how many rows an Arrow batch has. A single text is never
cut: memory grows with the longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK_BYTES = 1 << 19

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_OTHER_BASE = 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def blocks(sizes: Iterable[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items whose sizes add up to about the limit, one item at least."""
    start, total, i = 0, 0, -1
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start <= i:
        yield start, i + 1


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a block of texts (UTF-8 bytes, None is an empty text).

    hashes: one 64-bit hash per word; first: where each text's words begin, one entry more than
    there are texts; starts, ends: byte positions of each word in `data`, in which a space
    follows every text; origin: where each text begins in `data`.
    """

    def __init__(self, texts: list[bytes | None], base: int = _BASE):
        texts = [t or b"" for t in texts]
        self.data = b" ".join(texts) + b" "
        a = np.frombuffer(self.data, dtype=np.uint8)
        inside = ~_WHITE[a]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.origin = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.starts, self.origin)
        if len(self.starts):
            lengths = self.ends - self.starts
            at = np.flatnonzero(inside)
            begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            place = np.arange(len(at)) - np.repeat(begins, lengths)
            with np.errstate(over="ignore"):
                terms = (a[at].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()), base)[place]
                self.hashes = mix(np.add.reduceat(terms, begins))
        else:
            self.hashes = np.empty(0, dtype=np.uint64)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_words(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def grams(hashes: np.ndarray, n: int, base: int = _OTHER_BASE) -> np.ndarray:
    """Hashes of n consecutive words: entry i stands for words i .. i + n - 1."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k, power in enumerate(powers(n, base)):
            out += hashes[k : k + count] * power
    return mix(out)
