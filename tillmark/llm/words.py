"""Word and shingle hashes of many texts at once, in numpy.

A word is a run of bytes outside white space (bytes 9 to 13 and 32), A-Z lower-cased. All
texts of a batch are laid end to end, and every word is hashed by sums over a rolling
polynomial, so no step goes through the words one by one.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UP, _DOWN = _powers(_BASE, _STEP + 1), _powers(_INVERSE, _STEP + 1)


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, and where words start and end in them."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    word = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(word[1:] != word[:-1])
    return data, edges[::2], edges[1::2]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash.

    The hash is a polynomial in the bytes modulo 2**64, mixed. The rolling sum starts anew at
    blocks of 65,536 bytes; longer words are joined from their pieces.
    """
    data, starts, ends = word_spans(raw)
    n = len(data)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(starts), np.uint64)
        for at in range(0, n, _STEP):
            block = _LETTER[data[at : at + _STEP]]
            sums = np.concatenate(([np.uint64(0)], np.cumsum(block * _UP[: len(block)], dtype=np.uint64)))
            first = np.searchsorted(ends, at, side="right")
            last = np.searchsorted(starts, at + len(block), side="left")
            a = np.maximum(starts[first:last] - at, 0)
            b = np.minimum(ends[first:last] - at, len(block))
            part = (sums[b] - sums[a]) * _DOWN[a]
            begun = np.maximum(at - starts[first:last], 0)
            if last > first and begun[0]:
                part[0] *= np.uint64(pow(int(_BASE), int(begun[0]), 1 << 64))
            out[first:last] += part
        return starts, mix(out + (ends - starts).astype(np.uint64))


def slices(texts: list[str | None], chars: int = 2_000_000):
    """Runs of texts of about so many characters, as (from, to); a longer text is one alone."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        size = len(t) if t else 0
        if held and held + size > chars:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def batch_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the offset at which each text's words begin."""
    raws = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    sizes = np.array([len(r) + 1 for r in raws], np.int64)
    starts, hashes = word_hashes(b"\n".join(raws))
    begin = np.concatenate(([0], np.cumsum(sizes)))
    return hashes, np.searchsorted(starts, begin)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct hashes of the k-word shingles, sorted; of all words where there are fewer."""
    n = len(words)
    if not n:
        return words
    if n < k:
        k = n
    with np.errstate(over="ignore"):
        out = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            out = mix(out + words[i : n - k + 1 + i] + np.uint64(i + 1) * _BASE)
    return np.unique(out)
