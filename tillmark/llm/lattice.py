"""All vocabulary entries inside many short strings at once, in numpy.

A trie of the vocabulary is one hash table from (node, symbol) to node. Strings are laid out by
length, the longest first, so that those with a symbol at a place are always the first so many;
starting from each place all strings walk the trie together, and those that fall out are left
behind. Work grows with the entries found, not with the longest entry.
"""

from __future__ import annotations

import sys
from collections import defaultdict

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Trie:
    """Symbols are numbers below ``symbols``; each entry has a number from 0."""

    def __init__(self, entries: dict, symbols: int):
        go, value = {}, [-1]
        for word, number in entries.items():
            node = 0
            for symbol in word:
                key = node * symbols + symbol
                node = go.get(key, 0)
                if not node:
                    node = go[key] = len(value)
                    value.append(-1)
            value[node] = number
        self.symbols = symbols
        self.value = np.array(value, np.int32)
        bits = max(4, (4 * len(go)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.nodes = np.full(1 << bits, -1, np.int32)
        keys = np.fromiter(go.keys(), np.int64, len(go))
        slots = self._slots(keys)
        for key, node, slot in zip(keys.tolist(), go.values(), slots.tolist()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.keys[slot] = key
            self.nodes[slot] = node

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.view(np.uint64) * _SPREAD >> self.shift).view(np.int64)

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The nodes that symbols lead to, -1 where none does. Unknown symbols are negative."""
        keys = nodes.astype(np.int64) * self.symbols + symbols
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.nodes[slots], -1)
        lost = np.flatnonzero((held != keys) & (held >= 0))
        while len(lost):
            slots[lost] = (slots[lost] + 1) & self.mask
            held = self.keys[slots[lost]]
            hit = held == keys[lost]
            out[lost[hit]] = self.nodes[slots[lost[hit]]]
            lost = lost[~hit & (held >= 0)]
        out[symbols < 0] = -1
        return out


class Strings:
    """Strings of symbols, all laid end to end in ``symbols``, by their lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        first = (np.cumsum(lengths) - lengths)[self.order]
        self.lengths = lengths[self.order]
        self.longest = int(self.lengths[0]) if len(lengths) else 0
        #: How many strings have more than so many symbols.
        self.count = np.searchsorted(-self.lengths, -np.arange(1, self.longest + 1), side="right")
        self.rows = [symbols[first[:n] + e] for e, n in enumerate(self.count.tolist())]

    def found(self, trie: Trie) -> dict[int, list[tuple[int, np.ndarray, np.ndarray]]]:
        """By the place after it, the entries that end there: first place, strings and numbers,
        from the longest entry to the shortest."""
        out = defaultdict(list)
        for start in range(self.longest):
            who = np.arange(self.count[start])
            nodes = np.zeros(len(who), np.int32)
            for at in range(start, self.longest):
                n = int(np.searchsorted(who, self.count[at]))
                nodes = trie.step(nodes[:n], self.rows[at][who[:n]])
                on = np.flatnonzero(nodes >= 0)
                if not len(on):
                    break
                who, nodes = who[on], nodes[on]
                number = trie.value[nodes]
                hit = np.flatnonzero(number >= 0)
                if len(hit):
                    out[at + 1].append((start, who[hit], number[hit]))
        return out
