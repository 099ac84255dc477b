"""Exact token counts of every prefix of a text, for byte-level BPE vocabularies.

The encoding of a text is unique, and cutting tokens off its end leaves the encoding of
what remains. So for every prefix of a pre-token there is exactly one last token: one that
may follow the last token of the shorter prefix in front of it, which is the case when the
bytes of both, merged anew, give the two again. Going through the prefixes from short to long
gives the token count of each. A table holds, per text, the change of the count at every
character (``steps``, one signed byte each). Counts of any prefix, the longest prefix within
a limit, and budgets over many texts are then sums over that table, without encoding again.

A count is that of the prefix alone, as if the text ended there. Characters at which this
differs from the text's own pre-tokens are runs of white space (their last character leaves the
run once a word follows), contractions of three characters, and the beginnings of a special
string, which is one token once complete.

Defined results:

* a NULL text is empty: 0 bytes, 0 tokens, no steps; texts of any length are counted whole;
* rows are counted one by one, so repeated rows and NULL ids give one row each;
* an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.caches import Memo, kept
from tillmark.llm.lattice import Strings, Trie
from tillmark.llm.words import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters with the property White_Space, and the pre-tokens of the vocabulary.
SPACE = "\t-\r \x85\xa0  -     　"
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
UNIT = rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"


# Pre-tokens whose first two characters are two pre-tokens as long as the third is missing.
UNEVEN = ("'re", "'ve", "'ll")
NEVER = 1 << 60
# Pre-tokens of more bytes are counted one by one, and so many characters of texts together.
LONG, TOGETHER = 64, 2_000_000


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Prefix counts under the vocabulary in the text of a ``tokenizers`` JSON file."""

    def __init__(self, vocabulary: str, memo: int = 50_000):
        spec = json.loads(vocabulary)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"].get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        letters = _byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        special = [t["content"] for t in spec["added_tokens"]]
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.tokens = {raw(t): i for t, i in vocab.items()}
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[raw(a), raw(b)] = rank
        # The longest token by its last four bytes; any other is shorter than four.
        self.reach = {}
        for t in sorted(self.tokens, key=len):
            if len(t) > 3:
                self.reach[t[-4:]] = len(t)
        self.special = sorted(special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, self.special))) if special else None
        self.pre_token = regex.compile(PRE_TOKEN)
        self.unit = re.compile(UNIT)
        self.space = re.compile(f"[{SPACE}]+")
        self.nothing = max(self.tokens.values()) + 1
        self.raw = {i: t for t, i in self.tokens.items()} | {self.nothing: b""}
        self.pairs = {}
        self.trie = Trie(self.tokens, 256)
        self.endings = Memo(self._ending, memo)
        self.words = Memo(self._word_steps, memo)

    def merge(self, text: bytes) -> list[bytes]:
        """Plain BPE: join the adjacent pair of lowest rank until none is left."""
        parts, ranks = [text[i : i + 1] for i in range(len(text))], self.ranks
        found = [ranks.get(pair, NEVER) for pair in zip(parts, parts[1:])]
        while found and (best := min(found)) < NEVER:
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = ranks.get((parts[i - 1], parts[i]), NEVER)
            if i + 1 < len(parts):
                found[i] = ranks.get((parts[i], parts[i + 1]), NEVER)
        return parts

    def _follows(self, pair: int) -> bool:
        """Whether two tokens (or one, after nothing) stay as they are when merged anew."""
        if len(self.pairs) > 500_000:
            self.pairs.clear()
        last, token = self.raw[pair >> 32], self.raw[pair & 0xFFFFFFFF]
        found = self.pairs[pair] = self.merge(last + token) == ([last, token] if last else [token])
        return found

    def _ending(self, tail: bytes) -> list[tuple[int, int]]:
        """Length and id of the tokens that end a string, longest first."""
        return [
            (len(tail) - i, self.tokens[tail[i:]])
            for i in range(len(tail))
            if tail[i:] in self.tokens
        ]

    def counts(self, word: bytes) -> list[int]:
        """The token count of every prefix of one pre-token, from the empty one on."""
        endings, known, reach = self.endings, self.pairs.get, self.reach.get
        count, last = [0], [self.nothing]
        for end in range(1, len(word) + 1):
            longest = reach(word[end - 4 : end], 3) if end > 3 else 3
            for length, token in endings[word[end - longest if end > longest else 0 : end]]:
                pair = last[end - length] << 32 | token
                fits = known(pair)
                if fits is None:
                    fits = self._follows(pair)
                if fits:
                    count.append(count[end - length] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")
        return count

    def _word_steps(self, word: str) -> bytes:
        raw = word.encode()
        count = self.counts(raw)
        if len(raw) > len(word):
            ends, at = 0, [0]
            for c in word:
                ends += 1 if c < "\x80" else len(c.encode())
                at.append(count[ends])
            count = at
        if word in UNEVEN:
            count[2] = 2
        return bytes([b - a & 255 for a, b in zip(count, count[1:])])

    def _fits(self, pairs: np.ndarray) -> np.ndarray:
        """``_follows`` of many pairs."""
        distinct, at = np.unique(pairs, return_inverse=True)
        known = self.pairs.get
        found = [known(p) for p in distinct.tolist()]
        for i, fits in enumerate(found):
            if fits is None:
                found[i] = self._follows(int(distinct[i]))
        return np.array(found, bool)[at]

    def word_steps(self, words: Sequence[str]) -> list[bytes]:
        """The steps of many pre-tokens: all of ordinary length in one pass, byte by byte."""
        out = [None] * len(words)
        raws = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        odd = lengths > LONG
        for i, w in enumerate(words):
            if odd[i] or w in UNEVEN:
                out[i] = self.words[w]
        plain = np.flatnonzero(~odd)
        data = np.frombuffer(b"".join([raws[i] for i in plain.tolist()]), np.uint8)
        strings = Strings(data.astype(np.int32), lengths[plain])
        found = strings.found(self.trie)
        count, last = [np.zeros(len(plain), np.int32)], [np.full(len(plain), self.nothing, np.int64)]
        for end in range(1, strings.longest + 1):
            n = strings.count[end - 1]
            counts, lasts = np.full(n, -1, np.int32), np.zeros(n, np.int64)
            for start, who, number in found[end]:
                left = np.flatnonzero(counts[who] < 0)
                who, number = who[left], number[left]
                fits = self._fits(last[start][who] << 32 | number)
                who, number = who[fits], number[fits]
                counts[who] = count[start][who] + 1
                lasts[who] = number
            if (counts < 0).any():
                raise ValueError("a byte is missing from the vocabulary")
            count.append(counts)
            last.append(lasts)
        # Word after word again, the change at each byte, then at each character.
        first = (np.cumsum(lengths[plain]) - lengths[plain])[strings.order]
        change = np.zeros(len(data), np.int32)
        for end in range(1, strings.longest + 1):
            n = strings.count[end - 1]
            change[first[:n] + end - 1] = count[end] - count[end - 1][:n]
        starts = np.flatnonzero(data & 0xC0 != 0x80)
        steps = np.add.reduceat(change, starts).astype(np.int8).tobytes() if len(starts) else b""
        at = 0
        for i in plain.tolist():
            n = len(words[i])
            if out[i] is None:
                out[i] = steps[at : at + n]
            at += n
        return out

    def unit_steps(self, units: Sequence[str]) -> list[bytes]:
        """Steps of white space and the word after it, for many units."""
        split = list(map(self.pre_token.findall, units))
        runs = [
            run[0] if u[1:2].isspace() and (run := self.space.match(u)) and run.end() > 1 else None
            for u in units
        ]
        words = list(dict.fromkeys([w for row in split for w in row] + [r for r in runs if r]))
        steps = dict(zip(words, self.word_steps(words)))
        return [
            self._unit(row, steps) if run is None else self._spaced(row, run, steps)
            for row, run in zip(split, runs)
        ]

    def _unit(self, words: list[str], steps: dict[str, bytes]) -> bytes:
        return steps[words[0]] if len(words) == 1 else b"".join([steps[w] for w in words])

    def _spaced(self, words: list[str], run: str, known: dict[str, bytes]) -> bytes:
        """Counted as if the text ended inside the run; what follows makes up for it."""
        steps = np.frombuffer(self._unit(words, known), np.int8).astype(np.int64)
        alone = np.frombuffer(known[run], np.int8)
        k = len(run)
        gap = int(steps[:k].sum() - alone.sum())
        steps[:k] = alone
        if k < len(steps):
            steps[k] += gap
        return steps.astype(np.int8).tobytes()

    def steps_all(self, texts: Sequence[str]) -> list[bytes]:
        """``steps`` of many texts, whose distinct units are worked out together."""
        found = [
            None if self.split is not None and self.split.search(t) else self.unit.findall(t)
            for t in texts
        ]
        units = list(dict.fromkeys(u for row in found if row is not None for u in row))
        known = dict(zip(units, self.unit_steps(units))).__getitem__
        return [
            self.steps(t) if row is None else b"".join(map(known, row)) for t, row in zip(texts, found)
        ]

    def _plain(self, text: str) -> bytes:
        units = self.unit.findall(text)
        distinct = list(dict.fromkeys(units))
        known = dict(zip(distinct, self.unit_steps(distinct)))
        return b"".join([known[u] for u in units])

    def steps(self, text: str) -> bytes:
        """The change of the token count at every character of the text."""
        if self.split is None or not self.split.search(text):
            return self._plain(text)
        out, start = [], 0
        for m in self.split.finditer(text):
            # The special string's beginnings are text like any other until its last character.
            ahead = np.frombuffer(self._plain(text[start : m.end() - 1]), np.int8)
            rest = ahead[m.start() - start :].astype(np.int64)
            out += [ahead.tobytes(), np.int8(1 - int(rest.sum())).tobytes()]
            start = m.end()
        return b"".join([*out, self._plain(text[start:])])


def count_at(steps: bytes, n_chars: int) -> int:
    """The token count of the prefix of ``n_chars`` characters."""
    return int(np.frombuffer(steps, np.int8)[:n_chars].sum(dtype=np.int64))


def longest_within(steps: bytes, limit: int) -> int:
    """The characters of the longest prefix of at most ``limit`` tokens."""
    within = np.flatnonzero(np.frombuffer(steps, np.int8).cumsum(dtype=np.int64) <= limit)
    return int(within[-1]) + 1 if len(within) else 0


def token_prefixes(
    docs: DataFrame,
    vocabulary: str | Path,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    with_steps: bool = True,
) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, cut_chars and ``steps``.

    ``vocabulary`` is the path of the file on the driver; executors receive its content (a
    vocabulary, of a few MB). ``cut_chars`` is the length in characters of the longest
    prefix of at most ``limit`` tokens. Without ``with_steps`` the table of steps stays in
    the task, which answers from it and lets it go.
    """
    vocabulary = Path(vocabulary).read_text("utf-8")
    digest = zlib.crc32(vocabulary.encode())
    content = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(("prefixes", digest), lambda: PrefixCounter(content.value))
        for batch in batches:
            n_bytes, n_tokens, cut, tables = [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counted = (s for a, b in slices(texts, TOGETHER) for s in counter.steps_all(texts[a:b]))
            for text, steps in zip(texts, counted):
                n_bytes.append(len(text.encode()))
                total = count_at(steps, len(steps))
                n_tokens.append(total)
                cut.append(len(steps) if total <= limit and min(steps, default=0) >= 0
                           else longest_within(steps, limit))
                tables.append(steps if with_steps else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(cut, pa.int64()),
                    pa.array(tables, pa.binary()),
                ],
                names=["id", "n_bytes", "n_tokens", "cut_chars", "steps"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long, cut_chars long, steps binary"
    )
