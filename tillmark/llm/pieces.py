"""The N best segmentations of a text into the pieces of a SentencePiece model, and back.

All pieces of the vocabulary that match somewhere form a lattice over the normalised text; a
segmentation is a path through it, its score the sum of its pieces' scores. A forward Viterbi
pass gives the best score from the start to every position. Going backward from the end, these
scores are an exact estimate of what is still to come, so A* search takes paths off its queue
in the order of their scores: the N-th path taken is the N-th best, and nothing else is expanded.

No piece crosses the front of a run of word marks. Every path passes these, so the lattice falls
into parts, and the N best of a text are sums over its parts. The distinct parts of many texts are
worked out together, place by place. Only the N - 1 parts whose second-best path, also known
from the forward pass, is closest to the best can differ from it: these are searched.

The score is that of the lattice. A model trained by merging pairs lists the order of its merges
as scores; its own encoder replays merges, which need not give the highest score.

Defined results:

* characters without a piece are spelled in byte pieces, at the lowest score less 10 a character
  (without byte pieces: the unknown piece);
* a NULL or empty text has one segmentation, of no pieces, with score 0; texts are read whole;
* equal scores: within a part the path whose piece ids, read from the end, come first; between
  parts the change further to the front; fewer than N results where fewer paths exist;
* rows are segmented one by one: repeated rows and NULL ids give one row each; an empty table
  gives an empty result; other columns are not read, whatever their names;
* decoding gives the normalised text. A word mark (U+2581) in the text itself comes back as a space.
  Every segmentation is decoded from its ids.
"""

from __future__ import annotations

import gc
import heapq
import re
import struct
import sys
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.caches import Memo, forget, holds, kept, trim
from tillmark.llm.lattice import Strings, Trie
from tillmark.llm.words import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"
UNKNOWN_PENALTY = 10.0
FAR = float("inf")
# Parts of more characters are searched one by one, and the distinct parts of so many characters of
# texts are worked out once, so many parts in one pass. So many ids are decoded at once.
LONG, TOGETHER, MANY, SOME = 48, 1_000_000, 1 << 15, 1 << 16


class Pieces:
    """The vocabulary of a model, its lattice search, and decoding."""

    def __init__(self, model: bytes, n: int, memo: int = 50_000):
        import sentencepiece

        self.model = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n = n
        size = sp.get_piece_size()
        self.ids, self.bytes, scores = {}, {}, []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = (i, sp.get_score(i))
                scores.append(sp.get_score(i))
        self.unknown = min(scores) - UNKNOWN_PENALTY
        self.width = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # The longest piece by its last four characters; any other has at most three.
        self.reach = {p[-4:]: len(p) for p in sorted(self.ids, key=len) if len(p) > 3}
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.part = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        back = {i: p.replace(MARK, " ").encode() for p, (i, _) in self.ids.items()}
        back |= {i: bytes([b]) for b, i in self.bytes.items()}
        back[sp.unk_id()] = " ⁇ ".encode()
        #: What each piece gives back: all bytes end to end, where each piece's begin, how many.
        self.back = np.frombuffer(b"".join(back.get(i, b"") for i in range(size)), np.uint8)
        self.back_size = np.array([len(back.get(i, b"")) for i in range(size)], np.int32)
        self.back_first = np.cumsum(self.back_size, dtype=np.int32) - self.back_size
        self.endings = Memo(self._ending, memo)
        self.parts = Memo(self._part, memo)
        self.lists = Memo(lambda part: self.search(part, self.n), memo // 4)
        letters = {c: i for i, c in enumerate(sorted({c for p in self.ids for c in p}))}
        self.letter = np.full(sys.maxunicode + 1, -1, np.int32)
        self.letter[[ord(c) for c in letters]] = list(letters.values())
        #: Characters that are pieces of their own, so that a path exists without spelling.
        self.alone = np.zeros(sys.maxunicode + 1, bool)
        self.alone[[ord(c) for c in letters if c in self.ids]] = True
        self.trie = Trie({tuple(letters[c] for c in p): i for p, (i, _) in self.ids.items()}, len(letters))
        self.sizes = [0] * size
        for p, (i, _) in self.ids.items():
            self.sizes[i] = len(p)
        self.weights = np.zeros(size)
        self.weights[[i for i, _ in self.ids.values()]] = scores
        #: The mark put in front of a text, which decoding takes off again.
        self.front = self.normal("x") == f"{MARK}x"

    def normal(self, text: str) -> str:
        return self.model.normalize(text).replace(" ", MARK) if text else ""

    def _ending(self, tail: str) -> list[tuple[int, float, int]]:
        """Length, score and id of the pieces that end a string.

        A last character without a piece has its code point, negative, in place of an id.
        """
        found = [
            (len(tail) - i, self.ids[tail[i:]][1], self.ids[tail[i:]][0])
            for i in range(len(tail))
            if tail[i:] in self.ids
        ]
        if tail[-1] not in self.ids:
            found.append((1, self.unknown, -1 - ord(tail[-1])))
        return found

    def _edges(self, text: str) -> list[list[tuple[int, float, int]]]:
        """For every end position the pieces that end there."""
        endings, reach = self.endings, self.reach.get
        out = [[]]
        for end in range(1, len(text) + 1):
            longest = reach(text[end - 4 : end], 3) if end > 3 else 3
            out.append(endings[text[end - longest if end > longest else 0 : end]])
        return out

    def search(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Scores and ids of the ``n`` best paths, best first."""
        edges = self._edges(text)
        ahead = [0.0]  # forward Viterbi: the best score of a path from the start to here
        for end in range(1, len(text) + 1):
            ahead.append(max([ahead[end - length] + w for length, w, _ in edges[end]]))
        end = len(text)
        queue, found = [(-ahead[end], (), end, 0.0)], []
        while queue and len(found) < n:
            _, path, at, behind = heapq.heappop(queue)
            if at == 0:
                found.append((behind, path[::-1]))
                continue
            for length, weight, label in edges[at]:
                start, score = at - length, behind + weight
                heapq.heappush(queue, (-(score + ahead[start]), (*path, label), start, score))
        return [(score, self._spell(path)) for score, path in found]

    def _spell(self, path: Sequence[int]) -> Sequence[int]:
        if min(path, default=0) >= 0:
            return path
        out = []
        for label in path:
            if label >= 0:
                out.append(label)
            elif self.bytes:
                out += [self.bytes[b] for b in chr(-1 - label).encode()]
            else:
                out.append(self.model.unk_id())
        return tuple(out)

    def _pack(self, path: tuple[int, ...]) -> bytes:
        return struct.pack(f"<{len(path)}{self.code}", *path)

    def _part(self, text: str) -> tuple[bytes, float, float]:
        """Ids and score of the best path, and how far the second best is behind it.

        The forward pass keeps the two best scores of every position.
        """
        endings, reach = self.endings, self.reach.get
        first, second, via = [0.0], [-FAR], [(0, 0)]
        for end in range(1, len(text) + 1):
            longest = reach(text[end - 4 : end], 3) if end > 3 else 3
            best, next_, by = -FAR, -FAR, (0, 0)
            for length, weight, label in endings[text[end - longest if end > longest else 0 : end]]:
                score = first[end - length] + weight
                if score > best:
                    next_ = max(best, second[end - length] + weight)
                    best, by = score, (length, label)
                elif score > next_ or score == best:
                    next_ = score
                    if score == best and label < by[1]:
                        by = (length, label)
            first.append(best)
            second.append(next_)
            via.append(by)
        at, path = len(text), []
        while at:
            length, label = via[at]
            path.append(label)
            at -= length
        return self._pack(self._spell(path[::-1])), first[-1], first[-1] - second[-1]

    def work_out(self, parts: Sequence[str]) -> list[tuple[bytes, float, float]]:
        """What ``parts`` holds of each of many parts: all of ordinary length in one pass."""
        out = [None] * len(parts)
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths)
        spelled = np.concatenate(([0], np.cumsum(~self.alone[points])))
        odd = lengths > LONG
        spells = spelled[ends] > spelled[ends - lengths]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._part(parts[i])
        plain = np.flatnonzero(~odd)
        if not len(plain):
            return out
        points = points[np.repeat(~odd, lengths)]
        strings = Strings(self.letter[points], lengths[plain])
        alone = Strings(self.alone[points], lengths[plain]).rows if spells[plain].any() else None
        unknown = len(self.sizes)
        found, n = strings.found(self.trie), len(plain)
        first, second, by_length, by_piece = [np.zeros(n)], [np.full(n, -FAR)], [None], [None]
        for end in range(1, strings.longest + 1):
            count = strings.count[end - 1]
            best, next_ = np.full(count, -FAR), np.full(count, -FAR)
            length, piece = np.zeros(count, np.int16), np.zeros(count, np.int32)
            for start, who, number in found[end]:
                weight = self.weights[number]
                score = first[start][who] + weight
                b, after = best[who], next_[who]
                up, level = score > b, score == b
                behind = np.maximum(b, second[start][who] + weight)
                next_[who] = np.where(up, behind, np.where((score > after) | level, score, after))
                best[who] = np.where(up, score, b)
                take = up | level & (number < piece[who])
                length[who[take]] = end - start
                piece[who[take]] = number[take]
            if alone is not None:  # a last character without a piece comes after all pieces
                who = np.flatnonzero(~alone[end - 1])
                score = first[end - 1][who] + self.unknown
                b, after = best[who], next_[who]
                up = score > b
                behind = np.maximum(b, second[end - 1][who] + self.unknown)
                next_[who] = np.where(up, behind, np.where((score > after) | (score == b), score, after))
                best[who] = np.where(up, score, b)
                who = who[score >= b]
                length[who], piece[who] = 1, unknown
            first.append(best)
            second.append(next_)
            by_length.append(length)
            by_piece.append(piece)
        # Back from the ends, one piece of every path at a time.
        at, pieces = strings.lengths.copy(), []
        steps = np.zeros(n, np.int64)
        for end in range(strings.longest, 0, -1):
            # Paths are at different places; those at this one take their piece.
            here = np.flatnonzero(at[: strings.count[end - 1]] == end)
            if len(here):
                pieces.append((here, steps[here], by_piece[end][here]))
                steps[here] += 1
                at[here] = end - by_length[end][here]
        stops = np.cumsum(steps)
        ids = np.zeros(int(stops[-1]), np.int32)
        for who, back, number in pieces:
            ids[stops[who] - 1 - back] = number
        packed, width = ids.astype(self.width).tobytes(), self.width.itemsize
        last = strings.lengths
        score = np.empty(n)
        gap = np.empty(n)
        for end in np.unique(last).tolist():
            who = np.flatnonzero(last == end)
            score[who] = first[end][who]
            gap[who] = first[end][who] - second[end][who]
        edges = (stops * width).tolist()
        order = plain[strings.order]
        rows = zip(order.tolist(), [0, *edges], edges, score.tolist(), gap.tolist(), spells[order].tolist())
        for i, a, b, s, g, spell in rows:
            if spell:
                out[i] = self._pack(self._spell(self._named(ids[a // width : b // width].tolist(), parts[i]))), s, g
            else:
                out[i] = packed[a:b], s, g
        return out

    def _named(self, path: list[int], part: str) -> list[int]:
        """A path with the code points, negative, of its characters without a piece."""
        at, out = 0, []
        for i in path:
            if i == len(self.sizes):
                out.append(-1 - ord(part[at]))
                at += 1
            else:
                out.append(i)
                at += self.sizes[i]
        return out

    def encode_all(self, texts: Sequence[str]) -> list[tuple[list[tuple[float, bytes]], bool]]:
        """The N best segmentations of every text, and whether decoding each gives the text."""
        parts = [self.part.findall(self.normal(t)) for t in texts]
        some = list(dict.fromkeys(chain.from_iterable(parts)))
        known = {}
        for a in range(0, len(some), MANY):
            known.update(zip(some[a : a + MANY], self.work_out(some[a : a + MANY])))
        found = []
        for row in parts:
            entries = [known[p] for p in row]
            found.append(self._best(row, entries, np.array([e[2] for e in entries])))
        given = [True] * len(texts)
        for rank in range(self.n):
            held = [i for i, paths in enumerate(found) if len(paths) > rank]
            for i, text in zip(held, self.decode_all([found[i][rank][1] for i in held])):
                given[i] &= text == texts[i]
        return list(zip(found, given))

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """Scores and packed ids of the N best segmentations, best first."""
        parts = self.part.findall(self.normal(text))
        entries = [self.parts[p] for p in parts]
        return self._best(parts, entries, np.array([e[2] for e in entries]))

    def _best(
        self, parts: Sequence[str], entries: Sequence[tuple], gaps: np.ndarray
    ) -> list[tuple[float, bytes]]:
        ids = [e[0] for e in entries]
        best = sum([e[1] for e in entries])
        if self.n == 1 or not parts:
            return [(best, b"".join(ids))]
        k = min(self.n - 1, len(gaps))
        near = np.flatnonzero(gaps <= np.partition(gaps, k - 1)[k - 1])
        near = near[np.argsort(gaps[near], kind="stable")][:k]
        near = sorted((int(i) for i in near if gaps[i] < FAR), reverse=True)
        lists = [self.lists[parts[i]] for i in near]
        queue, seen, out = [(0.0, (0,) * len(near))], set(), []
        while queue and len(out) < self.n:
            cost, ranks = heapq.heappop(queue)
            changed = {near[j]: lists[j][r][1] for j, r in enumerate(ranks) if r}
            for i, path in changed.items():
                ids[i] = self._pack(path)
            out.append((best - cost, b"".join(ids)))
            for i in changed:
                ids[i] = entries[i][0]
            for j, r in enumerate(ranks):
                if r + 1 < len(lists[j]):
                    after = (*ranks[:j], r + 1, *ranks[j + 1 :])
                    if after not in seen:
                        seen.add(after)
                        more = lists[j][r][0] - lists[j][r + 1][0]
                        heapq.heappush(queue, (cost + more, after))
        return out

    def decode(self, ids: bytes) -> str:
        """The normalised text of packed ids, spaces for word marks."""
        return self.decode_all([ids])[0]

    def decode_all(self, packed: Sequence[bytes]) -> list[str]:
        ids = np.frombuffer(b"".join(packed), self.width)
        ends = np.concatenate(([0], np.cumsum(self.back_size[ids], dtype=np.int64)))
        raw = b"".join(self._raw(ids[a : a + SOME]) for a in range(0, len(ids), SOME))
        stops = np.cumsum([0, *(len(p) // self.width.itemsize for p in packed)])
        edges = ends[stops].tolist()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(edges, edges[1:])]
        return [t[1:] if self.front and t[:1] == " " else t for t in texts]

    def _raw(self, ids: np.ndarray) -> bytes:
        """The bytes that pieces give back, laid end to end."""
        size = self.back_size[ids]
        first = np.cumsum(size, dtype=np.int32) - size
        at = np.arange(int(size.sum()), dtype=np.int32) + np.repeat(self.back_first[ids] - first, size)
        return self.back[at].tobytes()


def encoded(vocabulary: Pieces, batches: Iterator[pa.RecordBatch], ids_of: int) -> Iterator[pa.RecordBatch]:
    """Batches of ids and texts as the result's columns, ``TOGETHER`` characters at a time."""
    width = vocabulary.width.itemsize
    kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.int64(), pa.bool_()]
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for a, b in slices(texts, TOGETHER):
            rows = []
            for paths, round_trip in vocabulary.encode_all(texts[a:b]):
                ids = [p[1] for p in paths]
                rows.append(
                    (
                        len(ids[0]) // width, [p[0] for p in paths], [len(i) // width for i in ids],
                        ids[:ids_of], zlib.crc32(ids[0]),
                        round_trip,
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *(pa.array(list(c), k) for c, k in zip(zip(*rows), kinds))],
                names=["id", "n_pieces", "scores", "pieces", "ids", "ids_crc32", "round_trip"],
            )


def encode_nbest(
    docs: DataFrame,
    model: str | Path,
    n: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids_of: int = 1,
) -> DataFrame:
    """One row per document: id, n_pieces, scores, pieces, ids, ids_crc32 and round_trip.

    ``scores`` and ``pieces`` (numbers of pieces) list the N best segmentations, ``ids`` their
    packed ids of the first ``ids_of`` (2 bytes each, 4 for more than 65,536 pieces).
    ``ids_crc32`` is the checksum of the best one's ids. ``round_trip`` says whether decoding
    each of the N best gives the text again. ``model`` is a path on the driver; executors receive
    its content.
    """
    model = Path(model).read_bytes()
    digest = zlib.crc32(model)
    content = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = "pieces", digest, n
        if not holds(key):  # what this worker did before leaves gaps
            forget()
            trim()
        gc.set_threshold(200_000)  # the memos hold many tuples and no cycles
        yield from encoded(kept(key, lambda: Pieces(content.value, n)), batches, ids_of)
        trim()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"id {kind}, n_pieces long, scores array<double>, pieces array<long>, ids array<binary>, "
        "ids_crc32 long, round_trip boolean",
    )
