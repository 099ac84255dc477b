"""Toxicity of whole texts by a bidirectional gated recurrent network, trained in numpy.

Every word enters as two vectors: one by the hash of the word, and the mean of those of its
character triples, so that altered spellings stay close to what they alter. A GRU reads a
window of words in both directions, attention pools its states, and a linear layer gives the
window's score. Windows overlap by half and cover the whole text; the highest counts.

Labels belong to documents, not to windows. Training starts with windows drawn at random and
goes on with the highest window of each document, so that a toxic document teaches by its worst
passage and a clean one by what looks worst in it. A last fit sets offset and scale of the
documents' scores.

The training sample is bounded: at most 1200 toxic and 2400 clean rows (``sample``), those with
the smallest hash of their id, with their whole texts. One task trains on it; the driver receives
the network, which has a fixed size, and no text.

Defined results:

* a NULL, empty or blank text is one window without words; its score is that of the offset;
* rows are scored one by one, repeated rows alike; long texts have more windows, none is cut;
* an empty table gives an empty result;
* without labelled rows of both kinds every score is 0;
* other columns are kept as they are.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.caches import forget, tidy, trim
from tillmark.llm.words import mix, slices, word_hashes, word_spans

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOXIC_SAMPLE, CLEAN_SAMPLE = 1200, 2400
WINDOW, STRIDE = 32, 16
WORDS, TRIPLES = 1 << 17, 1 << 13
WIDTH, HIDDEN = 8, 8
# Windows, and words, worked on at once.
BLOCK, SOME = 2048, 20_000


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: those whose id, as text, has a CRC-32 divisible by 5."""
    crc = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


class Windows:
    """The windows of a run of texts, by the distinct words in it."""

    def __init__(self, texts: list[str | None]):
        # Texts are read some at a time: a byte takes many more while its words are sought. Of the
        # words only the distinct ones and their triples stay.
        hashes, known, counts = [], np.empty(0, np.uint64), []
        lengths, triples = [], []
        for a, b in slices(texts, 1_000_000):
            raws = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts[a:b]]
            begin = 1 + np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
            raw = b" " + b"\n".join(raws) + b" "
            starts, found = word_hashes(raw)
            data, _, ends = word_spans(raw)
            counts.append(np.diff(np.searchsorted(starts, begin)))
            hashes.append(found)
            new, at = np.unique(found, return_index=True)
            fresh = ~np.isin(new, known)
            new, at = new[fresh], at[fresh]
            size = ends[at] - starts[at]
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) + np.repeat(starts[at] - first, size)
            x, y, z = (data[place + k].astype(np.uint64) for k in (-1, 0, 1))
            # Every white space beside a word is a space, wherever the word was met first.
            x[first], z[first + size - 1] = 32, 32
            triple = mix(x << np.uint64(16) | y << np.uint64(8) | z) % np.uint64(TRIPLES)
            known = np.append(known, new)
            lengths.append(size)
            triples.append(triple.astype(np.int16))
        order = np.argsort(known)
        self.word = np.searchsorted(known, np.concatenate(hashes), sorter=order) if hashes else known
        self.word = order[self.word].astype(np.int32)
        self.word_row = (mix(known) % np.uint64(WORDS)).astype(np.int64)
        self.lengths = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
        self.triple = np.concatenate(triples) if triples else np.empty(0, np.int16)
        self.first = np.cumsum(self.lengths) - self.lengths
        counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
        self.offsets = offsets = np.concatenate(([0], np.cumsum(counts)))
        per = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
        self.doc = np.repeat(np.arange(len(texts)), per)
        nth = np.arange(len(self.doc)) - np.repeat(np.cumsum(per) - per, per)
        self.start = offsets[self.doc] + nth * STRIDE
        self.end = np.minimum(self.start + WINDOW, offsets[self.doc + 1])

    def triples_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The triples of some distinct words one after another, and where each word's begin."""
        n = self.lengths[words]
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(self.first[words] - first, n)
        return self.triple[at].astype(np.int64), first

    def rows(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct-word numbers and mask of some windows, time first; no word is number -1."""
        at = self.start[pick][None, :] + np.arange(WINDOW)[:, None]
        mask = at < self.end[pick][None, :]
        if not len(self.word):
            return np.full(at.shape, -1), mask
        return np.where(mask, self.word[np.minimum(at, len(self.word) - 1)], -1), mask


class Network:
    """Parameters by name, forward and backward passes."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)

        def draw(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)

        inputs = 2 * WIDTH
        self.p = {
            "words": np.zeros((WORDS, WIDTH), np.float32),  # a word never seen says nothing
            "triples": draw(TRIPLES, WIDTH, scale=0.05),
            "input": draw(2, inputs, 3 * HIDDEN, scale=0.3),
            "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "state": draw(2, HIDDEN, 3 * HIDDEN, scale=0.3),
            "look": draw(2 * HIDDEN, HIDDEN, scale=0.3),
            "ask": draw(HIDDEN, scale=0.3),
            "out": draw(2 * HIDDEN, scale=0.3),
            "offset": np.zeros(1, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0
        self.trained = False

    def embed(self, w: Windows, words: np.ndarray | None = None) -> np.ndarray:
        """A vector for every distinct word (or some), and zeros at the end for no word."""
        words = np.arange(len(w.word_row)) if words is None else words
        n = len(words)
        out = np.zeros((n + 1, 2 * WIDTH), np.float32)
        if n:
            out[:n, :WIDTH] = self.p["words"][w.word_row[words]]
            for a in range(0, n, SOME):
                some = words[a : a + SOME]
                triples, first = w.triples_of(some)
                sums = np.add.reduceat(self.p["triples"][triples], first, axis=0)
                out[a : a + len(some), WIDTH:] = sums / w.lengths[some, None]
        return out

    def forward(self, projected: np.ndarray, rows: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. ``projected``: (2, words + 1, 3 * HIDDEN), by direction."""
        p = self.p
        steps, n = rows.shape
        m = mask.astype(np.float32)[..., None]
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((2, steps, n, HIDDEN), np.float32)
        trace = []
        for t in range(steps):
            back = steps - 1 - t
            x = np.stack([projected[0][rows[t]], projected[1][rows[back]]])
            g = h @ p["state"]
            zr = 0.5 * np.tanh(0.5 * (x[..., : 2 * HIDDEN] + g[..., : 2 * HIDDEN])) + 0.5
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            c = np.tanh(x[..., 2 * HIDDEN :] + r * g[..., 2 * HIDDEN :])
            on = np.stack([m[t], m[back]])
            new = h + on * (1 - z) * (c - h)
            if keep:
                trace.append((h, z, r, c, g[..., 2 * HIDDEN :], on))
            h = new
            states[0, t], states[1, back] = h[0], h[1]
        both = np.concatenate([states[0], states[1]], axis=-1)
        look = np.tanh(both @ p["look"])
        ask = np.where(mask, look @ p["ask"], np.float32(-1e9))
        weight = np.exp(ask - ask.max(axis=0)) * m[..., 0]
        weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = (weight[..., None] * both).sum(axis=0)
        logit = pooled @ p["out"] + p["offset"][0]
        return (logit, (trace, both, look, weight, pooled)) if keep else logit

    def project(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty((2, len(vectors), 3 * HIDDEN), np.float32)
        for k in range(2):
            np.matmul(vectors, self.p["input"][k], out=out[k])
        out += self.p["bias"]
        return out

    def logits(self, w: Windows) -> np.ndarray:
        projected = self.project(self.embed(w))
        out = np.empty(len(w.doc), np.float32)
        for a in range(0, len(out), BLOCK):
            pick = np.arange(a, min(a + BLOCK, len(out)))
            out[pick] = self.forward(projected, *w.rows(pick))
        return out

    def gradient(self, w: Windows, pick: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Loss and its gradient over some windows with labels ``y``."""
        p = self.p
        rows, mask = w.rows(pick)
        words, rows = np.unique(np.append(rows.ravel(), -1), return_inverse=True)
        words, rows = words[1:], (rows[:-1] - 1).reshape(mask.shape)
        vectors = self.embed(w, words)
        projected = self.project(vectors)
        logit, (trace, both, look, weight, pooled) = self.forward(projected, rows, mask, keep=True)
        score = 1 / (1 + np.exp(-logit))
        loss = float(np.mean(np.logaddexp(0, np.where(y > 0, -logit, logit))))
        d = ((score - y) / len(y)).astype(np.float32)
        g = {"out": pooled.T @ d, "offset": np.array([d.sum()], np.float32)}
        d_pooled = d[:, None] * p["out"]
        d_both = weight[..., None] * d_pooled
        d_weight = (both * d_pooled).sum(axis=-1)
        d_ask = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["ask"] = np.einsum("tn,tnk->k", d_ask, look)
        d_look = d_ask[..., None] * p["ask"] * (1 - look * look)
        g["look"] = np.einsum("tni,tnk->ik", both, d_look)
        d_both = d_both + d_look @ p["look"].T
        d_states = d_both[..., :HIDDEN], d_both[..., HIDDEN:]
        steps = len(rows)
        d_projected = np.zeros_like(projected)
        g["state"] = np.zeros_like(p["state"])
        dh = np.zeros((2, len(pick), HIDDEN), np.float32)
        for t in reversed(range(steps)):
            back = steps - 1 - t
            h, z, r, c, gc, on = trace[t]
            dh = dh + np.stack([d_states[0][t], d_states[1][back]])
            d_new = on * dh
            dz = d_new * (h - c) * z * (1 - z)
            dc = d_new * (1 - z) * (1 - c * c)
            dr = dc * gc * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], axis=-1)
            dg = np.concatenate([dz, dr, dc * r], axis=-1)
            g["state"] += np.swapaxes(h, 1, 2) @ dg
            np.add.at(d_projected[0], rows[t], dx[0])
            np.add.at(d_projected[1], rows[back], dx[1])
            dh = dh - d_new * (1 - z) + dg @ np.swapaxes(p["state"], 1, 2)
        g["input"] = np.swapaxes(vectors[None], 1, 2) @ d_projected
        g["bias"] = d_projected.sum(axis=1, keepdims=True)
        d_vectors = (d_projected @ np.swapaxes(p["input"], 1, 2)).sum(axis=0)
        d_vectors = d_vectors[:-1]
        triples, _ = w.triples_of(words)
        share = np.repeat(d_vectors[:, WIDTH:] / w.lengths[words, None], w.lengths[words], axis=0)
        for name, at, d_rows in (
            ("words", w.word_row[words], d_vectors[:, :WIDTH]),
            ("triples", triples, share),
        ):
            touched, inverse = np.unique(at, return_inverse=True)
            sums = np.zeros((len(touched), WIDTH), np.float32)
            np.add.at(sums, inverse, d_rows)
            g[name] = touched, sums
        return loss, g

    def _begin(self, w: Windows, y: np.ndarray) -> None:
        """Start the word vectors from how much more often toxic documents hold the word."""
        seen = np.concatenate([
            np.unique(w.word_row[w.word[a:b]]) + np.int64(WORDS) * doc
            for doc, (a, b) in enumerate(zip(w.offsets[:-1], w.offsets[1:]))
        ])
        rows, toxic = seen % WORDS, y[seen // WORDS] > 0
        odds = [
            np.log((np.bincount(rows[kind], minlength=WORDS) + 1.0) / (kind_y.sum() + 2.0))
            for kind, kind_y in ((toxic, y == 1), (~toxic, y == 0))
        ]
        self.p["words"][:, 0] += np.clip(odds[0] - odds[1], -4, 4) / 4

    def fit(self, texts: list[str], labels: list[int], rounds: int = 8, seed: int = 7) -> Network:
        """Adam over windows: at random for three rounds, then the highest of each document."""
        y = np.array(labels, np.float32)
        if not 0 < y.sum() < len(y):
            return self
        rng = np.random.default_rng(seed)
        w = Windows(texts)
        starts = np.searchsorted(w.doc, np.arange(len(y)))
        count = np.bincount(w.doc, minlength=len(y))
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        self._begin(w, y)
        step = 0
        for round_ in range(rounds):
            if round_ < 3:
                drawn = [starts + (rng.random(len(y)) * count).astype(np.int64) for _ in range(4)]
                pick = np.concatenate(drawn)
            else:
                logit = self.logits(w)
                order = np.lexsort((-logit, w.doc))
                clean = np.flatnonzero((y == 0) & (count > 1))
                pick = np.concatenate([order[starts], order[starts], order[starts[clean] + 1]])
            rng.shuffle(pick)
            for a in range(0, len(pick), 256):
                some = pick[a : a + 256]
                _, g = self.gradient(w, some, y[w.doc[some]])
                step += 1
                for k, v in g.items():
                    at, v = v if isinstance(v, tuple) else (slice(None), v)
                    first[k][at] += 0.1 * (v - first[k][at])
                    second[k][at] += 0.001 * (v * v - second[k][at])
                    move = first[k][at] / (1 - 0.9**step)
                    self.p[k][at] -= 0.01 * move / (np.sqrt(second[k][at] / (1 - 0.999**step)) + 1e-8)
        top = np.maximum.reduceat(self.logits(w).astype(np.float64), starts)
        # Inside the gap between the kinds, nearer to the toxic side: clean documents not seen
        # in training score higher than those seen.
        low, high = np.quantile(top[y == 0], 0.999), np.quantile(top[y == 1], 0.02)
        self.shift = low + 0.65 * (high - low)
        self.scale = 8 / max(high - low, 4.0)
        self.trained = True
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The toxicity of each text, from 0 to 1."""
        out = np.zeros(len(texts))
        if not self.trained:
            return out
        for a, b in slices(texts, 1_000_000):
            w = Windows(texts[a:b])
            first = np.searchsorted(w.doc, np.arange(b - a))
            top = np.maximum.reduceat(self.logits(w).astype(np.float64), first)
            out[a:b] = 1 / (1 + np.exp(np.clip((self.shift - top) * self.scale, -50, 50)))
        return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: tuple[int, int] = (CLEAN_SAMPLE, TOXIC_SAMPLE),
    rounds: int = 8,
) -> Network:
    """A network fitted to at most ``sample`` clean and toxic rows, none of them held out."""
    known = labels.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")
    ).where(~held_out("id") & F.col("id").isNotNull() & F.col("label").isin(0, 1))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = None
    for kind in (0, 1):
        part = known.where(F.col("label") == kind).orderBy(order, "id").limit(sample[kind])
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
    )

    def fit(table: pa.Table) -> pa.Table:
        forget()
        rows = sorted(table.to_pylist(), key=lambda r: str(r["id"]))
        fitted = Network().fit([r["text"] or "" for r in rows], [r["label"] for r in rows], rounds)
        del rows
        trim()
        return pa.table({"network": pa.array([pickle.dumps(vars(fitted))], pa.binary())})

    # The sample goes to one task: the driver receives the parameters and no text.
    made = texts.groupBy(F.lit(0).alias("sample")).applyInArrow(fit, "network binary").first()
    network = Network()
    if made is not None:
        vars(network).update(pickle.loads(made["network"]))
    del made
    tidy(docs.sparkSession)
    return network


def scorer(spark, network: Network):
    """A function of a text column that gives its toxicity."""
    sent = spark.sparkContext.broadcast(vars(network))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        copy = Network.__new__(Network)
        vars(copy).update(sent.value)
        for texts in batches:
            yield pd.Series(copy.score([t if isinstance(t, str) else None for t in texts]))
        trim()

    return score
