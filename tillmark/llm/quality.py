"""Quality of documents from weak labels: heuristics, their accuracies by EM, a linear scorer.

Simple labellers vote good, bad or abstain on every document; none is trusted and all overlap.
The votes of all documents are counted by pattern (at most 3 to the power of the number of
labellers, whatever the table's size). Expectation-maximisation over these counts estimates how
often each labeller votes what on good documents and on each kind of bad ones, and gives every
pattern a probability of being good. No given label is used.

These probabilities are the targets of a logistic regression over hashed features (words,
their shapes, and the rates the labellers look at), fitted to a bounded sample: at most ``SAMPLE``
documents, those with the smallest hash of id and text, half from either side of the posterior.
The scorer judges whole texts and generalises beyond the labellers' thresholds.

Defined results:

* a NULL, empty or blank text is bad: score 0;
* rows are scored one by one, repeated rows alike; NULL ids give rows like others;
* if all documents show one pattern, or the sample holds one class only, the score is the
  posterior of the document's pattern;
* an empty table gives an empty result; other columns are kept; texts are read whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.words import mix, slices, word_hashes, word_spans
from tillmark.session import new_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 4000
BUCKETS = 1 << 18
KEEP = 0.5

# Labeller: rate, good at most, bad from. Between the two it abstains.
LABELLERS = {
    "symbols": ("symbol bytes among all bytes", 0.02, 0.06),
    "capitals": ("capitals among ASCII letters", 0.15, 0.40),
    "shouting": ("words with two or more exclamation marks at the end", 0.02, 0.20),
    "bars": ("words that are a single bar", 0.01, 0.10),
    "echo": ("words equal to the word before", 0.05, 0.20),
    "sameness": ("1 less distinct words over three square roots of the words, or over the words if fewer", 0.15, 0.45),
    "bare": ("words without a letter", 0.05, 0.20),
    "unended": ("lines that end without punctuation", 0.20, 0.50),
}
NAMES = list(LABELLERS)
GOOD_AT_MOST = np.array([LABELLERS[n][1] for n in NAMES])
BAD_FROM = np.array([LABELLERS[n][2] for n in NAMES])

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*+<=>@\\^_`{|}~")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_END = np.zeros(256, bool)
_END[list(b".!?:;,\"')]")] = True


class Texts:
    """Rates and hashed features of a run of texts, all worked out at once."""

    def __init__(self, texts: list[str | None]):
        raws = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        raw = b"\n".join(raws) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        _, starts, ends = word_spans(raw)
        _, words = word_hashes(raw)
        sizes = np.array([len(r) for r in raws], np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        offsets = np.searchsorted(starts, begin)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        self.n = np.diff(offsets)
        count = np.maximum(self.n, 1)

        def of_bytes(mask):
            total = np.concatenate(([0], np.cumsum(mask)))
            return total[begin[1:] - 1] - total[begin[:-1]]

        def of_words(mask):
            return np.bincount(self.doc, weights=mask, minlength=len(texts))

        letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
        has_letter = letters[ends] > letters[starts]
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        long = ends - starts >= 2
        shout = long & (last == 33) & (before == 33)
        bar = (ends - starts == 1) & (data[starts] == 124)
        echo = np.zeros(len(words), bool)
        echo[1:] = (words[1:] == words[:-1]) & (self.doc[1:] == self.doc[:-1])
        order = np.lexsort((words, self.doc))
        fresh = np.ones(len(words), bool)
        fresh[1:] = (words[order][1:] != words[order][:-1]) | (self.doc[order][1:] != self.doc[order][:-1])
        distinct = np.bincount(self.doc[order], weights=fresh, minlength=len(texts))
        ends_line = np.flatnonzero(data == 10)
        line_doc = np.searchsorted(begin, ends_line, side="right") - 1
        line_text = ends_line > np.concatenate(([0], ends_line[:-1] + 1))
        closed = _END[data[np.maximum(ends_line - 1, 0)]]
        lines = np.bincount(line_doc, weights=line_text, minlength=len(texts))[: len(texts)]
        open_ = np.bincount(line_doc, weights=line_text & ~closed, minlength=len(texts))[: len(texts)]
        upper, ascii_letters = of_bytes(_UPPER[data]), of_bytes(_LETTER[data] & (data < 128))
        self.rates = np.stack(
            [
                of_bytes(_SYMBOL[data]) / np.maximum(sizes, 1),
                upper / np.maximum(ascii_letters, 1),
                of_words(shout) / count,
                of_words(bar) / count,
                of_words(echo) / count,
                1 - np.minimum(1.0, distinct / np.minimum(count, np.sqrt(count) * 3)),
                of_words(~has_letter) / count,
                open_ / np.maximum(lines, 1),
            ],
            axis=1,
        )
        # What a word looks like: its first and last byte kinds and length.
        kind = np.where(_LETTER[data], 1 + _UPPER[data], np.where(_SYMBOL[data], 3, 4))
        shape = kind[starts] * 1000 + kind[np.maximum(ends - 1, 0)] * 100 + np.minimum(ends - starts, 40)
        self.shapes = mix(shape.astype(np.uint64) + np.uint64(77) + before.astype(np.uint64) * np.uint64(100003) * long)
        self.words = words

    def votes(self) -> np.ndarray:
        """1 good, 0 bad, -1 for no vote: a row per text, a column per labeller."""
        out = np.where(self.rates <= GOOD_AT_MOST, 1, np.where(self.rates >= BAD_FROM, 0, -1))
        out[self.n == 0] = 0
        return out.astype(np.int8)

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, bucket and value of the hashed features that are not zero."""
        hashes = np.concatenate([self.words, self.shapes])
        doc = np.concatenate([self.doc, self.doc]).astype(np.uint64)
        place = doc * np.uint64(BUCKETS) + (mix(hashes) % np.uint64(BUCKETS))
        place, count = np.unique(place, return_counts=True)
        at = (place // np.uint64(BUCKETS)).astype(np.int64)
        value = count / np.maximum(self.n, 1)[at]
        value = np.sqrt(value)
        rate = np.sqrt(np.clip(self.rates, 0, 1))
        t, k = np.nonzero(rate)
        bucket = np.concatenate([(place % np.uint64(BUCKETS)).astype(np.int64), BUCKETS + k])
        return np.concatenate([at, t]), bucket, np.concatenate([value, rate[t, k]])


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each pattern, and the vote probabilities (class, labeller, vote).

    Junk comes in kinds that trip some labellers and pass the others, so bad documents are a
    mixture: one class for good, and one kind of bad for each labeller, in which the votes
    are independent. Starts from the belief that a vote for bad is right, shared among those who
    cast it; patterns without one are good.
    """
    seen = np.stack([votes == v for v in (0, 1, -1)], axis=2).astype(float)
    bad = (votes == 0).astype(float)
    given = bad.sum(axis=1)
    member = np.concatenate(
        [np.where(given > 0, 0.02, 0.98)[None], 0.98 * (bad / np.maximum(given, 1)[:, None]).T + 0.002]
    )
    member /= member.sum(axis=0)
    p = None
    for _ in range(rounds):
        weight = member * counts
        p = (np.einsum("cp,plv->clv", weight, seen) + 0.1) / (weight.sum(axis=1)[:, None, None] + 0.3)
        prior = (weight.sum(axis=1) + 0.1) / (counts.sum() + 0.1 * len(weight))
        log = np.log(prior)[:, None] + np.einsum("plv,clv->cp", seen, np.log(p))
        member = np.exp(log - log.max(axis=0))
        member /= member.sum(axis=0)
    return member[0], p


def _code(votes: np.ndarray) -> np.ndarray:
    return ((votes.astype(np.int64) + 1) * 3 ** np.arange(votes.shape[1])).sum(axis=1)


def _decode(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(len(NAMES)) % 3 - 1).astype(np.int8)


def vote_patterns(docs: DataFrame, text_col: str = "text"):
    """The column of vote patterns, as numbers, of a text column."""

    @F.pandas_udf("long")
    def patterns(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            parts = [_code(Texts(texts[a:b]).votes()) for a, b in slices(texts)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0, np.int64))

    return patterns(F.col(f"`{text_col}`").cast("string"))


class Scorer:
    """Posteriors by pattern, and the weights of the linear scorer."""

    def __init__(self, posterior: dict[int, float]):
        self.posterior, self.weights, self.offset = posterior, None, 0.0

    def fit(self, texts: list[str], targets: np.ndarray, rounds: int = 30, step: float = 0.5) -> Scorer:
        """Logistic regression by AdaGrad over batches, small weights preferred."""
        if not len(targets) or targets.min() > 0.5 or targets.max() < 0.5:
            return self
        rng = np.random.default_rng(1)
        rows = [Texts(texts[a:b]).features() + (a, b) for a, b in slices(texts, 500_000)]
        w, g2, offset = np.zeros(BUCKETS + len(NAMES)), np.full(BUCKETS + len(NAMES), 1e-6), 0.0
        for _ in range(rounds):
            for i in rng.permutation(len(rows)):
                t, bucket, value, a, b = rows[i]
                y = targets[a:b]
                z = np.bincount(t, weights=w[bucket] * value, minlength=b - a) + offset
                d = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
                touched, inverse = np.unique(bucket, return_inverse=True)
                grad = np.bincount(inverse, weights=d[t] * value) / (b - a) + 1e-5 * w[touched]
                g2[touched] += grad * grad
                w[touched] -= step * grad / np.sqrt(g2[touched])
                offset -= step * 0.2 * d.mean()
        self.weights, self.offset = w.astype(np.float32), float(offset)
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = [np.empty(0)]
        for a, b in slices(texts):
            run = Texts(texts[a:b])
            if self.weights is None:
                s = np.array([self.posterior.get(c, 0.5) for c in _code(run.votes()).tolist()])
            else:
                t, bucket, value = run.features()
                z = np.bincount(t, weights=self.weights[bucket] * value, minlength=b - a) + self.offset
                s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            out.append(np.where(run.n == 0, 0.0, s))
        return np.concatenate(out)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """Accuracies from the votes on all documents, then a scorer from a bounded sample."""
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(
        F.xxhash64(F.col(f"`{id_col}`").cast("string"), text).alias("key"), text.alias("text")
    )
    path = new_dir(docs.sparkSession, "votes")
    keyed.select("key", vote_patterns(keyed).alias("pattern")).write.parquet(path)
    voted = docs.sparkSession.read.parquet(path)
    counted = voted.groupBy("pattern").count().toPandas()
    if not len(counted):
        return Scorer({})
    votes = _decode(counted["pattern"].to_numpy())
    good, _ = estimate(votes, counted["count"].to_numpy(float))
    posterior = dict(zip(counted["pattern"].tolist(), good.tolist()))
    sides = [[c for c, g in posterior.items() if (g >= 0.5) == side] for side in (False, True)]
    drawn = None
    for codes in sides:
        part = voted.where(F.col("pattern").isin(codes)).distinct().orderBy("key").limit(sample // 2)
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = keyed.join(F.broadcast(drawn), "key").dropDuplicates(["key"])
    rows = texts.toPandas().sort_values("key", kind="stable")
    targets = np.array([posterior[c] for c in rows["pattern"]])
    shuffle = np.random.default_rng(2).permutation(len(rows))
    texts = [rows["text"].iloc[i] or "" for i in shuffle]
    return Scorer(posterior).fit(texts, targets[shuffle])


def scorer(spark, fitted: Scorer):
    """A function of a text column that gives its quality."""
    sent = spark.sparkContext.broadcast(vars(fitted))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        copy = Scorer.__new__(Scorer)
        vars(copy).update(sent.value)
        for texts in batches:
            yield pd.Series(copy.score([t if isinstance(t, str) else None for t in texts]))

    return score
