"""Scores of the network against plain loops over whole texts."""

import math
import random
import re

import numpy as np
import pytest
from test_operators import document_rows, words

from tillmark.llm import toxicity
from tillmark.llm import words as kernels

INSULTS = ["grulf", "zanker", "mopsel"]


def word_vector(net, word: bytes) -> np.ndarray:
    """The word's own row beside the mean of the rows of its character triples."""
    h = kernels.batch_words([word.decode("utf-8", "surrogatepass")])[0]
    own = net.p["words"][int(kernels.mix(h)[0] % np.uint64(toxicity.WORDS))]
    low = b" " + word.lower() + b" "
    rows = [low[i - 1] << 16 | low[i] << 8 | low[i + 1] for i in range(1, len(low) - 1)]
    rows = [int(kernels.mix(np.array([t], np.uint64))[0] % np.uint64(toxicity.TRIPLES)) for t in rows]
    return np.concatenate([own, net.p["triples"][rows].mean(axis=0)]).astype(float)


def plain_score(net, text: str | None) -> float:
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    p = {k: v.astype(float) for k, v in net.p.items()}
    found = [w for w in re.split(rb"[\x09-\x0d\x20]+", (text or "").encode("utf-8", "surrogatepass")) if w]
    vectors = [word_vector(net, w) for w in found]
    best, start, size = -math.inf, 0, toxicity.HIDDEN
    while True:
        window = vectors[start : start + toxicity.WINDOW]
        states = []
        for way, seen in ((0, window), (1, window[::-1])):
            h, out = np.zeros(size), []
            for x in seen:
                a = x @ p["input"][way] + p["bias"][way, 0]
                g = h @ p["state"][way]
                z, r = sigmoid(a[:size] + g[:size]), sigmoid(a[size : 2 * size] + g[size : 2 * size])
                c = np.tanh(a[2 * size :] + r * g[2 * size :])
                h = h + (1 - z) * (c - h)
                out.append(h)
            states.append(out if way == 0 else out[::-1])
        both = [np.concatenate(pair) for pair in zip(*states)]
        logit = p["offset"][0]
        if both:
            ask = np.array([np.tanh(b @ p["look"]) @ p["ask"] for b in both])
            weight = np.exp(ask - ask.max())
            logit += (weight / weight.sum()) @ np.array(both) @ p["out"]
        best = max(best, float(logit))
        if start + toxicity.WINDOW >= len(found):
            return float(sigmoid(-np.clip((net.shift - best) * net.scale, -50, 50)))
        start += toxicity.STRIDE


@pytest.fixture(scope="module")
def network():
    r = random.Random(9)
    texts, labels = [], []
    for i in range(160):
        found = words(r, r.randrange(5, 120)).split(" ")
        if i % 4 == 0:
            for _ in range(3):
                found.insert(r.randrange(len(found)), r.choice(INSULTS))
        texts.append(" ".join(found))
        labels.append(int(i % 4 == 0))
    return toxicity.Network().fit(texts, labels, rounds=4)


def test_scores_are_those_of_a_plain_loop(network):
    r = random.Random(10)
    texts = [t for _, t, *_ in document_rows()[:60]]
    texts += ["", None, " \n", "Grulf", "zanker\nmopsel", words(r, 31), words(r, 32), words(r, 33), words(r, 48), words(r, 49)]
    texts += [f"{words(r, 70)} grulf zanker {words(r, 70)}", "x" * 3000 + " y"]
    got = network.score(texts)
    want = [plain_score(network, t) for t in texts]
    assert np.allclose(got, want, atol=2e-4)
    assert max(want) > 0.5 > min(want)


def test_a_text_scores_alike_in_any_company(network):
    r = random.Random(11)
    texts = [words(r, 40).replace(" ", s) for s in (" ", "\n", "\t", "\r\n") for _ in range(5)] + ["grulf\tx", "grulf x"]
    alone = np.array([network.score([t])[0] for t in texts])
    assert np.allclose(network.score(texts), alone, atol=1e-6)
    assert np.allclose(network.score(texts[::-1])[::-1], alone, atol=1e-6)
    assert alone[-1] == pytest.approx(alone[-2], abs=1e-6)
