"""Operators 5 and 8 against plain versions: every score, the loss, and the gradient by differences."""
import math
import random
import re

import numpy as np
import pytest

from lapforge.llm import quality, toxicity


def net_score(p, text):
    """The network on one text, position by position."""
    size = -(-(len(text) + quality.WIDTH - 1) // quality.BLOCK)
    data = text + bytes(size * quality.BLOCK - len(text))
    blocks = []
    for b in range(size):
        last = min((b + 1) * quality.BLOCK, len(data) - quality.WIDTH + 1)
        blocks.append([max(sum(float(p["filters"][j][data[i + j]][f]) for j in range(quality.WIDTH))
                           for i in range(b * quality.BLOCK, last)) for f in range(quality.FILTERS)])
    outs = []
    for b, own in enumerate(blocks):
        chunk = [math.tanh(max(x, y)) for x, y in zip(own, blocks[min(b + 1, size - 1)])]
        outs.append([max(0.0, sum(c * float(w) for c, w in zip(chunk, p["w1"][:, h])) + float(p["b1"][h]))
                     for h in range(quality.HIDDEN)])
    read = [max(o[h] for o in outs) for h in range(quality.HIDDEN)] + [sum(o[h] for o in outs) / size for h in range(quality.HIDDEN)]
    z = sum(r * float(w) for r, w in zip(read, p["w2"])) + float(p["b2"][0])
    return 1 / (1 + math.exp(-z))


def texts_of(seed, sizes):
    rng = random.Random(seed)
    return [bytes(rng.choice(b"abc de,.\xc3\xa9\n") for _ in range(n)) for n in sizes]


def test_network_equals_plain_version(spark):
    texts = texts_of(1, (0, 1, 4, 123, 124, 125, 128, 300, 700, 0, 517))
    net = quality.Net(3)
    want = [net_score(net.p, t) for t in texts]
    assert net.scores(texts) == pytest.approx(want, abs=1e-4)
    assert [net.scores([t])[0] for t in texts] == pytest.approx(want, abs=1e-4)  # whatever lies beside it
    docs = spark.createDataFrame([(i, t.decode("utf-8", "ignore")) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.score(docs, net).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(
        [net_score(net.p, t.decode("utf-8", "ignore").encode()) for t in texts], abs=1e-4)


def test_a_long_text_is_pooled_in_parts():
    """Parts of a long text give what one pass gives: the end counts as much as the start."""
    text = texts_of(2, (3 * quality.PART_BYTES + 77,))[0]
    net = quality.Net(4)
    data, first = quality.lay_out([text])
    r = net.responses(data, net.tables())
    r[-(quality.WIDTH - 1):] = -1e9
    whole = r.reshape(-1, quality.BLOCK, quality.FILTERS).max(axis=1)
    assert np.allclose(net.pooled(data, first), whole, atol=1e-5)


def test_gradient_equals_differences():
    texts, y = texts_of(5, (0, 90, 260, 400, 130)), np.array([0, 1, 1, 0, 1], float)
    net = quality.Net(6)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    grad, rng, step = net.gradients(texts, y), np.random.default_rng(7), 1e-5

    def loss():
        s = net.scores(texts)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    # of the filters the bytes that occur
    used = np.flatnonzero(np.abs(grad["filters"]).ravel() > 1e-7)
    for name, value in net.p.items():
        flat, places = value.reshape(-1), used if name == "filters" else np.arange(value.size)
        # float32 pooling sums are too coarse for differences of single filter weights: a wider step there
        h = 1e-2 if name == "filters" else step
        close = 0
        chosen = rng.choice(places, min(12, len(places)), replace=False)
        for i in chosen:
            old = flat[i]
            flat[i] = old + h
            up = loss()
            flat[i] = old - h
            down = loss()
            flat[i] = old
            close += abs((up - down) / (2 * h) - grad[name].reshape(-1)[i]) < 2e-3 + 0.05 * abs(grad[name].reshape(-1)[i])
        assert close >= len(chosen) - 1, name  # a step may cross the place where another position is largest


WORD = re.compile(rb"[A-Za-z0-9\x80-\xff]+")
TEXTS = [b"Muslims are here", b"people are here, People!", b"", b"...", b"caf\xc3\xa9 gay-bar scum", b"scum " * 50]


def plain_features(hasher, text):
    """Every distinct word and 5-byte run of its words, hashed one at a time."""
    found = set()
    for w in WORD.findall(text):
        found.add(int(hasher.words([w])[0][0] >> np.uint64(64 - toxicity.BITS)))
        for i in range(len(w) - toxicity.GRAM + 1):
            found.add(int(hasher.grams([w[i:i + toxicity.GRAM]], toxicity.GRAM)[0][0] >> np.uint64(64 - toxicity.BITS)))
    return found


def test_toxicity_features_and_scores_equal_plain_version(spark):
    hasher = toxicity.Hasher(toxicity.LETTERS)
    row, col = toxicity.features(hasher, TEXTS)
    assert {(int(r), int(c)) for r, c in zip(row, col)} == {(i, c) for i, t in enumerate(TEXTS) for c in plain_features(hasher, t)}
    weights = np.random.default_rng(1).normal(0, 1, 1 << toxicity.BITS)
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, weights, -0.3).collect()}
    for i, t in enumerate(TEXTS):
        z = -0.3 + sum(weights[c] for c in plain_features(hasher, t))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def objective(hasher, sample, weights, bias, counterfactual):
    """Log loss, counterfactual penalty and L1, summed text by text."""
    total = toxicity.L1 * np.abs(weights).sum()
    for text, y in sample:
        z, cf = (bias + sum(weights[c] for c in plain_features(hasher, t)) for t in
                 (text.encode(), toxicity.counterfactual_of(text.encode())))
        p = 1 / (1 + math.exp(-z))
        total -= math.log(p if y else 1 - p) / len(sample)
        total += counterfactual * (z - cf) ** 2 / len(sample)
    return total


def test_toxicity_fit_lowers_the_stated_loss():
    sample = [(f"{who} {tail} {i}", int(who == "muslims" or tail == "are scum")) for i in range(8)
              for who in ("people", "muslims") for tail in ("are here", "are scum")]
    hasher = toxicity.Hasher(toxicity.LETTERS)
    for strength in (0.0, 1.0, 20.0):
        weights, bias = toxicity.fit(sample, strength)
        best = objective(hasher, sample, weights, bias, strength)
        assert best < objective(hasher, sample, np.zeros_like(weights), bias, strength)
        for other in {0.0, 1.0, 20.0} - {strength}:  # each strength's own fit is the best one for it
            assert best <= objective(hasher, sample, *toxicity.fit(sample, other), strength) + 1e-3
        rng, used = np.random.default_rng(3), np.flatnonzero(weights)
        for _ in range(20):  # and no small step from it is much better
            near = weights.copy()
            near[used] += rng.normal(0, 0.02, len(used))
            assert objective(hasher, sample, near, bias, strength) > best - 2e-3
