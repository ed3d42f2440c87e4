"""Decoding and losses of the learned classifiers, worked out in plain Python on tiny models."""

import math
import random

import numpy as np
import pytest

from keelson.llm import language, toxicity


def tiny_codes(draw, classes, features):
    codes = object.__new__(language.Codes)
    codes.names = [f"l{c}" for c in range(classes)]
    codes.code = language.codewords(classes)
    bits = codes.code.shape[1]
    codes.w = np.array([[draw.gauss(0, 1) for _ in range(bits)] for _ in range(features)])
    codes.b = np.array([draw.gauss(0, 1) for _ in range(bits)])
    known = np.array([[draw.random() for _ in range(bits)] for _ in range(classes)])
    codes.weight = known / known.sum(1, keepdims=True)
    return codes


def brute_decode(codes, row):
    """Per class the weighted sum of the bits' logistic losses against its codeword; the least wins."""
    bits = codes.code.shape[1]
    out = [sum(v * codes.w[f][k] for f, v in enumerate(row)) + codes.b[k] for k in range(bits)]
    losses = [
        bits * sum(codes.weight[c][k] * math.log1p(math.exp(-int(codes.code[c][k]) * out[k])) for k in range(bits))
        for c in range(len(codes.names))
    ]
    shares = [math.exp(min(losses) - loss) for loss in losses]
    shares = [s / sum(shares) for s in shares]
    order = sorted(range(len(shares)), key=lambda c: (-shares[c], c))
    return order[0], shares[order[0]], shares[order[1]] if len(order) > 1 else 0.0


@pytest.mark.parametrize("classes", [1, 2, 3, 5, 9])
def test_decoding_takes_the_codeword_of_least_weighted_loss(classes):
    draw = random.Random(classes)
    codes = tiny_codes(draw, classes, 6)
    rows = np.array([[draw.gauss(0, 1) for _ in range(6)] for _ in range(40)])
    best, score, second = codes.decode(rows)
    for i, row in enumerate(rows):
        want = brute_decode(codes, row)
        assert best[i] == want[0]
        assert score[i] == pytest.approx(want[1]) and second[i] == pytest.approx(want[2])


def test_wrong_bits_are_corrected():
    """With sure, equally trusted bits any fewer than half the least distance may be wrong."""
    codes = tiny_codes(random.Random(2), 5, 1)
    bits = codes.code.shape[1]
    apart = min((codes.code[a] != codes.code[b]).sum() for a in range(5) for b in range(a))
    codes.weight = np.full((5, bits), 1 / bits)
    draw = random.Random(3)
    for c in range(5):
        wrong = draw.sample(range(bits), (apart - 1) // 2)
        codes.w = np.where(np.isin(np.arange(bits), wrong), -1, 1)[None, :] * codes.code[c] * 4.0
        codes.b = np.zeros(bits)
        assert codes.decode(np.ones((1, 1)))[0][0] == c


def test_equal_losses_are_ambiguous():
    codes = tiny_codes(random.Random(4), 3, 2)
    codes.w, codes.b = np.zeros_like(codes.w), np.zeros_like(codes.b)
    codes.weight = np.full_like(codes.weight, 1 / codes.code.shape[1])
    best, score, second = codes.decode(np.ones((1, 2)))
    assert best[0] == 0 and score[0] == pytest.approx(1 / 3) and second[0] >= language.CLOSE * score[0]


def brute_loss(w, b, x, swapped, y, weight, fairness, decay):
    total = sum(weight)
    loss = decay / 2 * sum(v * v for v in w)
    for row, other, label, part in zip(x, swapped, y, weight, strict=True):
        z = sum(a * v for a, v in zip(row, w, strict=True)) + b
        change = sum((a - o) * v for a, o, v in zip(row, other, w, strict=True))
        loss += part / total * (math.log1p(math.exp(-z if label else z)) + fairness * change * change)
    return loss


def small_sentences():
    """Features: an insult, a neutral word, two identity terms of which the first goes with the label."""
    x = np.array([[1, 0, 1, 0], [1, 1, 1, 0], [0, 1, 0, 1], [0, 1, 0, 0], [1, 0, 0, 0], [0, 1, 1, 0]], np.float32)
    swapped = x[:, [0, 1, 3, 2]]
    return x, swapped, np.array([1, 1, 0, 0, 1, 0], np.float32), np.array([1, 2, 1, 1, 1, 3], np.float32)


@pytest.mark.parametrize("fairness", [0.0, 0.5, 5.0])
def test_the_fit_is_at_the_least_of_the_stated_loss(fairness):
    x, swapped, y, weight = small_sentences()
    w, b = toxicity.fit(x, swapped, y, weight, fairness=fairness, decay=0.05, steps=3000)
    at = [*map(float, w), b]
    loss = lambda p: brute_loss(p[:-1], p[-1], x, swapped, y, weight, fairness, 0.05)
    least = loss(at)
    # The loss is convex: nothing near is lower, so nothing is.
    for i in range(len(at)):
        for step in (-0.05, 0.05):
            assert loss([v + step * (i == j) for j, v in enumerate(at)]) > least
    draw = random.Random(1)
    for _ in range(50):
        assert loss([v + draw.gauss(0, 0.1) for v in at]) > least


def test_a_stronger_penalty_moves_scores_less_under_a_swap():
    x, swapped, y, weight = small_sentences()
    moved = []
    for fairness in (0.0, 0.5, 5.0, 50.0):
        w, _ = toxicity.fit(x, swapped, y, weight, fairness=fairness, decay=0.01, steps=3000)
        moved.append(float((((x - swapped) @ w) ** 2).sum()))
    assert moved == sorted(moved, reverse=True) and moved[-1] < 0.01 * moved[0]
