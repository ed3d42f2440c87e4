"""Whitening against exact fractions, and mixes against a plain walk through each source."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.llm import mixing, whitening
from keelson.llm.common import key_id

VECTORS = "vec_id bigint, embedding array<double>, x string, n int, component int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 4), st.lists(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=4, max_size=4), min_size=1, max_size=70))
def test_scatter_is_exact(dims, rows):
    x = np.array(rows, np.int64)[:, :dims].copy()
    sums, products = whitening.scatter(x)
    plain = x.astype(object)
    assert (sums == plain.sum(axis=0)).all()
    assert (products == np.triu(plain.T @ plain)).all()


def test_whitening_against_fractions(spark):
    draw = random.Random(3)
    # Far from zero, with spreads that differ by many orders, and with copies.
    rows = [(i, [1e9 + draw.gauss(0, 4e3), draw.gauss(5, 3), draw.gauss(0, 1), draw.gauss(0, 0.5), 7.0]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (2001, None), (2002, [1.0, None, 1.0, 1.0, 1.0]),
             (2003, [1.0, math.nan, 0.0, 0.0, 0.0]), (2004, [math.inf] * 5)]
    usable = [(i, v) for i, v in rows if i is None or i not in (2001, 2002, 2003, 2004)]
    ints = [(i, tuple(math.floor(256 * c) for c in v) + (0,) * (5 - len(v))) for i, v in usable]
    fit = sorted({(len(v), x) for (_, v), (_, x) in zip(usable, ints, strict=True)})
    fit = [x for _, x in fit]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    found = whitening.whitened(vectors(spark, rows).repartition(5)).collect()
    assert len(found) == 4 * len(usable)
    assert {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-9
    want = Counter((i, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in ints)
    got = Counter((r.vec_id, r.deviation) for r in found if r.component == 1)
    assert got == Counter({(i, d if d < 2**63 else None): k for (i, d), k in want.items()})
    v = [[Fraction(sum(n * n * a[i] * a[j] for a in fit) - n * sums[i] * sums[j], n**3) for j in range(5)] for i in range(5)]
    trace = sum(v[i][i] for i in range(5))
    by = {r.component: r.explained for r in found}
    # The largest spread by power iteration in fractions.
    q = [Fraction(1)] + [Fraction(0)] * 4
    for _ in range(6):
        q = [sum(a * b for a, b in zip(row, q, strict=True)) for row in v]
        q = [Fraction(float(a / q[0])) for a in q]
    first = sum(a * sum(x * y for x, y in zip(row, q, strict=True)) for a, row in zip(q, v, strict=True)) / sum(a * a for a in q)
    assert by[1] == pytest.approx(float(first / trace), rel=1e-9) and list(by.values()) == sorted(by.values(), reverse=True)
    # Whitened columns of the fit list: no mean, no correlation, variance one.
    seen, w = set(), []
    for (i, v0), r in zip(usable, range(len(usable)), strict=True):
        key = (len(v0), tuple(v0))
        if key not in seen and i is not None and i != 5:
            seen.add(key)
            w.append([next(x.whitened for x in found if x.vec_id == i and x.component == c) for c in (1, 2, 3, 4)])
    assert np.isfinite(np.array(w)).all()


def test_whitening_of_equal_or_no_vectors(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        assert whitening.whitened(vectors(spark, rows)).collect() == []
    flat = whitening.whitened(vectors(spark, [(1, [0.0, 3.0]), (2, [1.0, 3.0]), (3, [-0.001, 3.0])])).collect()
    assert {r.component for r in flat} == {1}
    assert whitening.whitened(vectors(spark, [])).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]


def test_shorter_vectors_are_followed_by_zeros(spark):
    rows = [(1, [1.0, 2.0, 5.0]), (2, [3.0]), (3, []), (4, [0.5, 7.0]), (5, [2.0, 2.0, 2.0])]
    padded = [(i, v + [0.0] * (3 - len(v))) for i, v in rows]
    short, whole = (
        sorted((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9)) for r in whitening.whitened(vectors(spark, x)).collect())
        for x in (rows, padded)
    )
    assert short == whole and len(short) == 15


def test_long_vectors_and_big_entries(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-1e300, 1e300, 0.0, 3.5]) for _ in range(130)]) for i in range(40)]
    found = whitening.whitened(vectors(spark, rows)).collect()
    assert len(found) == 160 and all(r.deviation is None and math.isfinite(r.whitened) for r in found)
    assert found[0].identity_error < 1e-9


# 12: mixes


def brute_mix(rows, quality, weights, most, seed="mix"):
    """``(id, size, source size, target, taken)`` of rows ``(id, text, source)`` with different ids."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for i, t, _ in rows}
    by_source = defaultdict(list)
    for i, _, s in rows:
        by_source[s].append(i)
    names = sorted((s for s in by_source if s is not None), key=str.encode) + ([None] if None in by_source else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    whole = {s: sum(size[i] for i in by_source[s]) for s in names}
    full, left = set(), sum(whole.values())
    while True:
        rest = [s for s in names if s not in full]
        left = sum(whole.values()) - sum(most * whole[s] for s in full)
        share = {s: Fraction(left * weight[s], sum(weight[r] for r in rest)) for s in rest}
        over = {s for s in rest if share[s] >= most * whole[s]}
        if not over:
            break
        full |= over
    out = []
    for s in names:
        target = float(most * whole[s]) if s in full else float(share[s])
        budget = math.floor(target + 0.5)

        def draw(i):
            digits = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16)
            w = quality.get(i, 1.0)
            return (-math.log((digits + 0.5) / 2**52) / w if w > 0 else math.inf, i)

        epochs, rest_words = divmod(budget, whole[s]) if whole[s] else (0, 0)
        for i in sorted(by_source[s], key=draw):
            part = max(0, min(size[i], rest_words))
            rest_words -= size[i]
            out.append((i, size[i], whole[s], target, epochs * size[i] + part))
    return sorted(out)


def documents(n, sources, seed):
    draw = random.Random(seed)
    return [
        (i, draw.choice([None, "", " \t", "one", "a b c d", " ".join("w" * (i % 3 + 1) for _ in range(draw.randint(1, 90)))]),
         draw.choice(sources))
        for i in range(n)
    ]


SCHEMA = "doc_id bigint, text string, source string, size int, target int, `row` int, draw int, _part int, before int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], SCHEMA)


def collected(mixed):
    rows = mixed.select(key_id().alias("d"), "size", "source_size", "target", "taken").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("sources", [["b", "a", "\U0001f600", "￮", "", None], ["hot"] * 30 + ["b", "c", "tiny"]])
def test_mix_against_brute_force(spark, sources):
    rows = documents(300, sources, 7)
    quality = {i: float(i % 4) for i in range(0, 300, 2)}
    table = spark.createDataFrame([(i, w) for i, w in quality.items()] + [(0, -3.0), (None, 9.0)], "doc_id bigint, weight double")
    for parts in (1, 7):
        got = collected(mixing.mix(frame(spark, rows).repartition(parts), table))
        want = brute_mix(rows, quality, (1, 2, 3), 3)
        assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in sorted(want, key=repr)]
        assert all(g[3] == pytest.approx(w[3]) for g, w in zip(got, sorted(want, key=repr), strict=True))
    taken, target = Counter(), {}
    source = {i: s for i, _, s in rows}
    for d, size, _, t, n in got:
        assert 0 <= n <= 3 * size
        taken[source[d]] += n
        target[source[d]] = t
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(sum(g[1] for g in got))


def test_odd_mixes(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "other words", "s"), (None, "x y", None), (None, None, None), (2, None, "empty")]
    got = mixing.mix(frame(spark, rows))
    found = got.select(key_id().alias("d"), "source", "size", "taken").collect()
    assert sorted((r.d, r.source, r.size) for r in found if r.d) == [(1, "s", 2), (1, "s", 3), (1, "s", 3), (2, "empty", 0)]
    assert sum(r.taken for r in found) == 10 and len(found) == 6
    assert mixing.mix(frame(spark, [])).count() == 0
    nothing = mixing.mix(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert {(r.target, r.taken) for r in nothing} == {(0.0, 0)}


def test_drawn_texts_have_the_words_taken(spark):
    rows = [r for r in documents(120, ["a", "b", "c", "d", None], 9) if r[1]] + [(7000, "twice the same", "a")] * 2
    docs = frame(spark, rows)
    mixed = mixing.mix(docs).cache()
    words = F.regexp_count("row.text", F.lit(mixing.WORD))
    got = mixing.drawn(docs, mixed).groupBy("row.doc_id").agg(F.sum(words).alias("n"), F.max("epoch").alias("times")).collect()
    want = mixed.groupBy(key_id().alias("d")).agg(F.sum("taken").alias("n")).where("n > 0").collect()
    assert {r.doc_id: r.n for r in got} == {r.d: r.n for r in want}
    assert max(r.times for r in got) > 1


def test_a_running_sum_over_ranges(spark):
    from keelson.operators.positions import running

    draw = random.Random(2)
    rows = [(draw.choice(["a", "a", "a", "b"]), i, draw.randint(0, 9)) for i in range(500)]
    got = running(spark.createDataFrame(rows, "g string, i int, n int").repartition(9), ["g"], ["i"], F.col("n"), "ahead")
    for r in got.collect():
        assert r.ahead == sum(n for g, i, n in rows if g == r.g and i < r.i)
