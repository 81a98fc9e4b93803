"""The learned models (operators 2, 5, 10) against plain versions that take one number at a time."""

import math
import random
import re

import numpy as np
import pytest

from larkmetric.llm import arrays, language, quality, toxicity


def flat(texts):
    import pyarrow as pa

    return arrays.flat(pa.array(texts, pa.string()))


# 2: expectation-maximisation and the choice of languages


def plain_mixture(columns, grams, other, rounds):
    """Shares by the textbook: responsibilities of each n-gram, then their means."""
    k = len(columns) + 1
    share = [1 / k] * k
    for _ in range(rounds):
        sums = [0.0] * k
        for g in grams:
            parts = [c[g] * s for c, s in zip(columns, share)] + [other * share[-1]]
            for i, part in enumerate(parts):
                sums[i] += part / sum(parts)
        new = [x / len(grams) for x in sums]
        moved = max(abs(a - b) for a, b in zip(new, share))
        share = new
        if moved < 1e-3:
            break
    likely = sum(math.log(sum(c[g] * s for c, s in zip(columns, share)) + other * share[-1]) for g in grams)
    return share, likely


def plain_infer(model, grams):
    other, cost = 1 / language.BUCKETS, model.penalty * math.log(len(grams) + 1)
    columns = [model.probability[:, i] for i in range(len(model.names))]
    whole, best = plain_mixture(columns, grams, other, model.rounds)
    order = sorted(range(len(columns)), key=lambda i: (-whole[i], i))
    chosen = order[:1]
    share, now = plain_mixture([columns[i] for i in chosen], grams, other, model.rounds)
    for i in order[1:]:
        more, likely = plain_mixture([columns[j] for j in [*chosen, i]], grams, other, model.rounds)
        if best - now <= cost or likely - now <= cost:
            break
        chosen, share, now = [*chosen, i], more, likely
    rank = sorted(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
    return [chosen[i] for i in rank], [share[i] for i in rank], share[-1]


def test_mixtures_are_those_of_the_plain_version():
    rng = np.random.default_rng(3)
    raw = rng.random((language.BUCKETS, 4)) ** 12 + 1e-9
    model = language.Languages(list("abcd"), raw / raw.sum(axis=0))
    several = 0
    for t in range(25):
        weights = rng.dirichlet([0.4] * 4)
        p = model.probability @ weights
        grams = rng.choice(language.BUCKETS, rng.integers(1, 160), p=p / p.sum()).astype(np.int32)
        if t % 5 == 0:
            grams = np.concatenate([grams, rng.integers(0, language.BUCKETS, 60).astype(np.int32)])
        of, shares, other = model.infer(grams)
        want = plain_infer(model, grams.tolist())
        assert of == want[0] and shares == pytest.approx(want[1], abs=1e-9) and other == pytest.approx(want[2], abs=1e-9)
        several += len(of) > 1
    assert several > 3


def test_equal_languages_go_by_name():
    rng = np.random.default_rng(4)
    one = rng.random(language.BUCKETS)
    model = language.Languages(["x", "y"], np.column_stack([one, one]) / one.sum())
    of, _, _ = model.infer(rng.integers(0, language.BUCKETS, 50).astype(np.int32))
    assert of == [0]


# 5: FTRL-proximal


def plain_ftrl(f, rows, y, value):
    """Follow the regularised leader, one coordinate at a time."""
    z, n = {}, {}

    def weight(i, l1):
        zi = z.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return (math.copysign(l1, zi) - zi) / ((f.beta + math.sqrt(n.get(i, 0.0))) / f.alpha + f.l2)

    for _ in range(f.epochs):
        for index, label in zip(rows, y):
            places = [*index, "bias"]
            l1 = {i: 0.0 if i == "bias" else f.l1 for i in places}
            w = {i: weight(i, l1[i]) for i in places}
            raw = sum(w[i] * value(i) for i in places)
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, raw)))) - label
            for i in places:
                gi = g * value(i)
                old = n.get(i, 0.0)
                sigma = (math.sqrt(old + gi * gi) - math.sqrt(old)) / f.alpha
                z[i] = z.get(i, 0.0) + gi - sigma * w[i]
                n[i] = old + gi * gi
    return {i: weight(i, 0.0 if i == "bias" else f.l1) * value(i) for i in z}


def test_weights_are_those_of_the_plain_version():
    rng, bits = random.Random(5), 12
    rows = [np.array(sorted(rng.sample(range(1 << bits), rng.randint(0, 12))), np.int32) for _ in range(60)]
    rows += [np.array(sorted({5, 9, *rng.sample(range(2100, 2200), 3)}), np.int32) for _ in range(60)]
    y = np.array([rng.random() < 0.1 for _ in range(60)] + [rng.random() < 0.9 for _ in range(60)]).astype(int)
    order = rng.sample(range(120), 120)
    rows, y = [rows[i] for i in order], y[order]
    f = toxicity.Ftrl(l1=0.5)
    got = f.fit(rows, y, bits)
    want = plain_ftrl(f, [r.tolist() for r in rows], y.tolist(), lambda i: 1.0 if i == "bias" or i < 1 << (bits - 1) else toxicity.PAIR)
    assert got[-1] == pytest.approx(want.pop("bias"))
    for i in range(1 << bits):
        assert got[i] == pytest.approx(want.get(i, 0.0), abs=1e-12)
    assert 0 < np.count_nonzero(got) < len(want), "L1 keeps some at zero"


def test_features_are_words_pairs_and_skips():
    texts = ["a b c a b", "", "one", "x y x y x", "été über été"]
    found = toxicity.features(*flat(texts))
    for text, index in zip(texts, found):
        words = re.findall(r"[^\W_]+", text)
        want = set(words) | {(gap, a, b) for gap in (1, 2, 3) for a, b in zip(words, words[gap:])}
        assert len(index) == len(set(index.tolist())) == len(want)
        assert sum(i < 1 << (toxicity.BITS - 1) for i in index.tolist()) == len(set(words))


def test_nothing_and_one_class_to_learn():
    f = toxicity.Ftrl()
    assert not f.fit([], np.empty(0, int), 8).any()
    one = f.fit([np.array([1], np.int32)] * 30, np.ones(30, int), 8)
    assert one[-1] > 0


# 10: factorisation machine


def plain_machine(rows, y, start, epochs, rate, decay):
    """Gradients of the pairwise sum, one pair at a time; AdaGrad."""
    bias, w, v = start.bias, dict(enumerate(start.weight.tolist())), {i: list(x) for i, x in enumerate(start.factor.tolist())}
    k = start.factor.shape[1]
    gb, gw, gv = 1.0, dict.fromkeys(w, 1.0), {i: [1.0] * k for i in v}
    share = min(0.98, max(0.02, sum(y) / len(y)))
    for _ in range(epochs):
        for (place, value), label in zip(rows, y):
            items = list(zip(place, value))
            raw = bias + sum(w[i] * x for i, x in items)
            for p, (i, x) in enumerate(items):
                raw += sum(sum(a * b for a, b in zip(v[i], v[j])) * x * z for j, z in items[p + 1 :])
            g = (1 / (1 + math.exp(-max(-35.0, min(35.0, raw)))) - label) * (0.5 / share if label else 0.5 / (1 - share))
            slopes = {i: [x * sum(v[j][f] * z for j, z in items if j != i) for f in range(k)] for i, x in items}
            gb += g * g
            bias -= rate * g / math.sqrt(gb)
            for i, x in items:
                step = g * x + decay * w[i]
                steps = [g * s + decay * v[i][f] for f, s in enumerate(slopes[i])]
                gw[i] += step * step
                w[i] -= rate * step / math.sqrt(gw[i])
                for f, s in enumerate(steps):
                    gv[i][f] += s * s
                    v[i][f] -= rate * s / math.sqrt(gv[i][f])
    return bias, w, v


def test_machine_learns_as_the_plain_version():
    rng = random.Random(6)
    size, k = 30, 3
    start = quality.Machine(0.1, np.array([rng.gauss(0, 0.1) for _ in range(size)]), np.array([[rng.gauss(0, 0.3) for _ in range(k)] for _ in range(size)]))
    rows = []
    for _ in range(25):
        place = sorted(rng.sample(range(size), rng.randint(1, 6)))
        rows.append((np.array(place), np.array([rng.random() for _ in place])))
    y = [int(1 in place.tolist() or rng.random() < 0.3) for place, _ in rows]
    got = quality.fit(rows, np.array(y), start, epochs=4, rate=0.1, decay=1e-3)
    bias, w, v = plain_machine([(p.tolist(), x.tolist()) for p, x in rows], y, start, 4, 0.1, 1e-3)
    assert got.bias == pytest.approx(bias, rel=1e-9)
    assert got.weight == pytest.approx([w[i] for i in range(size)], rel=1e-9)
    assert got.factor == pytest.approx(np.array([v[i] for i in range(size)]), rel=1e-9)


def test_machine_of_nothing_and_of_one_class():
    start = quality._start(2)
    same = quality.fit([], np.empty(0, int), start)
    assert same.bias == 0 and not same.weight.any()
    texts = ["good words here", "", "x"]
    rows = quality.features(*flat(texts), np.array([15.0, np.nan, 1.0]))
    one = quality.fit(rows, np.ones(3, int), start)
    assert all(one.raw(*r) > 0 for r in rows)
