"""Training against a plain follow-the-regularised-leader with dictionaries."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from loomspark.llm import language_id as own


def plain_fit(rows, languages):
    """(weights by (feature, language), bias by language, idf by feature), as McMahan et al. give the per-coordinate rule."""
    train = [r for i, r in enumerate(rows) if i % 5]
    df = defaultdict(int)
    for *_, at, _ in train:
        for k in at.tolist():
            df[k] += 1
    idf = lambda k: math.log((1 + len(train)) / (1 + df[k])) + 1.0
    z, n = defaultdict(float), defaultdict(float)

    def weight(k, c):
        if abs(z[k, c]) <= own.L1:
            return 0.0
        return -(z[k, c] - math.copysign(own.L1, z[k, c])) / ((own.BETA + math.sqrt(n[k, c])) / own.ALPHA + own.L2)

    for _ in range(own.EPOCHS):
        for _, lang, at, tf in train:
            x = {k: t * idf(k) for k, t in zip(at.tolist(), tf.tolist(), strict=True)}
            norm = math.sqrt(sum(v * v for v in x.values()))
            x = {k: v / norm for k, v in x.items()} | {"bias": 1.0}
            w = {(k, c): weight(k, c) for k in x for c in languages}
            s = {c: sum(v * w[k, c] for k, v in x.items()) for c in languages}
            top = max(s.values())
            total = sum(math.exp(v - top) for v in s.values())
            for c in languages:
                p = math.exp(s[c] - top) / total - (c == lang)
                for k, v in x.items():
                    g = v * p
                    sigma = (math.sqrt(n[k, c] + g * g) - math.sqrt(n[k, c])) / own.ALPHA
                    z[k, c] += g - sigma * w[k, c]
                    n[k, c] += g * g
    return weight, idf


def test_against_a_plain_leader():
    rng = random.Random(6)
    languages = ["a", "b", "c"]
    rows = []
    for i in range(60):
        k = rng.randrange(3)
        at = np.array(sorted(rng.sample(range(k * 10, k * 10 + 25), 8)))
        rows.append((i, languages[k], at, np.array([1 + math.log(rng.randint(1, 5)) for _ in at])))
    model = own.fit(rows)
    weight, idf = plain_fit(rows, languages)
    used = sorted({k for r in rows for k in r[2].tolist()})
    assert model.weights[used] == pytest.approx(np.array([[weight(k, c) for c in languages] for k in used]), abs=1e-9)
    assert model.bias == pytest.approx(np.array([weight("bias", c) for c in languages]), abs=1e-9)
    seen = sorted({k for i, r in enumerate(rows) if i % 5 for k in r[2].tolist()})
    assert model.idf[seen] == pytest.approx(np.array([idf(k) for k in seen]))
    # penalties leave weights at zero, and the temperature is the best of the grid on what training didn't see
    assert (model.weights[used] == 0).any()

    def loss(t):
        out = 0.0
        for i in range(0, len(rows), 5):
            s = model.logits(*rows[i][2:]) / t
            out -= s[languages.index(rows[i][1])] - s.max() - math.log(np.exp(s - s.max()).sum())
        return out

    assert loss(model.temperature) <= min(map(loss, np.geomspace(0.05, 20, 121).tolist())) + 1e-9
