"""The language model's learner against a loop over single weights, and its temperature against a search."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from panelweave.llm import language_id as L

DRAW = random.Random(6)
TEXTS = ["".join(DRAW.choice("abc é" if i % 2 else "bcd e") for _ in range(30)) for i in range(25)] + ["", "12 3"]
LABELS = [i % 2 for i in range(27)]


def plain_ftrl(texts, labels, idf, classes):
    """Weight by weight, document by document."""
    z, n = {}, {}
    for text, label in zip(texts, labels, strict=True):
        features = [f for part in L.grams([text])[0] for f in part.tolist()]
        if not features:
            continue
        x = {f: L.SCALE * features.count(f) / len(features) * idf[f] for f in set(features)} | {L.DIMENSIONS: 1.0}

        def weight(f, k):
            zz, nn = z.get((f, k), 0.0), n.get((f, k), 0.0)
            if abs(zz) <= L.L1:
                return 0.0
            return -(zz - math.copysign(L.L1, zz)) / ((L.BETA + math.sqrt(nn)) / L.RATE + L.L2)

        w = {(f, k): weight(f, k) for f in x for k in range(classes)}
        logits = [sum(x[f] * w[f, k] for f in x) for k in range(classes)]
        top = max(logits)
        p = [math.exp(v - top) / sum(math.exp(u - top) for u in logits) for v in logits]
        for f, value in x.items():
            for k in range(classes):
                g = value * (p[k] - (k == label))
                nn = n.get((f, k), 0.0)
                z[f, k] = z.get((f, k), 0.0) + g - (math.sqrt(nn + g * g) - math.sqrt(nn)) / L.RATE * w[f, k]
                n[f, k] = nn + g * g
    return z, n


def test_pass_over_a_shard_equals_a_loop():
    idf = 1 + np.random.default_rng(1).random(L.DIMENSIONS)
    rows = pd.DataFrame({"order": range(len(TEXTS)), "text": TEXTS, "label": LABELS})
    start = [np.zeros((L.DIMENSIONS + 1, 2))] * 2
    (z, n), size = L._follow(idf, 2)(rows.sample(frac=1, random_state=2), start, 0)
    want_z, want_n = plain_ftrl(TEXTS, LABELS, idf, 2)
    assert size == len(TEXTS) and {k[0] for k in want_z} == set(np.flatnonzero(n.any(1)).tolist())
    for (f, k), value in want_z.items():
        assert z[f, k] == pytest.approx(value, abs=1e-9) and n[f, k] == pytest.approx(want_n[f, k], abs=1e-9)


def test_temperature_has_the_least_loss(spark):
    draw = np.random.default_rng(3)
    model = L.Model(["x", "y"], draw.normal(size=(L.DIMENSIONS, 2)).astype(np.float32), np.array([0.1, -0.1]))
    rows = spark.createDataFrame(list(zip(TEXTS, LABELS, strict=True)), "text string, label int").repartition(3)
    logits, size = model.logits(TEXTS)

    def loss(t):
        return sum(math.log(sum(math.exp((v - row[label]) / t) for v in row)) for row, label, letters in zip(logits, LABELS, size, strict=True) if letters)

    assert L.temperature(rows, model, spark) == min(L.TEMPERATURES, key=loss)
    assert L.temperature(rows.where("text = ''"), model, spark) == 1.0
