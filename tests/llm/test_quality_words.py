"""The passage encoder: what passages say counts, the passage that says it gets the weight, and a forward pass in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import quality_mil as Q

DRAW = random.Random(4)
GOOD, BAD, BOTH = (["".join(DRAW.choice("abcdefghijklm") for _ in range(5)) for _ in range(200)] for _ in range(3))


def text(words, n):
    return " ".join(DRAW.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def taught(spark):
    """Classes differ in their words alone: equal lengths, letters and repetition. A bad document has one bad passage in five."""
    rows = []
    for i in range(1200):
        parts = [text(BOTH, 64) for _ in range(4)] + [text(GOOD if i % 2 else BAD, 64)]
        DRAW.shuffle(parts)
        rows.append((i, " ".join(parts), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return docs, Q.learn(docs, docs.where("doc_id < 1000").select("doc_id", "quality"), name="words")


def test_words_alone_tell_the_classes(taught):
    docs, model = taught
    got = Q.score(docs.where("doc_id >= 1000"), model, carry=(F.col("quality"),)).select("row.quality", "score").collect()
    assert sum((r.score > 0.5) == (r.quality == 1) for r in got) >= 0.97 * len(got)


def test_the_passage_that_tells_gets_the_weight(taught):
    _, model = taught
    right = 0
    for i in range(40):
        parts = [text(BOTH, 64) for _ in range(6)]
        parts[i % 6] = text(BAD, 64)
        x, begin, rows, edges = Q.encode([" ".join(parts).encode()])
        _, (_, _, _, weight, _) = Q.forward(model, x, begin, Q.meanings(model[-1], rows, edges))
        right += int(weight.argmax() == i % 6)
    assert right >= 30


def test_meanings_are_means_of_word_vectors():
    table = np.random.default_rng(1).normal(size=(3 * Q.TABLE, Q.HIDDEN))
    texts = [b"The cat  sat", b"", b"\n\t", " ".join(f"w{i}" for i in range(130)).encode(), "Été a".encode()]
    x, begin, rows, edges = Q.encode(texts)
    assert begin.tolist() == [0, 1, 2, 3, 6, 7] and edges.tolist() == [0, 3, 3, 3, 67, 131, 133, 135]
    got = Q.meanings(table, rows, edges)
    for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        want = sum((table[r[0]] + table[r[1]] + table[r[2]] for r in rows[a:b]), np.zeros(Q.HIDDEN)) / max(b - a, 1)
        np.testing.assert_allclose(got[p], want, atol=1e-12)
    # beginnings and endings in any case, words as they stand; short words are their own beginning
    same = Q.encode([b"Cat catty CATTY batty"])[2]
    assert same[1, 1] == same[2, 1] and same[1, 2] == same[2, 2] == same[3, 2] and same[1, 0] != same[2, 0]
    assert (same[:, 0] < Q.TABLE).all() and ((same[:, 1] // Q.TABLE) == 1).all() and ((same[:, 2] // Q.TABLE) == 2).all()


def test_forward_pass_equals_a_loop():
    draw = np.random.default_rng(2)
    model = [draw.normal(size=p.shape) * 0.5 for p in Q.start_model()]
    texts = [text(BOTH, 150).encode(), b"a b c", b"", text(GOOD, 64).encode()]
    x, begin, rows, edges = Q.encode(texts)
    meaning = Q.meanings(model[-1], rows, edges)
    got, _ = Q.forward(model, x, begin, meaning)
    w, b, v, u, a, c, c0, _ = model
    logistic = lambda t: 1 / (1 + math.exp(-t))
    for d in range(len(texts)):
        hidden, logits = [], []
        for p in range(begin[d], begin[d + 1]):
            h = [math.tanh(sum(x[p][i] * w[i][k] for i in range(Q.FEATURES)) + b[k] + meaning[p][k]) for k in range(Q.HIDDEN)]
            hidden.append(h)
            logits.append(sum(a[g] * math.tanh(sum(h[k] * v[k][g] for k in range(Q.HIDDEN)))
                              * logistic(sum(h[k] * u[k][g] for k in range(Q.HIDDEN))) for g in range(Q.GATE)))
        e = [math.exp(t - max(logits)) for t in logits]
        z = [sum(e[p] / sum(e) * hidden[p][k] for p in range(len(e))) for k in range(Q.HIDDEN)]
        assert got[d] == pytest.approx(logistic(sum(z[k] * c[k] for k in range(Q.HIDDEN)) + c0[0]), rel=1e-9)


def test_gradients_equal_differences():
    draw = np.random.default_rng(5)
    model = [draw.normal(size=p.shape) * 0.3 for p in Q.start_model()]
    texts = [text(BOTH, 150).encode(), b"a b c", b"", text(GOOD, 64).encode()]
    x, begin, rows, edges = Q.encode(texts)
    step = Q._Batch([(x[a:b], rows[edges[a]:edges[b]], edges[a:b + 1] - edges[a]) for a, b in zip(begin[:-1], begin[1:], strict=True)],
                    np.array([1.0, 0.0, 1.0, 0.0]))

    def loss():
        p, _ = Q.forward(model, step.x, step.begin, Q.meanings(model[-1], step.rows, step.edges))
        return -np.mean(step.y * np.log(p) + (1 - step.y) * np.log(1 - p))

    layers, dx = Q.gradient(model, step.x, step.begin, step.y, Q.meanings(model[-1], step.rows, step.edges))
    table = step.table_gradient(dx)
    spots = [(0, (3, 2), layers[0][3, 2]), (2, (1, 4), layers[2][1, 4]), (5, (7,), layers[5][7]),
             *((7, (step.found[i], 6), table[i, 6]) for i in (0, 40, len(table) - 1))]
    for part, place, want in spots:
        old = model[part][place]
        model[part][place] = old + 1e-5
        up = loss()
        model[part][place] = old - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(want, rel=1e-4, abs=1e-9)
        model[part][place] = old
