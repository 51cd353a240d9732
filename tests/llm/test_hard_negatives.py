"""Hard negatives against plain Python, odd rows, and scores by tables against products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import hard_negatives as H


def plain(rows, is_anchor, k=5, n=10):
    """(anchor, positive, rank, negative, scores) as the definition has them, one pair at a time."""
    whole = set()
    for i, vector, label in rows:
        if i is not None and vector is not None and label is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.add((i, tuple(math.floor(256 * x) for x in vector), label))
    dot = lambda a, b: sum(x * y for x, y in zip(a[1], b[1]))
    out = []
    for a in whole:
        if not is_anchor(a[0]):
            continue
        near = sorted((-dot(a, b), b[0]) for b in whole if b != a and b[2] == a[2])[:k]
        for score, p in near:
            far = sorted((-dot(a, b), b[0]) for b in whole if b[2] != a[2] and 30 * -score <= 100 * dot(a, b) <= 90 * -score)
            out += [(a[0], p, rank + 1, i, -score, -s) for rank, (s, i) in enumerate(far[:n])]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("largest, dims", [(3, 1), (256, 64), (256, 13), (5000, 64), (1 << 20, 9)])
def test_table_scores_are_inner_products(largest, dims):
    draw = np.random.default_rng(dims)
    rows, anchors = draw.integers(-largest, largest + 1, (50, dims)), draw.integers(-largest, largest + 1, (7, dims))
    rows[0], anchors[0] = -largest, -largest
    got = H.scores(H.subset_sums(anchors), H.bit_planes(rows, largest.bit_length() + 1), dims * (largest + 1) ** 2)
    assert (got == rows @ anchors.T).all()


def test_mine_equals_plain_python_with_ties_and_odd_rows(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-0.25, 0.0, 0.125, 0.3]) for _ in range(11)], draw.randrange(3)) for i in range(300)]
    rows += [(300, None, 1), (None, [0.1] * 11, 1), (301, [0.1] * 11, None), (302, [0.1] * 10 + [None], 1), (304, [float("nan")] * 11, 1),
             (305, [float("inf")] * 11, 1), (306, [0.3] * 4, 2), (310, [], 0), rows[20], rows[20]]
    wide = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, bits string, row_key int").repartition(3)
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 500 and found(H.mine(wide, F.col("vec_id") % 10 == 0)) == want
    # several passes, blocks and pieces make no difference
    monkeypatch.setattr(H, "PIECE", 16)
    monkeypatch.setattr(H, "BLOCK", 4)
    assert found(H.mine(wide, F.col("vec_id") % 10 == 0, anchors_a_pass=9)) == want


def test_mine_on_tables_without_anchors_or_rows(spark):
    kind = "vec_id long, embedding array<float>, label int"
    empty = H.mine(spark.createDataFrame([], kind), F.lit(True))
    assert empty.count() == 0 and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = spark.createDataFrame([(1, [0.5], 0), (2, [0.5], 0), (3, [0.25], 1), (4, [0.5], 1)], kind)
    assert H.mine(rows, F.col("vec_id") > 9).count() == 0
    # 128 x 64 is half of 128 x 128; an equal score is too near
    assert found(H.mine(rows, F.col("vec_id") == 1)) == [(1, 2, 1, 3, 16384, 8192)]
    with pytest.raises(ValueError, match="63 bits"):
        H.mine(spark.createDataFrame([(1, [1e9], 0)], kind), F.lit(True))
