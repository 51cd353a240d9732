"""The prefix forest: matched prefixes, recall, families of near copies that stay linear in rows, and tight families."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelweave.llm import jaccard_forest as J
from panelweave.session import stage
from tests.llm import brute


def family(n, words, changes, seed=1):
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for at in draw.sample(range(words), changes):
            own[at] = f"v{i}x{at}"
        rows.append((i, " ".join(own)))
    return rows


def test_matched_prefixes_are_the_longest_with_any_row(spark):
    draw = np.random.default_rng(4)
    rows = [(int(t), v.astype(np.uint32).tobytes(), bytes([i])) for i, (t, v) in enumerate(
        (draw.integers(0, 3), draw.integers(0, 3, J.DEPTH)) for _ in range(200))]
    longest = [max((next((k for k in range(J.DEPTH) if a[1][4 * k:4 * k + 4] != b[1][4 * k:4 * k + 4]), J.DEPTH)
                    for b in rows if b is not a and b[0] == a[0]), default=0) for a in rows]
    order = sorted(range(200), key=lambda i: rows[i])
    batches = [pa.RecordBatch.from_arrays([pa.array([rows[i][0] for i in part], pa.int32()), pa.array([rows[i][1] for i in part]),
                                           pa.array([rows[i][2] for i in part])], ["tree", "slice", "fp"])
               for part in (order[:1], order[1:90], [], order[90:])]
    got = {f: s for out in J._matched(3)(iter(batches)) for f, s in zip(out.column("fp").to_pylist(), out.column("shared").to_pylist(), strict=True)}
    want = {rows[i][2]: longest[i] for i in order if longest[i] >= 3}
    ends = {rows[i][2] for i in (order[0], order[-1])}
    assert {f: s for f, s in got.items() if f not in ends} == {f: s for f, s in want.items() if f not in ends}
    assert all(got[f] == J.DEPTH for f in ends) and len(got) > 50


def test_forest_links_equal_brute_force(spark):
    """Pairs of all similarities around the threshold; each of them may be the only link of its members."""
    draw = random.Random(9)
    rows = []
    for i in range(150):
        words = [f"p{i}w{j}" for j in range(60)]
        rows.append((2 * i, " ".join(words)))
        for at in draw.sample(range(60), i % 4):
            words[at] = "x"
        rows.append((2 * i + 1, " ".join(words)))
    got = {r.doc_id: (r.class_id, r.copies, r.n_links) for r in J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.families(rows)
    linked = [i for i, (_, _, links) in want.items() if links]
    assert len(linked) > 80
    assert sum(got[i] == want[i] for i in linked) >= 0.99 * len(linked)
    assert all(got[i] == want[i] for i in want if i not in linked)


@pytest.mark.parametrize("words, changes", [(300, 2), (70, 1)])
def test_rows_of_a_large_family_grow_with_its_members(spark, monkeypatch, words, changes):
    """Tight families (300 words) and ones in which copies differ too much among each other (70): rows written, by size.

    Sixteen trees hold each member once; each of four tasks hands out a count and a link for a member at most.
    """
    monkeypatch.setattr(J, "BLOCK", 64)
    rows = {}

    def counted(df, name):
        out = stage(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(J, "stage", counted)
    monkeypatch.setattr("panelweave.llm.components.stage", counted)
    for n in (256, 1024):
        rows.clear()
        docs = spark.createDataFrame(family(n, words, changes), "doc_id long, text string").repartition(2)
        got = J.near_duplicates(docs, name="grow").collect()
        if words == 300:
            assert {(r.class_id, r.n_links) for r in got} == {(0, n - 1)}
        assert rows["grow-live"] <= 16 * n + 16
        # links between components: a tree of each group, and pairs of blocks
        assert rows["grow-likely"] <= 16 * n and rows["grow-families-edges"] <= 32 * n
        assert n < rows["grow-verified"] <= 6 * n and rows["grow-classes-of-edges"] <= 4 * n


def test_tight_families_are_those_within_half_the_distance(spark):
    sets = {"a": list(range(100)), "b": list(range(5, 105)), "c": list(range(8, 108)), "d": list(range(20, 120))}
    rows = [(g, 3, i % 3, f.encode(), np.array(sets[f], dtype=np.uint64).tobytes()) for g, held in (("t", "abc"), ("u", "abcd")) for i, f in enumerate(held)]
    members = spark.createDataFrame(rows, "group string, blocks int, mine int, fp binary, value binary")
    # a and b share 95 of 105: more than 0.9; a and c 92 of 108: less
    assert J.tight_families(members, 0.8).collect() == []
    assert [r.group for r in J.tight_families(members.where(F.col("fp") != F.lit(b"c")), 0.8).collect()] == ["t"]


def test_family_of_long_texts(spark):
    base = " ".join(f"w{i}" for i in range(250_000))
    docs = spark.range(24).select(F.col("id").alias("doc_id"), F.concat(F.lit(base), F.lit(" end"), F.col("id").cast("string")).alias("text")).repartition(3)
    got = J.near_duplicates(docs, name="long").collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 23)} and len(got) == 24
