"""Parts of the operators by themselves."""

import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelweave.llm import decontaminate, feistel, jaccard_forest, language_id, line_dedup, mixing, shingles, tool_calls
from panelweave.llm.components import components
from tests.llm import brute


@given(st.integers(1, 3000), st.integers(0, 1 << 30))
@settings(max_examples=60, deadline=None)
def test_permutation_and_its_inverse(n, seed):
    cycle = feistel.Permutation(n, seed)
    out = cycle.forward(np.arange(n))
    assert sorted(out.tolist()) == list(range(n))
    assert cycle.inverse(out).tolist() == list(range(n))


def test_permutation_of_large_numbers():
    cycle = feistel.Permutation(10 ** 13 + 7)
    some = np.random.default_rng(1).integers(0, cycle.n, 1000)
    out = cycle.forward(some)
    assert out.min() >= 0 and out.max() < cycle.n and (cycle.inverse(out) == some).all()
    assert abs(np.corrcoef(some, out)[0, 1]) < 0.15


def _hash_of(words):
    return shingles.word_hashes([" ".join(words).encode()]).shingles()[0].tolist()


@given(st.lists(st.text("ab é1\n-", max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_shingles_do_not_depend_on_the_batch(texts):
    data = [t.encode() for t in texts]
    if not data:
        return
    together, begin = shingles.word_hashes(data).shingles()
    for i, text in enumerate(texts):
        own = together[begin[i]:begin[i + 1]].tolist()
        assert own == shingles.word_hashes([text.encode()]).shingles()[0].tolist()
        assert len(own) == len(brute.shingles(text))
        assert [own.index(h) for h in own] == [brute.shingles(text).index(s) for s in brute.shingles(text)]


def test_long_words_differ():
    a, b = "x" * 64 + "y" * 64, "y" * 64 + "x" * 64
    assert len({tuple(_hash_of([w])) for w in (a, b, "x" * 128, "x" * 127, "x" * 129)}) == 5


def test_prefix_depth_reaches_the_target():
    depth = jaccard_forest.prefix_depth()
    assert jaccard_forest.recall(0.8, depth) >= jaccard_forest.TARGET > jaccard_forest.recall(0.8, depth + 1)


def test_blocks_count_every_link_once(spark, monkeypatch):
    """A family far larger than a block: links as by brute force."""
    monkeypatch.setattr(jaccard_forest, "BLOCK", 8)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        own = list(words)
        own[(i * 7) % 150] = f"v{i}"
        own[(i * 11 + 3) % 150] = f"u{i % 5}"
        rows.append((i, " ".join(own)))
    got = jaccard_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), name="blocks")
    assert {r.doc_id: (r.class_id, r.copies, r.n_links) for r in got.collect()} == brute.families(rows)


def test_intersections():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 400, 100).astype(np.uint64)) for _ in range(9)]
    got = jaccard_forest.intersections(sets)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]


def test_components(spark):
    chain = [(bytes([i]), bytes([i + 1])) for i in range(10, 60)] + [(b"\x01", b"\x02"), (b"\x03", b"\x02"), (b"\x05", b"\x05")]
    got = {bytes(r.node): bytes(r.label) for r in components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    assert got == {**{bytes([i]): bytes([10]) for i in range(10, 61)}, b"\x01": b"\x01", b"\x02": b"\x01", b"\x03": b"\x01", b"\x05": b"\x05"}


def test_hamming_blocks_hold_all_within_the_radius():
    """Flip RADIUS bits in every way that spreads them evenly: some block still is among the variants."""
    draw = np.random.default_rng(3)
    flips = set(decontaminate._variants().tolist())
    for _ in range(300):
        bits = np.zeros(128, dtype=np.uint8)
        bits[draw.choice(128, decontaminate.RADIUS, replace=False)] = 1
        assert any(int(b) in flips for b in np.packbits(bits))


def test_counted_multisets():
    a, b = np.array([5, 5, 5, 9], dtype=np.uint64), np.array([5, 5, 9, 9], dtype=np.uint64)
    assert len(np.intersect1d(decontaminate.counted(a), decontaminate.counted(b))) == 3


@given(st.lists(st.text("ab \n", max_size=60), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_line_hashes(texts):
    """Equal word lists, and only they, have equal hashes; so have lines without one word."""
    lines = line_dedup.Lines([t.encode() for t in texts])
    plain = [(d, i, line.split()) for d, t in enumerate(texts) for i, line in enumerate(t.split("\n")) if line.split()]
    assert list(zip(lines.doc.tolist(), lines.number.tolist(), strict=True)) == [(d, i) for d, i, _ in plain]
    line, place, hashes = lines.without_each(np.arange(len(plain)))
    seen = {}
    for words, *h in [(tuple(w), *x) for (_, _, w), x in zip(plain, zip(*(h.tolist() for h in lines.whole()), strict=True), strict=True)] + [
            (tuple(plain[at][2][:p] + plain[at][2][p + 1:]), *x)
            for at, p, x in zip(line.tolist(), place.tolist(), zip(*(h.tolist() for h in hashes), strict=True), strict=True)]:
        assert seen.setdefault(words, h) == h
    assert len({tuple(h) for h in seen.values()}) == len(seen)


def test_near_lines(spark):
    base = "a b c d e f g h i j k l"
    rows = [(1, base), (2, base.replace("f ", "")), (3, base.replace("f", "x")), (4, base.replace("f", "x").replace("c", "y")),
            (5, "a b c"), (6, "a b d"), (7, "m " + base), (8, "  a\tb c "), (9, base.replace("a b", "b a"))]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "n_dropped").collect()
    # 4 is one word from 3, 8 equals 5, 9 takes two edits, short lines must be equal
    assert {r.doc_id for r in got if r.n_dropped} == {2, 3, 4, 7, 8}


def test_targets(spark):
    for sizes in ({"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, "ä": 70, None: 400}, {"z": 7}, {"a": 0, "b": 50}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(rows).collect()}
        assert got == pytest.approx(brute.mix_targets(sizes))


def test_first_words(spark):
    rows = spark.createDataFrame([(" a  b\nc ", 2), ("x", 1), ("", 0), ("a b", 0)], "text string, n int")
    from pyspark.sql import functions as F
    assert [r[0] for r in rows.select(mixing.first_words(F.col("text"), F.col("n"))).collect()] == [" a  b", "x", "", ""]


def test_penalty_leaves_weights_zero():
    z = np.array([[0.5 * language_id.L1, 2 * language_id.L1, -1.0]])
    assert (language_id.weights(z, np.ones_like(z)) == 0).tolist() == [[True, False, False]]


SCHEMAS = {"find": {"q": {"type": "string", "required": True, "min": 2}, "n": {"type": "integer", "max": 9}, "how": {"type": "string", "enum": ["a", "b"]}}}


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, "c", "b", "find", '{"n": 3, "q": "xyz"}', 1), (1, "b", "a", "find", '{"q": "x", "n": 12, "z": 1}', 2),
        (1, "a", None, "find", '{"how": "c"}', 3), (1, "a", None, "find", '{"q": "later"}', 4), (1, "a", None, "find", '{"q": "later"}', 4),
        (2, "a", "b", "find", '{"q": "loop"}', 1), (2, "b", "a", "lost", "{}", 2), (2, "d", "a", "find", '{"q": 5}', 3),
        (None, None, None, None, None, None), (3, "x", "gone", "find", "[1]", 1), (3, "y", None, "find", "no json", 2),
    ], "conv_id long, call_id string, after_id string, name string, arguments string, turn long")
    results = spark.createDataFrame([
        (1, "a", 'said "yes"\n', 5), (1, "a", "again", 6), (1, "c", None, 7), (9, "a", "nobody asked", 1), (3, "x", "", 4)],
        "conv_id long, call_id string, content string, turn long")
    rows = tool_calls.link(calls, results, SCHEMAS).collect()
    of = lambda conv: sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.position)
    assert [(r.call_id, r.level, r.status, r.copies, r.problems) for r in of(1)] == [
        ("a", 0, "linked", 1, ["how: not one of the values", "q: missing"]),
        ("b", 1, "unanswered", 1, ["z: not in the schema", "n: above 9", "q: below 2"]),
        ("c", 2, "linked", 1, []),
        ("a", None, "duplicate call", 2, []),
        ("a", None, "duplicate result", 1, []),
    ]
    assert {(r.call_id, r.status) for r in of(2)} == {("a", "cycle"), ("b", "cycle"), ("d", "cycle")}
    assert [r.problems for r in of(2)] == [[], ["unknown tool"], ["q: not of type string"]]
    assert [(r.level, r.status, r.problems) for r in of(3)] == [
        (0, "linked", ["not a JSON object"]), (0, "unanswered", ["not a JSON object"])]
    assert [r.status for r in of(9)] == ["orphan result"] and len(of(None)) == 1
    first = json.loads(of(1)[0].json)
    assert list(first) == sorted(first) and first["result"] == 'said "yes"\n' and of(1)[2].json == (
        '{"arguments":{"n":3,"q":"xyz"},"call_id":"c","name":"find","position":2,"result":null,"status":"linked"}')
    assert sorted(r.position for r in of(1)) == list(range(5))


def test_levels_of_a_long_chain(spark):
    calls = spark.createDataFrame([(1, str(i), str(i - 1)) for i in range(300)], "conv_id long, call_id string, after_id string")
    got = {r.call_id: r.level for r in tool_calls.levels(calls).collect()}
    assert got == {str(i): i for i in range(300)} and math.log2(300) < 9
