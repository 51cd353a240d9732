"""Spelling variants against plain Python: counts, near words, forms and roots."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelweave.llm import spelling
from panelweave.session import stage


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, every=97, length=5, count=3):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= count}
    close = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and near(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(close[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(out)


def found(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def corpus(seed, letters="abÀ", docs=60):
    draw = random.Random(seed)
    words = ["".join(draw.choice(letters) for _ in range(draw.randint(4, 8))) for _ in range(250)]
    return [(i, " ".join(words[int(draw.paretovariate(0.4)) % 250].title() + draw.choice(["", ",", "1"]) for _ in range(120))) for i in range(docs)]


@pytest.mark.parametrize("living, classes", [(2048, 6), (4, 2), (3, 1)])
def test_variants_equal_plain_python(spark, living, classes):
    rows = corpus(living)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = found(spelling.variants(docs, edit=spelling.drop_a_letter(7), living=living, classes=classes))
    assert got == plain(rows, 7)
    assert sum(r[2] for r in got) > 200 and any(r[3] != r[5] for r in got if r[3])


def test_every_pair_one_edit_apart_is_found_once(spark, monkeypatch):
    monkeypatch.setattr(spelling, "ENTRIES", 64)
    words = {"".join(random.Random(i).choice("abx") for _ in range(5 + i % 3)) for i in range(400)}
    words |= {"y" * 3000 + "z", "y" * 3000, "y" * 2999 + "zz", "y" * 5000 + "x", "y" * 5001}
    table = stage(spark.createDataFrame([(w.encode(), 5) for w in words], "word binary, n long"), "words")
    got = sorted((bytes(r.word).decode(), bytes(r.near).decode()) for r in spelling.near_words(table, living=8, classes=2).collect())
    assert got == sorted((a, b) for a in words for b in words if a != b and near(a, b))


def test_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, "1234 ..."), (None, "Hello hello, HELLO hallo hallo hallo ÉTÉSS étéss"), (4, "hello " * 300_000), (4, "hello"), (4, "hello"),
            (5, "x" * 70_000 + " " + "x" * 70_000 + " " + "x" * 70_000 + " ß×÷ıſK")]
    wide = spark.createDataFrame([(*r, "c", "c") for r in rows], "doc_id long, text string, word string, key string")
    assert found(spelling.variants(wide)) == plain(rows, None)
    assert found(spelling.variants(wide, edit=spelling.drop_a_letter())) == plain(rows)
    none = spelling.variants(wide.where("doc_id = 99"))
    assert none.count() == 0 and none.columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_counts_are_whole_beyond_what_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 10)
    rows = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {bytes(r.word).decode("latin-1"): r.n for r in spelling.count_words(docs).collect()}
    want = Counter("".join(c.lower() if c.isascii() else c for c in w) for _, t in rows for w in re.findall("[A-Za-zÀ-ÿ]+", t))
    assert got == want


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(b"%03d" % i, b"%03d" % (i + 1)) for i in range(50)] + [(b"a", b"020")], "word binary, form binary")
    got = {bytes(r.word): bytes(r.root) for r in spelling.roots(forms).collect()}
    assert got == {**{b"%03d" % i: b"050" for i in range(50)}, b"a": b"050"}


def test_distances_and_edits():
    words = [b"abcde", b"abcdf", b"abdce", b"edcba"]
    counts = spelling.letter_counts(words).astype(np.float32)
    assert spelling.squared_distances(counts[:1], counts).tolist() == [[0, 2, 0, 0]]
    codes = spelling._codes(words, 5)
    assert spelling.one_edit(codes[[0, 0, 0]], codes[[1, 2, 3]]).tolist() == [True, False, False]
    longer = spelling._codes([b"abcxde", b"aabcde", b"abcdee", b"bacdee"], 6)
    assert spelling.one_edit(codes[[0, 0, 0, 0]], longer).tolist() == [True, True, True, False]


def test_times_must_let_forms_end(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "doc_id long, text string"), times=1)
