"""Generated keys among ordinary text."""

import random

import pytest

from panelweave.llm import secret_scan

BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def found(spark, texts):
    """The random tokens of each text."""
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [s.hit for s in r.random] for r in secret_scan.scan(rows).select("row.doc_id", "random").collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("before, after", [
    ("AWS_SECRET_ACCESS_KEY=", ""), ("private_key=", "\nnext=1"), ("https://x.example/a?b=1&sig=", "==&c=2"), ("export SIGNING=", "= # old"),
])
def test_keys_behind_an_equals_sign(spark, before, after):
    draw = random.Random(11)
    keys = ["".join(draw.choice(BASE64) for _ in range(44)) for _ in range(30)]
    got = found(spark, [before + key + after for key in keys])
    padding = "=" * (len(after) - len(after.lstrip("=")))
    assert sum(hits == [key + padding] for hits, key in zip(got, keys, strict=True)) >= 27


DRAWN = {"HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "lower": "abcdefghijklmnopqrstuvwxyz",
         "base36": "0123456789abcdefghijklmnopqrstuvwxyz", "base62": BASE64[:62], "base64": BASE64}


def test_short_keys_of_each_alphabet(spark):
    """Keys of 20 to 40 characters, between ordinary tokens of the same alphabets."""
    draw = random.Random(12)
    keys = [(a, n, "".join(draw.choice(s) for _ in range(n))) for a, s in DRAWN.items() for n in (20, 24, 32, 40) for _ in range(50)]
    words = "people who work from home say they spend less time on travel and more with their own family than those in an office".split()
    plain = []
    for _ in range(100):
        some = [draw.choice(words) for _ in range(9)]
        plain += ["".join(some), "_".join(some).upper(), "/".join(some), "-".join(some), some[0] + "".join(w.title() for w in some[1:]),
                  "".join(some[:5]).upper() + str(draw.randrange(1900, 2100)), str(draw.randrange(10 ** 25, 10 ** 26))]
    got = found(spark, [*(key for _, _, key in keys), *(p for p in plain if len(p) >= 20)])
    for alphabet in DRAWN:
        for n in (20, 24, 32, 40):
            hits = sum(bool(h) for h, (a, m, _) in zip(got, keys, strict=False) if (a, m) == (alphabet, n))
            assert hits >= (38 if n <= 24 else 44), (alphabet, n, hits)
    assert sum(map(bool, got[len(keys):])) <= 0.01 * len(got[len(keys):])


def test_a_key_does_not_depend_on_the_size_of_the_corpus(spark):
    draw = random.Random(13)
    keys = ["".join(draw.choice(BASE64) for _ in range(44)) for _ in range(3000)]
    for few in (keys[:30], keys):
        assert sum(map(bool, found(spark, few)[:30])) >= 28
