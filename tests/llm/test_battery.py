"""The battery in plain Python, many hits in one text, and the share of false reports at several shares of keys."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from panelweave.llm import secret_scan as S

BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def tail(z):
    return 0.5 * math.erfc(z / math.sqrt(2))


def plain_battery(hit):
    core = hit.rstrip("=")
    alphabet = next((i for i, (_, p, _) in enumerate(S.ALPHABETS) if re.match(p, core)), None)
    if alphabet is None:
        return None
    symbols = S.ALPHABETS[alphabet][2]
    k = min(len(symbols), 64)
    x = [(symbols.index(c) - 2 if symbols.index(c) > 63 else symbols.index(c)) + 1 for c in core]
    n = len(x)
    chi = max(0.0, sum(x.count(d) ** 2 for d in set(x)) * k / n - n)
    spread = 2 / (9 * (k - 1))
    even = tail(((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    side = [v > (k + 1) / 2 for v in x]
    high, turns = sum(side), sum(a != b for a, b in zip(side, side[1:]))
    mean = 2 * high * (n - high) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs = 2 * tail(abs(turns + 1 - mean) / math.sqrt(variance)) if variance > 0 else 0.0
    middle = sum(x) / n
    spread, joint = sum((v - middle) ** 2 for v in x), sum((a - middle) * (b - middle) for a, b in zip(x, x[1:]))
    serial = 2 * tail(abs(joint / spread + 1 / n) * math.sqrt(n)) if spread > 0 else 0.0
    h = sum(-math.log(max(p, S.LEAST_P)) for p in (even, runs, serial))
    p = math.exp(-h) * (1 + h + h * h / 2)
    return alphabet, n, -math.log10(max(p, S.LEAST_P)), plain_evidence(core, symbols, k)


def plain_evidence(core, symbols, k):
    """Ordinary text as a chain over kinds of signs, letter by letter."""
    weight = [0.0] * 64
    for i, c in enumerate(symbols):
        weight[i if i < 64 else i - 2] += S.LETTERS.get(c.lower(), 1.0)
    at = lambda c: symbols.index(c) - 2 if symbols.index(c) > 63 else symbols.index(c)
    group = [S.group_of(c) for c in symbols[:64]]
    logs = []
    for style in S.STYLES:
        log, before = 0.0, ("start", "")
        for c in core:
            chances = {g: style[before[0]][g[0]] * ({"vowel": S.VOWEL_AFTER[before[1]], "consonant": 1 - S.VOWEL_AFTER[before[1]]}.get(g[1], 1.0))
                       for g in set(group)}
            own = group[at(c)]
            log += math.log(chances[own] / sum(chances.values()))
            log += math.log(weight[at(c)] / sum(w for w, g in zip(weight, group, strict=False) if g == own))
            before = own
        logs.append(log)
    text = math.log(sum(math.exp(v - max(logs)) for v in logs) / 2) + max(logs)
    return -len(core) * math.log(k) - text


def test_battery_equals_plain_python(spark):
    draw = random.Random(1)
    tokens = ["".join(draw.choice(s) for _ in range(n)) for _, _, s in S.ALPHABETS for n in (20, 33, 64, 200)]
    tokens += ["people_who_work_from_home", "THE/QUICK/BROWN/FOX/JUMPS", "a" * 25, "ab" * 15, "0" * 30, "Abc123-_+/Abc123-_+/==", "x" * 20 + "="]
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select(S.battery(F.col("t")).alias("b")).collect()
    for token, row in zip(tokens, got, strict=True):
        alphabet, n, level, evidence = plain_battery(token)
        assert (row.b.alphabet, row.b.n) == (alphabet, n)
        assert row.b.level / S.STEPS == pytest.approx(level, abs=0.02) and row.b.evidence == pytest.approx(evidence, abs=1e-6)


def plain_scan(text):
    def found(pattern, kind, keep=lambda m: True):
        return [(m.start(), kind, m.end(), m[0]) for m in re.finditer(pattern, text) if keep(m)]

    known = (found(S.ASSIGN, 0, lambda m: len(m[1]) >= S.ASSIGN_VALUE) + found(S.ACCESS, 1, lambda m: len(m[0]) >= S.ACCESS_LENGTH)
             + found(S.HEX, 2))
    tokens = [t for t in found(S.TOKEN, 3) if not any(k[0] < t[2] and t[0] < k[2] for k in known)]
    return sorted(known), tokens


@pytest.mark.parametrize("run", [1, 3, 256])
def test_spans_and_overlaps_equal_plain_python(spark, monkeypatch, run):
    monkeypatch.setattr(S, "RUN", run)
    draw = random.Random(run)
    bits = ["password: ", "é\n", " ", "AKIA" + "Z" * 18, "ab12" * 7, "Zz9+" * 6, "token=", "x" * 30, ".", "secret='", "q", "-_" * 12, "=="]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 60))) for _ in range(60)] + [""]
    body = F.col("text")
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(S.known_spans(body).alias("known"), S.spans(body, S.TOKEN, 3).alias("tokens"))
    got = df.select(F.sort_array("known").alias("known"), S.free_of(F.col("tokens"), F.col("known")).alias("free")).collect()
    for text, row in zip(texts, got, strict=True):
        known, free = plain_scan(text)
        assert [tuple(k) for k in row.known] == known and [tuple(t) for t in row.free] == free


def test_many_hits_in_one_text(spark):
    """Two hundred thousand hits take seconds: time grows with the hits, not with their square."""
    draw = random.Random(5)
    text = "\n".join(f"{draw.getrandbits(128):032x} " + "".join(draw.choice(BASE64) for _ in range(24)) for _ in range(100_000))
    start = time.time()
    row = S.scan(spark.createDataFrame([(text,)], "text string")).select(F.size("known").alias("k"), F.size("random").alias("r")).first()
    assert row.k == 100_000 and row.r > 80_000
    assert time.time() - start < 120


def names(draw, n):
    """Ordinary tokens with the letters and digits of base62: names in code, paths, versions."""
    words = ("people who work from home say they spend less time on travel and more with their own family than those in an office "
             "Config Http Xml Json Buffer Stream Reader Writer Manager Factory Service Client Server Request Response Error Cache Index").split()
    out = []
    while len(out) < n:
        token = "".join(w.title() if draw.random() < 0.8 else w for w in draw.sample(words, 5)) + (str(draw.randrange(100)) if draw.random() < 0.5 else "")
        if 20 <= len(token) <= 27:
            out.append(token)
    return out


@pytest.mark.parametrize("share, least", [(0.001, 0.9), (0.01, 0.95), (0.1, 0.95)])
def test_false_share_of_what_is_reported(spark, share, least):
    """Base62 keys of 24 letters among ordinary tokens: what is reported is keys, at any share of them, and doubling changes nothing."""
    draw = random.Random(int(share * 1000))
    n = 20_000
    keys = ["".join(draw.choice(BASE64[:62]) for _ in range(24)) for _ in range(int(n * share))]
    rows = [(i, t) for i, t in enumerate(names(draw, n) + keys)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    hits = {r.doc_id for r in S.scan(df).where(F.size("random") > 0).select("row.doc_id").collect()}
    true = sum(i >= n for i in hits)
    assert true >= least * len(keys) and len(hits) - true <= max(1, 0.02 * len(hits)), (true, len(hits), len(keys))
    twice = S.scan(df.union(df)).where(F.size("random") > 0).select("row.doc_id").distinct()
    assert {r.doc_id for r in twice.collect()} == hits
