"""URL lists against plain Python, odd URLs, and digests that collide."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelweave.llm import queries, url_filter

URLS = [
    (1, None), (2, ""), (3, "no scheme/at/all"), (4, "http://"), (5, "http://ORG"), (6, "http://org/"), (7, "HTTP://Example.ORG/en/12?x=/es/"),
    (8, "http://a.b.example.org/es/"), (9, "http://example.org/es"), (10, "http://notexample.org/es/"), (11, "ftp://x.com/de/1#f"),
    (12, "http://com/fr/"), (13, "http://spam-farm.net/a?b://c"), (14, "http://www.spam-farm.net"), (15, "http://spam-farm.net."),
    (16, "http://nospam.net/"), (17, "x\ny://É.Example.org/en/1\n2"), (18, "http://example.org?/en/1"), (19, "http://u:p@example.org:80/en/1"),
    (20, "a://b://example.org/"), (1, "http://org/" + "z" * 300_000), (None, "http://.com/fr/"), (21, "http://org/"), (21, "http://org/"),
]


def plain(url, rules, sites):
    """Host, path, rule and verdict of one URL by reading the rules from end to end."""
    _, there, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    under = lambda h: host == h or host.endswith("." + h)
    fits = [r for r in rules if there and under(r.partition("/")[0]) and ("/" not in r or path.startswith(r[r.index("/"):]))]
    rule = max(fits, key=lambda r: (len(r), len(r.partition("/")[0])), default=None)
    return host, path, rule, rules[rule] if rule else "block" if any(under(s) for s in sites) else "allow"


def test_judge_equals_plain_python_on_odd_urls(spark):
    pages = spark.createDataFrame([(i, u, "c") for i, u in URLS], "page_id long, url string, host string").repartition(3)
    listed = spark.createDataFrame([("spam-farm.net",), (None,), ("spam-farm.net",), ("example.org/en/1",)], "entry string")
    judged = url_filter.judge(pages, queries.RULES, listed)
    got = sorted(((r.row.page_id, r.row.url, r.row.host, r.host, r.path, r.rule, r.verdict) for r in judged.collect()), key=repr)
    want = sorted(((i, u, "c", *plain(u, queries.RULES, ["spam-farm.net"])) for i, u in URLS), key=repr)
    assert got == want and len(got) == len(URLS)
    assert {r[-1] for r in got} == {"allow", "block"}


def test_match_finds_every_entry_of_a_long_list(spark, monkeypatch):
    draw = random.Random(3)
    labels = ["a", "b", "c", "dd", "é"]
    host = lambda: ".".join(draw.choice(labels) for _ in range(draw.randint(1, 3)))
    path = lambda: "".join(draw.choice("/xy") for _ in range(draw.randint(0, 4)))
    entries = sorted({host() + draw.choice(["", "/" + path()]) for _ in range(400)})
    urls = [(i, f"http://{host()}{draw.choice(['', '/' + path()])}") for i in range(300)]
    monkeypatch.setattr(url_filter, "SEGMENT", 16)
    array = url_filter.digest_array(spark.createDataFrame([(e, i) for i, e in enumerate(entries)], "entry string, number long"))
    got = {r.row.page_id: sorted((f.entry, f.number) for f in r.fits)
           for r in url_filter.match(spark.createDataFrame(urls, "page_id long, url string"), array).collect()}
    for i, url in urls:
        want = [(e, n) for n, e in enumerate(entries) if plain(url, {e: "block"}, [])[2] == e]
        assert got[i] == sorted(want), url
    assert sum(map(len, got.values())) > 300


def test_longest_prefers_the_longer_host_among_equals(spark):
    pages = spark.createDataFrame([(1, "http://b.aa/ccc")], "page_id long, url string")
    rows = url_filter.judge(pages, {"b.aa/c": "allow", "aa/ccc": "block"}, spark.createDataFrame([], "entry string")).collect()
    assert [(r.rule, r.verdict) for r in rows] == [("b.aa/c", "allow")]


def test_colliding_digests_are_told_apart_by_the_stored_text():
    keys = ["x.org", "y.org", "z.org", "w.org"]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([keys]), pa.array([[7, 7, 7, 9]], pa.list_(pa.int64()))], ["k", "keys", "digests"])
    body = np.frombuffer(b"v.orgy.orgz.org", dtype=np.uint8)

    class Held(url_filter.DigestArray):
        def segments(self):
            return [(np.array([7, 7, 7]), np.array([10, 11, 12]), np.array([0, 5, 10, 15]), body)]

    (out,) = url_filter._probe(Held([], [0]))(iter([batch]))
    assert out.column("fits").to_pylist() == [[{"entry": "y.org", "number": 11}, {"entry": "z.org", "number": 12}]]


@pytest.mark.parametrize("urls", [[], [(1, "http://a.org/b")]])
def test_empty_tables_and_lists(spark, urls):
    pages = spark.createDataFrame(urls, "page_id long, url string")
    array = url_filter.digest_array(spark.createDataFrame([], "entry string, number long"))
    assert [r.fits for r in url_filter.match(pages, array).collect()] == [[] for _ in urls]
    assert queries.blocked_sites(pages).count() == 0


def test_blocked_sites_start_at_the_label_with_the_word(spark):
    urls = ["http://www.free-bets.example.com/x", "http://adult-x.net", "http://loads.net", "http://spam.de/", "http://bets", "http://a.b-casino.c.fr"]
    found = queries.blocked_sites(spark.createDataFrame([(u,) for u in urls], "url string")).orderBy(F.col("entry")).collect()
    assert [r.entry for r in found] == ["adult-x.net", "b-casino.c.fr", "free-bets.example.com", "spam.de"]
