"""Documents that are an item of the benchmark with words missing."""

from collections import Counter

import pytest

from panelweave.llm import decontaminate
from tests.llm import brute


def test_documents_shorter_than_the_item(spark):
    item = [f"word{i}" for i in range(59)]
    other = [f"term{i}" for i in range(40)]
    items = [(1, " ".join(item)), (2, " ".join(other)), (3, " ".join([*item, "more", "words"]))]
    docs = [(i, " ".join(item[i // 2:59 - (i + 1) // 2])) for i in range(20)]
    docs += [(100, " ".join(other[3:])), (101, " ".join(["ahead", *item[2:]])), (102, "word1 word2 word3"), (103, " ".join(item[:30] + item[31:]))]
    docs += [(104, " ".join([*other, *item[4:], *other]))]
    want = {}
    for (i, text), (j, passage) in ((d, x) for d in docs for x in items):
        own, need = brute.shingles(text), brute.shingles(passage)
        size = min(len(own), len(need))
        for start in range(len(own) - size + 1):
            both = sum((Counter(own[start:start + size]) & Counter(need)).values())
            if (similarity := both / (size + len(need) - both)) >= 0.8 - 1e-12:
                want[i, j] = max(want.get((i, j), 0), similarity)
    rows = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), name="short").collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in rows} == pytest.approx(want)
    short = {(r.doc_id, r.item_id): r for r in rows}
    assert (short[2, 1].n_words, short[2, 1].first_word, short[2, 1].n_windows) == (57, 0, 1)
    assert len(want) > 20 and (104, 3) in want
