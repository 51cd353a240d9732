"""Documents without words in the mix."""

from panelweave.llm import mixing


def test_documents_without_words_stay(spark):
    rows = [(i, "one two three four five " * 20, "b") for i in range(30)] + [(100, "", "b"), (101, None, "b"), (102, " \n ", "c"), (103, "few words", "a")]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), name="wordless").collect()
    assert {(r.doc_id, r.text) for r in got if 100 <= r.doc_id < 103} == {(100, ""), (101, None), (102, " \n ")}
    rows = [(i, "a b c d e " * 10, "a") for i in range(30)] + [(i, "a b c d e " * 10, "c") for i in range(30, 230)] + [(300, " ", "c")]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), name="wordless").collect()
    assert sum(r.doc_id == 300 for r in got) >= 1
