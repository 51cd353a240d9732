import pytest

SF = "/root/testdata/sf0.001"
LONG = "Alpha beta gamma delta epsilon zeta eta theta iota kappa " * 6000
NEAR = " ".join(f"word{i}" for i in range(120))
CLASHES = ("row", "key", "text_hash", "place", "size", "fp", "shard", "slot", "number", "key_", "label", "score", "dropped", "k_", "tie_")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows and keys, columns named like ours."""
    rows = [
        (1, "One two three four five six seven eight nine ten eleven", "en", "a", 55),
        (1, "One two three four five six seven eight nine ten eleven", "en", "a", 55),
        (1, "Another text under the same key with quite a few words in it", "en", "b", None),
        (None, "A text without a key but with more than five words", "fr", "a", 3),
        (None, None, None, None, None),
        (2, None, "de", "c", 0), (3, "", "en", "a", 0), (4, " \t\n ", "en", None, 4), (5, "!!! ... ###", "en", "a", 11),
        (6, "two words", None, "b", 9), (7, LONG, "en", "a", len(LONG)), (8, LONG, "en", "a", len(LONG)),
        (9, NEAR, "en", "b", 1), (10, NEAR.replace("word60", "other"), "en", "b", 1), (11, "Été où ça même naïve élève forêt", "fr", "d", 1),
    ]
    wide = [(*r, *([f"x{i}"] * len(CLASHES))) for i, r in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(wide, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 0), (None, 1, 0), (9, None, 0), (7, 1, 0), (99, 0, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, "one TWO three, four five six seven eight nine ten"), (1, "word3 word4 word5 word6 word7 word8 word9"),
                                  (2, None), (3, ""), (4, "only four words here"), (None, " ".join(f"word{i}" for i in range(20, 50)))],
                                 "item_id long, text string")
