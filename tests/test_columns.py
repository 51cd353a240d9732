"""Cleaning and deriving expressions on their edge cases."""

import math

from pyspark.sql import functions as F

from panelweave.functions import columns as C
from panelweave.operators import derive
from panelweave.registry import Registry


def values(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def frame(spark, items, kind):
    return spark.createDataFrame(list(enumerate(items)), f"i int, c {kind}")


def test_numeric(spark):
    texts = ["5d", " 12 ", "abc", "1e3", "nan", "", None, "inf", "-.5", "+7.", "1 2"]
    got = values(frame(spark, texts, "string"), C.numeric("c"))
    assert got == [None, 12.0, None, 1000.0, None, None, None, None, -0.5, 7.0, None]


def test_missing_codes(spark):
    items = [-8.0, -7.0, -6.0, -5.0, -4.0, -3.0, -2.0, -1.0, 0.0, -9.0, -1.5, None]
    assert values(frame(spark, items, "double"), C.without_codes("c")) == [None] * 8 + [0.0, -9.0, -1.5, None]
    assert values(frame(spark, ["-1", "-1.0", "-1.5", "x"], "string"), C.clean("c")) == [None, None, -1.5, None]


def test_nan_becomes_null(spark):
    df = frame(spark, [math.nan, 1.0, None, -3.0], "double")
    assert values(df, C.clean("c", text=False)) == [None, 1.0, None, None]


def test_identifier(spark):
    texts = ["12", "12.0", "-2", "", None, "x", "9007199254740993"]
    assert values(frame(spark, texts, "string"), C.identifier("c")) == [12, 12, None, None, None, None, 9007199254740993]
    assert values(frame(spark, [7, -1, None], "long"), C.identifier("c")) == [7, None, None]


def test_recode_is_simultaneous(spark):
    df = frame(spark, [1.0, 2.0, 3.0, None], "double")
    assert values(df, C.recode(F.col("c"), {1: 0, 2: 1})) == [0.0, 1.0, 3.0, None]
    assert values(df, C.recode(F.col("c"), {1: 2, 2: 1, 3: None})) == [2.0, 1.0, None, None]
    assert values(df, C.recode(F.col("c"), {1: 0}, "null")) == [0.0, None, None, None]
    assert values(df, C.recode(F.col("c"), {})) == [1.0, 2.0, 3.0, None]


def test_recode_columns_skips_absent(spark):
    df = frame(spark, [1.0], "double")
    assert derive.recode_columns(df, {"not_there": {1: 2}}).columns == ["i", "c"]


def test_first_version(spark):
    df = spark.createDataFrame(
        [(0, 1.0, None), (1, None, 2.0), (2, 2.0, 1.0), (3, None, None), (4, 5.0, 1.0)], "i int, a double, b double"
    )
    mapping = {1: 1, 2: 0}
    both = C.first_version([(F.col("a"), mapping), (F.col("b"), mapping)])
    assert values(df, both) == [1.0, 0.0, 0.0, None, 1.0]
    assert values(df, C.first_version([(F.col("a"), None), (F.col("b"), mapping)])) == [1.0, 0.0, 2.0, None, 5.0]
    assert values(df, C.first_version([])) == [None] * 5


def test_sector(spark):
    df = spark.createDataFrame(
        [(0, 1.0, None), (1, None, 1.0), (2, 45.0, 84.0), (3, 1.7, None), (4, 3.0, None), (5, 3.0, 62.0), (6, 55.0, 1.0)],
        "i int, pgnace double, pgnace2 double",
    )
    sectors = Registry.default().sectors
    got = derive.add_sector(df, sectors)
    assert got.columns == ["i", "sector"]
    assert values(got, "sector") == [1, 1, 5, None, None, 8, 6]
    only = derive.add_sector(df.drop("pgnace"), sectors)
    assert values(only, "sector") == [None, 1, 11, None, None, 8, 1]


def test_ratio_log_flags(spark):
    df = spark.createDataFrame([(0, 80.0, 0.0), (1, 80.0, -2.0), (2, 80.0, 2.0), (3, 80.0, None)], "i int, a double, b double")
    assert values(df, C.ratio(F.col("a"), F.col("b"))) == [None, None, 40.0, None]
    money = frame(spark, [-5.0, 0.0, 0.5, 1.0, None, math.e], "double")
    assert values(money, C.log_floored(F.col("c"))) == [0.0, 0.0, 0.0, 0.0, None, 1.0]
    assert values(money, C.flag(F.col("c") > 0)) == [0.0, 0.0, 1.0, 1.0, None, 1.0]
    assert values(money, C.flag(F.col("c") > 0, null_as_zero=True)) == [0.0, 0.0, 1.0, 1.0, 0.0, 1.0]


def test_migration_flags(spark):
    got = derive.migration_flags(spark.createDataFrame([(2.0,), (3.0,), (1.0,), (None,)], "migback double"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0), (0, 0), (0, 1), (1, 0)]


def test_dummies(spark):
    got = derive.treatment_dummies(frame(spark, [3.0, 1.0, 2.0, None], "double"), "c")
    assert got.columns == ["i", "c", "c_2", "c_3"]
    assert values(got, F.struct("c_2", "c_3")) == [(0.0, 1.0), (0.0, 0.0), (1.0, 0.0), (None, None)]
    many = derive.treatment_dummies(spark.range(600).select((F.col("id") * 1.0).alias("c")), "c")
    assert len(many.columns) == 600 and many.agg(F.sum("c_599")).first()[0] == 1.0


def test_text_formats(spark):
    shares = frame(spark, [0.005, 0.025, 0.015, 0.355, 1.0], "double")
    # ties go to the even number
    assert values(shares, C.percent_text(F.col("c"))) == ["0%", "2%", "2%", f"{35.5:.0f}%", "100%"]
    numbers = [0.125, 0.375, 50087.025, -0.0004, 1e6]
    assert values(frame(spark, numbers, "double"), C.fixed(F.col("c"), 2)) == [f"{x:.2f}" for x in numbers]
    assert values(frame(spark, [0.0099, 0.01, 0.05, 0.1, 0.0999], "double"), C.stars(F.col("c"))) == ["***", "**", "*", "", "*"]


def test_labels(spark):
    df = frame(spark, [1.0, 9.0, None], "double")
    assert values(df, C.label_of(F.col("c"), {1: "one", 2: "two"})) == ["one", None, None]
    names = frame(spark, ["x", "y"], "string")
    assert values(names, C.label_text(F.col("c"), {"x": "X"})) == ["X", "y"]


def test_any_code(spark):
    """Codes of any size and sign."""
    codes = frame(spark, [250_000.0, -20.0, 7.0, 7.5, 0.0, None], "double")
    assert values(codes, C.category_of("c", [(1, (250_000, 7)), (2, (-20,))])) == [1, 2, 1, None, None, None]
    assert values(codes, C.category_of("c", [])) == [None] * 6


def test_sectors():
    sectors = Registry.default().sectors
    for codes in ([c for s in sectors for c in s.rev1], [c for s in sectors for c in s.rev2]):
        assert len(codes) == len(set(codes))
