"""Merging, joining and skew handling."""

import pytest
from pyspark.sql import functions as F

from panelweave.operators import assemble, panel, skew


def people(spark):
    a = spark.createDataFrame([(1, 2000, 10, 1.0), (2, 2000, None, 2.0)], "pid long, syear int, hid long, a double")
    b = spark.createDataFrame([(1, 2000, 5.0), (3, 2001, 6.0)], "pid long, syear int, b double")
    return a, b


def test_full_outer(spark, rows):
    want = [(1, 2000, 10, 1.0, 5.0), (2, 2000, None, 2.0, None), (3, 2001, None, None, 6.0)]
    for unique in (True, False):
        merged = assemble.merge_person_tables(list(people(spark)), unique_keys=unique)
        assert rows(merged, "pid", "syear", "hid", "a", "b") == want


def test_duplicate_key_fails(spark):
    a, b = people(spark)
    merged = assemble.merge_person_tables([a, b.union(b)])
    with pytest.raises(Exception, match="duplicate key"):
        merged.select("syear").collect()
    multiplied = assemble.merge_person_tables([a, b.union(b)], unique_keys=False)
    assert multiplied.count() == 5


def test_same_column_twice_is_refused(spark):
    a, _ = people(spark)
    with pytest.raises(ValueError, match="more than one table"):
        assemble.merge_person_tables([a, a])


def test_year_filter_reaches_the_scans(spark, tmp_path):
    for name, df in zip("ab", people(spark)):
        df.write.parquet(str(tmp_path / name))
    merged = assemble.merge_person_tables([spark.read.parquet(str(tmp_path / n)) for n in "ab"])
    plan = merged.filter("syear = 2000")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(syear,2000)") >= 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_household_join(spark, rows):
    a, _ = people(spark)
    homes = spark.createDataFrame([(10, 2000, 90.0), (None, 2000, 50.0), (11, 2000, 70.0)], "hid long, syear int, m double")
    joined = assemble.add_household_tables(a, [homes])
    assert rows(joined, "pid", "hid", "m") == [(1, 10, 90.0), (2, None, None)]
    assert assemble.add_household_tables(a, []) is a
    twice = assemble.add_household_tables(a, [homes.union(homes)])
    with pytest.raises(Exception, match="duplicate key"):
        twice.collect()


def test_hot_keys_are_spread(spark, rows):
    """A third of all rows share one key; the result is that of a plain join."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(
        spark.createDataFrame([(7, 70)], "k long, w long")
    )
    plain = left.join(right, "k", "left").select("k", "v", "w")
    salted = skew.salted_left_join(left, right, ["k"], ["k", "v"], split=25)
    assert rows(salted) == rows(plain)
    # 2,800 rows with a key, of which 1,001 have this one
    assert rows(skew.hot_keys(left, "k", 25)) == [(7, 9)]


def test_no_hot_key_is_left_out(spark, rows):
    """Far more hot keys than a short list would hold; all are found at the default share of a small cluster."""
    left = spark.range(900_000).select(
        F.when(F.col("id") < 800_000, F.pmod("id", F.lit(8000))).otherwise(F.col("id")).alias("k"))
    hot = skew.hot_keys(left, "k", 12_000)
    assert set(rows(hot)) == {(k, 2) for k in range(8000)}


def test_hot_household(spark, rows):
    """A household with a third of all person-years, and many people without one."""
    people = spark.range(2000).select(
        F.col("id").alias("pid"), (2000 + F.col("id") % 3).cast("int").alias("syear"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("hid"),
    )
    homes = spark.range(0, 2000, 5).union(spark.createDataFrame([(7,)], "id long")).select(
        F.col("id").alias("hid"), F.explode(F.array(*map(F.lit, (2000, 2001, 2002)))).alias("syear")
    ).withColumn("m", F.col("hid") * 10 + F.col("syear"))
    got = assemble.add_household_tables(people, [homes], split=20)
    want = people.join(homes, ["hid", "syear"], "left").select(*got.columns)
    assert rows(got) == rows(want)


def test_join_reads_wanted_columns_only(spark, tmp_path):
    a, b = people(spark)
    homes = spark.createDataFrame([(10, 2000, 90.0)], "hid long, syear int, m double")
    for name, df in (("a", a), ("b", b), ("h", homes)):
        df.write.parquet(str(tmp_path / name))
    read = [spark.read.parquet(str(tmp_path / n)) for n in "abh"]
    panel_ = assemble.add_household_tables(assemble.merge_person_tables(read[:2]), read[2:])
    plan = panel_.groupBy("syear").agg(F.sum("m"))._jdf.queryExecution().executedPlan().toString()
    assert "a:double" not in plan and "b:double" not in plan and "m:double" in plan


def test_hot_group_means(spark, rows):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("pid"),
        F.col("id").alias("syear"), (F.col("id") * 1.0).alias("x"),
    )
    got = panel.add_group_means(df, ["x"], split=20)
    want = df.selectExpr("pid", "syear", "x", "avg(x) over (partition by pid) as x_mean")
    assert rows(got) == rows(want)


def test_dimension_join(spark, rows):
    names = spark.createDataFrame([("A",), ("B",)], "name string")
    stats = spark.createDataFrame([("B", 3.0), ("C", 4.0)], "state string, share double")
    assert rows(assemble.attach_dimension(names, stats, "name", "state"), "name", "share") == [("B", 3.0)]
