"""Person layouts: results as of the other ways, and plans without an exchange."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.estimation.fit import ModelSpec, fit_models
from panelweave.operators.assemble import merge_person_tables
from panelweave.operators.panel import add_group_means
from panelweave.sources import layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def people(spark):
    keys = spark.range(900).select((F.col("id") % 150).alias("pid"), (2000 + F.floor(F.col("id") / 150)).cast("int").alias("syear"))
    a = keys.where("pid % 7 <> 0").withColumn("a", F.randn(1)).withColumn("text", F.concat(F.lit("t"), "pid"))
    b = keys.where("pid % 5 <> 0").withColumn("b", F.when(F.col("syear") > 2001, F.randn(2)))
    c = keys.withColumn("c", (F.col("pid") + F.col("syear")).cast("double"))
    none = spark.createDataFrame([(None, 2001, 1.0), (None, None, 2.0), (3, None, 3.0)], "pid long, syear int, c double")
    return [a, b, c.unionByName(none)]


@pytest.fixture
def laid(spark, people, tmp_path):
    paths = [str(tmp_path / n) for n in "abc"]
    for table, path, name in zip(people, paths, "abc", strict=True):
        layout.write_by_person(table, path, 6, name)
    return paths


@pytest.fixture
def stored(spark, laid, tmp_path):
    return layout.merge_by_person(spark, laid, str(tmp_path / "merged"))


def test_merge_without_an_exchange(spark, people, laid, stored, rows, monkeypatch):
    want = merge_person_tables(people)
    assert stored.columns == want.columns and rows(stored) == rows(want) and stored.count() == 903
    files = {r[0] for r in stored.select("_metadata.file_name").distinct().collect()}
    assert len(files) == 6  # a task for each bucket
    assert spark.conf.get(layout.BUCKETED) == "true"
    with monkeypatch.context() as patch:
        seen = []
        patch.setattr(layout, "write_by_person", lambda df, *_, exchange: seen.append((plan(df), exchange)))
        layout.merge_by_person(spark, laid, "unused")
    assert "Exchange" not in seen[0][0] and seen[0][0].count("Bucketed: true") == 3 and seen[0][1] is False


def test_merge_of_layouts_that_are_planned_otherwise(spark, people, laid, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(layout, "lies_by_person", lambda *_: False)
    assert rows(layout.merge_by_person(spark, laid, str(tmp_path / "m"))) == rows(merge_person_tables(people))


def test_means_without_an_exchange(spark, people, stored, rows):
    got = layout.add_person_means(stored, ["a", "c"])
    assert "Exchange" not in plan(got)
    want = add_group_means(merge_person_tables(people), ["a", "c"])
    tidy = [F.round(c, 9).alias(c) for c in ("a_mean", "c_mean")]
    assert rows(got.select("pid", "syear", "b", *tidy)) == rows(want.select("pid", "syear", "b", *tidy))


def test_other_sessions_open_a_layout(spark, laid, rows):
    other = spark.newSession()
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("layout_")]:
        spark.sql(f"DROP TABLE {name}")
    got = layout.read_by_person(other, laid[0])
    assert got.columns == ["pid", "syear", "a", "text"] and got.count() == rows(got).__len__() > 700
    assert "Exchange" not in plan(got.groupBy("pid").count())
    with pytest.raises(FileNotFoundError):
        layout.read_by_person(spark, laid[0] + "x")


def test_duplicate_keys_and_layouts_that_do_not_fit(spark, people, laid, tmp_path):
    twice = str(tmp_path / "twice")
    layout.write_by_person(people[1].union(people[1].limit(1)).withColumnRenamed("b", "d"), twice, 6, "twice")
    with pytest.raises(Exception, match="duplicate key in a person table"):
        layout.merge_by_person(spark, [laid[0], twice], str(tmp_path / "m1"))
    layout.write_by_person(people[1].withColumnRenamed("b", "e"), str(tmp_path / "five"), 5, "five")
    with pytest.raises(ValueError, match="buckets"):
        layout.merge_by_person(spark, [laid[0], str(tmp_path / "five")], "m")
    with pytest.raises(ValueError, match="same name"):
        layout.merge_by_person(spark, [laid[0], laid[0]], "m")
    layout.write_by_person(people[0], str(tmp_path / "again"), 6, "again")
    with pytest.raises(ValueError, match=r"\['a', 'text'\]"):
        layout.merge_by_person(spark, [laid[0], str(tmp_path / "again")], "m")
    with pytest.raises(Exception, match="non-empty"):
        layout.write_by_person(people[0], laid[0], 6, "a")


def test_fits_on_a_layout_exchange_no_rows(spark, stored, monkeypatch):
    merged = stored.where("pid IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL").withColumn(
        "y", (F.col("a") + F.col("b") + F.sin("c") > 0).cast("double"))
    specs = [ModelSpec("", "P", "probit", "y", ("a", "c")), ModelSpec("", "L", "logit", "y", ("c",))]
    written = []
    import panelweave.estimation.fit as fit

    staged = fit.staged
    monkeypatch.setattr(fit, "staged", lambda df, name: written.append(plan(df)) or staged(df, name))
    got = fit_models(merged, specs, by_cluster=True)
    assert "Exchange" not in written[0]
    for mine, other in zip(got, fit_models(merged, specs), strict=True):
        np.testing.assert_allclose(mine.beta, other.beta, rtol=1e-9)
        np.testing.assert_allclose(mine.cov, other.cov, rtol=1e-8)
        assert mine.clusters == other.clusters
