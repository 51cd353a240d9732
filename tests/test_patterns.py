"""Panel structure from wave patterns, against the aggregations by person."""

import random

import pytest

from panelweave.operators import describe, panel


def people(spark, seed, years):
    draw = random.Random(seed)
    rows = [(p if p else None, y) for p in range(60) for y in years if draw.random() < 0.5]
    rows += [(3, None), (7, years[0]), (7, years[0])]  # a row without a year, and a year twice
    return spark.createDataFrame(rows, "pid long, syear int")


@pytest.mark.parametrize("years", [range(2009, 2015), range(1984, 2023), [1, 62, 63, 64, 130], [5]])
def test_patterns_give_what_persons_give(spark, rows, years):
    df, waves = people(spark, 1, list(years)), people(spark, 2, list(years))
    patterns, possible = panel.wave_patterns(df), panel.wave_patterns(waves)
    assert rows(panel.pattern_size(patterns, possible)) == rows(panel.panel_size(df, waves))
    assert rows(panel.pattern_histogram(patterns)) == rows(panel.wave_histogram(df))
    assert rows(panel.pattern_years(patterns)) == rows(describe.distinct_years(df))
    size, seen = panel.pattern_size(patterns).first(), describe.distinct_people(df).first()
    assert (size.observations, size.individuals) == tuple(seen)
    assert patterns.count() <= 60


def test_patterns_as_text(spark, rows):
    df = spark.createDataFrame([(1, 2010), (1, 2012), (2, 2010), (2, 2012), (3, 2011), (None, 2013)], "pid long, syear int")
    assert rows(panel.participation(panel.wave_patterns(df))) == [("0100", 1), ("1010", 2)]


def test_no_rows(spark, rows):
    none = spark.createDataFrame([], "pid long, syear int")
    patterns = panel.wave_patterns(none)
    assert rows(panel.pattern_size(patterns)) == rows(panel.panel_size(none, none))
    assert rows(panel.pattern_histogram(patterns)) == rows(panel.pattern_years(patterns)) == rows(panel.participation(patterns)) == []


def test_one_shuffle_of_persons(spark):
    """Persons are exchanged once and patterns once."""
    plan = panel.wave_patterns(people(spark, 1, [1, 2, 3]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("partial_bit_or") == 1
