"""Quoted CSV in splits: equal to reading the file from end to end, wherever splits end."""

import csv
import io
import random

import pytest

from panelweave.sources import codebook as codebook_files
from panelweave.sources.records import quoted_records


def wild_file(seed, rows=400):
    draw = random.Random(seed)
    field = lambda: "".join(draw.choice(['a', 'é', ' ', ',', '"', '""', "\n", "\n\n", "\r\n", "x" * 40]) for _ in range(draw.randint(0, 9)))
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=draw.choice(["\n", "\r\n"]), quoting=csv.QUOTE_ALL)
    table = [[field() for _ in range(7)] for _ in range(rows)]
    writer.writerows(table)
    return table, out.getvalue()


@pytest.fixture
def splits(spark):
    """Files are read in splits of so many bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
              if spark.conf.get(k, None)}

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield of
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)


@pytest.mark.parametrize("size", [37, 300, 5000, 1 << 27])
def test_records_are_those_of_one_reader(spark, tmp_path, splits, size):
    splits(size)
    want = {}
    for seed in (1, 2):
        table, text = wild_file(seed, 40 if size == 37 else 400)
        (tmp_path / f"f{seed}_values.csv").write_text(text, newline="")
        want[f"f{seed}"] = table
    book = codebook_files.read_values(spark, str(tmp_path)).orderBy("position").collect()
    for source, table in want.items():
        got = [[r[f] for f in codebook_files.VALUE_FIELDS] for r in book if r.source == source]
        assert got == table
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert (lines.rdd.getNumPartitions() > 5) == (size < 10_000)


@pytest.mark.parametrize("size", [5, 64, 1000])
def test_quotes_that_are_never_closed_and_odd_ends(spark, tmp_path, splits, size):
    splits(size)
    (tmp_path / "x.csv").write_text('a,b\n\n\n"one\n' + "long line\n" * 30 + 'two",c\r\nlast,"open\nto the end\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "line feeds.csv").write_text("\n\n")
    got = quoted_records(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.text for r in got] == ["a,b", '"one\n' + "long line\n" * 30 + 'two",c', 'last,"open\nto the end']


def test_one_field_over_all_splits(spark, tmp_path, splits):
    splits(100)
    (tmp_path / "l_variables.csv").write_text('s,d,1,v,"' + "z\n" * 5000 + '",x\ns,d,1,w,l,y\n')
    rows = codebook_files.read_variables(spark, str(tmp_path)).orderBy("position").collect()
    assert [(r.source, r.variable, r.label, r.label_de) for r in rows] == [("l", "v", "z\n" * 5000, "x"), ("l", "w", "l", "y")]


def test_names_of_files(spark, tmp_path):
    (tmp_path / "a+b %c_values.csv").write_text("s,d,1,v,2,l,m\n")
    assert [r.source for r in codebook_files.read_values(spark, str(tmp_path)).collect()] == ["a+b %c"]


def test_records_over_many_batches(spark, tmp_path, splits):
    splits(1000)
    table, text = wild_file(3, 200)
    (tmp_path / "f_values.csv").write_text(text, newline="")
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(name, 3)
    try:
        book = codebook_files.read_values(spark, str(tmp_path)).orderBy("position").collect()
    finally:
        spark.conf.set(name, before)
    assert [[r[f] for f in codebook_files.VALUE_FIELDS] for r in book] == table


@pytest.fixture
def plan(spark, tmp_path):
    """The plan of a filter on scanned values."""
    (tmp_path / "f_values.csv").write_text('s,d,1,v,2,"l\nl",m\ns,d,1,w,2\ns,d,1,v,3,n\n')
    found = codebook_files.read_values(spark, str(tmp_path)).where("lower(variable) = 'v'")
    assert [(r.value, r.label, r.label_de) for r in found.orderBy("position").collect()] == [("2", "l\nl", "m"), ("3", "n", "")]
    return found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_record_is_parsed_once(plan):
    assert plan.count("from_csv(") == 1


def test_files_go_through_the_kernel_twice_at_most_and_carry_no_paths(plan):
    kernels = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert 1 <= len(kernels) <= 2
    assert all("file" not in line for line in kernels)
