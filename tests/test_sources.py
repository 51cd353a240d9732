"""Files in, tables out, and codebooks."""

import json

import pytest
from pyspark.sql import functions as F

from panelweave.operators import codebook
from panelweave.plans.master import build_master
from panelweave.registry import Registry
from panelweave.sources import codebook as codebook_files
from panelweave.sources import tables, versions

FILES = {
    "ppathl": "PID,syear,hid,gebjahr,sex,partner,migback,extra\n1,2010,100,1970,1,1,1,x\n2,2010,-2,1980,2,0,2,y\n"
              "3,2010,100,1990,2,-1,3,z\n1,2008,100,1970,1,1,1,x\n",
    "pl": "pid,syear,plb0097,plb0095_v1,plb0193_v1,PLB0193_V2,plh0173\n1,2010,1,2,2,-5,7\n2,2010,2,1,-5,1,abc\n"
          "3,2010,3,2,9,1,-1\n4,2010,1,1,1,1,5\n",
    "pgen": "pid,syear,pgisced97,pglfs,pgemplst,pgnace,pgnace2\n1,2010,3,11,1,45,-8\n2,2010,4,11,1,-8,62\n"
            "3,2010,5,11,2,1,1\n1,2008,3,11,1,45,-8\n",
    "pequiv": "pid,syear,d11106,d11107,i11102,l11101,e11101\n1,2010,2,1,50000,2,2000\n2,2010,0,0,1e4,16,1800\n",
    "hl": "hid,syear,hlf0019_h\n100,2010,90\n101,2010,-1\n",
}


@pytest.fixture
def survey(tmp_path):
    for name, text in FILES.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return Registry.default(survey_dir=str(tmp_path), key_files={}), str(tmp_path / "tables")


def test_required_columns():
    registry = Registry.default()
    raw = registry.raw_columns()
    assert set(raw) == {"ppathl", "pl", "pgen", "pequiv", "hl"}
    assert raw["pl"] == {"plb0097", "plb0095_v1", "plh0173", "plb0193_v1", "plb0193_v2"}
    assert raw["hl"] == {"hlf0019_h"}
    assert registry.stored_columns("pl") == {"pid", "syear", "plb0097", "plb0095_v1", "plh0173", "plb0193_h"}
    assert registry.entity_key("hl") == "hid" and registry.entity_key("pequiv") == "pid"
    labels = registry.labels()
    assert labels["sqm_per_head"] == "Living space pp." and labels["plb0193_h"] == "Works overtime"
    assert labels["syear"] == "Survey Year"
    assert registry.period_label("--") == "2009--2014"
    assert Registry.default(survey_dir="/d").csv_path("pl") == "/d/pl.csv"
    assert Registry.default(survey_dir="/d").csv_path("other") == "/d/other.csv"


def test_extract(spark, survey, rows):
    registry, _ = survey
    pl = tables.extract(spark, registry, "pl")
    assert set(pl.columns) == registry.stored_columns("pl")
    got = rows(pl, "pid", "plb0097", "plb0193_h", "plh0173")
    # version 1 code 9 is outside its mapping, so version 2 answers
    assert got == [(1, 1.0, 0.0, 7.0), (2, 2.0, 1.0, None), (3, 3.0, 1.0, None), (4, 1.0, 1.0, 5.0)]
    person = tables.extract(spark, registry, "ppathl")
    assert "extra" not in person.columns
    assert rows(person.filter("pid = 2"), "hid") == [(None,)]
    assert dict(person.dtypes)["hid"] == "bigint" and dict(person.dtypes)["syear"] == "int"


def test_scan_reads_wanted_columns_only(spark, survey):
    registry, _ = survey
    scan = tables.scan_csv(spark, registry.csv_path("ppathl"), ["pid", "syear", "SEX", "not_there"])
    assert scan.columns == ["pid", "syear", "sex"]
    assert "gebjahr" not in scan._jdf.queryExecution().executedPlan().toString()


def test_refresh(spark, survey):
    registry, folder = survey
    assert sorted(tables.refresh(spark, registry, folder)) == ["hl", "pequiv", "pgen", "pl", "ppathl"]
    assert tables.refresh(spark, registry, folder) == []
    path = tables.table_path(folder, "pl")
    tables.write_version(versions.read(spark, path).drop("plh0173"), path)
    assert tables.refresh(spark, registry, folder, "missing") == []
    assert tables.refresh(spark, registry, folder, "stale") == ["pl"]
    assert len(tables.refresh(spark, registry, folder, "force")) == 5
    with pytest.raises(ValueError):
        tables.refresh(spark, registry, folder, "sometimes")


def test_load(spark, survey):
    registry, folder = survey
    with pytest.raises(FileNotFoundError):
        tables.load(spark, registry, folder)
    tables.refresh(spark, registry, folder)
    person, household = tables.load(spark, registry, folder)
    assert [d.columns[:2] for d in person] == [["pid", "syear"]] * 4
    assert [d.columns for d in household] == [["hid", "syear", "hlf0019_h"]]


def test_master_from_files(spark, survey, rows):
    registry, folder = survey
    master = build_master(spark, registry, folder)
    got = rows(master, "pid", "syear", "hid", "sex", "plb0097", "age", "sqm_per_head", "sector")
    assert got == [(1, 2010, 100, 0.0, 1.0, 40.0, 45.0, 5), (2, 2010, None, 1.0, 0.0, 30.0, None, 8)]
    stored = tables.load_master(spark, f"{folder}/master.parquet")
    assert stored.schema["age"].metadata["comment"] == "Age"
    assert "syear=2010" in stored.select(F.input_file_name()).first()[0]
    views = tables.export_views(master)
    assert {k: v.count() for k, v in views.items()} == {"full": 2, "complete": 1, "eligible": 1}
    with pytest.raises(FileNotFoundError):
        tables.load_master(spark, f"{folder}/nothing")


def test_read_variable(spark, survey, rows):
    registry, _ = survey
    got = tables.read_variable(spark, registry.csv_path("pl"), "PLH0173")
    assert rows(got, "pid", "plh0173") == [(1, 7.0), (2, None), (3, None), (4, 5.0)]
    assert tables.read_variable(spark, registry.csv_path("pl"), "nope").columns == ["pid", "syear"]
    homes = tables.read_variable(spark, registry.csv_path("hl"), "hlf0019_h", key="hid")
    assert homes.columns == ["hid", "syear", "hlf0019_h"]


def test_keys_written_as_decimals(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_text('PID,Syear,Other,V\n12.0,2010.0,"a ""b"", c",1\nx,2011,,-1\n7,,z,2.5\n')
    got = tables.read_variable(spark, str(tmp_path / "x.csv"), "v")
    assert got.dtypes == [("pid", "bigint"), ("syear", "int"), ("v", "double")]
    assert rows(got) == [(12, 2010, 1.0), (7, None, 2.5), (None, 2011, None)]
    text = tables.scan_csv(spark, str(tmp_path / "x.csv"), ["other"])
    assert rows(text) == [('a "b", c',), ("z",), (None,)]


def test_views_and_labels_as_tables(spark, survey, tmp_path, rows):
    registry, folder = survey
    master = build_master(spark, registry, folder)
    views = tables.save_views(master, str(tmp_path / "views"))
    assert {k: v.count() for k, v in views.items()} == {"full": 2, "complete": 1, "eligible": 1}
    assert views["full"].columns == master.columns and (tmp_path / "views" / "full.parquet").exists()
    labels = dict(rows(tables.label_table(spark, registry)))
    assert labels["syear"] == "Survey Year" and labels == registry.labels()


def test_config_without_folder(tmp_path):
    path = tmp_path / "study.json"
    path.write_text(json.dumps({"data": {"files_dir": "/x"}, "variables": {}}))
    with pytest.raises(KeyError, match="survey_dir"):
        Registry.from_json(str(path))
    assert Registry.from_json(str(path), folder_key="files_dir").survey_dir == "/x"


def test_registry_from_json(tmp_path):
    doc = {
        "data": {"survey_dir": "/data", "key_files": {"pl": "people.csv"}},
        "study": {"study_years": [2001, 2003]},
        "panels": [{"key": "p", "label": "Panel"}],
        "variables": {"p": [{"name": "Pid", "dataset": "pl", "label": "Person", "type": "id"},
                            {"name": "h", "dataset": "pl", "label": "H"}]},
        "harmonize": [{"name": "h", "dataset": "pl", "label": "H2", "sources": [
            {"variable": "h1", "recode": {"1": 1, "2": 0}}, {"variable": "h2"}]}],
        "derived": [{"name": "d", "label": "D", "source_vars": [{"name": "src", "dataset": "pl"}]}],
        "nace_sectors": [{"id": 1, "label": "A", "nace_rev1": [1], "nace_rev2": [2]}],
    }
    path = tmp_path / "study.json"
    path.write_text(json.dumps(doc))
    registry = Registry.from_json(str(path))
    assert registry.raw_columns() == {"pl": {"pid", "h1", "h2", "src"}}
    assert registry.harmonised[0].sources == (("h1", {1: 1, 2: 0}), ("h2", None))
    assert registry.csv_path("pl") == "/data/people.csv"
    assert registry.period_label() == "2001–2003"
    assert registry.labels() == {"syear": "Survey Year", "pid": "Person", "h": "H2", "d": "D"}


VARIABLES = """study,dataset,version,variable,label,label_de
s,pl,1,plb0097,"Home office, wish",Wunsch
s,pl,1,plb0095,,Heimarbeit
s,pl,1
s,pl,1,plx,Work hours
"""
VALUES = """study,dataset,version,variable,value,label,label_de
s,pl,1,PLB0097,1,Yes,Ja
s,pl,1,plb0097,2,,Nein
s,pl,1,plb0097,2,No,Nein
s,pl,1,plb0097,x,Other,Anders
s,pl,1,plb0097,-1,no answer,keine Angabe
s,pl,1,plb0097,3,,
s,pl,1,plb0097,4
s,pl,1,plb0097, 5 ,Five
"""


@pytest.fixture
def codebooks(tmp_path):
    (tmp_path / "pl_variables.csv").write_text(VARIABLES)
    (tmp_path / "aux_variables.csv").write_text("s,auxset,1,plb0097,Home office copy,x\n")
    (tmp_path / "pl_values.csv").write_text(VALUES)
    return str(tmp_path)


def test_odd_codebook_rows(spark, tmp_path, rows):
    """Line breaks, doubled quotes and very long labels in quotes; short and long rows."""
    long = '""'.join("x" * 7 for _ in range(3000))
    (tmp_path / "b_values.csv").write_text(
        f's,d,1,v,1,"two\nlines, one ""label""",x\n\ns,d,1,v,2,"{long}"\ns,d,1,"v,\nw",3\ns,d,1,v,4,a,b,more\ns,d,1,v,5,,\n')
    book = codebook_files.read_values(spark, str(tmp_path))
    assert rows(book, "value", "label", "label_de") == [
        ("1", 'two\nlines, one "label"', "x"), ("2", long.replace('""', '"'), ""), ("4", "a", "b"), ("5", "", "")]
    assert [r.value for r in book.orderBy("position").collect()] == ["1", "2", "4", "5"]
    assert book.select("variable").count() == 4


def test_search(spark, codebooks, rows):
    book = codebook_files.read_variables(spark, codebooks)
    assert book.count() == 5  # the three-field line is dropped, the header kept
    found = codebook.search_variables(book, "HOME office")
    assert rows(found, "dataset", "variable", "label") == [
        ("auxset", "plb0097", "Home office copy"), ("pl", "plb0097", "Home office, wish")]
    assert rows(codebook.search_variables(book, "home hours", match_any=True), "variable") == [
        ("plb0097",), ("plb0097",), ("plx",)]
    assert codebook.search_variables(book, "wunsch").count() == 0  # German labels are not searched
    assert rows(codebook.search_variables(book, "label"), "variable") == [("variable",)]
    assert rows(codebook.search_variables(book, "plx"), "label", "label_de") == [("Work hours", "")]
    assert codebook.search_variables(book, "").count() == 5
    assert codebook.search_variables(book, "", match_any=True).count() == 0
    assert codebook.search_variables(book, "home", source="pl").count() == 1
    assert codebook_files.read_variables(spark, codebooks, "aux").count() == 1


def test_find_dataset(spark, codebooks):
    book = codebook_files.read_variables(spark, codebooks)
    assert codebook.find_dataset(book, "PLB0097") == "auxset"
    assert codebook.find_dataset(book, "plb0097", preferred={"pl"}) == "pl"
    assert codebook.find_dataset(book, "nothing") is None


def test_value_labels(spark, codebooks, rows):
    values = codebook_files.read_values(spark, codebooks)
    shown = codebook.value_labels(values, "Plb0097")
    assert rows(shown, "value", "shown") == [
        (" 5 ", "Five"), ("-1", "no answer"), ("1", "Yes"), ("2", "Nein"), ("2", "No"), ("3", ""), ("x", "Other")]
    labels = codebook.value_label_map(values, "plb0097", "pl")
    assert rows(labels) == [(-1, "no answer"), (1, "Yes"), (2, "No"), (5, "Five")]
    assert rows(codebook.scale_bounds(labels, [])) == [(1, "Yes", 5, "Five")]


def test_profile(spark, survey, codebooks, rows):
    registry, _ = survey
    data = tables.read_variable(spark, registry.csv_path("pl"), "plh0173")
    labels = codebook.value_label_map(codebook_files.read_values(spark, codebooks), "plb0097", "pl")
    parts = codebook.profile(data, "plh0173", labels)
    assert set(parts) == {"missing", "statistics", "by_year", "scale"}
    assert rows(parts["statistics"], "position", "statistic", "value") == [
        (1, "count", 2.0), (2, "mean", 6.0), (3, "std", pytest.approx(2 ** 0.5)), (4, "min", 5.0),
        (5, "25%", 5.5), (6, "50%", 6.0), (7, "75%", 6.5), (8, "max", 7.0)]
