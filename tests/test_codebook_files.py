"""Codebook files of whole texts: written by many tasks, the same rows."""

import glob
import hashlib

import __spark_entry__ as entry


def test_codebook_of_texts_is_written_by_as_many_tasks_as_read(spark, tmp_path, monkeypatch):
    from workload import codebooks

    rows = [(i, None if i % 7 == 0 else f'one, "{i}"\n\n"two"\r\n  ' * (i % 5), None if i % 11 == 0 else "de") for i in range(60)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts.repartition(3, "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(codebooks, "stage_folder", lambda _: str(tmp_path / "out"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 600)
    try:
        got = entry.queries()["codebook_of_texts"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(str(i), len(t or ""), hashlib.md5((t or "").encode()).hexdigest(), lang or "") for i, t, lang in rows]
    assert sorted(map(tuple, got)) == sorted(want)
    assert len(glob.glob(str(tmp_path / "out/*/texts_variables.csv/part-*"))) > 1
