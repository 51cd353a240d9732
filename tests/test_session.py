"""Folders of written stages and who deletes them."""

import os

import pytest

from panelweave.session import CHECKPOINT_DIR, new_folder, owned_stages, stage, staged, written


def folders(spark):
    return set(os.listdir(spark.conf.get(CHECKPOINT_DIR)))


def test_a_run_leaves_what_it_keeps(spark):
    before, path = folders(spark), new_folder(spark, "result")
    with owned_stages(spark):
        rows = stage(spark.range(5), "inner")
        with owned_stages(spark):
            again = stage(rows, "deeper")
            result = written(again.union(rows), path)
        assert rows.count() == 5
    left = folders(spark) - before
    assert len(left) == 1 and left.pop().startswith("result-") and result.count() == 10


def test_a_run_that_fails_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(RuntimeError), owned_stages(spark), staged(spark.range(3), "block"):
        stage(spark.range(2), "inner")
        raise RuntimeError
    assert folders(spark) == before
    assert stage(spark.range(2), "after").count() == 2 and len(folders(spark) - before) == 1
