"""A run of the pipeline leaves nothing but its result."""

import os

import corpus_pipeline
from panelweave.session import CHECKPOINT_DIR


def test_only_the_result_is_left(spark):
    folder = spark.conf.get(CHECKPOINT_DIR)
    before = set(os.listdir(folder))
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("pipeline-4-")
