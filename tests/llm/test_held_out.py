"""Scores of rows whose labels were not learnt from."""

import os

import numpy as np
import pytest

from ledgerloom.llm import queries

LABELLED = "/root/testdata/sf0.1"


def test_toxicity_ranks_held_out_rows(spark):
    if not os.path.isdir(LABELLED):
        pytest.skip(f"no tables at {LABELLED}")
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    found = queries.op2_recurrent_toxicity(spark, LABELLED).filter("held_out").join(labels, "doc_id").select("score", "toxic", "predicted").collect()
    score, toxic = np.array([r.score for r in found]), np.array([r.toxic for r in found])
    high, low = score[toxic == 1], score[toxic == 0]
    assert len(high) > 50 and len(low) > 500
    assert (high[:, None] > low).mean() + (high[:, None] == low).mean() / 2 >= 0.95
    assert np.mean([r.predicted for r in found if r.toxic]) >= 0.9
    assert np.mean([r.predicted == r.toxic for r in found]) >= 0.95
