"""Columns of the caller that are named like those the operators use, and ids that repeat."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm import decontamination_wm, embedding_itq, hilbert_shards, quality_gam, simhash_ball, source_schedule

NAMES = (
    "_id", "_times", "_row", "_order", "_piece", "_rank", "_offset", "_position", "_score", "fp", "row", "runs",
    "taken", "start", "label", "component_id",
)


@pytest.fixture(scope="module")
def clashing(odd_documents):
    return odd_documents.withColumns({name: F.lit(f"own {name}") for name in NAMES})


def _benchmark(docs):
    return docs.sparkSession.createDataFrame([("i", "one two")], "item_id string, text string")


@pytest.mark.parametrize(
    "stage",
    [
        lambda docs: quality_gam.keep_good(docs, quality_gam.fit(np.zeros((0, 14)), np.zeros(0)), 0.0),
        simhash_ball.keep_one,
        lambda docs: decontamination_wm.keep_clean(docs, _benchmark(docs)),
        source_schedule.mixed,
        hilbert_shards.sharded,
    ],
    ids=["quality", "near_duplicates", "decontamination", "mixing", "sharding"],
)
def test_own_columns_stay(clashing, stage):
    kept = stage(clashing)
    new = ("size", "text_crc32", "curve", "shard", "slot")
    assert [c for c in kept.columns if c not in new] == [c for c in clashing.columns if c not in new]
    rows = kept.collect()
    assert rows and all(row[name] == f"own {name}" for row in rows for name in NAMES)


def test_vectors_that_repeat_an_id(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=64), rng.normal(size=64)
    near = lambda v: (v + rng.normal(size=64) * 0.02).tolist()
    rows = [(1, a.tolist(), 1), (1, b.tolist(), 1), (2, near(a), 1), (3, near(b), 1), (4, near(b), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r) for r in embedding_itq.near_duplicates(frame).collect())
    assert found == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1)]
