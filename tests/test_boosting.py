"""Trees grown over blocks against MLlib's own evaluation of them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tesela.ml import boosting, models


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(1500, numPartitions=3).select(
        F.col("id").cast("string").alias("id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("x"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7))).alias("c"),
        F.when(F.col("id") % 5 == 0, "val").when(F.col("id") % 5 == 1, "test").otherwise("train").alias("split"),
    )
    rows = StringIndexer(inputCol="c", outputCol="c_idx", handleInvalid="keep").fit(rows).transform(rows)
    rows = rows.withColumn("punt_global", 100 * F.sin(9 * F.col("x")) + 200 + 20 * F.col("c_idx"))
    rows = rows.withColumn("punt_ingles", F.when(F.col("id").cast("int") % 3 > 0, 50 * F.col("x")))
    rows = VectorAssembler(inputCols=["c_idx", "x"], outputCol="features").transform(rows)
    return rows.select("id", "features", "split", "punt_global", "punt_ingles").persist()


def _grown(table, targets, **kw):
    inputs = models.ScoreInputs(["x"], PipelineModel(stages=[]), table)
    grown = models.score_boosting(inputs, targets, **({"rounds": 12, "patience": 6, "depth": 4} | kw))
    fitted = [boosting.BlockRegressor.over(grown, t, grown.rounds).fit(table) for t in targets]
    grown.close()
    return grown, fitted


def test_losses_are_those_of_the_model(spark, table):
    """The model that is handed out predicts what the blocks hold, for known labels only."""
    grown, fitted = _grown(table, ["punt_global", "punt_ingles"])
    for target, model in zip(grown.targets, fitted):
        val = models.labelled(table.where("split = 'val'"), target)
        losses = model.evaluateEachIteration(val, "squared")
        assert grown.losses[target] == pytest.approx(losses, rel=1e-3, abs=1e-3) and losses[-1] < 0.8 * losses[0]
        assert grown.judged[target] == val.count() and model.treeWeights == [1.0] + [0.1] * (model.getNumTrees - 1)
    assert {len(t.measured) for trees in grown.trees.values() for t in trees} == {0}


def test_trees_do_not_depend_on_the_layout(spark, table, monkeypatch):
    targets = ["punt_global", "punt_ingles"]
    whole, first = _grown(table, targets, rounds=6)
    monkeypatch.setattr(boosting, "BLOCK", 100)
    parts, second = _grown(table.repartition(5), targets, rounds=6)
    assert whole.losses == parts.losses
    for a, b in zip(first, second):
        assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:]


def test_a_longer_fit_goes_on_from_the_shorter_one(spark, table, monkeypatch):
    """Growing to all rounds grows no tree twice; before, the first ones were fitted again."""
    made, tree = [], boosting.Tree
    monkeypatch.setattr(boosting, "Tree", lambda *a: made.append(a) or tree(*a))
    inputs = models.ScoreInputs(["x"], PipelineModel(stages=[]), table)
    _, metrics, _ = models.fit_score_model(inputs, "punt_global", rounds=9, patience=2, depth=3)
    assert metrics.first().n_trees == 9 and len(made) == 9


def test_sums_of_a_block_are_whole_numbers():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, (2, 3000)).astype(np.uint8)
    r = rng.integers(-(2**31) + 1, 2**31, 3000).astype(np.int32)
    groups = [np.arange(0, 1000), np.arange(1000, 3000), np.zeros(0, np.intp)]
    got = boosting._summer([5, 5], boosting.DROPPED, boosting.COUNT)(x, r, groups)
    coarse = (r.astype(np.int64) + 2 ** (boosting.DROPPED - 1)) >> boosting.DROPPED
    for g, rows in enumerate(groups):
        for f in range(2):
            for b in range(5):
                mine = coarse[rows][x[f][rows] == b]
                assert got[:, g, 5 * f + b].tolist() == [len(mine), mine.sum()]


def test_cut_points():
    assert boosting.cut_points(np.array([1.0, 1, 2, 4]), 32).tolist() == [1.5, 3.0]
    assert len(boosting.cut_points(np.arange(1000.0), 32)) == 31
    assert boosting.cut_points(np.ones(3), 32).tolist() == []
