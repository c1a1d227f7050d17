"""Ensembles as node tables: the built-in expression scores as the model does."""

import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.operators import models, sampling, trees
from tidemark.session import scratch_dir
from tidemark.sources import views


@pytest.fixture(scope="module")
def folds(spark):
    return models.folds(views.features_clean(spark, "/root/testdata/sf0.01")).cache()


def test_saved_trees_score_as_the_model_does(spark, folds):
    model = models.fit_boosted(models.fold(folds, "train"), 6)
    path = scratch_dir(spark, "t-gbt")
    model.write().save(path)
    nodes = trees.saved_nodes(spark, path, config.FEATURES)
    assert nodes.select("tree").distinct().count() == 6
    score = trees.score_column(nodes, trees.LOGISTIC)
    both = models.raw_scores(model, folds.withColumn("own", score))
    assert both.filter(F.abs(F.col("own") - F.col("raw")) > 1e-9).count() == 0
    assert both.select("raw").distinct().count() > 2


def test_committee_by_brute_force(spark):
    rows = [(float(i % 7), None if i % 5 == 0 else float(i), int(i % 3 == 0)) for i in range(60)]
    frame = spark.createDataFrame(rows, "a double, b double, label int")
    nodes = {(r["tree"], r["node"]): r for r in trees.committee(frame, ["a", "b"]).collect()}
    for tree, at in ((0, 0), (1, 1)):
        known = sorted((r[at], r[2]) for r in rows if r[at] is not None)
        values = [v for v, _ in known]
        n = len(values)
        median = (values[(n - 1) // 2] + values[n // 2]) / 2
        low, high = [y for v, y in known if v <= median], [y for v, y in known if v > median]
        assert nodes[tree, 0]["cut"] == median
        assert nodes[tree, 1]["leaf"] == pytest.approx(sum(low) / len(low))
        assert nodes[tree, 2]["leaf"] == pytest.approx(sum(high) / len(high))


def test_registered_nodes_score_as_before(spark, folds):
    nodes = trees.committee(models.fold(folds, "train"), config.FEATURES)
    root = scratch_dir(spark, "t-nodes")
    trees.register_nodes(nodes, root, "v1", trees.MEAN, (0.1, 0.2))
    loaded, link, cuts = trees.load_nodes(spark, root, "v1")
    assert cuts == (0.1, 0.2)
    both = folds.select(trees.score_column(nodes, trees.MEAN).alias("a"), trees.score_column(loaded, link).alias("b"))
    assert both.filter("a <> b or a is null or a < 0 or a > 1").count() == 0


def test_shares_are_exact_in_every_class(spark):
    """Small classes, a null class, keys that repeat; the same folds whatever the order of the rows."""
    rows = [(f"k{i}", label) for label, n in ((0, 997), (1, 33), (2, 1), (3, 2), (None, 10)) for i in range(n)]
    frame = spark.createDataFrame(rows, "entity_id string, label int")
    split = sampling.split_folds(frame)
    sizes = {(r["label"], r["fold"]): r["count"] for r in split.groupBy("label", "fold").count().collect()}
    for label, n in ((0, 997), (1, 33), (2, 1), (3, 2), (None, 10)):
        held = int(n * 0.3 + 0.5)
        test = int(held * 0.5 + 0.5)
        got = [sizes.get((label, f), 0) for f in ("train", "test", "calibration")]
        assert got == [n - held, test, held - test]
    again = sampling.split_folds(frame.orderBy(F.desc("entity_id")).repartition(5))
    assert again.exceptAll(split).count() == 0


def test_keys_that_repeat_stay_together(spark):
    frame = spark.createDataFrame([("same", 1)] * 20 + [(f"k{i}", 1) for i in range(20)], "entity_id string, label int")
    split = sampling.split_folds(frame)
    assert split.filter("entity_id = 'same'").select("fold").distinct().count() == 1
    assert split.count() == 40
    assert sampling.split_folds(frame.limit(0)).count() == 0
