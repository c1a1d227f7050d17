"""Boosted trees from binned blocks: the trees are Spark's own, whatever the blocks are."""

import numpy as np
import pytest
from pyspark.ml import classification
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import boosting

NAMES = ["a", "b", "c"]
SETTINGS = {"maxIter": 7, "maxDepth": 4, "stepSize": 0.3, "seed": 42, "weightCol": "weight"}


@pytest.fixture(scope="module")
def rows(spark):
    value = lambda i, n: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n)).cast("double")
    frame = spark.range(3000, numPartitions=3).select(value(1, 20).alias("a"), value(2, 7).alias("b"), value(3, 31).alias("c"), value(4, 600).alias("u"))
    frame = frame.withColumn("label", (F.col("u") < F.col("a") * F.col("b") + 9 * F.col("c")).cast("int")).drop("u")
    frame = frame.union(frame.limit(200)).withColumn("weight", F.when(F.col("label") == 1, 2.5).otherwise(1.0))
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(frame).cache()


def stored(spark, model, path):
    model.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()


def same_trees(one, two):
    assert len(one) == len(two) > 50
    for a, b in zip(one, two):
        assert [a[c] for c in ("treeID", "id", "leftChild", "rightChild", "rawCount", "split")] == [
            b[c] for c in ("treeID", "id", "leftChild", "rightChild", "rawCount", "split")
        ]
        assert [a["prediction"], a["impurity"], a["gain"], *a["impurityStats"]] == pytest.approx(
            [b["prediction"], b["impurity"], b["gain"], *b["impurityStats"]], rel=1e-7, abs=1e-9
        )


def test_trees_are_those_of_spark(spark, rows, tmp_path):
    own = boosting.GBTClassifier(**SETTINGS).fit(rows)
    other = classification.GBTClassifier(**SETTINGS).fit(rows)
    same_trees(stored(spark, own, f"{tmp_path}/own"), stored(spark, other, f"{tmp_path}/spark"))
    assert (own.treeWeights, own.getMaxIter(), own.numClasses) == (other.treeWeights, 7, 2)
    assert own.featureImportances.toArray() == pytest.approx(other.featureImportances.toArray())


def test_blocks_and_sums_made_anew_make_no_difference(spark, rows, tmp_path, monkeypatch):
    whole = boosting.GBTClassifier(**SETTINGS).fit(rows)
    monkeypatch.setattr(boosting, "REBUILD", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    parts = boosting.GBTClassifier(**SETTINGS).fit(rows.repartition(9))
    same_trees(stored(spark, whole, f"{tmp_path}/whole"), stored(spark, parts, f"{tmp_path}/parts"))


def test_a_training_row_takes_a_byte_a_feature_and_no_object(spark, rows):
    plain = rows.select(*NAMES, F.col("label").cast("double").alias("label"), "weight")
    blocks = boosting.binned(plain, [np.array([2.0, 5.0])] * 3).collect()
    n = sum(len(b.sign) for b in blocks)
    assert n == 3200 and len(blocks) <= plain.rdd.getNumPartitions()
    assert sum(x.nbytes for b in blocks for x in (b.bins, b.sign, b.weight, b.total)) == n * (3 + 1 + 8 + 8)


def test_candidates_share_the_weight(spark):
    few = boosting.candidates(np.array([1.0, 2.0, 4.0]), np.ones(3), 32)
    assert few.tolist() == [1.5, 3.0]
    cuts = boosting.candidates(np.arange(100.0), np.r_[np.full(50, 3.0), np.ones(50)], 4)
    assert cuts.tolist() == [16.5, 32.5, 49.5]
    assert boosting.candidates(np.array([1.0]), np.ones(1), 32).tolist() == []
    # All rows count, also far beyond a sample of ten thousand.
    values = spark.range(50_000).select(F.col("id").cast("double").alias("v"), F.lit(0.0).alias("label"), F.lit(1.0).alias("weight"))
    (cuts,) = boosting.choose_splits(values, ["v"], 32)
    assert len(cuts) == 31 and np.abs(np.diff(cuts) - 50_000 / 32).max() < 50


def test_few_rows_one_class_and_bad_rows(spark, rows):
    fit = boosting.GBTClassifier(**SETTINGS).fit
    same = rows.filter("label = 1").limit(5)
    model = fit(same)
    assert [t.numNodes for t in model.trees] == [1] * 7
    assert model.transform(same).filter("prediction <> 1").count() == 0
    with pytest.raises(ValueError):
        fit(rows.limit(0))
    for label in (2, None):
        with pytest.raises(Exception, match="label"):
            fit(rows.limit(5).withColumn("label", F.lit(label).cast("int")))
