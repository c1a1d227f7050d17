"""Model fitting: sane fits, a registry round trip, and folds that do not move."""

import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.operators import metrics, models, sampling
from tidemark.plans import catalog
from tidemark.session import scratch_dir
from tidemark.sources import views


@pytest.fixture(scope="module")
def table(spark):
    return models.folds(views.features_clean(spark, "/root/testdata/sf0.01")).cache()


@pytest.fixture(scope="module")
def bundle(table):
    return models.train_bundle(table, rounds=4)


def test_folds_do_not_depend_on_the_other_rows(spark, table):
    part = table.filter(F.col("label") == 1).select("entity_id", "label")
    again = sampling.split_folds(part).join(table.select("entity_id", F.col("fold").alias("was")), "entity_id")
    assert again.filter(F.col("fold") != F.col("was")).count() == 0
    share = table.groupBy("label").agg(F.avg((F.col("fold") == "train").cast("int")).alias("s")).collect()
    assert all(abs(r["s"] - 0.7) < 0.05 for r in share)


def test_trees_beat_the_rule(table, bundle):
    test = models.fold(table, "test")
    rule = metrics.ranking_metrics(
        test.select(models.S.heuristic_flag().cast("double").alias("score"), "label")
    ).first()
    trees = models.evaluate(bundle, test).first()
    assert trees["average_precision"] > rule["average_precision"] > 0


def test_thresholds_and_tiers(table, bundle):
    assert 0 < bundle.t_low <= bundle.t_high < 1
    tiers = {r["tier"]: r["positive_rate"] for r in metrics.tier_distribution(bundle.score(table)).collect()}
    assert set(tiers) <= set(config.TIERS)
    assert tiers["senior_escalation"] > tiers["auto_resolve"]


def test_calibrators_keep_the_order(spark, table, bundle):
    scored = models.raw_scores(bundle.model, models.fold(table, "calibration", "test"))
    assert bundle.platt.slope > 0
    iso = models.fit_isotonic(models.fold(scored, "calibration"))
    out = iso.transform(scored).select("raw", "calibrated_score").distinct().orderBy("raw").collect()
    values = [r["calibrated_score"] for r in out]
    assert values == sorted(values) and 0 <= values[0] and values[-1] <= 1


def test_penalties(table):
    train = models.fold(table, "train")
    for penalty in ("l1", "l2"):
        model = models.fit_linear(train, penalty, iterations=20)
        assert model.coefficients[config.FEATURES.index("support_tickets_30d")] > 0


def test_register_load_score(spark, table, bundle):
    root = scratch_dir(spark, "t-registry")
    card = models.model_card(table, bundle, "test-data", 4)
    version = models.register(card, bundle, root)
    row = spark.read.parquet(f"{root}/cards").first()
    assert (row["version"], row["stage"], row["data_version"]) == (version, "none", "test-data")
    assert row["thresholds"]["t_low"] == bundle.t_low
    assert row["metrics"]["n_train"] == models.fold(table, "train").count()
    back = models.load(spark, root, version)
    a = bundle.score(table).select("entity_id", "calibrated_score", "tier")
    b = back.score(table).select("entity_id", "calibrated_score", "tier")
    assert a.exceptAll(b).count() == 0


def test_feature_importance_asks_boosted_trees_too(spark, monkeypatch):
    """Not the committee's cuts alone. Rows without a feature and rows that come twice do not stop it."""
    columns = [(F.col("id") % (7 + i)).cast("double").alias(c) for i, c in enumerate(config.FEATURES)]
    rows = spark.range(400).select((F.col("id") % 7 > 4).cast("int").alias("label"), F.lit("train").alias("fold"), *columns)
    lost = rows.limit(30).withColumn(config.FEATURES[1], F.lit(None).cast("double"))
    table = rows.union(rows.limit(50)).union(lost)
    fitted, fit = [], models.fit_boosted
    monkeypatch.setattr(catalog, "_folds", lambda *of: table)
    monkeypatch.setattr(models, "fit_boosted", lambda train: fitted.append(train.count()) or fit(train, 2))
    found = catalog.QUERIES["feature_importance"](spark, "").collect()
    assert fitted == [450]
    assert sorted(r["feature"] for r in found) == sorted(config.FEATURES)
    assert all(r["in_range"] and r["total"] == 1.0 for r in found)
    assert abs(sum(r["importance"] for r in found) - 1) < 1e-5
    monkeypatch.setattr(catalog, "_folds", lambda *of: lost)
    assert [r["total"] for r in catalog.QUERIES["feature_importance"](spark, "").collect()] == [None] * 5


def test_training_rows_are_dealt_evenly_over_the_cores(spark, monkeypatch):
    """A round waits for its slowest task: one large file beside small ones must not be one task."""
    sizes = []

    class Fit:
        def __init__(self, **settings):
            pass

        def fit(self, df):
            sizes.extend(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())

    monkeypatch.setattr(models, "GBTClassifier", Fit)
    monkeypatch.setattr(models, "PARTITION_ROWS", 100)
    rows = spark.range(0, 9000, numPartitions=1).union(spark.range(9000, 9100, numPartitions=5))
    columns = [(F.col("id") % (7 + i)).cast("double").alias(c) for i, c in enumerate(config.FEATURES)]
    models.fit_boosted(rows.select((F.col("id") % 2).cast("int").alias("label"), *columns))
    assert len(sizes) == models.PARTITIONS_A_CORE * spark.sparkContext.defaultParallelism
    assert sum(sizes) == 9100 and max(sizes) < 1.5 * 9100 / len(sizes)


def test_a_sample_is_exact_and_repeatable(spark, table):
    one = sampling.sample_rows(table.select("entity_id"), 50, "entity_id", 5)
    assert one.count() == 50
    assert one.exceptAll(sampling.sample_rows(table.select("entity_id"), 50, "entity_id", 5)).count() == 0
    assert sampling.sample_rows(spark.range(7), 50, "id", 5).count() == 7
