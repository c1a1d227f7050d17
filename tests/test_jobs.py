"""The full run from landed rows to a promoted model, and what stops it."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.plans import jobs
from tidemark.session import scratch_dir
from tidemark.sources import views

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def features(spark):
    return views.features_clean(spark, SF).cache()


@pytest.fixture(scope="module")
def landed(features):
    """Orders without lines have lost their key."""
    return features.withColumn("entity_id", F.when(F.col("n_lines") > 0, F.col("entity_id"))).drop("n_lines")


def statuses(df):
    return [r["status"] for r in df.orderBy("position").collect()]


def test_full_run_promotes_then_contests(spark, features, landed):
    root, labels = scratch_dir(spark, "t-run"), views.labels_delayed(spark, SF)
    assert jobs.pointer(spark, root, "production") is None
    assert jobs.champion_score_psi(features, features, root).first()["status"] == "no_production_model"

    assert statuses(jobs.full_run(landed, labels, root, "b1", rounds=3)) == ["passed"] * 4
    first = jobs.pointer(spark, root, "production")
    assert first is not None
    lost = spark.read.parquet(f"{root}/dead_letters")
    assert lost.count() == features.filter("n_lines = 0").count()
    assert set(r["reason"] for r in lost.select("reason").distinct().collect()) == {"null entity_id"}

    folds = models.folds(features)
    assert jobs.contest_and_promote(folds, root, dry_run=True).first()["stage"] is None
    assert jobs.pointer_log(spark, root).count() == 1

    models.train_and_register(landed.filter("entity_id is not null"), root, "b2", 3)
    decision = jobs.contest_and_promote(folds, root).first()
    assert decision["passed"] and decision["version"] > first
    assert jobs.pointer(spark, root, "production") == decision["version"]

    log = models.load(spark, root, decision["version"]).score(features)
    row = jobs.champion_score_psi(features, log, root).first()
    assert (row["status"], row["psi"], row["interpretation"]) == ("checked", 0.0, "stable")


def test_a_run_reads_its_input_and_cuts_its_folds_once(spark, landed, monkeypatch):
    """Gate one reads the written batch, and the contest the folds that the version was trained on."""
    cut, read = [], []
    split, gate = models.sampling.split_folds, jobs.gates.ingestion_gate
    monkeypatch.setattr(models.sampling, "split_folds", lambda df, *a: cut.append(1) or split(df, *a))
    monkeypatch.setattr(jobs.gates, "ingestion_gate", lambda df, *a: read.extend(df.inputFiles()) or gate(df, *a))
    root, labels = scratch_dir(spark, "t-once"), views.labels_delayed(spark, SF)
    assert statuses(jobs.full_run(landed, labels, root, "b1", rounds=1)) == ["passed"] * 4
    assert len(cut) == 1
    assert read and not any(f.endswith(("orders.parquet", "lineitem.parquet")) for f in read)


def test_orphans_block_training(spark, features):
    root = scratch_dir(spark, "t-blocked")
    run = jobs.full_run(features.drop("n_lines"), views.labels_delayed(spark, SF), root, "b1", rounds=3)
    assert statuses(run) == ["passed", "failed", "blocked", "blocked"]


def test_too_many_lost_keys_block_everything(spark, landed):
    root = scratch_dir(spark, "t-lost")
    none = landed.withColumn("entity_id", F.when(F.col("label") == 1, F.col("entity_id")))
    run = jobs.full_run(none, views.labels_delayed(spark, SF), root, "b1", rounds=3)
    assert statuses(run) == ["failed", "blocked", "blocked", "blocked"]


def test_an_unreadable_pointer_log_stops_the_gate(spark, tmp_path):
    assert jobs.pointer_log(spark, str(tmp_path)).count() == 0
    (tmp_path / "pointers").mkdir()
    (tmp_path / "pointers" / "part-0.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception, match="part-0.parquet"):
        jobs.pointer(spark, str(tmp_path), "production")


def test_a_missing_score_has_no_tier(spark):
    from tidemark.functions import scalars

    df = spark.createDataFrame([(None,), (0.1,), (0.9,)], "s double")
    rows = df.select(scalars.tier(F.col("s"), 0.2, 0.6).alias("t")).collect()
    assert [r["t"] is None for r in rows] == [True, False, False]


def test_a_killed_run_goes_on(spark, features, landed, monkeypatch):
    """It is cut off in the training, then goes on behind the gates, and a finished run does nothing."""
    root, labels = scratch_dir(spark, "t-resume"), views.labels_delayed(spark, SF)
    trained, written = models.train_and_register, jobs.sinks.write_clean
    runs = []
    monkeypatch.setattr(jobs.sinks, "write_clean", lambda *a, **k: runs.append("clean") or written(*a, **k))

    def killed(*args):
        trained(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(models, "train_and_register", killed)
    with pytest.raises(KeyboardInterrupt):
        jobs.full_run(landed, labels, root, "b1", rounds=2)
    ledger = {r["step"]: r["status"] for r in jobs.ledger(spark, f"{root}/runs/batch_id=b1").collect()}
    assert ledger == {"ingestion_gate": "passed", "transformation_gate": "passed"}

    monkeypatch.setattr(models, "train_and_register", lambda *a: runs.append("train") or trained(*a))
    for _ in range(2):
        assert statuses(jobs.full_run(landed, labels, root, "b1", rounds=2)) == ["passed"] * 4
    # The version that was registered before the kill is used; neither gate nor training ran again.
    assert runs == ["clean"]
    assert spark.read.parquet(f"{root}/cards").count() == 1 and jobs.pointer_log(spark, root).count() == 1


def test_a_failed_step_is_tried_again(spark, tmp_path):
    path, verdicts = str(tmp_path / "ledger"), iter([False, True])
    steps = [("one", lambda: True), ("two", lambda: next(verdicts)), ("three", lambda: True)]
    assert statuses(jobs.run_steps(spark, steps, path)) == ["passed", "failed", "blocked"]
    assert statuses(jobs.run_steps(spark, steps, path)) == ["passed"] * 3
