"""Jobs made of several operators: alerts, gate chains, drift reports, promotion, a full run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators import drift, gates, metrics, models, registry, trees
from tidemark.session import materialized
from tidemark.sources import sinks


def concept_drift_report(df: DataFrame, is_live: Column, flipped: Column, feature: str) -> DataFrame:
    """KS on one input and F1 of a fixed rule, before and in the live period.

    Live labels are turned over where ``flipped`` holds, which leaves every input as it was.
    """
    label = F.when(is_live & flipped, 1 - F.col("label")).otherwise(F.col("label"))
    rows = materialized(
        df.select(
            is_live.alias("is_live"),
            F.lit(feature).alias("feature"),
            F.col(feature).alias("value"),
            S.heuristic_flag().alias("pred"),
            label.alias("label"),
        ),
        "concept",
    )
    ks = drift.ks_drift(rows, ["feature"])
    f1 = lambda side: F.max(F.when(F.col("is_live") == side, F.col("f1")))
    scores = metrics.precision_recall_f1(rows, by=["is_live"]).agg(
        F.struct(f1(False).alias("f1_before"), f1(True).alias("f1_after")).alias("f")
    )
    both = ks.withColumn("_f", scores.scalar()).select("feature", "ks_stat", "drifted", "_f.*")
    return both.select(
        "*",
        drift.concept_verdict(F.col("drifted"), F.col("f1_before"), F.col("f1_after")).alias("verdict"),
        (F.col("f1_after") < config.F1_ALERT).alias("f1_alert"),
    )


def concept_drift_fitted(df: DataFrame, is_live: Column, flipped: Column) -> DataFrame:
    """As :func:`concept_drift_report` over all features, with a model learned before the live period.

    The model is a committee; a row is predicted positive at or above the share of positives it learned from.
    """
    label = F.when(is_live & flipped, 1 - F.col("label")).otherwise(F.col("label"))
    rows = materialized(df.select(*config.FEATURES, is_live.alias("is_live"), label.alias("label")), "concept")
    before = rows.filter("not is_live")
    nodes = materialized(trees.committee(before, config.FEATURES), "nodes")
    cut = before.agg(F.avg(F.col("label").cast("double"))).first()[0]
    preds = rows.select("is_live", "label", (trees.score_column(nodes, trees.MEAN) >= F.lit(cut)).cast("int").alias("pred"))
    f1 = lambda side: F.max(F.when(F.col("is_live") == side, F.col("f1")))
    both = metrics.precision_recall_f1(preds, by=["is_live"]).agg(f1(False).alias("f1_before"), f1(True).alias("f1_after"))
    long = drift.unpivot(rows, ["is_live"], config.FEATURES).filter("value is not null")
    moved = drift.ks_drift(long, ["feature"]).agg(F.bool_or("drifted")).scalar()
    both = both.withColumn("drifted", moved)
    verdict = drift.concept_verdict(F.col("drifted"), F.col("f1_before"), F.col("f1_after")).alias("verdict")
    return both.select("drifted", "f1_before", "f1_after", verdict, (F.col("f1_after") < config.F1_ALERT).alias("f1_alert"))


def gate_chain(name: str, steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row per step: passed, failed, or blocked behind an earlier failure.

    Every step is a one-row frame with a boolean ``passed``.
    """
    out = None
    for position, (step, verdict) in enumerate(steps):
        row = verdict.select(
            F.lit(name).alias("chain"), F.lit(position).alias("position"), F.lit(step).alias("step"), "passed"
        )
        out = row if out is None else out.unionByName(row)
    earlier = W.partitionBy("chain").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    blocked = F.coalesce(F.bool_or(~F.col("passed")).over(earlier), F.lit(False))
    status = F.when(blocked, F.lit("blocked")).when(F.col("passed"), F.lit("passed")).otherwise(F.lit("failed"))
    return out.select("chain", "position", "step", status.alias("status"))


def ingestion_alerts(checks: DataFrame) -> DataFrame:
    volume = checks.filter(F.col("check_name") == config.CHECK_VOLUME)
    message = F.format_string(config.MESSAGE_VOLUME, F.col("share") * 100)
    return gates.gate_alerts(volume, "ingestion_gate", "warning", message)


def transformation_alerts(tests: DataFrame) -> DataFrame:
    """One alert for the gate, however many of its tests failed."""
    verdict = tests.agg(F.bool_and("passed").alias("passed"))
    message = F.lit(config.MESSAGE_TRANSFORMATION)
    return gates.gate_alerts(verdict, "transformation_gate", "warning", message)


def drift_alerts(per_feature: DataFrame) -> DataFrame:
    drifted = F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))
    names = per_feature.agg(drifted.alias("names"))
    verdict = names.select((F.size("names") == 0).alias("passed"), "names")
    quoted = F.array_join(F.transform("names", lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", ")
    message = F.format_string(config.MESSAGE_DATA_DRIFT, quoted)
    return gates.gate_alerts(verdict, "data_drift", "critical", message)


def psi_alerts(psi: DataFrame) -> DataFrame:
    checked = psi.filter(F.col("status") == config.STATUS_CHECKED).withColumn(
        "passed", F.col("psi") <= config.PSI_MODERATE
    )
    message = F.format_string(config.MESSAGE_PSI, F.col("psi"), F.col("interpretation"))
    return gates.gate_alerts(checked, "score_psi", "warning", message)


def backfill_alerts(backfill: DataFrame) -> DataFrame:
    checked = backfill.filter(F.col("status") == config.STATUS_CHECKED).withColumn(
        "passed", F.col("f1") >= config.F1_ALERT
    )
    message = F.format_string(config.MESSAGE_BACKFILL, F.col("f1"), F.col("n_matched"))
    return gates.gate_alerts(checked, "label_backfill", "critical", message)


# ---- promotion ---------------------------------------------------------------------------------

_POINTERS = "stage string, version string, pointed_at timestamp, seq bigint"


def pointer_log(spark: SparkSession, root: str) -> DataFrame:
    """The registry's promotions; empty before the first one."""
    try:
        return spark.read.schema(_POINTERS).parquet(f"{root}/pointers")
    except AnalysisException as missing:
        # Only a log that was never written means no promotions; one that can't be read stops the gate.
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _POINTERS)


def pointer(spark: SparkSession, root: str, stage: str) -> str | None:
    """The version a stage points at, or None."""
    at_stage = pointer_log(spark, root).filter(F.col("stage") == stage)
    return at_stage.agg(F.max_by("version", F.struct("pointed_at", "seq"))).first()[0]


def contest_and_promote(
    folds: DataFrame, root: str, version: str | None = None, dry_run: bool = False
) -> DataFrame:
    """Champion against challenger on both slices of the holdout; appends the pointer move.

    The challenger is the newest registered version unless one is named. Returns the decision.
    """
    spark = folds.sparkSession
    newest = spark.read.parquet(f"{root}/cards").agg(F.max("version")).first()[0]
    challenger, champion = version or newest, pointer(spark, root, "production")
    wanted = [challenger] if champion is None else list(dict.fromkeys([champion, challenger]))
    holdout = materialized(models.fold(folds, "calibration", "test"), "holdout")
    bundles = {v: models.load(spark, root, v) for v in wanted}
    scores = materialized(models.score_versions(bundles, registry.eval_slices(holdout)), "scores")
    contest = registry.champion_challenger(registry.slice_metrics(scores), challenger, champion)
    decision = materialized(registry.promotion(contest, challenger, dry_run), "decision")
    move = decision.filter(F.col("stage").isNotNull()).select(
        "stage", "version", F.current_timestamp().alias("pointed_at"), F.lit(pointer_log(spark, root).count()).cast("bigint").alias("seq")
    )
    sinks.append_rows(move, f"{root}/pointers")
    return decision


def champion_score_psi(features: DataFrame, log: DataFrame, root: str) -> DataFrame:
    """PSI of the logged scores against the champion's scores of the training features."""
    spark = features.sparkSession
    champion = pointer(spark, root, "production")
    if champion is None:
        return spark.createDataFrame([(config.STATUS_NO_MODEL,)], "status string")
    expected = materialized(models.load(spark, root, champion).score(features).select("calibrated_score"), "expected")
    return drift.psi(drift.two_samples(expected, log, ["calibrated_score"]))


# ---- a full run --------------------------------------------------------------------------------


_LEDGER = "step string, status string, position int"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """What is written of a run's steps; empty before the first one."""
    if not sinks.children(spark, path, "position="):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).option("basePath", path).parquet(path)


def run_steps(spark: SparkSession, steps: list[tuple[str, Callable[[], bool]]], path: str) -> DataFrame:
    """Runs the steps in order up to the first that fails; one status row per step, from the ledger at ``path``.

    A step's outcome is written when it ends. A run that was cut off goes on behind the last step that passed, so
    a step must stand being run again from its start. A failed step is tried again, too.
    """
    passed = {r["step"] for r in ledger(spark, path).filter(F.col("status") == "passed").collect()}
    failed = False
    for position, (name, step) in enumerate(steps):
        if name in passed and not failed:
            continue
        state = "blocked" if failed else ("passed" if step() else "failed")
        failed = failed or state == "failed"
        row = spark.createDataFrame([(name, state)], "step string, status string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/position={position}")
    return ledger(spark, path).select("position", "step", "status")


def full_run(
    landed: DataFrame, labels: DataFrame, root: str, batch_id: str, rounds: int = models.BOOSTED["rounds"]
) -> DataFrame:
    """Landed rows to a promoted model: gate one, gate two, training, promotion.

    ``landed`` has the key, the features and the label. Gate one's clean rows are what gate two
    and the training read; its quarantined rows go to the dead letters. The ledger of the run is kept under the
    batch's id: the same batch again goes on where it stopped.
    """
    spark = landed.sparkSession
    passed = lambda checks, column: bool(checks.agg(F.bool_and(column)).first()[0])
    clean_path = f"{root}/clean/batch_id={batch_id}"
    clean = lambda: spark.read.parquet(clean_path)

    def ingestion() -> bool:
        # Written once: what is made of it reads the batch, not the tables that it comes from.
        batch = materialized(landed, "landed")
        sinks.write_dlq(batch, f"{root}/dead_letters", batch_id)
        sinks.write_clean(batch, clean_path)
        return passed(gates.ingestion_gate(batch), "batch_passed")

    def train() -> bool:
        # A version that this batch registered before it was cut off is not trained again.
        if not registered_by(spark, root, batch_id):
            models.train_and_register(clean(), root, batch_id, rounds)
        return True

    def promotion() -> bool:
        version = registered_by(spark, root, batch_id)
        if pointer(spark, root, "production") == version:
            return True
        # The version was trained on these very folds, so they are there; if somebody took them away, they are cut anew.
        path = models.folds_path(root, batch_id)
        kept = "_SUCCESS" in sinks.children(spark, path)
        folds = spark.read.parquet(path) if kept else models.folds(clean())
        return passed(contest_and_promote(folds, root, version), "passed")

    return run_steps(
        spark,
        [
            ("ingestion_gate", ingestion),
            ("transformation_gate", lambda: passed(gates.transformation_gate(clean(), labels), "passed")),
            ("train", train),
            ("promotion_gate", promotion),
        ],
        f"{root}/runs/batch_id={batch_id}",
    )


def registered_by(spark: SparkSession, root: str, data_version: str) -> str | None:
    """The newest version with a card that was trained on this data, or None."""
    if not sinks.children(spark, f"{root}/cards"):
        return None
    cards = spark.read.parquet(f"{root}/cards").filter(F.col("data_version") == data_version)
    return cards.agg(F.max("version")).first()[0]
