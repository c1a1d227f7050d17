"""Reads over the feature store and inference log tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.scalars import predict_at
from tidemark.operators import trees
from tidemark.operators.asof import latest, pit_join, previous_value
from tidemark.operators.metrics import precision_recall_f1, ranking_metrics
from tidemark.operators.skew import lookup_join
from tidemark.session import materialized
from tidemark.sources.sinks import children, drop_days


def newest_log_rows(log: DataFrame, limit: int = config.LOG_READ_LIMIT) -> DataFrame:
    """The newest rows first; a top-k, not a sort of the log."""
    return log.orderBy(F.desc("request_ts"), F.desc("request_id")).limit(limit)


def logged_days(spark: SparkSession, path: str) -> list[str]:
    """The days of a log partitioned by ``date``, from its folders."""
    return [name.removeprefix("date=") for name in children(spark, path, "date=")]


def newest_logged(spark: SparkSession, path: str, limit: int = config.LOG_READ_LIMIT) -> DataFrame:
    """The newest rows of a log partitioned by day, from its newest days only.

    Days are taken in, twice as many each time, until they hold ``limit`` rows; older ones are not opened.
    """
    days = logged_days(spark, path)
    log = spark.read.parquet(path)
    take = 1
    while take < len(days) and log.filter(F.col("date") >= F.lit(days[-take]).cast("date")).count() < limit:
        take *= 2
    since = days[-take:][:1]
    return newest_log_rows(log.filter(F.col("date") >= F.lit(since[0]).cast("date")) if since else log, limit)


def retained(spark: SparkSession, path: str, days: int = config.RETENTION_DAYS) -> DataFrame:
    """The log's last ``days`` days, counted from its newest one: whole partitions, no row is looked at."""
    there = logged_days(spark, path)
    log = spark.read.parquet(path)
    return log.filter(F.col("date") >= F.date_sub(F.lit(there[-1]).cast("date"), days)) if there else log


def drop_expired(spark: SparkSession, path: str, days: int = config.RETENTION_DAYS) -> list[str]:
    """Deletes the days that :func:`retained` leaves out; returns them."""
    there = logged_days(spark, path)
    if not there:
        return []
    first = dt.date.fromisoformat(there[-1]) - dt.timedelta(days=days)
    return drop_days(spark, path, first.isoformat())


def log_to_predictions(log: DataFrame) -> DataFrame:
    return log.select("entity_id", "calibrated_score", "tier").filter(F.col("entity_id").isNotNull())


def within_retention(df: DataFrame, ts: str, days: int = config.RETENTION_DAYS) -> DataFrame:
    """Rows of the last ``days`` days, counted from the newest day present."""
    newest = F.date_sub(F.to_date(F.max(ts)), days).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) >= df.agg(newest.alias("since")).scalar())


def reconcile(
    online: DataFrame,
    history: DataFrame,
    now: Column,
    features: list[str],
    tolerance: float = config.RECONCILE_TOLERANCE,
) -> DataFrame:
    """Features whose online value is off the history's value as of ``now``.

    Both sides are one row per entity before they meet. Entities missing on a side, absent
    values and NaN give no mismatch, and history dated after ``now`` is not looked at.
    """
    asof_now = latest(history.filter(F.col("ts") <= now), ["entity_id"], ["ts", "write_seq"])
    right = asof_now.select(
        F.col("entity_id").alias("_entity"), *[F.col(f).alias(f"_off_{f}") for f in features]
    )
    both = online.join(right, online["entity_id"] == right["_entity"], "inner")
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.col(f).cast("double").alias("online_value"),
                F.col(f"_off_{f}").cast("double").alias("offline_value"),
            )
            for f in features
        ]
    )
    rows = both.select("entity_id", F.inline(cells))
    gap = F.abs(F.col("online_value") - F.col("offline_value"))
    return rows.filter((gap > tolerance) & ~F.isnan(gap))


def mismatch_summary(online: DataFrame, history: DataFrame, now: Column, features: list[str]) -> DataFrame:
    return (
        reconcile(online, history, now, features)
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("mismatches"))
    )


def latest_value_join(labels: DataFrame, history: DataFrame, how: str = "left") -> DataFrame:
    """The leaky join: every label with the entity's current value, whenever that was written."""
    current = latest(
        history.select("entity_id", "ts", "write_seq", "spend"), ["entity_id"], ["ts", "write_seq"]
    ).select("entity_id", F.col("ts").alias("current_ts"), F.col("spend").alias("current_spend"))
    return lookup_join(labels, current, ["entity_id"], how)


def leakage_fitted(labels: DataFrame, history: DataFrame, features: list[str]) -> DataFrame:
    """What a committee of one-cut trees learns from the leaky and from the point-in-time join (column ``view``).

    Each is fitted on, and judged on, the labels that its own join has values for.
    """
    pit = materialized(pit_join(labels, history).select("entity_id", "label", *features), "pit")
    current = latest(history, ["entity_id"], ["ts", "write_seq"]).select("entity_id", *features)
    leaky = materialized(lookup_join(pit.select("entity_id", "label"), current, ["entity_id"]), "leaky")
    scores = None
    for view, rows in (("leaky", leaky), ("pit", pit)):
        rows = rows.na.drop(subset=features)
        nodes = materialized(trees.committee(rows, features), "nodes")
        part = rows.select(F.lit(view).alias("view"), "label", trees.score_column(nodes, trees.MEAN).alias("score"))
        scores = part if scores is None else scores.unionByName(part)
    return ranking_metrics(scores, by=["view"])


def leakage_report(labels: DataFrame, history: DataFrame) -> DataFrame:
    """How far the leaky join departs from the point-in-time join, and the AUC of each."""
    pit = pit_join(labels, history).select("entity_id", "label", "label_timestamp", "spend")
    joined = materialized(
        latest_value_join(materialized(pit, "pit"), history).drop("entity_id"), "leakage"
    )
    leaky_known = F.col("current_spend").isNotNull()
    counts = joined.agg(
        F.count(F.lit(1)).alias("n_labels"),
        F.count_if(leaky_known & ~F.col("spend").eqNullSafe(F.col("current_spend"))).alias("n_differ"),
        F.count_if(F.col("current_ts") > F.col("label_timestamp")).alias("n_future"),
    )
    views = F.array(
        F.struct(F.lit("leaky").alias("view"), F.col("current_spend").alias("score")),
        F.struct(F.lit("pit").alias("view"), F.col("spend").alias("score")),
    )
    long = joined.select("label", F.inline(views)).filter(F.col("score").isNotNull())
    either_way = F.greatest("roc_auc", 1.0 - F.col("roc_auc"))
    auc = lambda view: F.max(F.when(F.col("view") == view, either_way)).alias(f"auc_{view}")
    aucs = ranking_metrics(long, by=["view"]).agg(F.struct(auc("leaky"), auc("pit")).alias("a"))
    return counts.withColumn("_a", aucs.scalar()).select("n_labels", "n_differ", "n_future", "_a.*")


def backfill_counts(predictions: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """(pred, label, n) after the inner join on the entity.

    Predictions are counted per (entity, pred) first, so an entity with very many predictions
    reaches the join as two rows at most.
    """
    counted = predictions.groupBy("entity_id", predict_at(F.col("calibrated_score"), cut).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    truth = labels.groupBy("entity_id", "label").agg(F.count(F.lit(1)).alias("n_labels"))
    return counted.join(truth, "entity_id").select(
        "pred", "label", (F.col("n") * F.col("n_labels")).alias("n")
    )


def label_backfill(predictions: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """Precision, recall and F1 once the true labels are there."""
    out = precision_recall_f1(backfill_counts(predictions, labels, cut), weight="n")
    matched = F.col("n_rows") > 0
    return out.select(
        F.when(matched, F.lit(config.STATUS_CHECKED)).otherwise(F.lit(config.STATUS_NO_LABELS)).alias("status"),
        F.col("n_rows").alias("n_matched"),
        *[F.when(matched, F.col(c)).alias(c) for c in ("precision", "recall", "f1")],
    )


def label_backfills(
    predictions: DataFrame, labels: DataFrame, cutoffs: list[str], cut: float = 0.5
) -> DataFrame:
    """:func:`label_backfill` as of several times (column ``as_of``), from one join with all labels."""
    counted = predictions.groupBy("entity_id", predict_at(F.col("calibrated_score"), cut).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = [F.col("label_observed_timestamp") <= F.lit(c).cast("timestamp_ntz") for c in cutoffs]
    truth = labels.groupBy("entity_id", "label").agg(*[F.count_if(k).alias(f"_n{i}") for i, k in enumerate(known)])
    each = F.array(
        *[F.struct(F.lit(c).alias("as_of"), (F.col("n") * F.col(f"_n{i}")).alias("w")) for i, c in enumerate(cutoffs)]
    )
    rows = counted.join(truth, "entity_id").select("pred", "label", F.inline(each))
    # A row of weight zero for each time, so that one without any label is reported too.
    none = labels.sparkSession.createDataFrame([(0, 0, c, 0) for c in cutoffs], "pred int, label int, as_of string, w bigint")
    out = precision_recall_f1(rows.unionByName(none), by=["as_of"], weight="w")
    matched = F.col("n_rows") > 0
    return out.select(
        "as_of",
        F.when(matched, F.lit(config.STATUS_CHECKED)).otherwise(F.lit(config.STATUS_NO_LABELS)).alias("status"),
        F.col("n_rows").alias("n_matched"),
        *[F.when(matched, F.col(c)).alias(c) for c in ("precision", "recall", "f1")],
    )


def labels_known_at(labels: DataFrame, now: Column) -> DataFrame:
    return labels.filter(F.col("label_observed_timestamp") <= now)


def previous_pointer(pointers: DataFrame, by: list[str]) -> DataFrame:
    """For every promotion, what was pointed at before: the rollback target."""
    return previous_value(pointers, by, "pointed_at", "seq", "version", "rollback_to")

