"""The query catalogue: every operator over the given tables, by name."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators import asof, drift, gates, history, metrics, models, registry, routing, running, sampling
from tidemark.operators import store, trees
from tidemark.operators.skew import lookup_join
from tidemark.plans import jobs
from tidemark.session import materialized, scratch_dir, scratch_root
from tidemark.sources import sinks, views
from tidemark.sources.tables import stream_folder, stream_table, table
from tidemark.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPEND_AND_K = ["spend", "k"]
LOG_COLUMNS = [
    "request_id",
    "entity_id",
    "request_ts",
    "calibrated_score",
    "tier",
    "served_by",
    "low_confidence",
    "spend",
    "k",
    "model_version",
]
LOG_ROWS_READ = 500
SLICES = (config.EVAL_SLICES[0], "high_quantity_slice")


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- sources and sinks -------------------------------------------------------------------------


@query("scan_raw_landing")
def scan_raw_landing(spark, folder):
    return views.raw_landing(spark, folder)


@query("scan_features_labels")
def scan_features_labels(spark, folder):
    return views.features_clean(spark, folder).select("entity_id", "label")


@query("sink_clean_batch")
def sink_clean_batch(spark, folder):
    return sinks.write_clean(views.raw_landing(spark, folder), scratch_dir(spark, "clean"))


@query("sink_dlq")
def sink_dlq(spark, folder):
    path = scratch_dir(spark, "dlq")
    sinks.write_dlq(views.raw_landing(spark, folder), path, "batch_1")
    return spark.read.parquet(path)


def _write_history(spark, folder, write) -> None:
    """Two writes, the first half of the month and the rest."""
    rows = views.feature_history(spark, folder)
    first = F.col("ts") < F.lit(views.DRIFT_SPLIT).cast("timestamp_ntz")
    for part in (rows.filter(first), rows.filter(~first)):
        write(part)


@query("sink_offline_append")
def sink_offline_append(spark, folder):
    path = scratch_dir(spark, "offline")
    _write_history(spark, folder, lambda part: sinks.append_features(part, path))
    return asof.dedupe_last_write(spark.read.parquet(path).drop("date"), ["entity_id", "ts"])


@query("sink_online_upsert")
def sink_online_upsert(spark, folder):
    path = scratch_dir(spark, "online")
    batches = iter(("1", "2"))
    _write_history(spark, folder, lambda part: sinks.append_online(part, path, next(batches)))
    return sinks.read_online(spark, path)


@query("sink_online_merge")
def sink_online_merge(spark, folder):
    """The table after two batches and the first one again; and how many files more the last merge had to read than
    the one before it."""
    path, parts = scratch_dir(spark, "online-merge"), []
    _write_history(spark, folder, parts.append)
    files = [sinks.upsert_online(part, path) for part in (*parts, parts[0])]
    rows = spark.read.parquet(path).drop("bucket")
    return rows.withColumn("files_more", F.greatest(F.lit(0), F.lit(files[2] - files[1])))


def _log_by_day(spark, folder) -> str:
    path = scratch_dir(spark, "log-by-day")
    sinks.append_log(views.inference_log(spark, folder).select(*LOG_COLUMNS), path)
    return path


@query("scan_log_by_day")
def scan_log_by_day(spark, folder):
    return store.newest_logged(spark, _log_by_day(spark, folder), LOG_ROWS_READ).select(*LOG_COLUMNS)


@query("log_retention_by_day")
def log_retention_by_day(spark, folder):
    """The expired days are dropped from the table; the rest is read back."""
    path = _log_by_day(spark, folder)
    store.drop_expired(spark, path)
    return store.retained(spark, path).select(*LOG_COLUMNS)


@query("sink_inference_log")
def sink_inference_log(spark, folder):
    path = scratch_dir(spark, "log")
    sinks.append_log(views.inference_log(spark, folder).select(*LOG_COLUMNS), path)
    return spark.read.parquet(path).select(*LOG_COLUMNS)


@query("scan_inference_log")
def scan_inference_log(spark, folder):
    return store.newest_log_rows(views.inference_log(spark, folder).select(*LOG_COLUMNS), LOG_ROWS_READ)


@query("scan_model_cards")
def scan_model_cards(spark, folder):
    return registry.list_versions(
        views.model_versions(spark, folder), views.model_cards(spark, folder), views.pointer_log(spark, folder)
    )


@query("alerts_table")
def alerts_table(spark, folder):
    clean, labels = views.features_clean(spark, folder), views.labels_delayed(spark, folder)
    shifted = _events_long(spark, folder, factor=1.35)
    parts = [
        jobs.ingestion_alerts(gates.ingestion_gate(views.raw_landing(spark, folder))),
        jobs.transformation_alerts(gates.transformation_gate(clean, labels)),
        jobs.drift_alerts(drift.ks_drift(shifted, ["feature"])),
        jobs.psi_alerts(drift.psi(shifted.filter(F.col("feature") == "value"))),
        jobs.backfill_alerts(store.label_backfill(_predictions(spark, folder), labels)),
        registry.promotion(_champion_challenger(spark, folder), "challenger")
        .filter(F.col("alert").isNotNull())
        .select(
            F.lit("promotion").alias("source"),
            F.when(F.col("passed"), F.lit("warning")).otherwise(F.lit("critical")).alias("severity"),
            F.col("alert").alias("line"),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("log_retention")
def log_retention(spark, folder):
    return store.within_retention(views.inference_log(spark, folder).select(*LOG_COLUMNS), "request_ts")


@query("holdout_table")
def holdout_table(spark, folder):
    path = scratch_dir(spark, "holdout")
    folds = sampling.split_folds(views.features_clean(spark, folder))
    folds.filter(F.col("fold") != "train").select("entity_id", *config.FEATURES, "label").write.parquet(path)
    return spark.read.parquet(path)


# ---- projections, filters, scalar rules --------------------------------------------------------


@query("quarantine_split")
def quarantine_split(spark, folder):
    return gates.routed(views.raw_landing(spark, folder)).select("event_id", "entity_id", "route")


@query("request_validation")
def request_validation(spark, folder):
    broken = views.features_clean(spark, folder).select("entity_id", S.request_violations().alias("v"))
    return broken.select(
        "entity_id", F.array_join("v", ",").alias("violations"), (F.size("v") == 0).alias("valid")
    )


@query("feature_projection")
def feature_projection(spark, folder):
    df = views.features_clean(spark, folder)
    return df.select("entity_id", *[c for c in config.FEATURES if c in df.columns])


@query("heuristic_rule")
def heuristic_rule(spark, folder):
    flagged = views.features_clean(spark, folder).select(
        S.heuristic_flag().cast("double").alias("score"), "label"
    )
    return rounded(metrics.ranking_metrics(flagged), "average_precision", "roc_auc")


@query("tier_routing")
def tier_routing(spark, folder):
    return views.inference_log(spark, folder).select("request_id", "calibrated_score", "tier")


@query("low_confidence_flag")
def low_confidence_flag(spark, folder):
    return views.inference_log(spark, folder).select("request_id", "calibrated_score", "low_confidence")


@query("label_availability")
def label_availability(spark, folder):
    return views.labels_delayed(spark, folder).select(
        "entity_id", "event_timestamp", "label_observed_timestamp"
    )


@query("predict_at_cutoff")
def predict_at_cutoff(spark, folder):
    return views.inference_log(spark, folder).select(
        "request_id", S.predict_at(F.col("calibrated_score")).alias("pred")
    )


@query("log_to_predictions")
def log_to_predictions(spark, folder):
    return store.log_to_predictions(views.inference_log(spark, folder))


@query("psi_band")
def psi_band(spark, folder):
    return drift.psi(_events_long(spark, folder), ["feature"]).select("feature", "psi", "interpretation")


@query("json_pack_unpack")
def json_pack_unpack(spark, folder):
    unpacked = table(spark, folder, "events").select(
        "event_id", F.col("value").alias("spend"), F.from_json("props", "k bigint")["k"].alias("k")
    )
    packed = unpacked.withColumn("features_json", F.to_json(F.struct("spend", "k")))
    back = F.from_json("features_json", "spend double, k bigint")
    return packed.select("event_id", "features_json", back["spend"].alias("spend"), back["k"].alias("k"))


@query("drop_incomplete")
def drop_incomplete(spark, folder):
    joined = asof.pit_join(views.label_events(spark, folder), views.feature_history(spark, folder))
    return joined.na.drop()


@query("sticky_bucket")
def sticky_bucket(spark, folder):
    keyed = table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"), S.sticky_bucket(views.customer_key()).alias("bucket")
    )
    return keyed.withColumn("served_by", S.pick_variant(F.col("bucket"), views.CANARY_PCT))


@query("version_id")
def version_id(spark, folder):
    return table(spark, folder, "events").select("event_id", S.version_id(F.col("ts")).alias("version"))


@query("status_action_text")
def status_action_text(spark, folder):
    checks = gates.ingestion_gate(views.raw_landing(spark, folder))
    line = F.format_string("[%s] %s: %s", S.check_status(F.col("passed")), "check_name", "action")
    return checks.select("check_name", line.alias("line"))


@query("relabel_where")
def relabel_where(spark, folder):
    flip = F.col("satisfaction_score") > 4.0
    return views.features_clean(spark, folder).select(
        "entity_id", F.when(flip, 1 - F.col("label")).otherwise(F.col("label")).alias("label")
    )


def _events_long(spark, folder, factor: float = 1.0) -> DataFrame:
    """Both event features as (feature, value, is_live); live is the second half of the month."""
    live = F.col("ts") >= F.lit(views.DRIFT_SPLIT).cast("timestamp_ntz")
    rows = table(spark, folder, "events").select(
        live.alias("is_live"),
        F.when(live, F.col("value") * factor).otherwise(F.col("value")).alias("value"),
        F.from_json("props", "k double")["k"].alias("k"),
    )
    return drift.unpivot(rows, ["is_live"], ["value", "k"])


FEATURE_SPLIT = "1998-04-15"


def _features_long(spark, folder) -> DataFrame:
    """The six model features as (feature, value, is_live)."""
    live = F.col("event_timestamp") >= F.lit(FEATURE_SPLIT).cast("timestamp_ntz")
    rows = views.features_clean(spark, folder).withColumn("is_live", live)
    return drift.unpivot(rows, ["is_live"], config.FEATURES).filter("value is not null")


@query("scale_scenario")
def scale_scenario(spark, folder):
    """One feature scaled by 1.35 in the live half; the other is the control."""
    long = _events_long(spark, folder, factor=1.35)
    ks = drift.ks_drift(long, ["feature"]).select("feature", "ks_stat", "drifted")
    return ks.join(drift.psi(long, ["feature"]).select("feature", "psi", "interpretation"), "feature")


# ---- joins -------------------------------------------------------------------------------------


@query("pit_join")
def pit_join(spark, folder):
    return asof.pit_join(views.label_events(spark, folder), views.feature_history(spark, folder))


@query("pit_training_set")
def pit_training_set(spark, folder):
    return asof.pit_training_set(views.label_events(spark, folder), views.feature_history(spark, folder))


def _prepared_history(spark, folder) -> history.PreparedHistory:
    """The first half of the month, prepared, and the rest appended."""
    parts = []
    _write_history(spark, folder, parts.append)
    first, rest = (p.withColumn("feature_ts", F.col("ts")) for p in parts)
    prepared = history.prepare(first, ["entity_id"], "ts", "write_seq", ["feature_ts", "spend", "k"])
    history.append(prepared, rest)
    return prepared


@query("pit_join_prepared")
def pit_join_prepared(spark, folder):
    """The labels against bucketed history: only the labels are shuffled."""
    return history.asof(views.label_events(spark, folder), _prepared_history(spark, folder), "label_timestamp")


@query("pit_training_set_prepared")
def pit_training_set_prepared(spark, folder):
    return pit_join_prepared(spark, folder).filter(F.col("feature_ts").isNotNull())


@query("leakage_report")
def leakage_report(spark, folder):
    out = store.leakage_report(views.label_events(spark, folder), views.feature_history(spark, folder))
    return rounded(out, "auc_leaky", "auc_pit")


@query("leakage_fitted")
def leakage_fitted(spark, folder):
    """A committee learned from each kind of join, and what it scores on its own rows."""
    out = store.leakage_fitted(views.label_events(spark, folder), views.feature_history(spark, folder), SPEND_AND_K)
    return rounded(out, "average_precision", "roc_auc")


def _predictions(spark, folder) -> DataFrame:
    return views.scored(spark, folder).select("entity_id", F.col("score").alias("calibrated_score"))


@query("label_backfill")
def label_backfill(spark, folder):
    """Against the labels that have arrived by the middle of the period, and by its end."""
    labels = views.labels_delayed(spark, folder)
    out = store.label_backfills(_predictions(spark, folder), labels, ["1998-04-15", "2002-01-01"])
    return rounded(out, "precision", "recall", "f1")


@query("referential_integrity")
def referential_integrity(spark, folder):
    return gates.referential_integrity(
        views.features_clean(spark, folder), views.labels_delayed(spark, folder), "entity_id"
    )


def _online(spark, folder) -> DataFrame:
    return asof.latest(views.feature_history(spark, folder), ["entity_id"], ["write_seq"])


NOW = "2024-01-31"


@query("reconcile")
def reconcile(spark, folder):
    return store.reconcile(
        _online(spark, folder),
        views.feature_history(spark, folder),
        F.lit(NOW).cast("timestamp_ntz"),
        SPEND_AND_K,
    )


@query("serving_state")
def serving_state(spark, folder):
    return registry.serving_state(
        views.pointer_log(spark, folder), views.model_cards(spark, folder), views.CANARY_PCT
    )


def _two_model_scores(spark, folder) -> DataFrame:
    """(version, slice, label, score, n) of the stronger and the weaker model, from one scan.

    Rows are counted before they are taken into their slices.
    """
    lineitem = table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        "l_quantity",
        views.request_score(0.15).alias("champion"),
        views.request_score(0.05).alias("challenger"),
    )
    scored = materialized(lineitem, "two-models")
    edge = running.exact_quantiles(scored, "l_quantity", [0.75], alias="q").select(F.col("q")[0]).scalar()
    both = F.array(
        *[F.struct(F.lit(v).alias("version"), F.col(v).alias("score")) for v in ("champion", "challenger")]
    )
    rows = scored.select("label", (F.col("l_quantity") >= edge).alias("_hard"), F.inline(both))
    counts = rows.groupBy("version", "_hard", "label", "score").agg(F.count(F.lit(1)).alias("n"))
    return registry.slices_of(counts, F.col("_hard"), SLICES).select("version", "slice", "label", "score", "n")


def _champion_challenger(spark, folder) -> DataFrame:
    metrics_of = registry.slice_metrics(_two_model_scores(spark, folder), "n")
    return registry.champion_challenger(metrics_of, "challenger", "champion")


AP_COLUMNS = ("champion_ap", "champion_auc", "challenger_ap", "challenger_auc")


@query("champion_challenger")
def champion_challenger(spark, folder):
    return rounded(rounded(_champion_challenger(spark, folder), *AP_COLUMNS), "regression", digits=5)


@query("route_requests")
def route_requests(spark, folder):
    requests = table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"),
        views.customer_key().alias("entity_id"),
        F.least(F.lit(1.0), F.col("value") / 200.0).alias("champion_score"),
        F.least(F.lit(1.0), F.col("value") / 250.0).alias("challenger_score"),
    )
    rows = table(spark, folder, "lineitem").select(
        views.request_score(0.15).alias("old"),
        views.request_score(0.05).alias("new"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )
    grid = metrics.COST_GRID
    # A row for each threshold of both models, read for either one.
    curves = metrics.cost_curves(rows, {"old": (F.col("old"), grid), "new": (F.col("new"), grid)})
    curves = materialized(curves, "cost-curves")
    cuts = [metrics.boundaries(curves.filter(F.col("curve") == name)) for name in ("old", "new")]
    return routing.route_requests(requests, *cuts, views.CANARY_PCT)


@query("hash_equi_merge")
def hash_equi_merge(spark, folder):
    labels = views.labels_delayed(spark, folder).select("entity_id", "label")
    return lookup_join(_predictions(spark, folder), labels, ["entity_id"], "inner")


# ---- aggregations and statistics ---------------------------------------------------------------


@query("ingestion_gate")
def ingestion_gate(spark, folder):
    return gates.ingestion_gate(views.raw_landing(spark, folder))


@query("volume_check")
def volume_check(spark, folder):
    checks = gates.ingestion_gate(views.raw_landing(spark, folder))
    return checks.filter(F.col("check_name") == config.CHECK_VOLUME).select(
        F.col("observed").alias("row_count"), F.col("share").alias("drop_pct"), "passed"
    )


@query("rolling_volume_check")
def rolling_volume_check(spark, folder):
    out = gates.rolling_volume_check(views.raw_landing(spark, folder), "event_timestamp")
    return rounded(out, "baseline", "drop_share")


@query("unique_not_null")
def unique_not_null(spark, folder):
    keys = gates.unique_not_null(views.features_clean(spark, folder), "entity_id")
    landed = gates.unique_not_null(views.raw_landing(spark, folder), "entity_id")
    return keys.withColumn("source", F.lit("features")).unionByName(
        landed.withColumn("source", F.lit("landing"))
    )


@query("transformation_gate")
def transformation_gate(spark, folder):
    return gates.transformation_gate(
        views.features_clean(spark, folder), views.labels_delayed(spark, folder)
    )


@query("class_balance")
def class_balance(spark, folder):
    out = metrics.class_balance(views.features_clean(spark, folder))
    return rounded(out, "positive_rate", "scale_pos_weight")


@query("confusion_at_threshold")
def confusion_at_threshold(spark, folder):
    return metrics.confusion(views.scored(spark, folder), [0.2, 0.5, 0.8])


@query("cost_threshold")
def cost_threshold(spark, folder):
    """Both tier boundaries on the fine grid, and the 10:1 search on the coarse one."""
    score = F.col("score")
    curves = metrics.cost_curves(
        views.scored(spark, folder), {"fine": (score, metrics.COST_GRID), "coarse": (score, metrics.COARSE_GRID)}
    )
    curves = materialized(curves, "cost-curves")
    of = lambda name: curves.filter(F.col("curve") == name)
    fine = metrics.cheapest(of("fine"), {"low": config.COST_LOW, "high": config.COST_HIGH})
    coarse = metrics.cheapest(of("coarse"), {"ten_to_one": (10, 1)})
    return rounded(fine.unionByName(coarse), "threshold", digits=9)


@query("precision_recall_f1")
def precision_recall_f1(spark, folder):
    preds = views.scored(spark, folder).withColumn("pred", S.predict_at(F.col("score")))
    return rounded(metrics.precision_recall_f1(preds), "precision", "recall", "f1")


@query("cascade_thresholds")
def cascade_thresholds(spark, folder):
    return rounded(metrics.cascade_thresholds(views.scored(spark, folder)), "t_low", "t_high", digits=9)


@query("average_precision")
def average_precision(spark, folder):
    out = metrics.ranking_metrics(views.scored(spark, folder)).select("n_rows", "n_pos", "average_precision")
    return rounded(out, "average_precision")


@query("roc_auc")
def roc_auc(spark, folder):
    """On request scores, and on document length against the quality labels."""
    requests = metrics.ranking_metrics(views.scored(spark, folder)).select(
        F.lit("requests").alias("source"), "n_rows", "roc_auc"
    )
    texts = metrics.ranking_metrics(views.document_scores(spark, folder)).select(
        F.lit("documents").alias("source"), "n_rows", "roc_auc"
    )
    return rounded(requests.unionByName(texts), "roc_auc")


@query("quantile_bins")
def quantile_bins(spark, folder):
    probs = [i * 0.1 for i in range(1, 10)] + [0.75]
    edges = running.exact_quantiles(views.features_clean(spark, folder), "monthly_spend", probs)
    out = edges.select(F.posexplode("quantiles").alias("position", "edge"))
    return rounded(out, "edge")


@query("ks_two_sample")
def ks_two_sample(spark, folder):
    """All six features of the orders, before and after the middle of the period."""
    out = drift.ks_drift(_features_long(spark, folder), ["feature"])
    return out.withColumn("any_drift", F.bool_or("drifted").over(W.partitionBy(F.lit(0))))


@query("ks_library_p")
def ks_library_p(spark, folder):
    """The same report with the p-values that statistics libraries give: exact for small samples, else finite-n."""
    return drift.ks_drift(_features_long(spark, folder), ["feature"], exact=True)


@query("ks_baseline_log")
def ks_baseline_log(spark, folder):
    """The features that were known when models were trained against those that requests were served with."""
    both = drift.two_samples(views.feature_history(spark, folder), views.inference_log(spark, folder), SPEND_AND_K)
    return drift.ks_drift(both, ["feature"])


@query("psi")
def psi(spark, folder):
    long = _events_long(spark, folder, factor=1.35).filter(F.col("feature") == "value")
    return drift.psi(long)


@query("reliability_curve")
def reliability_curve(spark, folder):
    out = metrics.reliability_curve(views.scored(spark, folder))
    return rounded(out, "mean_predicted", "observed_rate")


@query("roc_curve_youden")
def roc_curve_youden(spark, folder):
    return rounded(metrics.youden_threshold(views.scored(spark, folder)), "j", "fpr", "tpr")


@query("roc_curve")
def roc_curve(spark, folder):
    """The origin's infinite threshold is shown as null."""
    curve = rounded(metrics.roc_curve(views.scored(spark, folder)), "fpr", "tpr")
    return curve.withColumn("threshold", F.nullif("threshold", F.lit(float("inf"))))


@query("pr_curve")
def pr_curve(spark, folder):
    return rounded(metrics.pr_curve(views.scored(spark, folder)), "precision", "recall")


@query("concept_vs_data_drift")
def concept_vs_data_drift(spark, folder):
    live = F.col("event_timestamp") >= F.lit(views.CONCEPT_SPLIT).cast("timestamp_ntz")
    out = jobs.concept_drift_report(
        views.features_clean(spark, folder), live, F.col("satisfaction_score") > 4.0, "support_tickets_30d"
    )
    return rounded(out, "f1_before", "f1_after")


@query("concept_drift_fitted")
def concept_drift_fitted(spark, folder):
    """A committee learned before the split, with a cut at the positives' share, on both sides of it."""
    live = F.col("event_timestamp") >= F.lit(views.CONCEPT_SPLIT).cast("timestamp_ntz")
    out = jobs.concept_drift_fitted(views.features_clean(spark, folder), live, F.col("satisfaction_score") > 4.0)
    return rounded(out, "f1_before", "f1_after")


def _tiered(spark, folder) -> DataFrame:
    scored = views.scored(spark, folder)
    cuts = routing.as_struct(metrics.cascade_thresholds(scored)).scalar()
    rows = scored.select("label", "score", cuts.alias("_t"))
    return rows.select("label", S.tier(F.col("score"), F.col("_t.t_low"), F.col("_t.t_high")).alias("tier"))


@query("tier_distribution")
def tier_distribution(spark, folder):
    return rounded(metrics.tier_distribution(_tiered(spark, folder)), "positive_rate")


@query("recall_above_low")
def recall_above_low(spark, folder):
    return rounded(metrics.recall_above_low(_tiered(spark, folder)), "recall")


def canary_stage():
    """The rollout's four stages, a week of the month each."""
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    ts = F.col("request_ts")
    first, second, third, full = config.CANARY_STAGES
    return (
        F.when(ts < at("2024-01-08"), F.lit(first))
        .when(ts < at("2024-01-15"), F.lit(second))
        .when(ts < at("2024-01-22"), F.lit(third))
        .otherwise(F.lit(full))
    )


@query("canary_sla")
def canary_sla(spark, folder):
    log = views.inference_log(spark, folder).select("entity_id", "request_ts", "is_error")
    return rounded(routing.canary_sla(log, canary_stage()), "error_rate", digits=9)


@query("threshold_alarm")
def threshold_alarm(spark, folder):
    log = views.inference_log(spark, folder).select("request_ts", "served_by", "is_error")
    return routing.threshold_alarm(log, "request_ts", ["served_by"])


@query("hitl_fast_read")
def hitl_fast_read(spark, folder):
    reviewed = sampling.sample_rows(
        views.features_clean(spark, folder), config.REVIEW_SAMPLE_ROWS, "entity_id", 5
    ).withColumn("pred", S.heuristic_flag())
    return rounded(metrics.precision_recall_f1(reviewed), "precision", "recall", "f1")


@query("online_offline_mismatch_summary")
def online_offline_mismatch_summary(spark, folder):
    return store.mismatch_summary(
        _online(spark, folder),
        views.feature_history(spark, folder),
        F.lit(NOW).cast("timestamp_ntz"),
        SPEND_AND_K,
    )


@query("eval_slices")
def eval_slices(spark, folder):
    folds = sampling.split_folds(views.features_clean(spark, folder))
    holdout = folds.filter(F.col("fold") != "train").select("entity_id", "support_tickets_30d", "label")
    return registry.eval_slices(materialized(holdout, "holdout"))


# ---- windows -----------------------------------------------------------------------------------


@query("latest_per_entity")
def latest_per_entity(spark, folder):
    """The newest value by event time, and the current value by write order."""
    rows = views.feature_history(spark, folder)
    by_time = asof.latest(rows, ["entity_id"], ["ts", "write_seq"]).withColumn("basis", F.lit("time"))
    by_write = _online(spark, folder).withColumn("basis", F.lit("write"))
    return by_time.unionByName(by_write)


@query("asof_frame")
def asof_frame(spark, folder):
    """The running last known high spend of each entity, at every snapshot."""
    marked = views.feature_history(spark, folder).withColumn("last_high", F.when(F.col("spend") >= 50, F.col("spend")))
    return asof.running_last(marked, ["entity_id"], ["ts", "write_seq"], "last_high").select(
        "entity_id", "ts", "write_seq", "last_high"
    )


@query("dedupe_last_write")
def dedupe_last_write(spark, folder):
    """Snapshots kept by the hour: the last write of each hour stands."""
    hourly = views.feature_history(spark, folder).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return asof.dedupe_last_write(hourly, ["entity_id", "ts"])


@query("cumulative_counts")
def cumulative_counts(spark, folder):
    counts = metrics.score_counts(views.scored(spark, folder))
    return running.running_totals(counts, "score", ["pos", "neg"], descending=True)


@query("rollback_target")
def rollback_target(spark, folder):
    pointers = materialized(views.pointer_log(spark, folder), "pointers")
    return store.previous_pointer(pointers, ["model", "stage"])


@query("duplicate_rows")
def duplicate_rows(spark, folder):
    return gates.duplicate_rows(views.raw_landing(spark, folder), "entity_id", "event_id")


# ---- sort, limit, sets, sampling ---------------------------------------------------------------


@query("sort_by_event_time")
def sort_by_event_time(spark, folder):
    return views.raw_landing(spark, folder).orderBy("event_timestamp", "event_id")


@query("latest_version")
def latest_version(spark, folder):
    return registry.latest_version(views.model_cards(spark, folder))


@query("top_orphans")
def top_orphans(spark, folder):
    orphans = gates.orphan_keys(
        views.features_clean(spark, folder), views.labels_delayed(spark, folder), "entity_id"
    )
    return orphans.orderBy("entity_id").limit(5)


@query("key_difference")
def key_difference(spark, folder):
    features = views.features_clean(spark, folder).select("entity_id")
    return features.subtract(views.labels_delayed(spark, folder).select("entity_id"))


@query("concat_blocks")
def concat_blocks(spark, folder):
    """Positive and negative rows, selected apart and put together again."""
    rows = table(spark, folder, "events").select("event_id", "event_type", "value")
    positive = F.col("event_type") == "purchase"
    yes = rows.filter(positive).withColumn("label", F.lit(1))
    return yes.unionByName(rows.filter(~positive).withColumn("label", F.lit(0)))


@query("stratified_split")
def stratified_split(spark, folder):
    return sampling.split_folds(views.features_clean(spark, folder)).select("entity_id", "label", "fold")


@query("shuffle_rows")
def shuffle_rows(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "value")
    return sampling.shuffled(rows, "event_id", 42)


@query("hash_sample_n")
def hash_sample_n(spark, folder):
    rows = views.features_clean(spark, folder).select("entity_id", "avg_message_length", "label")
    return sampling.sample_rows(rows, 2000, "entity_id", 1)


# ---- promotion and gate chains -----------------------------------------------------------------


@query("promote")
def promote(spark, folder):
    """The weaker model against the stronger one and the other way round, dry and for real."""
    metrics_of = materialized(registry.slice_metrics(_two_model_scores(spark, folder), "n"), "slice-metrics")
    out = None
    for version, champion in (("challenger", "champion"), ("champion", "challenger")):
        per_slice = materialized(registry.champion_challenger(metrics_of, version, champion), "contest")
        worst = per_slice.agg(
            F.struct(
                F.min("challenger_ap").alias("challenger_ap"),
                F.min("champion_ap").alias("champion_ap"),
                F.max("regression").alias("regression"),
            )
        ).scalar()
        for dry in (False, True):
            part = registry.promotion(per_slice, version, dry).withColumn("_w", worst).select("*", "_w.*").drop("_w")
            out = part if out is None else out.unionByName(part)
    return rounded(rounded(out, "challenger_ap", "champion_ap"), "regression", digits=5)


@query("gate_chain")
def gate_chain(spark, folder):
    """The full run on landed rows, and a retrain on all features, which starts at gate two."""
    features, labels = views.features_clean(spark, folder), views.labels_delayed(spark, folder)
    keyless = F.col("n_lines") == 0
    landed = features.withColumn("entity_id", F.when(~keyless, F.col("entity_id")))
    ingested = gates.ingestion_gate(landed).agg(F.bool_and("batch_passed").alias("passed"))
    verdict = lambda rows: gates.transformation_gate(rows, labels).agg(F.bool_and("passed").alias("passed"))
    balance = sampling.split_folds(features).filter(F.col("fold") == "train").groupBy().agg(
        (F.count_if(F.col("label") == 1) > 0).alias("_p"), (F.count_if(F.col("label") == 0) > 0).alias("_n")
    )
    trainable = balance.select((F.col("_p") & F.col("_n")).alias("passed"))
    promoted = materialized(registry.gate_verdict(_champion_challenger(spark, folder)), "verdict")
    full = jobs.gate_chain(
        "full",
        [
            ("ingestion_gate", ingested),
            ("transformation_gate", verdict(gates.clean_rows(landed))),
            ("train", trainable),
            ("promotion_gate", promoted),
        ],
    )
    retrain = jobs.gate_chain(
        "retrain",
        [("transformation_gate", verdict(features)), ("train", trainable), ("promotion_gate", promoted)],
    )
    return full.unionByName(retrain)


# ---- models ------------------------------------------------------------------------------------

# What boosting finds cannot be written down in SQL, but what must hold of it can: those queries return facts. A
# committee of one-cut trees can: its nodes, scores, tiers and metrics are compared number by number.

DATA_VERSION = "catalogue"


def _keyed(spark, folder) -> DataFrame:
    """The rows that gate one lets through: orders without lines have lost their key."""
    return views.features_clean(spark, folder).filter(F.col("n_lines") > 0)


def _run(spark, folder) -> tuple[str, DataFrame]:
    """A full run over ``folder``, from landed rows to a promoted model: its root and steps.

    The run is the session's: a query that needs it starts it, or goes on with it, by its ledger.
    """
    run = f"{spark.sparkContext.applicationId}-{zlib.crc32(folder.encode()):08x}"
    root = f"{scratch_root(spark)}/registry-{run}"
    features = views.features_clean(spark, folder)
    landed = features.withColumn("entity_id", F.when(F.col("n_lines") > 0, F.col("entity_id"))).drop("n_lines")
    return root, jobs.full_run(landed, views.labels_delayed(spark, folder), root, DATA_VERSION)


def _registered(spark, folder) -> tuple[str, str]:
    """The registry folder and the version in production."""
    root, _ = _run(spark, folder)
    return root, jobs.pointer(spark, root, "production")


@query("full_run")
def full_run(spark, folder):
    return _run(spark, folder)[1]


def _committee(spark, folds: DataFrame, root: str, version: str, train: DataFrame) -> tuple[Column, tuple[float, float]]:
    """Fits a committee, sets its thresholds, registers it, and loads it again: its score and thresholds."""
    nodes = materialized(trees.committee(train, config.FEATURES), "nodes")
    score = trees.score_column(nodes, trees.MEAN)
    cuts = metrics.cascade_thresholds(models.fold(folds, "calibration").select("label", score.alias("score"))).first()
    trees.register_nodes(nodes, root, version, trees.MEAN, (cuts["t_low"], cuts["t_high"]))
    loaded, link, thresholds = trees.load_nodes(spark, root, version)
    return trees.score_column(loaded, link), thresholds


def _one_committee(spark, folder) -> tuple[DataFrame, str, Column, tuple[float, float]]:
    folds, root = _folds(spark, folder), scratch_dir(spark, "committee")
    return folds, root, *_committee(spark, folds, root, "whole", models.fold(folds, "train"))


@query("promote_registered")
def promote_registered(spark, folder):
    """A version that learned from young customers alone, in production, against one that learned from all."""
    folds, root = _folds(spark, folder), scratch_dir(spark, "committees")
    train = models.fold(folds, "train")
    young, _ = _committee(spark, folds, root, "v1", train.filter(F.col("tenure_days") < 1000))
    whole, _ = _committee(spark, folds, root, "v2", train)
    holdout = registry.eval_slices(materialized(models.fold(folds, "calibration", "test"), "holdout"))
    both = F.array(*[F.struct(F.lit(v).alias("version"), c.alias("score")) for v, c in (("v1", young), ("v2", whole))])
    scores = holdout.select("slice", "label", F.inline(both))
    per_slice = materialized(
        registry.champion_challenger(registry.slice_metrics(scores), "v2", "v1"), "contest"
    )
    move = registry.promotion(per_slice, "v2").select(F.struct("stage", "alert").alias("m")).scalar()
    out = per_slice.withColumn("_m", move).select("*", "_m.stage", "_m.alert").drop("_m")
    return rounded(rounded(out, *AP_COLUMNS), "regression", digits=5)


@query("score_psi")
def score_psi(spark, folder):
    """Logged scores against the scores that the version in production gives the training features."""
    root, _ = _registered(spark, folder)
    log = views.inference_log(spark, folder).select("calibrated_score")
    out = jobs.champion_score_psi(views.features_clean(spark, folder), log, root)
    return out.select(
        "status",
        "n_live",
        (F.col("psi") >= 0).alias("not_negative"),
        (F.col("interpretation") == S.psi_band(F.col("psi"))).alias("band_agrees"),
    )


def _bundle(spark, folder) -> models.Bundle:
    root, version = _registered(spark, folder)
    return models.load(spark, root, version)


def _folds(spark, folder) -> DataFrame:
    return models.folds(_keyed(spark, folder))


def _within(score: str) -> Column:
    return F.bool_and(F.col(score).between(0.0, 1.0)).alias("in_range")


def _ranked_facts(scored: DataFrame, score: str, by: list[str] | None = None) -> DataFrame:
    """Rows, positives, whether scores are probabilities and rank better than chance."""
    by = by or []
    scored = materialized(scored.select(*by, "label", score), "scored")
    ranked = metrics.ranking_metrics(scored, score=score, by=by)
    chance = F.col("n_pos") / F.col("n_rows")
    better = (F.col("average_precision") > chance) & (F.col("average_precision") <= 1) & (F.col("roc_auc") > 0.5)
    facts = ranked.select(*by, "n_rows", "n_pos", better.alias("beats_chance"))
    inside = scored.groupBy(*by).agg(_within(score))
    return facts.join(inside, by) if by else facts.withColumn("in_range", inside.scalar())


@query("linear_l1_l2")
def linear_l1_l2(spark, folder):
    folds = _folds(spark, folder)
    train, test = models.fold(folds, "train"), models.fold(folds, "calibration", "test")
    parts = [
        models.raw_scores(models.fit_linear(train, penalty), test).select(F.lit(penalty).alias("penalty"), "label", "raw")
        for penalty in ("l1", "l2")
    ]
    return _ranked_facts(parts[0].unionByName(parts[1]), "raw", ["penalty"])


@query("boosted_trees")
def boosted_trees(spark, folder):
    folds = _folds(spark, folder)
    model = _bundle(spark, folder).model
    facts = _ranked_facts(models.raw_scores(model, models.fold(folds, "calibration", "test")), "raw")
    n_rows, weight = models.balance(models.fold(folds, "train"))
    return facts.select(
        "*",
        F.lit(model.getNumTrees).alias("trees"),
        F.lit(max(t.depth for t in model.trees) <= models.BOOSTED["depth"]).alias("shallow"),
        F.lit(n_rows).cast("bigint").alias("n_train"),
        F.round(F.lit(float(weight)), 6).alias("scale_pos_weight"),
    )


def _raw_calibration(spark, folder) -> DataFrame:
    """Calibration rows with a linear model's raw score."""
    folds = _folds(spark, folder)
    model = models.fit_linear(models.fold(folds, "train"), "l2")
    return materialized(models.raw_scores(model, models.fold(folds, "calibration")).select("label", "raw"), "raw")


@query("platt_scaling")
def platt_scaling(spark, folder):
    """A fitted intercept makes the calibrated scores add up to the positives."""
    rows = _raw_calibration(spark, folder)
    platt = models.fit_platt(rows)
    scored = rows.withColumn("calibrated_score", platt.column(F.col("raw")))
    residual = F.abs(F.sum("calibrated_score") - F.sum("label"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("label").cast("bigint")).alias("n_pos"),
        _within("calibrated_score"),
        (residual < 0.01 * F.sum("label")).alias("adds_up"),
        F.lit(platt.slope > 0).alias("increasing"),
    )


@query("isotonic")
def isotonic(spark, folder):
    """Every pool's value is the mean label of its rows, and pools ascend with the score."""
    rows = _raw_calibration(spark, folder)
    fitted = models.fit_isotonic(rows)
    # Cell by cell, as it was fitted: the value of a cell is that of its mean score.
    cells = rows.groupBy(F.floor(F.col("raw") * models.ISOTONIC_CELLS).alias("cell")).agg(
        F.avg("raw").alias("raw"), F.sum(F.col("label").cast("double")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    pools = fitted.transform(cells).groupBy(F.round("calibrated_score", 9).alias("value")).agg(
        F.sum("pos").alias("pos"), F.sum("n").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")
    )
    upto = W.partitionBy(F.lit(0)).orderBy("value")
    pools = pools.withColumn("ascends", F.coalesce(F.lag("high").over(upto) <= F.col("low"), F.lit(True)))
    return pools.agg(
        F.sum("n").alias("n_rows"),
        F.sum("pos").cast("bigint").alias("n_pos"),
        F.bool_and(F.abs(F.col("pos") / F.col("n") - F.col("value")) < 1e-6).alias("pools_are_means"),
        F.bool_and("ascends").alias("increasing"),
    )


@query("batch_score")
def batch_score(spark, folder):
    """Every entity with the registered committee's score, tier and flag."""
    _, _, score, (low, high) = _one_committee(spark, folder)
    scored = views.features_clean(spark, folder).select("entity_id", score.alias("calibrated_score"))
    score = F.col("calibrated_score")
    out = scored.withColumns({"tier": S.tier(score, low, high), "low_confidence": S.low_confidence(score, F.lit(low), F.lit(high))})
    return rounded(out, "calibrated_score", digits=9)


def _eval_sets() -> Column:
    both = F.array(F.lit("holdout"), F.lit("untouched"))
    return F.explode(F.when(F.col("fold") == "test", both).otherwise(F.array(F.lit("holdout")))).alias("eval_set")


@query("evaluate_on")
def evaluate_on(spark, folder):
    """On the whole holdout, whose first half set calibrator and thresholds, and on the rest alone: the metrics of the
    committee, and whether the boosted version beats chance."""
    folds, _, score, _ = _one_committee(spark, folder)
    held = models.fold(folds, "calibration", "test")
    ranked = metrics.ranking_metrics(held.select("label", score.alias("score"), _eval_sets()), by=["eval_set"])
    boosted = _bundle(spark, folder).score(held).select("label", "calibrated_score", _eval_sets())
    facts = _ranked_facts(boosted, "calibrated_score", ["eval_set"]).select("eval_set", "beats_chance", "in_range")
    return rounded(ranked.join(facts, "eval_set"), "average_precision", "roc_auc")


@query("train_and_register")
def train_and_register(spark, folder):
    """The card, read back."""
    root, version = _registered(spark, folder)
    card = spark.read.parquet(f"{root}/cards").filter(F.col("version") == version)
    cuts, numbers = F.col("thresholds"), F.col("metrics")
    return card.select(
        "data_version",
        "stage",
        F.col("hyperparameters")["maxIter"].cast("int").alias("rounds"),
        numbers["n_train"].alias("n_train"),
        numbers["n_final_test"].alias("n_final_test"),
        F.round(numbers["positive_rate_train"], 6).alias("positive_rate_train"),
        (cuts["t_low"] <= cuts["t_high"]).alias("thresholds_ordered"),
        numbers["pr_auc"].between(0.0, 1.0).alias("in_range"),
    )


@query("registry_append")
def registry_append(spark, folder):
    """The nodes of a registered committee, read back."""
    _, root, _, _ = _one_committee(spark, folder)
    nodes, _, _ = trees.load_nodes(spark, root, "whole")
    return rounded(nodes, "cut", "leaf", "weight", digits=9)


@query("baseline_gaps")
def baseline_gaps(spark, folder):
    """The average precision of the rule and of the committee, and that the gaps to the fitted models add up."""
    folds, _, score, _ = _one_committee(spark, folder)
    held = models.fold(folds, "calibration", "test").select("label", score.alias("score"))
    own = metrics.ranking_metrics(held).select("average_precision").scalar()
    gaps = models.baseline_gaps(models.baseline_metrics(folds, _bundle(spark, folder).model))
    whole = F.col("boosted_ap") - F.col("heuristic_ap")
    return gaps.select(
        F.round("heuristic_ap", 6).alias("heuristic_ap"),
        F.round(own, 6).alias("committee_ap"),
        F.round(own - F.col("heuristic_ap"), 6).alias("heuristic_to_committee"),
        (F.abs(F.col("heuristic_to_linear") + F.col("linear_to_boosted") - whole) < 1e-9).alias("gaps_add_up"),
        (F.col("boosted_ap") > F.col("heuristic_ap")).alias("trees_beat_the_rule"),
    )


@query("feature_importance")
def feature_importance(spark, folder):
    """Each feature's share of what the committee's cuts take off the label's variance, and that its importances in
    boosted trees, which learn from the rows that have all features, are shares, too."""
    train = models.fold(_folds(spark, folder), "train")
    gains = trees.committee(train, config.FEATURES).filter("node = 0").select("feature", "gain")
    share = F.col("gain") / F.nullif(F.sum("gain").over(W.partitionBy(F.lit(0))), F.lit(0.0))
    own = gains.select("feature", F.round(F.coalesce(share, F.lit(0.0)), 6).alias("importance"))
    complete = train.dropna(subset=[*config.FEATURES, "label"])
    if complete.isEmpty():
        return own.withColumns({"in_range": F.lit(None).cast("boolean"), "total": F.lit(None).cast("double")})
    boosted = models.importances(spark, models.fit_boosted(complete)).select(
        "feature",
        F.col("importance").between(0.0, 1.0).alias("in_range"),
        F.round(F.sum("importance").over(W.partitionBy(F.lit(0))), 6).alias("total"),
    )
    return own.join(boosted, "feature", "left")


# ---- streams -----------------------------------------------------------------------------------

# Delays and widths of the streams; the SQL counterparts close windows by the same delay.
STREAM_DELAY = "10 minutes"
DRIFT_WIDTH = "6 hours"


@query("stream_ingestion_gate")
def stream_ingestion_gate(spark, folder):
    """Two landings, the first half of the month and the rest, each a batch."""
    root = scratch_dir(spark, "stream-gate")
    landed, first = table(spark, folder, "events"), F.col("ts") < F.lit(views.DRIFT_SPLIT).cast("timestamp_ntz")
    for part in (landed.filter(first), landed.filter(~first)):
        part.coalesce(1).write.mode("append").parquet(f"{root}/landing")
    streams.ingestion_gate(views.raw_landing_of(stream_folder(spark, f"{root}/landing", "events", 1)), root)
    return spark.read.parquet(f"{root}/checks")


@query("stream_dual_write")
def stream_dual_write(spark, folder):
    root = scratch_dir(spark, "stream-store")
    streams.dual_write(views.feature_history_of(stream_table(spark, folder, "events")), root)
    return sinks.read_online(spark, f"{root}/online")


def _log_stream(spark, folder) -> DataFrame:
    return views.inference_log_of(stream_table(spark, folder, "events"))


@query("stream_error_alarm")
def stream_error_alarm(spark, folder):
    log = _log_stream(spark, folder).select("request_ts", "is_error")
    return streams.error_alarm(log, scratch_dir(spark, "stream-alarm"), STREAM_DELAY)


@query("stream_hourly_drift")
def stream_hourly_drift(spark, folder):
    split = F.lit(views.DRIFT_SPLIT).cast("timestamp_ntz")
    baseline = table(spark, folder, "events").filter(F.col("ts") < split).select("value")
    live = stream_table(spark, folder, "events").filter(F.col("ts") >= split).select("ts", "value")
    root = scratch_dir(spark, "stream-drift")
    return streams.windowed_drift(baseline, live, "value", "ts", root, STREAM_DELAY, DRIFT_WIDTH)


def _prediction_rows(lineitem: DataFrame) -> DataFrame:
    return views.scored_of(lineitem).select(
        "entity_id", F.col("score").alias("calibrated_score"), F.col("ts").alias("predicted_at")
    )


def _label_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        views.order_key("o_orderkey").alias("entity_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        S.label_available_at(F.col("o_orderdate")).alias("label_observed_at"),
    )


@query("stream_label_delay_join")
def stream_label_delay_join(spark, folder):
    return streams.label_delay_join(
        _prediction_rows(stream_table(spark, folder, "lineitem")),
        _label_rows(stream_table(spark, folder, "orders")),
        scratch_dir(spark, "stream-labels"),
    )


def _land_in_turn(parts: list[DataFrame], path: str) -> Iterator[None]:
    """Lands one part after the other; the stream runs in between, from where it stopped."""
    for part in parts:
        part.write.mode("append").parquet(path)
        yield


def _thirds(df: DataFrame, at: Column, cuts: tuple[str, str]) -> list[DataFrame]:
    first, second = (F.lit(c).cast("timestamp_ntz") for c in cuts)
    return [df.filter(at < first), df.filter((at >= first) & (at < second)), df.filter(at >= second)]


LANDINGS = ("1996-01-01", "1999-01-01")


@query("stream_label_outcomes")
def stream_label_outcomes(spark, folder):
    """Predictions and labels land in three parts by their time, and the stream goes on after each."""
    root = scratch_dir(spark, "stream-outcomes")
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    landings = zip(
        _land_in_turn(_thirds(lines, F.col("l_shipdate"), LANDINGS), f"{root}/lines"),
        _land_in_turn(_thirds(orders, S.label_available_at(F.col("o_orderdate")), LANDINGS), f"{root}/orders"),
    )
    for _ in landings:
        out = streams.label_outcomes(
            _prediction_rows(stream_folder(spark, f"{root}/lines", "lineitem")),
            _label_rows(stream_folder(spark, f"{root}/orders", "orders")),
            root,
        )
    return out


ROLLOUT_DAYS = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"]


@query("stream_canary_rollout")
def stream_canary_rollout(spark, folder):
    """The rollout's four weeks as they happen: events land in three parts."""
    root = scratch_dir(spark, "stream-rollout")
    stages = list(zip(config.CANARY_STAGES, ROLLOUT_DAYS, ROLLOUT_DAYS[1:]))
    for _ in _land_in_turn(_thirds(table(spark, folder, "events"), F.col("ts"), ("2024-01-10", "2024-01-20")), f"{root}/events"):
        log = views.inference_log_of(stream_folder(spark, f"{root}/events", "events"))
        out = streams.rollout(log.select("entity_id", "request_ts", "is_error"), root, stages, STREAM_DELAY)
    return rounded(out, "error_rate", digits=9)


@query("stream_window_ks")
def stream_window_ks(spark, folder):
    """The live half of the month lands in three parts; every window's exact distance from the first half."""
    split = F.lit(views.DRIFT_SPLIT).cast("timestamp_ntz")
    events = table(spark, folder, "events")
    root = scratch_dir(spark, "stream-ks")
    parts = _thirds(events.filter(F.col("ts") >= split), F.col("ts"), ("2024-01-19", "2024-01-25"))
    baseline = events.filter(F.col("ts") < split).select("value")
    for _ in _land_in_turn(parts, f"{root}/events"):
        live = stream_folder(spark, f"{root}/events", "events").select("ts", "value")
        out = streams.windowed_ks(baseline, live, "value", "ts", root, 10, DRIFT_WIDTH)
    return rounded(out, "d")


@query("stream_canary_sla")
def stream_canary_sla(spark, folder):
    log = _log_stream(spark, folder).select("request_ts", "served_by", "is_error")
    return rounded(streams.canary_windows(log, scratch_dir(spark, "stream-canary"), STREAM_DELAY), "error_rate")


def request_rows(lineitem: DataFrame) -> DataFrame:
    """Requests with all six features; high prices put the spend out of bounds."""
    return lineitem.select(
        views.order_key("l_orderkey").alias("entity_id"),
        F.col("l_linenumber").cast("double").alias("support_tickets_30d"),
        (F.col("l_extendedprice") / 10.0).alias("avg_message_length"),
        (1.0 + F.col("l_discount") * 40.0).alias("satisfaction_score"),
        F.col("l_quantity").alias("days_since_last_login"),
        F.col("l_suppkey").cast("double").alias("tenure_days"),
        (F.col("l_extendedprice") * 12.0).alias("monthly_spend"),
        views.request_score(0.15).alias("calibrated_score"),
    )


@query("stream_validate_route")
def stream_validate_route(spark, folder):
    root = scratch_dir(spark, "stream-requests")
    streams.validate_and_route(
        request_rows(stream_table(spark, folder, "lineitem")),
        root,
        views.CANARY_PCT,
        views.SERVING_T_LOW,
        views.SERVING_T_HIGH,
    )
    rows = spark.read.parquet(f"{root}/rows").drop("batch_id", *config.FEATURES)
    return rows.withColumn("valid", F.col("valid").cast("boolean"))


@query("stream_dedup_log")
def stream_dedup_log(spark, folder):
    """Every event delivered twice."""
    log = stream_table(spark, folder, "events").select("event_id", "ts", "value")
    return streams.dedup_log(log.unionByName(log), scratch_dir(spark, "stream-dedup"), "event_id", "ts")


@query("late_label_audit")
def late_label_audit(spark, folder):
    return streams.label_arrival(
        _prediction_rows(table(spark, folder, "lineitem")), _label_rows(table(spark, folder, "orders"))
    )
