"""Literal cases and boundaries of gates, joins, registry and rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators import asof, drift, gates, metrics, registry, routing, store

DAY = lambda d, month=1: dt.datetime(2026, month, d)


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "entity_id string")


def gate(spark, values, **kw):
    return {r["check_name"]: r for r in gates.ingestion_gate(keys(spark, values), **kw).collect()}


@pytest.mark.parametrize(
    ("values", "passed", "quarantined", "clean"),
    [
        (["a", None, "c"], False, 1, 2),
        (["a"] * 99 + [None], True, 1, 99),
        (["a", "b", "c"], True, 0, 3),
        (["a"] * 95 + [None] * 5, True, 5, 95),
        (["a"] * 94 + [None] * 6, False, 6, 94),
        ([], True, 0, 0),
    ],
)
def test_ingestion_gate(spark, values, passed, quarantined, clean):
    df = keys(spark, values)
    check = gate(spark, values)["not_null_entity_id"]
    assert (check["passed"], check["batch_passed"], check["observed"]) == (passed, passed, quarantined)
    assert gates.quarantined_rows(df).count() == quarantined
    assert gates.clean_rows(df).count() == clean


def test_zero_tolerance_blocks_any_null(spark):
    assert not gate(spark, ["a"] * 99 + [None], tolerance=0.0)["not_null_entity_id"]["passed"]


@pytest.mark.parametrize(("rows", "passed"), [(14_000, False), (14_001, True), (13_999, False), (20_000, True)])
def test_volume_at_the_limit(spark, rows, passed):
    df = spark.range(rows).select(F.col("id").cast("string").alias("entity_id"))
    checks = {r["check_name"]: r for r in gates.ingestion_gate(df).collect()}
    assert checks["row_count_volume_check"]["passed"] is passed
    assert checks["not_null_entity_id"]["batch_passed"]


def test_nulls_count_as_equal_duplicates(spark):
    row = gates.unique_not_null(keys(spark, ["a", None, None, "b", "b", None]), "entity_id").first()
    assert (row["nulls"], row["duplicates"], row["passed"]) == (3, 3, False)
    empty = gates.unique_not_null(keys(spark, []), "entity_id").first()
    assert (empty["nulls"], empty["duplicates"], empty["passed"]) == (0, 0, True)


@pytest.mark.parametrize(
    ("features", "labels", "orphans"),
    [(["a", "b", "c"], ["a", "b"], ["c"]), (["a", "b", "c"], ["c", "a", "b"], []), ([None, "a"], [None], ["a"])],
)
def test_referential_integrity(spark, features, labels, orphans):
    row = gates.referential_integrity(keys(spark, features), keys(spark, labels), "entity_id").first()
    assert row["orphaned_count"] == len(orphans)
    assert row["orphaned_sample"] == ",".join(orphans)
    assert row["passed"] is (not orphans)


def test_orphan_sample_is_five(spark):
    row = gates.referential_integrity(keys(spark, list("hgfedcba")), keys(spark, ["z"]), "entity_id").first()
    assert (row["orphaned_count"], row["orphaned_sample"]) == (8, "a,b,c,d,e")


def history(spark, rows):
    return spark.createDataFrame(
        rows, "entity_id string, ts timestamp_ntz, write_seq bigint, spend double, k double"
    )


def labels(spark, rows):
    return spark.createDataFrame(rows, "label_id bigint, entity_id string, label_timestamp timestamp_ntz, label int")


@pytest.mark.parametrize(("as_of", "value"), [(DAY(15), 2.0), (DAY(10), 2.0), (DAY(9), 1.0), (DAY(20), 99.0)])
def test_asof_never_sees_the_future(spark, as_of, value):
    past = history(spark, [("a", DAY(1), 1, 1.0, 0.0), ("a", DAY(10), 2, 2.0, 0.0), ("a", DAY(20), 3, 99.0, 0.0)])
    got = asof.pit_join(labels(spark, [(1, "a", as_of, 1)]), past).first()
    assert got["spend"] == value


def test_asof_without_history_is_null_and_dropped(spark):
    past = history(spark, [("a", DAY(10), 1, 1.0, 0.0)])
    wanted = labels(spark, [(1, "a", DAY(9), 1), (2, "b", DAY(11), 0)])
    assert {r["spend"] for r in asof.pit_join(wanted, past).collect()} == {None}
    assert asof.pit_training_set(wanted, past).count() == 0


def test_asof_last_write_of_a_time_wins(spark):
    past = history(spark, [("a", DAY(1), 5, 5.0, 0.0), ("a", DAY(1), 9, 9.0, 0.0), ("a", DAY(1), 7, 7.0, 0.0)])
    assert asof.pit_join(labels(spark, [(1, "a", DAY(1), 1)]), past).first()["spend"] == 9.0


def test_strictly_before(spark):
    past = history(spark, [("a", DAY(1), 1, 1.0, 0.0), ("a", DAY(2), 2, 2.0, 0.0)])
    got = asof.asof_join(
        labels(spark, [(1, "a", DAY(2), 1)]), past, ["entity_id"], "label_timestamp", "ts", "write_seq", ["spend"], False
    )
    assert got.first()["spend"] == 1.0


def test_online_goes_by_write_order_history_by_time(spark):
    rows = history(spark, [("a", DAY(2), 1, 5.0, 0.0), ("a", DAY(1), 2, 1.0, 0.0)])
    assert asof.latest(rows, ["entity_id"], ["write_seq"]).first()["spend"] == 1.0
    assert asof.latest(rows, ["entity_id"], ["ts", "write_seq"]).first()["spend"] == 5.0


@pytest.mark.parametrize(
    ("online", "mismatches"),
    [(999.0, 1), (1.0, 0), (1.009, 0), (1.02, 1), (float("nan"), 0), (None, 0)],
)
def test_reconcile(spark, online, mismatches):
    past = history(spark, [("a", DAY(1), 1, 1.0, 3.0), ("b", DAY(1), 1, 1.0, 3.0)])
    now = spark.createDataFrame([("a", online, 3.0), ("zzz", 5.0, 5.0)], "entity_id string, spend double, k double")
    got = store.reconcile(now, past, F.lit("2026-02-01").cast("timestamp_ntz"), ["spend", "k"])
    assert got.count() == mismatches


def test_reconcile_at_the_tolerance_and_future_history(spark):
    past = history(spark, [("a", DAY(1), 1, 0.0, 0.0), ("a", DAY(1, 3), 2, 50.0, 0.0)])
    now = spark.createDataFrame([("a", 0.01, 0.0)], "entity_id string, spend double, k double")
    assert store.reconcile(now, past, F.lit("2026-02-01").cast("timestamp_ntz"), ["spend", "k"]).count() == 0


def scores(spark, rows):
    table = spark.createDataFrame(rows, "version string, slice string, label int, score double")
    return registry.slice_metrics(table)


def test_first_model_passes_without_champion(spark):
    rows = [("new", "all", y, s) for y, s in ((0, 0.1), (0, 0.4), (1, 0.3), (1, 0.9))]
    row = registry.champion_challenger(scores(spark, rows), "new", None).first()
    assert row["passed"] and row["champion_ap"] is None and row["regression"] == 0.0


def test_one_failing_slice_fails_the_gate(spark):
    good, bad = ((0, 0.1), (1, 0.9)), ((0, 0.9), (1, 0.1))
    rows = [(v, s, y, x) for v, s, data in
            (("old", "a", good), ("new", "a", good), ("old", "b", good), ("new", "b", bad)) for y, x in data]
    per_slice = registry.champion_challenger(scores(spark, rows), "new", "old")
    assert {r["slice"]: r["passed"] for r in per_slice.collect()} == {"a": True, "b": False}
    got = {d: registry.promotion(per_slice, "new", d).first() for d in (True, False)}
    assert [got[d]["stage"] for d in (True, False)] == ["staging", "staging"]
    assert got[False]["alert"].startswith("[CRITICAL ALERT]")


def test_dry_run_promotes_nothing(spark):
    rows = [(v, "a", y, s) for v in ("old", "new") for y, s in ((0, 0.1), (1, 0.9))]
    per_slice = registry.champion_challenger(scores(spark, rows), "new", "old")
    dry, real = registry.promotion(per_slice, "new", True).first(), registry.promotion(per_slice, "new").first()
    assert (dry["stage"], dry["alert"]) == (None, None)
    assert real["stage"] == "production" and real["alert"].startswith("[ALERT] Promoted new")


@pytest.mark.parametrize(("limit", "passed"), [(0.5, True), (0.49, False)])
def test_regression_at_the_limit_passes(spark, limit, passed):
    rows = [("old", "a", 0, 0.1), ("old", "a", 1, 0.9), ("new", "a", 0, 0.9), ("new", "a", 1, 0.1)]
    row = registry.champion_challenger(scores(spark, rows), "new", "old", limit).first()
    assert row["regression"] == 0.5 and row["passed"] is passed


def test_serving_state(spark):
    at = "model string, stage string, version string, pointed_at timestamp_ntz, seq bigint"
    log = spark.createDataFrame(
        [
            ("m", "production", "v1", DAY(1), 1),
            ("m", "production", "v2", DAY(2), 2),
            ("m", "staging", "v3", DAY(3), 3),
            ("n", "staging", "v9", DAY(1), 4),
        ],
        at,
    )
    cards = spark.createDataFrame(
        [("m", "v1", 0.2, 0.6), ("m", "v2", 0.3, 0.7), ("m", "v3", 0.1, 0.5)],
        "model string, version string, t_low double, t_high double",
    )
    on = {r["model"]: r for r in registry.serving_state(log, cards, 25).collect()}
    assert (on["m"]["champion_version"], on["m"]["champion_t_low"], on["m"]["challenger_version"]) == ("v2", 0.3, "v3")
    assert (on["n"]["status"], on["n"]["challenger_version"]) == ("no_production_model", None)
    off = {r["model"]: r for r in registry.serving_state(log, cards, 0).collect()}
    assert off["m"]["challenger_version"] is None
    back = {r["version"]: r["rollback_to"] for r in store.previous_pointer(log, ["model", "stage"]).collect()}
    assert back == {"v1": None, "v2": "v1", "v3": None, "v9": None}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("score", "tier"),
    [(0.19, "auto_resolve"), (0.2, "review_queue"), (0.59, "review_queue"), (0.6, "senior_escalation")],
)
def test_tiers(spark, score, tier):
    assert one(spark, S.tier(F.lit(score), 0.2, 0.6)) == tier


def test_equal_thresholds_leave_the_middle_empty(spark):
    assert one(spark, S.tier(F.lit(0.2), 0.2, 0.2)) == "senior_escalation"


@pytest.mark.parametrize(("score", "low"), [(0.25, True), (0.26, False), (0.5, False), (0.625, True)])
def test_low_confidence_band_is_inclusive(spark, score, low):
    assert one(spark, S.low_confidence(F.lit(score), F.lit(0.25), F.lit(0.625), 0.0)) is (score in (0.25, 0.625))
    assert one(spark, S.low_confidence(F.lit(score), F.lit(0.25), F.lit(0.625), 0.005)) is low


def test_nan_is_never_above_a_cut(spark):
    assert one(spark, S.predict_at(F.lit(float("nan")), 0.5)) == 0
    assert one(spark, S.predict_at(F.lit(None).cast("double"), 0.5)) == 0
    assert one(spark, S.predict_at(F.lit(0.5), 0.5)) == 1


def test_sticky_bucket_is_the_digest_modulo_100(spark):
    import hashlib

    names = [f"cust_{i:06d}" for i in range(300)] + ["", "ü", "x" * 64]
    got = keys(spark, names).select("entity_id", S.sticky_bucket(F.col("entity_id")).alias("b")).collect()
    assert {r["entity_id"]: r["b"] for r in got} == {
        n: int(hashlib.sha256(n.encode()).hexdigest(), 16) % 100 for n in names
    }


@pytest.mark.parametrize(
    ("pct", "staged", "served"), [(25, True, "challenger"), (24, True, "champion"), (0, True, "champion"), (25, False, "champion")]
)
def test_variant(spark, pct, staged, served):
    assert one(spark, S.pick_variant(F.lit(24), pct, staged)) == served


def request(spark, **change):
    base = {"entity_id": "a", "support_tickets_30d": 0.0, "avg_message_length": 20000.0, "satisfaction_score": 5.0,
            "days_since_last_login": 3650.0, "tenure_days": 0.0, "monthly_spend": 1000000.0}
    schema = ", ".join(f"{c} {'string' if c == 'entity_id' else 'double'}" for c in base)
    return spark.createDataFrame([tuple({**base, **change}.values())], schema)


@pytest.mark.parametrize(
    ("change", "broken"),
    [
        ({}, []),
        ({"entity_id": ""}, ["entity_id"]),
        ({"entity_id": "x" * 64}, []),
        ({"entity_id": "x" * 65}, ["entity_id"]),
        ({"entity_id": None, "tenure_days": None}, ["entity_id", "tenure_days"]),
        ({"satisfaction_score": 0.99, "monthly_spend": 1000000.01}, ["satisfaction_score", "monthly_spend"]),
        ({"support_tickets_30d": float("nan")}, ["support_tickets_30d"]),
    ],
)
def test_request_bounds(spark, change, broken):
    assert request(spark, **change).select(S.request_violations().alias("v")).first()["v"] == broken


def test_alert_prefixes(spark):
    lines = [one(spark, S.alert_line(F.lit(s), F.lit("m"))) for s in ("warning", "critical", "other")]
    assert lines == ["[ALERT] m", "[CRITICAL ALERT] m", "[ALERT] m"]


def test_psi_bands_are_strict(spark):
    names = [one(spark, S.psi_band(F.lit(v))) for v in (0.1, 0.1001, 0.25, 0.2501)]
    assert [n.split()[0] for n in names] == ["stable", "MODERATE", "MODERATE", "MAJOR"]


def test_canary_stops_at_first_breach(spark):
    log = spark.createDataFrame(
        [(f"e{i}", stage, int(stage == 25 and i < 400)) for stage in (10, 25, 50, 100) for i in range(800)],
        "entity_id string, stage int, is_error int",
    )
    got = routing.canary_sla(log, F.col("stage")).orderBy("stage_pct").collect()
    assert [r["status"] for r in got] == ["OK", "BREACH", "OK", "OK"]
    assert [r["reached"] for r in got] == [True, True, False, False]
    assert got[3]["requests"] == 800


def test_backfill(spark):
    logged = spark.createDataFrame(
        [("a", 0.9), ("a", 0.5), ("a", 0.1), ("b", 0.8), ("c", 0.9), (None, 0.9)],
        "entity_id string, calibrated_score double",
    )
    truth = spark.createDataFrame([("a", 1), ("b", 0)], "entity_id string, label int")
    row = store.label_backfill(logged, truth).first()
    assert (row["status"], row["n_matched"]) == ("checked", 4)
    assert [round(row[c], 6) for c in ("precision", "recall", "f1")] == [round(2 / 3, 6)] * 3
    none = store.label_backfill(logged, truth.filter("label > 5")).first()
    assert (none["status"], none["n_matched"], none["f1"]) == ("no_matching_labels", 0, None)


def test_duplicate_rows_are_those_after_the_first(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("a", 6)], "entity_id string, event_id bigint"
    )
    got = gates.duplicate_rows(df, "entity_id", "event_id")
    assert sorted(r["event_id"] for r in got.collect()) == [2, 5, 6]


def test_retention_counts_from_the_newest_day(spark):
    df = spark.createDataFrame([(DAY(d),) for d in (1, 15, 16, 29, 30)], "request_ts timestamp_ntz")
    kept = store.within_retention(df, "request_ts", 14).collect()
    assert sorted(r["request_ts"].day for r in kept) == [16, 29, 30]


def test_few_logged_rows_give_no_drift_verdict(spark):
    long = spark.range(100).select(
        F.lit("f").alias("feature"), F.col("id").cast("double").alias("value"), (F.col("id") < 29).alias("is_live")
    )
    assert drift.ks_drift(long, ["feature"]).first()["status"] == "insufficient_data"
    assert drift.psi(long).first()["status"] == "insufficient_data"


def test_cascade_is_ordered(spark):
    rows = [(i * 0.4 / 89, 0) for i in range(90)] + [(0.6 + i * 0.4 / 9, 1) for i in range(10)]
    cuts = metrics.cascade_thresholds(spark.createDataFrame(rows, "score double, label int")).first()
    assert cuts["t_low"] <= cuts["t_high"]


def test_defaults_are_the_published_ones():
    assert (config.COST_LOW, config.COST_HIGH, config.MAX_AP_REGRESSION) == ((8, 1), (3, 6), 0.01)
