"""What the physical plans must and must not contain."""

import re

from pyspark.sql import functions as F

from tidemark.operators import asof, gates, metrics, running, store
from tidemark.sources import views
from tidemark.sources.tables import table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


def test_running_totals_never_window_over_all_values(spark, folder):
    """The only unpartitioned window is the one over the pieces' totals."""
    counts = metrics.score_counts(views.scored(spark, folder))
    text = plan(running.running_totals(counts, "score", ["pos", "neg"]))
    windows = [line for line in text.splitlines() if re.search(r"\bWindow \[", line)]
    over_values = [w for w in windows if "score" in w]
    assert over_values and all("_piece" in w for w in over_values)


def test_running_totals_share_the_counts(spark, folder):
    assert "ReusedExchange" in final_plan(metrics.ranking_metrics(views.scored(spark, folder)))


def test_scan_is_pruned(spark, folder):
    text = plan(metrics.ranking_metrics(views.scored(spark, folder)))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == {"l_quantity:double,l_discount:double,l_returnflag:string"}


def test_filters_reach_the_scan(spark, folder):
    text = plan(views.label_events(spark, folder))
    assert "EqualTo(event_type,purchase)" in text
    kept = store.within_retention(table(spark, folder, "events").select("ts"), "ts")
    assert "PushedFilters: [IsNotNull(ts)" in plan(kept)


def test_point_in_time_join_shuffles_once(spark, folder):
    text = plan(asof.pit_join(views.label_events(spark, folder), views.feature_history(spark, folder)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_gate_is_one_aggregation_over_one_scan(spark, folder):
    text = plan(gates.ingestion_gate(views.raw_landing(spark, folder)))
    assert text.count("FileScan") == 1


def test_aggregates_combine_before_the_shuffle(spark, folder):
    for df in (
        gates.unique_not_null(views.raw_landing(spark, folder), "entity_id"),
        metrics.cost_curve(views.scored(spark, folder)),
    ):
        assert "partial_" in plan(df)


def test_latest_rows_are_found_without_sorting_the_input(spark, folder):
    """The greatest order value combines in a hash table; nothing aggregates whole rows by sorting."""
    from tidemark.plans.catalog import QUERIES

    for name in ("latest_per_entity", "reconcile", "sink_offline_append", "sink_online_upsert", "serving_state"):
        assert "SortAggregate" not in plan(QUERIES[name](spark, folder)), name


def test_point_in_time_join_shuffles_its_inputs_once(spark, folder):
    """Without hot keys nothing is written before: each side is scanned where it lies, and one shuffle brings them together."""
    text = plan(asof.pit_join(views.label_events(spark, folder), views.feature_history(spark, folder)))
    assert text.count("events.parquet]") == 2 and text.count("FileScan") == 2
    assert text.count("Exchange") == 1


def test_cost_curves_read_the_rows_once(spark, folder):
    rows = views.scored(spark, folder)
    grid = metrics.COST_GRID
    curves = metrics.cost_curves(rows, {"a": (F.col("score"), grid), "b": (F.col("quantity") / 50, grid)})
    for df in (metrics.cost_curve(rows), curves, metrics.cascade_thresholds(rows)):
        assert plan(df).count("FileScan") == 1


def test_no_python_rows_and_no_cross_joins(spark, folder):
    from tidemark.plans.catalog import QUERIES

    for name in ("pit_join", "champion_challenger", "ks_two_sample", "psi", "route_requests", "reconcile"):
        text = plan(QUERIES[name](spark, folder))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_sinks_rebalance_by_day(spark, folder):
    from tidemark.sources.sinks import by_day

    assert "REBALANCE_PARTITIONS_BY_COL" in plan(by_day(table(spark, folder, "events").select("ts", F.lit(1)), "ts"))
