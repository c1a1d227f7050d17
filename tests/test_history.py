"""As-of joins over prepared history give what the plain join gives, and shuffle the probes only."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, history
from tidemark.sources import views

VALUES = ["feature_ts", "spend", "k"]


def stamped(rows):
    return rows.withColumn("feature_ts", F.col("ts"))


@pytest.fixture(scope="module")
def snaps(spark, folder):
    heap = spark.range(1500).select(
        F.when(F.col("id") % 5 > 0, F.lit("cust_000003")).alias("entity_id"),
        F.expr("timestamp_ntz '2024-01-09 20:00:00' + make_interval(0, 0, 0, 0, 0, cast(greatest(id - 500, 0) / 3 as int), 0)").alias("ts"),
        (F.col("id") + 10**6).alias("write_seq"),
        F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("spend"),
        F.lit(1.0).alias("k"),
    )
    return stamped(views.feature_history(spark, folder).unionByName(heap)).cache()


@pytest.fixture(scope="module")
def labels(spark, folder):
    heap = spark.range(900).select(
        (F.col("id") + 10**6).alias("label_id"),
        F.when(F.col("id") % 9 > 0, F.lit("cust_000003")).alias("entity_id"),
        F.expr("timestamp_ntz '2024-01-09 19:59:00' + make_interval(0, 0, 0, 0, 0, cast(greatest(id - 300, 0) as int), 0)").alias(
            "label_timestamp"
        ),
        F.lit(1).alias("label"),
    )
    lost = heap.limit(3).withColumn("label_timestamp", F.lit(None).cast("timestamp_ntz"))
    return views.label_events(spark, folder).unionByName(heap).unionByName(lost).cache()


def plain(labels, snaps, inclusive=True):
    return asof.asof_join(labels, snaps, ["entity_id"], "label_timestamp", "ts", "write_seq", VALUES, inclusive)


@pytest.mark.parametrize("task_rows", [20, 200, 10**6])
@pytest.mark.parametrize("inclusive", [True, False])
def test_same_as_the_plain_join(labels, snaps, same, task_rows, inclusive):
    prepared = history.prepare(snaps, ["entity_id"], "ts", "write_seq", VALUES, 12, task_rows)
    same(history.asof(labels, prepared, "label_timestamp", inclusive), plain(labels, snaps, inclusive))


@pytest.mark.parametrize("task_rows", [20, 10**6])
def test_batches_in_any_order(labels, snaps, same, task_rows):
    """Late rows end up in early slices, and are seen from the slices after them."""
    late = F.hash("write_seq") % 3 == 0
    prepared = history.prepare(snaps.filter(~late), ["entity_id"], "ts", "write_seq", VALUES, None, task_rows)
    history.append(prepared, snaps.filter(late))
    same(history.asof(labels, prepared, "label_timestamp"), plain(labels, snaps))


def test_only_the_probes_are_shuffled(spark, folder):
    rows = stamped(views.feature_history(spark, folder))
    prepared = history.prepare(rows, ["entity_id"], "ts", "write_seq", VALUES)
    out = history.asof(views.label_events(spark, folder), prepared, "label_timestamp")
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "REPARTITION_BY_NUM" in exchanges[0], plan
    assert "Bucketed: true" in plan


def test_empty_sides(labels, snaps):
    prepared = history.prepare(snaps.limit(0), ["entity_id"], "ts", "write_seq", VALUES)
    out = history.asof(labels, prepared, "label_timestamp")
    assert out.count() == labels.count() and out.filter("feature_ts is not null").count() == 0
    assert history.asof(labels.limit(0), prepared, "label_timestamp").count() == 0
