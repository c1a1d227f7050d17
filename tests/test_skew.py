"""Hot keys take other plans and give the same rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, gates
from tidemark.operators.skew import hot_keys, lookup_join
from tidemark.sources import views

HOT = "cust_000003"


@pytest.fixture(scope="module")
def labels(spark, folder):
    """A heap of labels of one entity, most of them at one time."""
    heap = spark.range(2000).select(
        (F.col("id") + 10**6).alias("label_id"),
        F.lit(HOT).alias("entity_id"),
        F.expr("timestamp_ntz '2024-01-10' + make_interval(0, 0, 0, 0, 0, cast(greatest(id - 1500, 0) as int), 0)").alias(
            "label_timestamp"
        ),
        F.lit(1).alias("label"),
    )
    return views.label_events(spark, folder).unionByName(heap).cache()


@pytest.fixture(scope="module")
def history(spark, folder):
    """Snapshots of the same entity, three to a time."""
    heap = spark.range(1500).select(
        F.lit(HOT).alias("entity_id"),
        F.expr("timestamp_ntz '2024-01-09 20:00:00' + make_interval(0, 0, 0, 0, 0, cast(id / 3 as int), 0)").alias("ts"),
        (F.col("id") + 10**6).alias("write_seq"),
        F.col("id").cast("double").alias("spend"),
        F.lit(1.0).alias("k"),
    )
    return views.feature_history(spark, folder).unionByName(heap).cache()


def test_hot_keys_are_few_and_found(spark, labels):
    assert [r["entity_id"] for r in hot_keys(labels, ["entity_id"]).collect()] == [HOT]
    assert hot_keys(labels.filter(F.col("entity_id") != HOT), ["entity_id"]) is None


def test_a_key_below_an_even_share_is_hot_above_the_task_limit(spark, same):
    """12 % of the rows with eight partitions: no even share, but more than a task may carry."""
    rows = spark.range(1000).select(
        F.when(F.col("id") < 120, F.lit(0)).otherwise(F.col("id") % 80 + 1).alias("k"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"),
    )
    assert hot_keys(rows, ["k"]) is None
    assert [r["k"] for r in hot_keys(rows, ["k"], 50).collect()] == [0]
    args = (rows, ["k"], ["t"], "v")
    same(asof.running_last(*args, task_rows=50), asof.running_last(*args))
    probes = rows.select("k", F.col("t").alias("at"))
    history = rows.select("k", "t", F.col("t").alias("seq"), F.col("t").alias("seen"))
    args = (probes, history, ["k"], "at", "t", "seq", ["seen"])
    same(asof.asof_join(*args, task_rows=50), asof.asof_join(*args))


@pytest.mark.parametrize("keys", [1, 4, 20])
def test_no_slice_exceeds_the_limit(spark, keys):
    """More hot keys than pieces of a global order, too; a third of all rows have one key."""
    rows = spark.range(keys * 500).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % keys).alias("k"), F.hash("id").alias("t")
    )
    hot = hot_keys(rows, ["k"], 50)
    assert hot.count() == keys
    cut = asof.slices(rows, ["k"], "t", hot)
    assert cut.count() == rows.count()
    loads = [r["count"] for r in cut.groupBy("k", "_seg").count().collect()]
    assert max(loads) <= 50 * 1.5
    assert len(loads) <= 2 * keys * 500 / 50


def test_null_can_be_hot(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 700, F.col("id")).alias("k"))
    assert [r["k"] for r in hot_keys(df, ["k"], 10).collect()] == [None]


@pytest.mark.parametrize("inclusive", [True, False])
def test_asof(labels, history, same, inclusive):
    args = (labels, history, ["entity_id"], "label_timestamp", "ts", "write_seq", ["spend"], inclusive)
    same(asof.asof_join(*args, task_rows=10), asof.asof_join(*args))


def test_running_last(history, same):
    marked = history.withColumn("high", F.when(F.col("spend") >= 50, F.col("spend")))
    args = (marked, ["entity_id"], ["ts", "write_seq"], "high")
    same(asof.running_last(*args, task_rows=10), asof.running_last(*args))


def test_previous_value(history, same):
    args = (history, ["entity_id"], "ts", "write_seq", "spend", "before")
    same(asof.previous_value(*args, task_rows=10), asof.previous_value(*args))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join(labels, history, same, how):
    current = asof.latest(history, ["entity_id"], ["write_seq"]).select("entity_id", "spend")
    plain = labels.join(current, "entity_id", how).select(*labels.columns, "spend")
    same(lookup_join(labels, current, ["entity_id"], how), plain)


def test_lookup_join_with_copies_and_nulls(spark, same):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("k"), F.lit(1).alias("x"))
    right = spark.createDataFrame([(0, "zero"), (None, "null")], "k bigint, name string")
    for null_safe, how in ((True, "left"), (False, "left"), (True, "inner"), (False, "inner")):
        on = left["k"].eqNullSafe(right["k"]) if null_safe else left["k"] == right["k"]
        want = left.join(right, on, how).select(left["k"], "x", "name")
        same(lookup_join(left, right, ["k"], how, null_safe), want)


def test_duplicate_rows(labels, same):
    first = labels.groupBy("entity_id").agg(F.min("label_id").alias("first"))
    want = labels.join(first, "entity_id").filter("label_id > first").select(*labels.columns)
    same(gates.duplicate_rows(labels, "entity_id", "label_id"), want)
