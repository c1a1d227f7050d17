"""Tables that stay small, and logs that are read and expired by day."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, store
from tidemark.session import scratch_dir
from tidemark.sources import sinks, views


def test_merges_read_touched_buckets_only(spark, folder, same):
    path = scratch_dir(spark, "t-merge")
    history = views.feature_history(spark, folder)
    parts = [history.filter(F.pmod(F.hash("write_seq"), F.lit(5)) == i) for i in range(5)]
    for part in parts:
        assert sinks.upsert_online(part, path, buckets=8) <= 8
    one = history.filter(F.col("entity_id") == history.first()["entity_id"])
    assert sinks.upsert_online(one, path, buckets=8) == 1
    assert sinks.upsert_online(one, path, buckets=8) == 1
    same(spark.read.parquet(path).drop("bucket"), asof.latest(history, ["entity_id"], ["write_seq"]))
    assert len(spark.read.parquet(path).inputFiles()) <= 8


def test_an_older_write_never_wins(spark):
    path = scratch_dir(spark, "t-late")
    rows = lambda *r: spark.createDataFrame(list(r), "entity_id string, write_seq long, v string")
    sinks.upsert_online(rows(("a", 5, "new"), ("b", 1, "b1"), (None, 2, "n2")), path, buckets=3)
    sinks.upsert_online(rows(("a", 4, "late"), ("b", 2, "b2"), ("c", 1, "c1"), (None, 1, "n1")), path, buckets=3)
    got = {r["entity_id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {"a": "new", "b": "b2", "c": "c1", None: "n2"}
    assert sinks.upsert_online(rows(("a", 9, "x")).limit(0), path, buckets=3) == 0


@pytest.fixture()
def log(spark, folder):
    path = scratch_dir(spark, "t-log")
    sinks.append_log(views.inference_log(spark, folder).select("request_id", "entity_id", "request_ts"), path)
    return path


def test_newest_rows_open_newest_days_only(spark, folder, log, same):
    whole = spark.read.parquet(log)
    for limit in (1, 40, 200, 10**6):
        same(store.newest_logged(spark, log, limit), store.newest_log_rows(whole, limit))
    plan = store.newest_logged(spark, log, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert len(store.logged_days(spark, log)) > 20


def test_retention_drops_whole_days(spark, log):
    whole = spark.read.parquet(log)
    kept = [tuple(r) for r in store.within_retention(whole, "request_ts").select("request_id").collect()]
    assert sorted(r["request_id"] for r in store.retained(spark, log).collect()) == sorted(k[0] for k in kept)
    days = store.logged_days(spark, log)
    gone = store.drop_expired(spark, log)
    assert len(gone) == len(days) - 15 and store.logged_days(spark, log) == days[-15:]
    assert spark.read.parquet(log).count() == len(kept)
    assert store.drop_expired(spark, log) == []


def test_no_log_yet(spark, tmp_path):
    assert store.logged_days(spark, str(tmp_path / "none")) == []
    assert store.drop_expired(spark, str(tmp_path / "none")) == []
