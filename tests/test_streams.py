"""Streams against their batch twins: several micro-batches, replays, late labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, gates
from tidemark.session import scratch_dir
from tidemark.sources import sinks, views
from tidemark.sources.tables import schema_of, table
from tidemark.streaming import streams


@pytest.fixture(scope="module")
def pieces(spark, folder, tmp_path_factory):
    """The events in three files, written and so read one after the other, cut by time."""
    path = str(tmp_path_factory.mktemp("events"))
    events = table(spark, folder, "events")
    ends = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]
    for start, end in zip(ends, ends[1:]):
        inside = (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        events.filter(inside).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return spark.readStream.schema(schema_of("events")).option("maxFilesPerTrigger", 1).parquet(path)


def test_gate_per_batch_adds_up(spark, folder, pieces, same):
    root = scratch_dir(spark, "t-gate")
    streams.ingestion_gate(views.raw_landing_of(stream(spark, pieces)), root)
    checks = spark.read.parquet(f"{root}/checks").filter(F.col("check_name") == "row_count_volume_check")
    assert checks.count() == 3
    assert checks.agg(F.sum("observed")).first()[0] == table(spark, folder, "events").count()
    landed = views.raw_landing(spark, folder)
    got = spark.read.parquet(f"{root}/rows")
    same(got.filter("route = 'clean'").drop("route", "batch_id"), gates.clean_rows(landed))
    same(got.filter("route = 'quarantine'").drop("route", "batch_id"), gates.quarantined_rows(landed))


def test_dual_write_survives_a_replay(spark, folder, pieces, same):
    """Without its checkpoint the stream writes every batch again, to the same folders."""
    root = scratch_dir(spark, "t-store")
    history = views.feature_history(spark, folder)
    for checkpoint in ("one", "two"):
        source = views.feature_history_of(stream(spark, pieces))
        original = streams.run_batches

        def run(df, _, write, at=checkpoint):
            original(df, f"{root}/{at}", write)

        streams.run_batches = run
        try:
            streams.dual_write(source, root)
        finally:
            streams.run_batches = original
        same(sinks.read_online(spark, f"{root}/online"), asof.latest(history, ["entity_id"], ["write_seq"]))
        same(spark.read.parquet(f"{root}/history").drop("batch_id", "date"), history)
    sinks.compact_online(spark, f"{root}/online", f"{root}/compact")
    same(sinks.read_online(spark, f"{root}/compact"), asof.latest(history, ["entity_id"], ["write_seq"]))


def test_stopped_stream_goes_on(spark, pieces):
    root = scratch_dir(spark, "t-again")
    log = stream(spark, pieces).select("event_id", "ts")
    first = streams.dedup_log(log, root, "event_id", "ts").count()
    assert streams.dedup_log(log, root, "event_id", "ts").count() == first


def test_windows_over_several_batches(spark, folder, pieces, same):
    log = views.inference_log_of(stream(spark, pieces)).select("request_ts", "served_by", "is_error")
    got = streams.canary_windows(log, scratch_dir(spark, "t-canary"))
    batch = views.inference_log(spark, folder)
    last = batch.agg(F.max("request_ts")).first()[0] - dt.timedelta(minutes=10)
    want = batch.groupBy(F.window(F.col("request_ts"), "1 hour").alias("w"), "served_by").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("is_error").cast("bigint").alias("errors")
    )
    want = want.filter(F.col("w.end") <= F.lit(last)).select(
        F.col("w.start").alias("window_start"), "served_by", "requests", "errors"
    )
    same(got.select("window_start", "served_by", "requests", "errors"), want)


def test_label_join_and_audit_agree(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    predictions = spark.createDataFrame(
        [("a", 0.9, day(0)), ("b", 0.8, day(0)), ("c", 0.7, day(5)), ("d", 0.6, day(1)), ("e", 0.5, day(0))],
        "entity_id string, calibrated_score double, predicted_at timestamp_ntz",
    )
    labels = spark.createDataFrame(
        [("a", 1, day(21)), ("b", 0, day(22)), ("c", 1, day(4)), ("e", 1, day(0))],
        "entity_id string, label int, label_observed_at timestamp_ntz",
    )
    paths = {}
    for name, df in (("p", predictions), ("l", labels)):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    read = lambda n, df: spark.readStream.schema(df.schema).parquet(paths[n])
    got = streams.label_delay_join(read("p", predictions), read("l", labels), scratch_dir(spark, "t-labels"))
    assert sorted(r["entity_id"] for r in got.collect()) == ["a", "e"]
    audit = {r["arrival"]: r["predictions"] for r in streams.label_arrival(predictions, labels).collect()}
    assert audit == {"in_time": 2, "late": 1, "before_prediction": 1, "no_label": 1}
