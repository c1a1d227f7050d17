"""Streams that hold something back: unlabelled predictions, rollout stages, windows that are still open."""

import datetime as dt
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators import drift, routing
from tidemark.session import scratch_dir
from tidemark.sources import views
from tidemark.sources.tables import table
from tidemark.streaming import streams

DAY = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def landed(spark, path, df, name):
    """Appends to a folder and gives it as a stream."""
    df.coalesce(1).write.mode("append").parquet(f"{path}/{name}")
    return spark.readStream.schema(df.schema).parquet(f"{path}/{name}")


@pytest.mark.parametrize("salts", [1, 4])
def test_unlabelled_predictions_come_out_once(spark, tmp_path, salts):
    """Three batches; a label that comes too late does not change what was written."""
    p = lambda *rows: spark.createDataFrame(list(rows), "entity_id string, calibrated_score double, predicted_at timestamp_ntz")
    l = lambda *rows: spark.createDataFrame(list(rows), "entity_id string, label int, label_observed_at timestamp_ntz")
    batches = [
        (p(("a", 0.9, DAY(0)), ("a", 0.4, DAY(0)), ("b", 0.8, DAY(0)), ("c", 0.7, DAY(1))), l(("z", 1, DAY(1)))),
        (p(("d", 0.6, DAY(20))), l(("a", 1, DAY(21)))),
        (p(("e", 0.5, DAY(60))), l(("b", 1, DAY(30)), ("c", 0, DAY(58)))),
        (p(("f", 0.5, DAY(61))), l(("b", 1, DAY(59)), ("y", 0, DAY(61)))),
    ]
    root, seen = str(tmp_path / "run"), []
    for predictions, labels in batches:
        out = streams.label_outcomes(
            landed(spark, str(tmp_path), predictions, "p"), landed(spark, str(tmp_path), labels, "l"), root, salts=salts
        )
        seen.append(sorted((r["entity_id"], r["calibrated_score"], r["label"], r["outcome"]) for r in out.collect()))
    held = ("b", 0.8, None, "no_label_in_time")
    assert seen[0] == []
    assert seen[1] == [("a", 0.4, 1, "labelled"), ("a", 0.9, 1, "labelled")]
    assert held in seen[2]
    lost = [(e, s, None, "no_label_in_time") for e, s in (("b", 0.8), ("c", 0.7), ("d", 0.6))]
    assert seen[3] == sorted(seen[1] + lost)


@pytest.mark.parametrize("join", [streams.label_delay_join, streams.label_outcomes])
def test_the_state_of_a_join_is_kept_on_disk(spark, tmp_path, join):
    """Not in maps of the executors: it grows with the rows of both sides. Partners meet over batches all the same."""
    p = lambda *rows: spark.createDataFrame(list(rows), "entity_id string, calibrated_score double, predicted_at timestamp_ntz")
    l = lambda *rows: spark.createDataFrame(list(rows), "entity_id string, label int, label_observed_at timestamp_ntz")
    before = {k: spark.conf.get(k, None) for k in streams.JOIN_STATE}
    batches = [
        (p(("a", 0.9, DAY(0)), ("b", 0.8, DAY(0)), (None, 0.7, DAY(0))), l(("z", 1, DAY(1)), (None, 1, DAY(1)))),
        (p(("c", 0.6, DAY(40))), l(("a", 1, DAY(21)), ("b", 1, DAY(40)))),
        (p(("d", 0.5, DAY(90))), l(("c", 0, DAY(50)), ("a", 1, DAY(20)))),
    ]
    root = str(tmp_path / "run")
    for predictions, labels in batches:
        out = join(landed(spark, str(tmp_path), predictions, "p"), landed(spark, str(tmp_path), labels, "l"), root)
    assert sorted((r["entity_id"], r["label"]) for r in out.filter("label is not null").collect()) == [("a", 1), ("c", 0)]
    kept = [f.name for f in Path(root, "checkpoint/state").rglob("*.*") if not f.name.startswith(".")]
    assert any(f.endswith(".changelog") for f in kept) and not any(f.endswith(".delta") for f in kept)
    assert before == {k: spark.conf.get(k, None) for k in before}


P_ROWS = "entity_id string, calibrated_score double, predicted_at timestamp_ntz"
L_ROWS = "entity_id string, label int, label_observed_at timestamp_ntz"


def outcomes_by_hand(batches, late_by=dt.timedelta(days=1), days=dt.timedelta(days=config.LABEL_DELAY_DAYS)):
    """Pairs and unlabelled predictions: a batch's rows are late if the watermark of the batches before has passed them."""
    mark, newest, ps, ls = dt.datetime(1970, 1, 1), [None, None], [], []
    for batch in batches:
        for k, (rows, kept) in enumerate(zip(batch, (ps, ls))):
            kept += [r for r in rows if r[2] is not None and r[2] > mark]
            newest[k] = max((t for t in (newest[k], *(r[2] for r in rows if r[0] is not None)) if t is not None), default=None)
        mark = max(mark, min(newest) - late_by) if None not in newest else mark
    pairs = [(*p, *l[1:]) for p in ps for l in ls if p[0] is not None and p[0] == l[0] and p[2] <= l[2] <= p[2] + days]
    met = {p[:3] for p in pairs}
    return pairs, [(*p, None, None) for p in ps if p[:3] not in met and p[2] + days < mark]


def random_batches(seed, n=4, rows=300):
    """Batches of some weeks that reach back into one another, with copies, nulls, rows at the very ends of the delay."""
    draw, out, seen = random.Random(seed), [], [(None, DAY(0))]
    for k in range(n):
        at = lambda: draw.choice([None, *9 * [DAY(35 * k) + dt.timedelta(hours=draw.randint(-60, 24 * 50))]])
        entity = lambda: draw.choice([None, *(f"e{draw.randint(0, 60)}" for _ in range(12))])
        ps = [(entity(), round(draw.random(), 3), at()) for _ in range(rows)]
        # Some entities whose predictions and labels meet to the second, or miss by one.
        ends = [(f"x{k}-{i}", 0.5, DAY(35 * k + i)) for i in range(30)]
        gap = lambda: dt.timedelta(days=draw.choice([0, config.LABEL_DELAY_DAYS]), seconds=draw.choice([-1, 0, 0, 1]))
        ls = [(entity(), draw.randint(0, 1), at()) for _ in range(rows // 3)] + [(e, 1, t + gap()) for e, _, t in ends if draw.random() < 0.8]
        seen += [(e, t) for e, _, t in ps if t]
        ls += [(e, 0, t + gap()) for e, t in draw.sample(seen, min(20, len(seen)))]
        out.append((ps + ends + ps[:5], ls + ls[:5]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_joins_over_batches_lose_and_repeat_nothing(spark, tmp_path, seed):
    """Whatever batch the partners come in: settled in one, or held over several."""
    batches = random_batches(seed)
    pairs, lost = outcomes_by_hand(batches)
    assert len(pairs) > 100 and len(lost) > 100
    for join, want in ((streams.label_delay_join, pairs), (streams.label_outcomes, pairs + lost)):
        path = str(tmp_path / join.__name__)
        for ps, ls in batches:
            out = join(
                landed(spark, path, spark.createDataFrame(ps, P_ROWS), "p"),
                landed(spark, path, spark.createDataFrame(ls, L_ROWS), "l"),
                f"{path}/run",
            )
        got = out.select("entity_id", "calibrated_score", "predicted_at", "label", "label_observed_at").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("join", [streams.label_outcomes, streams.label_delay_join])
def test_only_what_a_batch_leaves_open_reaches_the_state(spark, tmp_path, join):
    """A year of predictions in a batch: those whose days are over are settled without the state, whatever their outcome is."""
    ps = [(f"e{i}", 0.5, DAY(i % 365)) for i in range(3650)]
    ls = [(f"e{i}", i % 2, DAY(i % 365 + 7)) for i in range(0, 3650, 2)]
    out = join(
        landed(spark, str(tmp_path), spark.createDataFrame(ps, P_ROWS), "p"),
        landed(spark, str(tmp_path), spark.createDataFrame(ls, L_ROWS), "l"),
        f"{tmp_path}/run",
    )
    pairs, lost = outcomes_by_hand([(ps, ls)])
    assert out.count() == len(pairs) + (len(lost) if join is streams.label_outcomes else 0)
    state = spark.read.format("statestore").option("batchId", 0).option("path", f"{tmp_path}/run/checkpoint")
    for side, most in (("left", 300), ("right", 4 * 200)):
        assert 0 < state.option("joinSide", side).load().count() < most


def test_a_backlog_in_many_batches_is_joined_as_one(spark, tmp_path):
    """Files in the order of time, one a batch."""
    ps = [(f"e{i}", 0.5, DAY(i // 10)) for i in range(1000)]
    ls = [(f"e{i}", i % 2, DAY(i // 10 + i % 40)) for i in range(0, 1000, 2)]
    for name, rows, schema in (("p", ps, P_ROWS), ("l", ls, L_ROWS)):
        for k in range(4):
            part = [r for r in rows if DAY(25 * k) <= r[2] < DAY(25 * (k + 1) if k < 3 else 999)]
            landed(spark, str(tmp_path), spark.createDataFrame(part, schema), name)
            time.sleep(0.05)
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    out = streams.label_outcomes(read("p", P_ROWS), read("l", L_ROWS), f"{tmp_path}/run")
    pairs, lost = outcomes_by_hand([(ps, ls)])
    assert sorted(map(str, out.drop("outcome").select("entity_id", "calibrated_score", "predicted_at", "label", "label_observed_at").collect())) == sorted(
        str(Row(entity_id=e, calibrated_score=s, predicted_at=p, label=l, label_observed_at=o)) for e, s, p, l, o in pairs + lost
    )
    assert len(list(Path(tmp_path, "run/settled").glob("batch_id=*"))) == 4


@pytest.mark.parametrize("breaks_in", ["_labelled", "run_to_table"])
def test_a_join_that_broke_off_goes_on_without_repeating(spark, tmp_path, monkeypatch, breaks_in):
    """Once what is open has been handed on, in the same batch; and once before the join with state has seen it."""
    batches = random_batches(3, n=2, rows=100)
    pairs, lost = outcomes_by_hand(batches)
    path, root, whole, broken = str(tmp_path), f"{tmp_path}/run", getattr(streams, breaks_in), []

    def once(*args):
        if not broken:
            broken.append(True)
            raise RuntimeError("broken off")
        return whole(*args)

    for k, (ps, ls) in enumerate(batches):
        rows = lambda: (
            spark.readStream.schema(P_ROWS).parquet(f"{path}/p"),
            spark.readStream.schema(L_ROWS).parquet(f"{path}/l"),
        )
        landed(spark, path, spark.createDataFrame(ps, P_ROWS), "p")
        landed(spark, path, spark.createDataFrame(ls, L_ROWS), "l")
        if k:
            with monkeypatch.context() as m:
                m.setattr(streams, breaks_in, once)
                with pytest.raises(Exception, match="broken off"):
                    streams.label_outcomes(*rows(), root)
        out = streams.label_outcomes(*rows(), root)
    got = out.select("entity_id", "calibrated_score", "predicted_at", "label", "label_observed_at").collect()
    assert sorted(map(tuple, got), key=str) == sorted(pairs + lost, key=str)


def test_rollout_is_the_batch_report_stage_by_stage(spark, folder, tmp_path):
    """The canary's rows equal :func:`routing.canary_sla`, whatever the batches are; other days move the clock only."""
    events = table(spark, folder, "events")
    days = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"]
    stages = list(zip(config.CANARY_STAGES, days, days[1:]))
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    log = views.inference_log(spark, folder).select("entity_id", "request_ts", F.when(F.pmod(F.hash("entity_id"), F.lit(4)) == 0, 1).otherwise(F.col("is_error")).alias("is_error"))
    stage = F.lit(None).cast("int")
    for pct, begin, end in stages:
        stage = F.when((F.col("request_ts") >= at(begin)) & (F.col("request_ts") < at(end)), pct).otherwise(stage)
    want = {r["stage_pct"]: tuple(r) for r in routing.canary_sla(log.filter(stage.isNotNull()), stage).collect()}
    root, counts = str(tmp_path / "run"), []
    for begin, end in (("2023-01-01", "2024-01-10"), ("2024-01-10", "2024-01-23"), ("2024-01-23", "2025-01-01")):
        part = log.filter((F.col("request_ts") >= at(begin)) & (F.col("request_ts") < at(end)))
        out = streams.rollout(landed(spark, str(tmp_path), part, "log"), root, stages)
        counts.append(out.filter("variant = 'canary'").count())
    assert counts == [1, 3, 4]
    canary = out.filter("variant = 'canary'").drop("variant")
    got = {r["stage_pct"]: tuple(r) for r in canary.select("stage_pct", "requests", "errors", "error_rate", "status", "reached").collect()}
    assert got == want
    assert {r["reached"] for r in out.collect()} == {True, False}
    assert events.count() == log.count()


def test_window_distances_add_up_over_batches(spark, folder, tmp_path):
    """Each window's D equals the two-sample distance of all its rows; late rows for closed windows change nothing."""
    events = table(spark, folder, "events").select("ts", F.round("value", 1).alias("value"))
    split = F.lit("2024-01-10").cast("timestamp_ntz")
    base, live = events.filter(F.col("ts") < split).select("value"), events.filter(F.col("ts") >= split)
    cuts = ["2024-01-10", "2024-01-15", "2024-01-16 05:00:00", "2025-01-01"]
    root = str(tmp_path / "run")
    for begin, end in zip(cuts, cuts[1:]):
        inside = (F.col("ts") >= F.lit(begin).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        part = live.filter(inside)
        if begin == cuts[2]:
            part = part.unionByName(spark.createDataFrame([(dt.datetime(2024, 1, 11), 1e9)], "ts timestamp_ntz, value double"))
        out = streams.windowed_ks(base, landed(spark, str(tmp_path), part, "live"), "value", "ts", root, 10, "12 hours")
    windows = live.withColumn("w", F.window(F.col("ts").cast("timestamp"), "12 hours")["start"].cast("timestamp_ntz"))
    newest = live.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    rows = {r["window_start"]: (r["n_baseline"], r["n_live"], round(r["d"], 9)) for r in out.collect()}
    want = {}
    for start in [r["w"] for r in windows.select("w").distinct().collect()]:
        if start + dt.timedelta(hours=12) <= newest:
            long = base.select("value", F.lit(False).alias("is_live")).unionByName(
                windows.filter(F.col("w") == F.lit(start)).select("value", F.lit(True).alias("is_live"))
            )
            r = drift.ks_distance(long, []).first()
            want[start] = (r["n_baseline"], r["n_live"], round(r["d"], 9))
    assert rows == want and len(rows) > 10


def test_distances_where_values_lie_outside_the_baseline(spark):
    base = spark.createDataFrame([(float(v),) for v in (5, 5, 6, 9)], "value double")
    ranks = drift.baseline_ranks(base, "value")
    groups = {"below": [1.0, 2.0], "above": [10.0], "same": [5.0, 5.0, 6.0, 9.0], "between": [7.0, 8.0], "mixed": [1.0, 5.0, 20.0]}
    counts = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, value double")
    counts = counts.groupBy("g", "value").agg(F.count(F.lit(1)).alias("n"))
    got = {r["g"]: round(r["d"], 9) for r in drift.ks_against(counts, ranks, ["g"]).collect()}
    cdf = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    base_values = [5.0, 5.0, 6.0, 9.0]
    want = {g: round(max(abs(cdf(base_values, v) - cdf(vs, v)) for v in [*base_values, *vs]), 9) for g, vs in groups.items()}
    assert got == want
