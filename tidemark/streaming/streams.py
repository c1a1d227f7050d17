"""Streaming forms of the gates, monitors and joins.

Every stream runs with ``availableNow``: it takes what is there, in as many micro-batches as the
source cuts, and ends. Started again on the same folder it goes on where it stopped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators import gates
from tidemark.operators.drift import baseline_ranks, ks_against, psi_from_shares
from tidemark.operators.metrics import DECILES
from tidemark.operators.running import exact_quantiles
from tidemark.operators.skew import lookup_join
from tidemark.sources import sinks


def run_to_table(stream: DataFrame, root: str) -> DataFrame:
    """Runs an append stream into a Parquet table below ``root`` and reads that back."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/table")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/table")


def run_batches(stream: DataFrame, root: str, write: Callable[[DataFrame, int], None]) -> None:
    """Runs ``write`` on every micro-batch. A replayed batch comes with the same id."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned time stamp; the session zone is UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# ---- gates and writes --------------------------------------------------------------------------


def ingestion_gate(stream: DataFrame, root: str) -> None:
    """Gate one per micro-batch: clean and quarantined rows in one write, then the check rows.

    Both land in folders named after the batch, so a replay replaces what it wrote before.
    """
    rows = gates.routed(stream)

    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{root}/rows/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy("route").parquet(path)
        landed = batch.sparkSession.read.schema(rows.schema).parquet(path)
        gates.ingestion_gate(landed).write.mode("overwrite").parquet(f"{root}/checks/batch_id={batch_id}")

    run_batches(rows, root, write)


def dual_write(stream: DataFrame, root: str) -> None:
    """History first, then the online delta, both under the batch's id.

    The history lies by day and within a day by batch: a reader of some days lists only those, and a
    replayed batch replaces its own folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Both sinks read what was landed for this batch; no days of other batches are listed.
        landed = f"{root}/landed/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(landed)
        written = batch.sparkSession.read.schema(T.StructType([*stream.schema])).parquet(landed)
        rows = sinks.by_day(written, "ts").withColumn("batch_id", F.lit(batch_id))
        history = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        history.partitionBy("date", "batch_id").parquet(f"{root}/history")
        sinks.append_online(written, f"{root}/online", str(batch_id))

    run_batches(stream, root, write)


def validate_and_route(
    stream: DataFrame, root: str, canary_pct: int, t_low: float, t_high: float
) -> None:
    """Requests in, decisions and rejections out: one write, partitioned by validity.

    A rejected request is served by nobody: it has neither score nor tier.
    """
    valid = F.col("violations") == ""
    score = F.when(valid, F.col("calibrated_score"))
    served = S.pick_variant(S.sticky_bucket(F.col("entity_id")), canary_pct)
    decided = stream.withColumn("violations", F.array_join(S.request_violations(), ",")).select(
        *[c for c in stream.columns if c != "calibrated_score"],
        "violations",
        score.alias("calibrated_score"),
        valid.alias("valid"),
        F.when(valid, served).alias("served_by"),
        S.tier(score, t_low, t_high).alias("tier"),
        S.low_confidence(score, t_low, t_high).alias("low_confidence"),
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("valid").parquet(f"{root}/rows/batch_id={batch_id}")

    run_batches(decided, root, write)


# ---- windowed monitors -------------------------------------------------------------------------


def windowed(stream: DataFrame, ts: str, delay: str, width: str, by: list[Column | str], aggs: list[Column]) -> DataFrame:
    """Tumbling windows; a window is emitted once the watermark has passed its end."""
    sums = (
        event_time(stream, ts)
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("w"), *by)
        .agg(*aggs)
    )
    rest = [c for c in sums.columns if c != "w"]
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def error_alarm(log: DataFrame, root: str, delay: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Windows in which any request failed."""
    sums = windowed(log, "request_ts", delay, width, [], [F.sum(F.col("is_error").cast("bigint")).alias("errors")])
    return plain_time(run_to_table(sums.filter(F.col("errors") > 0), root), "window_start", "window_end")


def canary_windows(log: DataFrame, root: str, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Error rate per window and variant against the SLA."""
    counts = [
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.col("is_error").cast("bigint")).alias("errors"),
    ]
    table = run_to_table(windowed(log, "request_ts", delay, width, ["served_by"], counts), root)
    rate = S.ratio_or_zero(F.col("errors"), F.col("requests"))
    breach = F.when(rate > config.CANARY_ERROR_SLA, F.lit("BREACH")).otherwise(F.lit("OK"))
    return plain_time(table, "window_start", "window_end").select(
        "*", rate.alias("error_rate"), breach.alias("status")
    )


def rollout(
    log: DataFrame, root: str, stages: list[tuple[int, str, str]], delay: str = "10 minutes", sla: float = config.CANARY_ERROR_SLA
) -> DataFrame:
    """A staged rollout that judges each stage at its end and stops at the first breach, per variant.

    ``stages`` are (share of traffic, begin, end). Requests are first counted per day and variant, so the state
    machine of a variant sees a row a day, whatever the traffic is. It holds the counts of the stages, and
    a timer for the end of each; what it emits is a stage's verdict, and whether the rollout got that far.
    """
    spark = log.sparkSession
    share, begin = F.lit(None).cast("int"), [F.lit(b).cast("timestamp") for _, b, _ in stages]
    # Marked before any row is left out: traffic after the last stage still moves the clock.
    rows = event_time(log, "request_ts").withWatermark("request_ts", delay)
    for (pct, _, end), start in zip(stages, begin):
        inside = (F.col("request_ts") >= start) & (F.col("request_ts") < F.lit(end).cast("timestamp"))
        share = F.when(inside, F.lit(pct)).otherwise(share)
    canary = S.sticky_bucket(F.col("entity_id")) < F.col("stage_pct")
    counted = (
        rows.withColumn("stage_pct", share)
        .filter(F.col("stage_pct").isNotNull())
        .groupBy(F.window("request_ts", "1 day").alias("w"), "stage_pct", F.when(canary, F.lit("canary")).otherwise(F.lit("stable")).alias("variant"))
        .agg(F.count(F.lit(1)).alias("requests"), F.sum(F.col("is_error").cast("bigint")).alias("errors"))
        .select("variant", "stage_pct", "requests", "errors", F.window_time("w").alias("day"))
    )
    ends = [(pct, int(dt.datetime.fromisoformat(end).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)) for pct, _, end in stages]
    schema = "variant string, stage_pct int, requests bigint, errors bigint, error_rate double, status string, reached boolean"
    judged = counted.groupBy("variant").transformWithStateInPandas(
        stage_machine(ends, sla), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return run_to_table(judged, root)
    finally:
        spark.conf.set(provider, before)


def stage_machine(ends: list[tuple[int, int]], sla: float) -> StatefulProcessor:
    """The state machine of :func:`rollout`. ``ends``: share and end of the stages, in milliseconds, in order.

    Defined here, not in the module, so that it travels to the workers whole.
    """

    class Stages(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.started = handle.getValueState("started", "yes boolean")
            self.counts = handle.getMapState("counts", "stage_pct int", "requests bigint, errors bigint")

        def handleInputRows(self, key, rows, timerValues):
            if not self.started.exists():
                self.started.update((True,))
                for _, end in ends:
                    self.handle.registerTimer(end)
            for frame in rows:
                for pct, part in frame.groupby("stage_pct"):
                    had = self.counts.getValue((int(pct),)) if self.counts.containsKey((int(pct),)) else (0, 0)
                    sums = had[0] + int(part["requests"].sum()), had[1] + int(part["errors"].sum())
                    self.counts.updateValue((int(pct),), sums)
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            reached = True
            for pct, end in ends:
                had = self.counts.getValue((pct,)) if self.counts.containsKey((pct,)) else (0, 0)
                rate = had[1] / had[0] if had[0] else 0.0
                if end == expiredTimerInfo.getExpiryTimeInMs():
                    status = "BREACH" if rate > sla else "OK"
                    row = {"variant": [key[0]], "stage_pct": [pct], "requests": [had[0]], "errors": [had[1]]}
                    yield pd.DataFrame({**row, "error_rate": [rate], "status": [status], "reached": [reached]})
                    return
                reached = reached and rate <= sla

        def close(self) -> None:
            pass

    return Stages()


def windowed_ks(
    baseline: DataFrame, live: DataFrame, value: str, ts: str, root: str, delay_minutes: int, width: str
) -> DataFrame:
    """The exact two-sample KS distance of each window against a fixed baseline.

    A micro-batch adds its counts per window and value to a table, under its own id: they add up whatever the batches
    were, and a replay replaces its own. When the watermark passes the end of a window, its counts are put together and
    ranked against the baseline, whose running counts are written before the stream begins: a stream that goes on
    keeps to them, and does not read the baseline again.
    """
    spark = live.sparkSession
    if "_SUCCESS" not in sinks.children(spark, f"{root}/baseline"):
        baseline_ranks(baseline, value).write.mode("overwrite").parquet(f"{root}/baseline")
    ranks = spark.read.parquet(f"{root}/baseline")
    rows = live.select(F.window(F.col(ts).cast("timestamp"), width).alias("w"), F.col(value).alias("value"), F.col(ts).alias("_ts"))
    rows = plain_time(rows.select("w.start", "w.end", "value", "_ts"), "start", "end").filter("value is not null and not isnan(value)")

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(F.to_date("start").alias("day"), "start", "end", "value").agg(
            F.count(F.lit(1)).alias("n"), F.max("_ts").alias("newest")
        )
        counts.write.mode("overwrite").parquet(f"{root}/counts/batch_id={batch_id}")
        seen = spark.read.parquet(f"{root}/counts")
        # A batch only closes what no earlier one has: windows whose end the watermark passed with it.
        upto = lambda ids: F.max(F.when(ids, F.col("newest"))) - F.expr(f"interval {int(delay_minutes)} minutes")
        marks = seen.agg(upto(F.col("batch_id") <= batch_id).alias("now"), upto(F.col("batch_id") < batch_id).alias("was")).first()
        closed = seen.filter((F.col("batch_id") <= batch_id) & (F.col("end") <= F.lit(marks["now"])))
        if marks["was"]:
            # Rows for windows that are closed already are late.
            closed = closed.filter(F.col("end") > F.lit(marks["was"]))
        if marks["now"]:
            merged = closed.groupBy("start", "end", "value").agg(F.sum("n").alias("n"))
            found = ks_against(merged, ranks, ["start", "end"])
            found.write.mode("overwrite").parquet(f"{root}/windows/batch_id={batch_id}")

    run_batches(rows, root, write)
    return spark.read.parquet(f"{root}/windows").select(
        F.col("start").alias("window_start"), F.col("end").alias("window_end"), "n_baseline", "n_live", "d"
    )


def windowed_drift(
    baseline: DataFrame, live: DataFrame, value: str, ts: str, root: str, delay: str, width: str
) -> DataFrame:
    """PSI and binned KS distance of each window against a fixed baseline.

    The baseline is reduced to nine edges and ten shares before the stream starts; the stream
    keeps ten counters per open window.
    """
    edges = exact_quantiles(baseline, value, DECILES, alias="edges").first()["edges"]
    bins = range(len(edges) + 1)
    bin_of = S.bin_index(F.col(value), edges)
    in_bin = lambda b: F.count_if(bin_of == b).alias(f"b{b}")
    base = baseline.agg(F.count(F.lit(1)).alias("n"), *[in_bin(b) for b in bins]).first()
    expected = [base[f"b{b}"] / base["n"] for b in bins]

    counts = [F.count(F.lit(1)).alias("n_live"), *[in_bin(b) for b in bins]]
    table = run_to_table(windowed(live, ts, delay, width, [], counts), root)
    actual = [F.col(f"b{b}") / F.col("n_live") for b in bins]
    psi = psi_from_shares([F.lit(e) for e in expected], actual)
    gaps, seen, known = [], F.lit(0.0), 0.0
    for e, a in zip(expected, actual):
        known, seen = known + e, seen + a
        gaps.append(F.abs(seen - F.lit(known)))
    enough = F.col("n_live") >= config.MIN_LOGGED_ROWS
    return plain_time(table, "window_start", "window_end").select(
        "window_start",
        "window_end",
        F.when(enough, F.lit(config.STATUS_CHECKED)).otherwise(F.lit(config.STATUS_FEW_ROWS)).alias("status"),
        "n_live",
        F.when(enough, F.round(psi, 4)).alias("psi"),
        F.when(enough, F.round(F.greatest(*gaps), 4)).alias("ks_binned"),
        F.when(enough, S.psi_band(psi)).alias("interpretation"),
    )


# ---- joins and de-duplication ------------------------------------------------------------------


# Places that the state of one entity is spread over in stream joins.
JOIN_SALTS = 4

# A join holds the rows that a batch leaves open. They are kept on disk, one store a partition for both sides, under
# one memory limit an executor; counting the rows of the state would read each key once more before it is written.
_STORE = "spark.sql.streaming.stateStore"
JOIN_STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while: a stream takes them along when it starts."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _labelled(predictions: DataFrame, labels: DataFrame, how: str, delay: str, days: int, salts: int) -> DataFrame:
    """The interval join of both streams. An entity's predictions are dealt over ``salts`` places, its labels are in each."""
    left = event_time(predictions, "predicted_at").withWatermark("predicted_at", delay)
    left = left.withColumn("_salt", F.pmod(F.xxhash64("predicted_at", "calibrated_score"), F.lit(salts)).cast("int"))
    right = event_time(labels, "label_observed_at").withWatermark("label_observed_at", delay)
    places = F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("_place")
    right = right.withColumnRenamed("entity_id", "_entity").select("*", places)
    in_time = (F.col("label_observed_at") >= F.col("predicted_at")) & (
        F.col("label_observed_at") <= F.col("predicted_at") + F.expr(f"interval {int(days)} days")
    )
    same = (F.col("entity_id") == F.col("_entity")) & (F.col("_salt") == F.col("_place"))
    return left.join(right, same & in_time, how).drop("_entity", "_salt", "_place")


def _settled_and_held(
    predictions: DataFrame, labels: DataFrame, root: str, how: str, delay: str, days: int, salts: int
) -> DataFrame:
    """The interval join of both streams, with only those rows in its state that another batch may concern.

    A prediction is settled within its batch, in a plain join, if its days begin after every label of the batches before
    and end before the watermark that its own batch leaves: earlier labels are too old for it, and later ones come
    too late for any prediction. Each of the others is handed on to the join with state, and so is every label that may
    belong to one of them. The newest row of each side is always among them: that join has the watermark of the
    whole streams. What the watermark of the batches before has passed is late and handed on no more.
    """
    spark = predictions.sparkSession
    left, right = event_time(predictions, "predicted_at"), event_time(labels, "label_observed_at")
    slack = left.withWatermark("predicted_at", delay).schema["predicted_at"].metadata["spark.watermarkDelayMs"]
    # One stream of both, so that a batch has the same rows of either whenever it is run.
    rows = left.select(F.struct("*").alias("prediction")).unionByName(
        right.select(F.struct("*").alias("label")), allowMissingColumns=True
    )
    in_days = F.expr(f"interval {int(days)} days")

    def newest(batch: DataFrame, batch_id: int) -> tuple[list[int], list[int]]:
        """The newest prediction and label before the batch and with it, in microseconds (zero: none)."""
        was = [0, 0]
        if batch_id:
            was = [*spark.read.parquet(f"{root}/newest/batch_id={batch_id - 1}").first()]
        # Rows without an entity have no partner, and do not always move the clock.
        of = lambda side, at: F.max(F.when(F.col(f"{side}.entity_id").isNotNull(), F.unix_micros(f"{side}.{at}")))
        found = batch.agg(of("prediction", "predicted_at"), of("label", "label_observed_at")).first()
        now = [max(a, b or 0) for a, b in zip(was, found)]
        kept = spark.createDataFrame([tuple(now)], "prediction bigint, label bigint")
        kept.coalesce(1).write.mode("overwrite").parquet(f"{root}/newest/batch_id={batch_id}")
        return was, now

    def write(batch: DataFrame, batch_id: int) -> None:
        was, now = newest(batch, batch_id)
        moment = lambda micros: F.timestamp_micros(F.lit(micros))
        # Watermarks are whole milliseconds and begin at zero.
        late, mark = (moment(max(min(n) // 1000 - slack, 0) * 1000) for n in (was, now))
        at, seen = F.col("prediction.predicted_at"), F.col("label.label_observed_at")
        settled = (at > moment(was[1])) & (at + in_days < mark)
        # A day more than needed, as days need not have 24 hours.
        near = F.expr(f"interval {int(days) + 1} days")
        wanted = (seen >= mark - near) | (seen <= moment(max(was)) + near)
        held = F.when(F.col("label").isNull(), (at > late) & ~settled).otherwise((seen > late) & wanted)
        if "_SUCCESS" not in sinks.children(spark, f"{root}/held/batch_id={batch_id}"):
            # Once: the join with state takes each file as new rows.
            batch.filter(held).write.mode("overwrite").parquet(f"{root}/held/batch_id={batch_id}")
        own = batch.filter(settled).select("prediction.*")
        joined = _labelled(own, batch.filter("label is not null").select("label.*"), how, delay, days, 1)
        joined.write.mode("overwrite").parquet(f"{root}/settled/batch_id={batch_id}")

    for name in ("held", "settled"):
        sinks.make_folder(spark, f"{root}/{name}")
    run_batches(rows, f"{root}/batches", write)
    held = spark.readStream.schema(rows.schema).parquet(f"{root}/held")
    side = lambda name: held.filter(F.col(name).isNotNull()).select(f"{name}.*")
    joined = _labelled(side("prediction"), side("label"), how, delay, days, salts)
    with settings(spark, JOIN_STATE):
        found = run_to_table(joined, root)
    settled = spark.read.schema(joined.schema).parquet(f"{root}/settled").select(*joined.columns)
    found = found.unionByName(settled)
    return plain_time(found, "predicted_at", "label_observed_at")


def label_delay_join(
    predictions: DataFrame,
    labels: DataFrame,
    root: str,
    delay: str = "1 day",
    days: int = config.LABEL_DELAY_DAYS,
    salts: int = JOIN_SALTS,
) -> DataFrame:
    """Predictions with the label of their entity that arrives within the delay.

    Both sides are watermarked, so state is dropped once no partner can come.
    """
    return _settled_and_held(predictions, labels, root, "inner", delay, days, salts)


def label_outcomes(
    predictions: DataFrame,
    labels: DataFrame,
    root: str,
    delay: str = "1 day",
    days: int = config.LABEL_DELAY_DAYS,
    salts: int = JOIN_SALTS,
) -> DataFrame:
    """Every prediction's outcome: its label if one comes in time, else, once, that none did.

    A labelled prediction is written as soon as both are there. One without a label is held back until the
    watermark says that none can come any more; a label that comes later still changes nothing.
    """
    rows = _settled_and_held(predictions, labels, root, "left_outer", delay, days, salts)
    return rows.withColumn("outcome", F.when(F.col("label_observed_at").isNull(), F.lit("no_label_in_time")).otherwise(F.lit("labelled")))


def dedup_log(log: DataFrame, root: str, key: str, ts: str, delay: str = "1 day") -> DataFrame:
    """At-least-once deliveries reduced to one row per id, within the watermark."""
    once = event_time(log, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    return plain_time(run_to_table(once, root), ts)


def label_arrival(predictions: DataFrame, labels: DataFrame, days: int = config.LABEL_DELAY_DAYS) -> DataFrame:
    """Batch audit of the stream join: predictions by whether and when their label came.

    ``labels`` has one row per entity. What is not in time is what the stream leaves out.
    """
    joined = lookup_join(predictions, labels, ["entity_id"], "left")
    seen, at = F.col("label_observed_at"), F.col("predicted_at")
    arrival = (
        F.when(seen.isNull(), F.lit("no_label"))
        .when(seen < at, F.lit("before_prediction"))
        .when(seen <= at + F.expr(f"interval {int(days)} days"), F.lit("in_time"))
        .otherwise(F.lit("late"))
    )
    return joined.groupBy(arrival.alias("arrival")).agg(F.count(F.lit(1)).alias("predictions"))
