"""Feature history that is prepared once for many as-of joins: bucketed and sorted by key.

A join shuffles its probes only. The history is read bucket by bucket, where it lies, and neither shuffled nor
rewritten. Keys with too many rows for a task are cut into time slices when the history is prepared, and each slice
begins with a copy of the last row before it. So a probe needs no more than its own slice. Later batches are
appended to the same buckets; a late row that ends its slice is copied to the next one as well.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.asof import TIMELINE, asof_join, cut_points, placed
from tidemark.operators.skew import TASK_ROWS, hot_keys, prefixed, same_key, split_by_heat
from tidemark.session import scratch_dir, split_count


@dataclass(frozen=True)
class PreparedHistory:
    """A bucketed table of the session's catalogue, with the cuts of its hot keys."""

    spark: SparkSession
    table: str
    path: str
    buckets: int
    by: list[str]
    on: str
    seq: str
    values: list[str]
    cuts: DataFrame | None
    task_rows: int

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def slice_of(self, rows: DataFrame, time: Column) -> DataFrame:
        """``rows`` with their slice, and the place that this key and slice are bucketed by."""
        if self.cuts is None:
            out = rows.withColumns({"_seg": F.lit(0), "_heavy": F.lit(False)})
        else:
            out = placed(rows, self.by, time, self.cuts)
        return out.withColumn("_place", F.xxhash64(*self.by, F.col("_seg")))


def _columns(prepared: PreparedHistory, history: DataFrame) -> DataFrame:
    """The table's columns; equal times that fill a slice are reduced to their last write."""
    rows = prepared.slice_of(history, F.col(prepared.on)).select(
        "_place",
        *prepared.by,
        "_seg",
        F.col(prepared.on).alias("_t"),
        F.col(prepared.seq).cast("bigint").alias("_seq"),
        F.struct(*prepared.values).alias("_snap"),
        "_heavy",
    )
    if prepared.cuts is None:
        return rows.drop("_heavy")
    at = ["_place", *prepared.by, "_seg", "_t"]
    last = rows.filter("_heavy").groupBy(*at).agg(F.max_by("_snap", "_seq").alias("_snap"), F.max("_seq").alias("_seq"))
    return rows.filter("not _heavy").drop("_heavy").unionByName(last)


def _carried(prepared: PreparedHistory, rows: DataFrame) -> DataFrame:
    """``rows``, and the last one of every slice once more, as the first of the next slice."""
    if prepared.cuts is None:
        return rows
    by = prepared.by
    ends = prefixed(prepared.cuts.select(*by, F.size("_cuts").alias("_last")), by, "_c_")
    inner = rows.join(ends, same_key(rows, ends, by, "_c_")).filter(F.col("_seg") < F.col("_last"))
    newest = inner.groupBy(*by, "_seg").agg(F.max("_t").alias("_end"))
    newest = prefixed(newest, [*by, "_seg"], "_n_")
    at = same_key(inner, newest, [*by, "_seg"], "_n_") & (inner["_t"] == newest["_end"])
    tied = inner.join(newest, at).groupBy(*by, "_seg", "_t")
    last = tied.agg(F.max_by("_snap", "_seq").alias("_snap"), F.max("_seq").alias("_seq"))
    moved = last.withColumn("_seg", F.col("_seg") + 1).withColumn("_place", F.xxhash64(*by, F.col("_seg")))
    return rows.unionByName(moved.select(*rows.columns))


def append(prepared: PreparedHistory, batch: DataFrame) -> None:
    """Adds a batch to the buckets; what is there is not read. Keys that become hot stay whole until prepared anew."""
    rows = _carried(prepared, _columns(prepared, batch))
    writer = rows.repartition(prepared.buckets, "_place").write.mode("append").option("path", prepared.path)
    writer.bucketBy(prepared.buckets, "_place").sortBy("_place", "_t").saveAsTable(prepared.table)


def prepare(
    history: DataFrame,
    by: list[str],
    on: str,
    seq: str,
    values: list[str],
    buckets: int | None = None,
    task_rows: int = TASK_ROWS,
) -> PreparedHistory:
    """Writes ``history`` for later joins by ``by`` and time ``on``; ``seq`` decides between equal times."""
    spark = history.sparkSession
    hot = hot_keys(history, by, task_rows)
    cuts = None
    if hot is not None:
        # Without empty slices: each has a row of its own to hand on.
        cuts = cut_points(split_by_heat(history, by, hot)[1], by, on, hot).withColumn("_cuts", F.array_distinct("_cuts"))
    name = f"history_{uuid.uuid4().hex}"
    path = scratch_dir(spark, "prepared-history")
    prepared = PreparedHistory(
        spark, name, path, buckets or split_count(spark), by, on, seq, values, cuts, task_rows
    )
    append(prepared, history)
    return prepared


def _joined(prepared: PreparedHistory, probes: DataFrame, columns: list[str], inclusive: bool) -> DataFrame:
    """Probes with their slice and place, against the buckets. The place gets another name after it has been
    dealt by, on both sides alike: only then does the union keep the buckets, and nothing is shuffled again."""
    first, second = (0, 1) if inclusive else (1, 0)
    line = [*prepared.by, "_seg"]
    own = F.struct(*columns)
    dealt = probes.repartition(prepared.buckets, "_place")
    asked = dealt.select(F.col("_place").alias("_spot"), *line, F.col("_time").alias("_t"), F.lit(second).alias("_side"), own.alias("_own"))
    snaps = prepared.rows().select(F.col("_place").alias("_spot"), *line, "_t", F.lit(first).alias("_side"), "_seq", "_snap")
    both = snaps.unionByName(asked, allowMissingColumns=True)
    upto = W.partitionBy("_spot", *line).orderBy(*TIMELINE).rowsBetween(W.unboundedPreceding, 0)
    filled = both.withColumn("_snap", F.last("_snap", ignorenulls=True).over(upto)).filter(F.col("_own").isNotNull())
    return filled.select(*[F.col("_own")[c].alias(c) for c in columns], *[F.col("_snap")[c].alias(c) for c in prepared.values])


def asof(left: DataFrame, prepared: PreparedHistory, left_on: str, inclusive: bool = True) -> DataFrame:
    """Every left row with the newest row of the history at or before its time, as :func:`asof_join` gives it.

    A slice that more left rows ask for than a task may carry is cut further, with those left rows, by that join.
    """
    by = prepared.by
    probes = prepared.slice_of(left.withColumn("_time", F.col(left_on)), F.col("_time")).drop("_heavy")
    crowded = hot_keys(probes, [*by, "_seg"], prepared.task_rows)
    if crowded is None:
        return _joined(prepared, probes, left.columns, inclusive)
    cold, hot = split_by_heat(probes, [*by, "_seg"], crowded)
    # That join has slices of its own.
    line = [*by, "_line"]
    rows = prepared.rows().withColumnRenamed("_seg", "_line")
    keys = prefixed(crowded.select(*by, F.col("_seg").alias("_line")), line, "_h_")
    asked_of = rows.join(keys, same_key(rows, keys, line, "_h_"), "left_semi").select(
        *line, "_t", "_seq", *[F.col("_snap")[c].alias(c) for c in prepared.values]
    )
    asked = hot.drop("_place").withColumnRenamed("_seg", "_line")
    cut = asof_join(asked, asked_of, line, "_time", "_t", "_seq", prepared.values, inclusive, prepared.task_rows)
    plain = _joined(prepared, cold, left.columns, inclusive)
    return plain.unionByName(cut.select(*left.columns, *prepared.values))
