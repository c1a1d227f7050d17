"""Request routing and rollout checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S


def route_requests(
    requests: DataFrame, champion: DataFrame, challenger: DataFrame, canary_pct: int
) -> DataFrame:
    """Picks the variant per entity, then its score, tier and confidence flag.

    ``requests`` carries both scores; each thresholds frame is one row, read as a scalar.
    """
    served = S.pick_variant(S.sticky_bucket(F.col("entity_id")), canary_pct)
    is_new = F.col("served_by") == "challenger"
    rows = requests.select(
        "request_id",
        "entity_id",
        served.alias("served_by"),
        "champion_score",
        "challenger_score",
        as_struct(champion).scalar().alias("_old"),
        as_struct(challenger).scalar().alias("_new"),
    )
    pick = lambda c: F.when(is_new, F.col("_new")[c]).otherwise(F.col("_old")[c])
    rows = rows.select(
        "request_id",
        "entity_id",
        "served_by",
        F.when(is_new, F.col("challenger_score")).otherwise(F.col("champion_score")).alias("calibrated_score"),
        pick("t_low").alias("_t_low"),
        pick("t_high").alias("_t_high"),
    )
    score, lo, hi = F.col("calibrated_score"), F.col("_t_low"), F.col("_t_high")
    return rows.select(
        "request_id",
        "entity_id",
        "served_by",
        "calibrated_score",
        S.tier(score, lo, hi).alias("tier"),
        S.low_confidence(score, lo, hi).alias("low_confidence"),
    )


def as_struct(one_row: DataFrame) -> DataFrame:
    """A one-row frame as one struct column, to be read as a scalar in a single subquery."""
    return one_row.select(F.struct(*one_row.columns).alias("one"))


def canary_sla(log: DataFrame, stage: Column, sla: float = config.CANARY_ERROR_SLA) -> DataFrame:
    """Error rate of the canary's share of traffic per rollout stage.

    ``log`` has ``entity_id`` and ``is_error``. The rollout ends at the first breach, so later
    stages are marked as not reached. One row per stage of a fixed list of stages.
    """
    staged = log.withColumn("stage_pct", stage)
    in_canary = S.sticky_bucket(F.col("entity_id")) < F.col("stage_pct")
    out = _stage_rates(staged.withColumn("_in", in_canary))
    breach = F.col("error_rate") > sla
    earlier = W.partitionBy(F.lit(0)).orderBy("stage_pct").rowsBetween(W.unboundedPreceding, -1)
    return out.select(
        "stage_pct",
        "requests",
        "errors",
        "error_rate",
        F.when(breach, F.lit("BREACH")).otherwise(F.lit("OK")).alias("status"),
        (~F.coalesce(F.bool_or(breach).over(earlier), F.lit(False))).alias("reached"),
    )


def _stage_rates(staged: DataFrame) -> DataFrame:
    sums = staged.groupBy("stage_pct").agg(
        F.count_if("_in").alias("requests"),
        F.count_if(F.col("_in") & (F.col("is_error") == 1)).alias("errors"),
    )
    return sums.withColumn("error_rate", S.ratio_or_zero(F.col("errors"), F.col("requests")))


def threshold_alarm(log: DataFrame, ts: str, by: list[str], limit: int = 0, width: str = "300 seconds") -> DataFrame:
    """Tumbling windows whose error sum is over the limit."""
    sums = log.groupBy(F.window(ts, width).alias("w"), *by).agg(
        F.sum(F.col("is_error").cast("bigint")).alias("errors")
    )
    return sums.filter(F.col("errors") > limit).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "errors"
    )
