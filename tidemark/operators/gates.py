"""Quality gates: null-key quarantine, volume, uniqueness, referential integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators.skew import lookup_join


def routed(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """Every row with its route: ``quarantine`` for a null key, else ``clean``."""
    return df.withColumn(
        "route", F.when(F.col(key).isNull(), F.lit("quarantine")).otherwise(F.lit("clean"))
    )


def clean_rows(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def quarantined_rows(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return df.filter(F.col(key).isNull())


def drop_share(rows: Column, baseline: Column) -> Column:
    return F.lit(1.0) - rows.cast("double") / baseline.cast("double")


def quarantine_action(nulls: Column, passed: Column) -> Column:
    return (
        F.when(nulls == 0, F.lit(config.ACTION_PASS))
        .when(passed, F.format_string(config.ACTION_QUARANTINE, nulls))
        .otherwise(F.lit(config.ACTION_BLOCKED))
    )


def volume_action(passed: Column) -> Column:
    return F.when(passed, F.lit(config.ACTION_PASS)).otherwise(F.lit(config.ACTION_VOLUME))


def ingestion_gate(
    df: DataFrame,
    key: str = "entity_id",
    tolerance: float = config.MAX_QUARANTINE_RATE,
    baseline_rows: int = config.VOLUME_BASELINE_ROWS,
) -> DataFrame:
    """One row per check, from a single aggregation. Only the quarantine rate can block."""
    sums = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"))
    rate = S.ratio_or_zero(F.col("nulls"), F.col("rows"))
    sums = sums.select(
        "rows",
        "nulls",
        rate.alias("rate"),
        (rate <= tolerance).alias("rate_ok"),
        drop_share(F.col("rows"), F.lit(baseline_rows)).alias("drop"),
    ).withColumn("volume_ok", F.col("drop") < config.VOLUME_DROP_LIMIT)
    row = lambda check, passed, observed, share, action: F.struct(
        F.lit(check).alias("check_name"),
        passed.alias("passed"),
        observed.alias("observed"),
        F.round(share, 4).alias("share"),
        action.alias("action"),
        F.col("rate_ok").alias("batch_passed"),
    )
    checks = F.array(
        row(
            config.CHECK_NOT_NULL,
            F.col("rate_ok"),
            F.col("nulls"),
            F.col("rate"),
            quarantine_action(F.col("nulls"), F.col("rate_ok")),
        ),
        row(
            config.CHECK_VOLUME,
            F.col("volume_ok"),
            F.col("rows"),
            F.col("drop"),
            volume_action(F.col("volume_ok")),
        ),
    )
    return sums.select(F.inline(checks))


def rolling_volume_check(df: DataFrame, ts: str, days: int = config.ROLLING_VOLUME_DAYS) -> DataFrame:
    """Each day's rows against the mean of the days before it (one row per calendar day)."""
    daily = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    daily = daily.withColumn("_day_no", F.datediff("day", F.lit("1970-01-01").cast("date")))
    before = W.partitionBy(F.lit(0)).orderBy("_day_no").rangeBetween(-days, -1)
    out = daily.withColumn("baseline", F.avg("n_rows").over(before))
    drop = drop_share(F.col("n_rows"), F.col("baseline"))
    return out.select(
        "day",
        "n_rows",
        "baseline",
        drop.alias("drop_share"),
        (drop < config.VOLUME_DROP_LIMIT).alias("passed"),
    )


def unique_not_null(df: DataFrame, key: str) -> DataFrame:
    """Null count and rows after the first per key (nulls equal), via one grouped count."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    sums = groups.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )
    return sums.select(
        F.lit(config.TEST_UNIQUE % key).alias("test"),
        ((F.col("nulls") == 0) & (F.col("duplicates") == 0)).alias("passed"),
        "nulls",
        "duplicates",
    )


def orphan_keys(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Distinct feature keys without a label. Null matches null; both sides are reduced first."""
    left = features.select(key).distinct()
    right = labels.select(F.col(key).alias("_known")).distinct()
    return left.join(right, left[key].eqNullSafe(right["_known"]), "left_anti")


def referential_integrity(features: DataFrame, labels: DataFrame, key: str, sample: int = 5) -> DataFrame:
    """Orphan count and the first few orphans in key order.

    The sample comes from a top-k over the orphans, never from collecting them all.
    """
    orphans = orphan_keys(features, labels, key)
    count = orphans.agg(F.count(F.lit(1)).alias("n"))
    first = orphans.orderBy(key).limit(sample).agg(F.sort_array(F.collect_list(key)).alias("s"))
    return count.select(
        F.lit(config.TEST_RELATED % key).alias("test"),
        (F.col("n") == 0).alias("passed"),
        F.col("n").alias("orphaned_count"),
        F.array_join(first.scalar(), ",").alias("orphaned_sample"),
    )


def transformation_gate(features: DataFrame, labels: DataFrame, key: str = "entity_id") -> DataFrame:
    """Both tests, one row each, with the overall verdict."""
    tests = (
        unique_not_null(features, key)
        .select("test", "passed", "nulls", "duplicates")
        .unionByName(
            referential_integrity(features, labels, key).select("test", "passed", "orphaned_count"),
            allowMissingColumns=True,
        )
    )
    every = W.partitionBy(F.lit(0))
    return tests.withColumn("gate_passed", F.bool_and("passed").over(every))


def duplicate_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The rows after the first of their key (null keys included), in ``order``.

    The first row per key is a map-side-combined minimum; a key that repeats very often is
    spread by the lookup join instead of being ranked in one window.
    """
    firsts = (
        df.groupBy(key)
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .drop("_n")
    )
    joined = lookup_join(df, firsts, [key], "inner", True)
    return joined.filter(F.col(order) > F.col("_first")).drop("_first")


def gate_alerts(checks: DataFrame, source: str, severity: str, message: Column) -> DataFrame:
    """One alert row per failed check."""
    return checks.filter(~F.col("passed")).select(
        F.lit(source).alias("source"),
        F.lit(severity).alias("severity"),
        S.alert_line(F.lit(severity), message).alias("line"),
    )
