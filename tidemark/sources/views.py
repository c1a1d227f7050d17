"""Inputs of the operators, derived from the given tables (whole tables, no subsets)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.asof import asof_join
from tidemark.sources.tables import table

DRIFT_SPLIT = "2024-01-15"
CONCEPT_SPLIT = "1998-04-15"
# What the served variant's name is put behind in the log.
SERVING_VERSION = "serving-"
CANARY_PCT = 25
SERVING_T_LOW = 0.2
SERVING_T_HIGH = 0.6


def _padded(prefix: str, number: str, width: int) -> Column:
    """``prefix`` and the number, zero-padded to ``width``; longer numbers keep all their digits."""
    digits = F.col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def customer_key(user: str = "user_id") -> Column:
    return _padded("cust_", user, 6)


def order_key(order: str) -> Column:
    return _padded("ord_", order, 9)


def raw_landing_of(events: DataFrame) -> DataFrame:
    """Cheap error events arrive without their key."""
    lost = (F.col("event_type") == "error") & (F.col("value") < 5)
    return events.select(
        "event_id",
        F.when(~lost, customer_key()).alias("entity_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("monthly_spend"),
    )


def raw_landing(spark: SparkSession, folder: str) -> DataFrame:
    return raw_landing_of(table(spark, folder, "events"))


def feature_history_of(events: DataFrame) -> DataFrame:
    """Feature snapshots; sign-ups are backfilled with a time stamp one day before their write."""
    backfilled = F.col("event_type") == "signup"
    return events.filter(F.col("event_type") != "purchase").select(
        customer_key().alias("entity_id"),
        F.when(backfilled, F.col("ts") - F.expr("interval 1 day")).otherwise(F.col("ts")).alias("ts"),
        F.col("event_id").alias("write_seq"),
        F.col("value").alias("spend"),
        F.from_json("props", "k double")["k"].alias("k"),
    )


def feature_history(spark: SparkSession, folder: str) -> DataFrame:
    return feature_history_of(table(spark, folder, "events"))


def label_events(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("label_id"),
            customer_key().alias("entity_id"),
            F.col("ts").alias("label_timestamp"),
            (F.col("value") >= 50).cast("int").alias("label"),
        )
    )


def features_clean(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order. Averages come from whole cents, so they are the same in any row order."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
            F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount_pct"),
        )
    )
    per_line = lambda c: F.col(c).cast("double") / F.col("n_lines").cast("double")
    out = (
        table(spark, folder, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            order_key("o_orderkey").alias("entity_id"),
            F.col("o_orderdate").alias("event_timestamp"),
            F.coalesce("returned", F.lit(0)).cast("double").alias("support_tickets_30d"),
            F.coalesce(per_line("cents") / 1000.0, F.lit(0.0)).alias("avg_message_length"),
            F.coalesce(1.0 + 4.0 * (1.0 - per_line("discount_pct") / 10.0), F.lit(3.0)).alias(
                "satisfaction_score"
            ),
            F.datediff(F.lit("2001-08-01").cast("date"), F.col("o_orderdate"))
            .cast("double")
            .alias("days_since_last_login"),
            (F.col("o_custkey") % 2000).cast("double").alias("tenure_days"),
            (F.col("o_totalprice") * 2.1).alias("monthly_spend"),
            F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        )
    )
    positive = (F.col("support_tickets_30d") >= 4) | (F.col("satisfaction_score") < 1.4)
    return out.withColumn("label", positive.cast("int"))


def labels_delayed(spark: SparkSession, folder: str) -> DataFrame:
    """Ground truth, observed 21 days later, for the orders that have any line."""
    return (
        features_clean(spark, folder)
        .filter(F.col("n_lines") > 0)
        .select(
            "entity_id",
            "event_timestamp",
            "label",
            S.label_available_at(F.col("event_timestamp")).alias("label_observed_timestamp"),
        )
    )


def request_score(flag_weight: float = 0.15) -> Column:
    """Score of a line, 0 to 1 in steps of a thousandth."""
    returned = F.when(F.col("l_returnflag") == "R", F.lit(flag_weight)).otherwise(F.lit(0.0))
    raw = F.round(F.col("l_quantity") / 50.0 * 0.5 + F.col("l_discount") * 3.0 + returned, 3)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw))


def scored_of(lineitem: DataFrame, flag_weight: float = 0.15) -> DataFrame:
    """Scored requests: several per entity. A lower weight makes a weaker model."""
    return lineitem.select(
        order_key("l_orderkey").alias("entity_id"),
        request_score(flag_weight).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("quantity"),
    )


def scored(spark: SparkSession, folder: str, flag_weight: float = 0.15) -> DataFrame:
    return scored_of(table(spark, folder, "lineitem"), flag_weight)


def inference_log_of(events: DataFrame, canary_pct: int = CANARY_PCT) -> DataFrame:
    score = F.least(F.lit(1.0), F.col("value") / 200.0)
    out = events.select(
        F.col("event_id").alias("request_id"),
        customer_key().alias("entity_id"),
        F.col("ts").alias("request_ts"),
        score.alias("calibrated_score"),
        ((F.col("event_type") == "error") & (F.col("value") > 250)).cast("int").alias("is_error"),
        F.col("value").alias("spend"),
        F.from_json("props", "k double")["k"].alias("k"),
    )
    served = S.pick_variant(S.sticky_bucket(F.col("entity_id")), canary_pct)
    return out.select(
        "*",
        F.concat(F.lit(SERVING_VERSION), served).alias("model_version"),
        S.tier(F.col("calibrated_score"), SERVING_T_LOW, SERVING_T_HIGH).alias("tier"),
        S.low_confidence(F.col("calibrated_score"), SERVING_T_LOW, SERVING_T_HIGH).alias("low_confidence"),
        served.alias("served_by"),
    )


def inference_log(spark: SparkSession, folder: str, canary_pct: int = CANARY_PCT) -> DataFrame:
    return inference_log_of(table(spark, folder, "events"), canary_pct)


def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Registered versions, one registry line (``model``) per customer, one version per sign-up."""
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "signup")
        .select(
            customer_key().alias("model"),
            F.col("event_id").alias("seq"),
            S.version_id(F.col("ts")).alias("version"),
            F.col("ts").alias("created_at"),
        )
    )


def model_cards(spark: SparkSession, folder: str) -> DataFrame:
    """Cards of the versions; a registration that broke off (value below 5) left none."""
    return (
        table(spark, folder, "events")
        .filter((F.col("event_type") == "signup") & (F.col("value") >= 5))
        .select(
            customer_key().alias("model"),
            S.version_id(F.col("ts")).alias("version"),
            F.least(F.lit(1.0), F.col("value") / 500.0).alias("t_low"),
            F.least(F.lit(1.0), F.col("value") / 250.0).alias("t_high"),
            (F.from_json("props", "k double")["k"] / 100.0).alias("pr_auc"),
        )
    )


def pointer_log(spark: SparkSession, folder: str) -> DataFrame:
    """Append-only promotions: each points at the model's newest version of that moment."""
    moves = (
        table(spark, folder, "events")
        .filter(F.col("event_type").isin("purchase", "click"))
        .select(
            customer_key().alias("model"),
            F.col("event_id").alias("seq"),
            F.when(F.col("event_type") == "purchase", F.lit("production"))
            .otherwise(F.lit("staging"))
            .alias("stage"),
            F.col("ts").alias("pointed_at"),
        )
    )
    joined = asof_join(
        moves,
        model_versions(spark, folder).select("model", "created_at", "seq", "version"),
        by=["model"],
        left_on="pointed_at",
        right_on="created_at",
        right_seq="seq",
        values=["version"],
    )
    return joined.filter(F.col("version").isNotNull())


def document_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Quality labels with the text length as the score."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return (
        table(spark, folder, "labels")
        .join(docs, "doc_id", "inner")
        .select(F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label"))
    )
