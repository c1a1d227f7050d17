"""Model registry as append-only tables: versions, cards and a pointer log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators.asof import latest
from tidemark.operators.metrics import ranking_metrics
from tidemark.operators.running import exact_quantiles


def list_versions(versions: DataFrame, cards: DataFrame, pointers: DataFrame) -> DataFrame:
    """Every card with its stage, oldest first; versions whose registration left no card are skipped.

    The stage is what points at the version now, production before staging, else none.
    """
    now = current_pointers(pointers).select("model", "version", "stage")
    at = lambda stage: now.filter(F.col("stage") == stage).select("model", "version", F.lit(stage).alias(f"_{stage}"))
    out = versions.join(cards, ["model", "version"], "inner")
    for stage in ("production", "staging"):
        out = out.join(at(stage), ["model", "version"], "left")
    stage = F.coalesce("_production", "_staging", F.lit("none")).alias("stage")
    return out.select("*", stage).drop("_production", "_staging").orderBy("model", "version")


def latest_version(cards: DataFrame, wanted: str | None = None) -> DataFrame:
    """Per model the newest version with a card, or the one asked for."""
    pool = cards.filter(F.col("version") == wanted) if wanted else cards
    return pool.groupBy("model").agg(F.max("version").alias("version"))


def current_pointers(pointers: DataFrame) -> DataFrame:
    """What each stage points at now: the last entry of the log."""
    return latest(pointers, ["model", "stage"], ["pointed_at", "seq"])


def serving_state(pointers: DataFrame, cards: DataFrame, canary_pct: int) -> DataFrame:
    """Champion and challenger per model with their thresholds.

    There is a challenger only if one is staged and the canary share is above zero; without a
    production version the model cannot serve.
    """
    current = current_pointers(pointers)
    at = lambda stage, name: current.filter(F.col("stage") == stage).select("model", F.col("version").alias(name))
    staged = at("production", "champion_version").join(at("staging", "_staging"), "model", "full")
    if canary_pct > 0:
        challenger = F.when(F.col("champion_version").isNotNull(), F.col("_staging"))
    else:
        challenger = F.lit(None).cast("string")
    state = staged.withColumn("challenger_version", challenger).drop("_staging")

    def card(role: str) -> DataFrame:
        return cards.select(
            "model",
            F.col("version").alias(f"{role}_version"),
            F.col("t_low").alias(f"{role}_t_low"),
            F.col("t_high").alias(f"{role}_t_high"),
        )

    for role in ("champion", "challenger"):
        state = state.join(card(role), ["model", f"{role}_version"], "left")
    status = F.when(F.col("champion_version").isNull(), F.lit(config.STATUS_NO_MODEL)).otherwise(F.lit("ok"))
    return state.select(
        "model",
        status.alias("status"),
        "champion_version",
        "champion_t_low",
        "champion_t_high",
        "challenger_version",
        "challenger_t_low",
        "challenger_t_high",
        F.lit(canary_pct).alias("canary_pct"),
    )


def slice_metrics(scores: DataFrame, weight: str | None = None) -> DataFrame:
    """Ranking metrics of every (version, slice) of (version, slice, label, score), in one plan."""
    return ranking_metrics(scores, by=["version", "slice"], weight=weight)


def champion_challenger(
    metrics: DataFrame, challenger: str, champion: str | None, limit: float = config.MAX_AP_REGRESSION
) -> DataFrame:
    """Per slice, whether the challenger's average precision holds up against the champion's.

    ``metrics`` comes from :func:`slice_metrics`. Without a champion every slice passes.
    """
    of = lambda version, c: F.max(F.when(F.col("version") == version, F.col(c)))
    none = F.max(F.lit(None).cast("double"))
    per_slice = metrics.groupBy("slice").agg(
        (of(champion, "average_precision") if champion else none).alias("champion_ap"),
        (of(champion, "roc_auc") if champion else none).alias("champion_auc"),
        of(challenger, "average_precision").alias("challenger_ap"),
        of(challenger, "roc_auc").alias("challenger_auc"),
    )
    regression = F.coalesce(F.col("champion_ap") - F.col("challenger_ap"), F.lit(0.0))
    ok = F.when(F.col("champion_ap").isNull(), F.lit(True)).otherwise(regression <= limit)
    return per_slice.select("*", regression.alias("regression"), ok.alias("passed"))


def gate_verdict(per_slice: DataFrame) -> DataFrame:
    return per_slice.agg(F.bool_and("passed").alias("passed"))


def promotion(per_slice: DataFrame, version: str, dry_run: bool = False) -> DataFrame:
    """The pointer move that follows from the gate, with its alert.

    A passing version goes to production unless this is a dry run; a failing one is staged
    either way.
    """
    passed = F.col("passed")
    stage = F.when(~passed, F.lit("staging")).when(F.lit(not dry_run), F.lit("production"))
    severity = F.when(passed, F.lit("warning")).otherwise(F.lit("critical"))
    message = F.when(passed, F.lit(config.MESSAGE_PROMOTED % version)).otherwise(
        F.lit(config.MESSAGE_NOT_PROMOTED % version)
    )
    silent = passed & F.lit(dry_run)
    return gate_verdict(per_slice).select(
        F.lit(version).alias("version"),
        "passed",
        F.lit(dry_run).alias("dry_run"),
        stage.alias("stage"),
        F.when(~silent, S.alert_line(severity, message)).alias("alert"),
    )


def slices_of(df: DataFrame, in_slice: Column, names: tuple[str, str]) -> DataFrame:
    """Every row in the whole set, and once more in the harder slice it belongs to."""
    whole, hard = names
    tags = F.when(in_slice, F.array(F.lit(whole), F.lit(hard))).otherwise(F.array(F.lit(whole)))
    return df.withColumn("slice", F.explode(tags))


def eval_slices(holdout: DataFrame, feature: str = "support_tickets_30d") -> DataFrame:
    """The whole holdout, and its rows at or above the 75th percentile of ``feature``."""
    edge = exact_quantiles(holdout, feature, [0.75], alias="q").select(F.col("q")[0])
    tagged = holdout.withColumn("_edge", edge.scalar())
    heavy = F.col(feature) >= F.col("_edge")
    return slices_of(tagged, heavy, config.EVAL_SLICES).drop("_edge")
