"""Evaluation metrics of binary scores, as grouped distributed plans."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators.running import exact_quantiles, running_totals
from tidemark.session import materialized

COST_GRID = np.linspace(0.01, 0.99, 98).tolist()
COARSE_GRID = np.linspace(0.01, 0.99, 50).tolist()
DECILES = [i * 0.1 for i in range(1, 10)]


def score_counts(
    df: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score; a row may stand for ``weight`` rows."""
    by = by or []
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    return df.groupBy(*by, score).agg(
        F.sum(F.col(label).cast("bigint") * w).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint") * w).alias("neg"),
    )


def ranking_metrics(
    df: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """Average precision and ROC-AUC (ties counted half), one row (per group)."""
    by = by or []
    ranked = running_totals(score_counts(df, score, label, by, weight), score, ["pos", "neg"], by, True)
    d = lambda c: F.col(c).cast("double")
    no_zero = lambda c: F.nullif(c, F.lit(0.0))
    precision = d("cum_pos") / no_zero(d("cum_pos") + d("cum_neg"))
    gain = d("pos") / no_zero(d("all_pos"))
    below = d("all_neg") - d("cum_neg") + d("neg") / 2.0
    return ranked.groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_rows"),
        F.max("all_pos").alias("n_pos"),
        F.coalesce(F.sum(gain * precision), F.lit(0.0)).alias("average_precision"),
        F.sum(d("pos") * below / no_zero(d("all_pos") * d("all_neg"))).alias("roc_auc"),
    )


def _curve(ranked: DataFrame, point: dict[str, Column], extra: dict[str, float | None]) -> DataFrame:
    """One row per distinct score, and the curve's fixed end point next to the highest score."""
    own = F.struct(*[c.cast("double").alias(k) for k, c in point.items()])
    end = F.struct(*[F.lit(v).cast("double").alias(k) for k, v in extra.items()])
    highest = (F.col("cum_pos") + F.col("cum_neg")) == (F.col("pos") + F.col("neg"))
    return ranked.select(F.inline(F.when(highest, F.array(own, end)).otherwise(F.array(own))))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """False and true positive rate at every distinct threshold, from (inf, 0, 0) on."""
    ranked = running_totals(score_counts(df, score, label), score, ["pos", "neg"], descending=True)
    point = {
        "threshold": F.col(score),
        "fpr": S.ratio_or_zero(F.col("cum_neg"), F.col("all_neg")),
        "tpr": S.ratio_or_zero(F.col("cum_pos"), F.col("all_pos")),
    }
    return _curve(ranked, point, {"threshold": float("inf"), "fpr": 0.0, "tpr": 0.0})


def youden_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """The threshold with the largest TPR - FPR; the highest one among equals."""
    curve = roc_curve(df, score, label).withColumn("j", F.col("tpr") - F.col("fpr"))
    best = curve.agg(F.max(F.struct("j", "threshold", "fpr", "tpr")).alias("b"))
    return best.select("b.threshold", "b.j", "b.fpr", "b.tpr")


def pr_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision and recall at every distinct threshold, and the closing point (1, 0)."""
    ranked = running_totals(score_counts(df, score, label), score, ["pos", "neg"], descending=True)
    point = {
        "threshold": F.col(score),
        "precision": S.ratio_or_zero(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")),
        "recall": S.ratio_or_zero(F.col("cum_pos"), F.col("all_pos")),
    }
    return _curve(ranked, point, {"threshold": None, "precision": 1.0, "recall": 0.0})


def cost_curve(
    df: DataFrame,
    grid: list[float] = COST_GRID,
    score: str = "score",
    label: str = "label",
    by: list[str] | None = None,
) -> DataFrame:
    """False negatives and positives at each grid threshold, from one pass over the rows.

    Rows are counted per grid cell; the cumulation then runs over the len(grid) + 1 cells only.
    A missing or NaN score reaches no threshold.
    """
    by = by or []
    cells = df.select(*by, F.col(label).alias("_label"), cell_of(F.col(score), grid).alias("i"))
    return _cumulated(cells, F.array(*[F.lit(float(t)) for t in grid]), by)


def cell_of(score: Column, grid: list[float]) -> Column:
    known = score.isNotNull() & ~F.isnan(score)
    return F.when(known, S.bin_index(score, grid)).otherwise(F.lit(0))


def _cumulated(rows: DataFrame, thresholds: Column, by: list[str]) -> DataFrame:
    """Cost curves from the label and grid cell of every row."""
    cells = rows.groupBy(*by, "i").agg(
        F.sum(F.col("_label").cast("bigint")).alias("pos"), F.sum((1 - F.col("_label")).cast("bigint")).alias("neg")
    )
    # At most one cell more than thresholds in a group: one small array, so nothing reads the rows twice.
    packed = cells.groupBy(*by).agg(F.sum("neg").alias("all_neg"), F.collect_list(F.struct("i", "pos", "neg")).alias("cells"))
    frame = packed.select(*by, "all_neg", "cells", F.posexplode(thresholds).alias("i", "threshold"))

    def upto(part: str) -> Column:
        below = F.filter("cells", lambda c: c["i"] <= F.col("i"))
        return F.aggregate(below, F.lit(0).cast("bigint"), lambda acc, c: acc + c[part])

    return frame.select(*by, "i", "threshold", upto("pos").alias("fn"), (F.col("all_neg") - upto("neg")).alias("fp"))


def cost_curves(df: DataFrame, curves: dict[str, tuple[Column, list[float]]], label: str = "label") -> DataFrame:
    """Several cost curves (column ``curve``), each of a score and a grid, from one pass over the rows."""
    sides = F.array(
        *[
            F.struct(F.lit(name).alias("curve"), cell_of(score, grid).alias("i"))
            for name, (score, grid) in curves.items()
        ]
    )
    cells = df.select(F.col(label).alias("_label"), F.inline(sides))
    grids = F.create_map(*[x for n, (_, g) in curves.items() for x in (F.lit(n), F.array(*[F.lit(float(t)) for t in g]))])
    return _cumulated(cells, grids[F.col("curve")], ["curve"])


def cheapest(curve: DataFrame, cases: dict[str, tuple[float, float]]) -> DataFrame:
    """Per named (false negative, false positive) cost pair, the cheapest grid threshold.

    The first among equals. All cases come from one reading of the curve.
    """
    options = F.array(
        *[
            F.struct(
                F.lit(name).alias("boundary"),
                (F.col("fn") * fn + F.col("fp") * fp).cast("double").alias("cost"),
                F.col("i"),
                F.col("threshold"),
            )
            for name, (fn, fp) in cases.items()
        ]
    )
    best = curve.select(F.inline(options)).groupBy("boundary")
    return best.agg(F.min(F.struct("cost", "i", "threshold")).alias("b")).select(
        "boundary", "b.threshold", "b.cost"
    )


def cascade_thresholds(
    df: DataFrame, score: str = "score", label: str = "label", grid: list[float] = COST_GRID
) -> DataFrame:
    """Both tier boundaries from one cost curve. Thresholds are put in order; costs stay put."""
    return boundaries(cost_curve(df, grid, score, label))


def boundaries(curve: DataFrame) -> DataFrame:
    """Both tier boundaries of a cost curve, in order; costs stay put."""
    best = cheapest(curve, {"low": config.COST_LOW, "high": config.COST_HIGH})
    of = lambda name, c: F.max(F.when(F.col("boundary") == name, F.col(c)))
    return best.agg(
        F.min("threshold").alias("t_low"),
        F.max("threshold").alias("t_high"),
        of("low", "cost").alias("cost_low"),
        of("high", "cost").alias("cost_high"),
    )


def confusion(
    df: DataFrame, thresholds: list[float], score: str = "score", label: str = "label"
) -> DataFrame:
    """tp, fp, fn, tn at a few given thresholds, one row each, in one pass."""
    aggs = []
    for i, t in enumerate(thresholds):
        hit = S.predict_at(F.col(score), t) == 1
        true = F.col(label) == 1
        aggs += [
            F.count_if(hit & true).alias(f"tp{i}"),
            F.count_if(hit & ~true).alias(f"fp{i}"),
            F.count_if(~hit & true).alias(f"fn{i}"),
            F.count_if(~hit & ~true).alias(f"tn{i}"),
        ]
    cells = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "fn", "tn")],
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return df.agg(*aggs).select(F.inline(cells))


def prf_columns(tp: Column, fp: Column, fn: Column) -> list[Column]:
    return [
        S.ratio_or_zero(tp, tp + fp).alias("precision"),
        S.ratio_or_zero(tp, tp + fn).alias("recall"),
        S.ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def precision_recall_f1(
    df: DataFrame, pred: str = "pred", label: str = "label", by: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """Binary precision, recall and F1 (zero for empty denominators); optional row weights."""
    by = by or []
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    p, t = F.col(pred) == 1, F.col(label) == 1
    total = lambda hit: F.coalesce(F.sum(F.when(hit, w).otherwise(zero)), zero)
    sums = df.groupBy(*by).agg(
        F.coalesce(F.sum(w), zero).alias("n_rows"),
        total(p & t).alias("tp"),
        total(p & ~t).alias("fp"),
        total(~p & t).alias("fn"),
    )
    return sums.select(*by, "n_rows", *prf_columns(F.col("tp"), F.col("fp"), F.col("fn")))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    n, pos = F.count(F.lit(1)), F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0))
    sums = df.agg(n.alias("n_rows"), pos.alias("n_pos"))
    return sums.select(
        "n_rows",
        "n_pos",
        S.ratio_or_zero(F.col("n_pos"), F.col("n_rows")).alias("positive_rate"),
        F.try_divide(
            (F.col("n_rows") - F.col("n_pos")).cast("double"), F.col("n_pos").cast("double")
        ).alias("scale_pos_weight"),
    )


def reliability_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Mean score against observed rate in decile bins; a score on an edge stays below it.

    Score and label are written once: edges and bins read them, not the table.
    """
    df = materialized(df.select(score, label), "reliability")
    edges = exact_quantiles(df, score, DECILES, alias="edges").scalar()
    binned = df.withColumn("edges", edges).withColumn(
        "bin", S.edges_passed(F.col(score), F.col("edges"), len(DECILES), strict=True)
    )
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def tier_distribution(df: DataFrame, tier: str = "tier", label: str = "label") -> DataFrame:
    return df.groupBy(tier).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )


def recall_above_low(df: DataFrame, tier: str = "tier", label: str = "label") -> DataFrame:
    """Share of the positives that are not resolved automatically."""
    positive = F.col(label) == 1
    sums = df.agg(
        F.count_if(positive & (F.col(tier) != config.TIERS[0])).alias("caught"),
        F.count_if(positive).alias("n_pos"),
    )
    return sums.select(
        "caught",
        "n_pos",
        F.try_divide(F.col("caught").cast("double"), F.col("n_pos").cast("double")).alias("recall"),
    )
