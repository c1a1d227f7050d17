"""Distribution drift: two-sample Kolmogorov-Smirnov, population stability, concept drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators import laws
from tidemark.operators.metrics import DECILES
from tidemark.operators.running import CUT_ACCURACY, CUT_POINTS, bucket_of, exact_quantiles, rough_quantiles, running_totals
from tidemark.operators.skew import join_group_values
from tidemark.session import materialized, ship, split_count

SERIES_TERMS = 100
PSI_FLOOR = 1e-6


def unpivot(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """(ids, feature, value) rows; columns the table lacks are left out."""
    present = [c for c in columns if c in df.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in present])
    return df.select(*ids, F.inline(cells))


def two_samples(baseline: DataFrame, live: DataFrame, columns: list[str]) -> DataFrame:
    """Both tables as (feature, value, is_live) rows, for the features they share."""
    shared = [c for c in columns if c in baseline.columns and c in live.columns]
    tagged = [
        unpivot(df.withColumn("is_live", F.lit(side)), ["is_live"], shared)
        for df, side in ((baseline, False), (live, True))
    ]
    return tagged[0].unionByName(tagged[1])


def kolmogorov_p(d: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic p-value. Below 0.2 the alternating series has no accuracy and p is 1."""
    root = F.sqrt(n1.cast("double") * n2.cast("double") / (n1 + n2).cast("double"))
    lam = (root + 0.12 + 0.11 / root) * d
    term = lambda k: F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(
        F.lit(-2.0) * (k * k).cast("double") * lam * lam
    )
    ks = F.sequence(F.lit(1), F.lit(SERIES_TERMS))
    series = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + term(k))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)


def ks_distance(long: DataFrame, by: list[str], value: str = "value", live: str = "is_live") -> DataFrame:
    """D and both sample sizes per group. ``long`` has both samples, told apart by ``live``."""
    usable = long.filter(F.col(value).isNotNull() & ~F.isnan(value))
    counts = usable.groupBy(*by, value).agg(
        F.count_if(~F.col(live)).alias("a"), F.count_if(F.col(live)).alias("b")
    )
    ranked = running_totals(counts, value, ["a", "b"], by)
    share = lambda s: F.col(f"cum_{s}").cast("double") / F.nullif(F.col(f"all_{s}").cast("double"), F.lit(0.0))
    return ranked.groupBy(*by).agg(
        F.max(F.abs(share("a") - share("b"))).alias("d"),
        F.max("all_a").alias("n_baseline"),
        F.max("all_b").alias("n_live"),
    )


def baseline_ranks(baseline: DataFrame, value: str) -> DataFrame:
    """Every distinct ``value`` of the baseline with its count ``n``, the count up to it, the total, and the piece
    of the value range that it is in (``_cuts`` are the ends of all pieces). Written once, for many windows."""
    pieces = split_count(baseline.sparkSession)
    usable = baseline.filter(F.col(value).isNotNull() & ~F.isnan(value))
    counts = materialized(usable.groupBy(F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n")), "baseline-counts")
    ends = [(i + 1) / pieces for i in range(pieces - 1)]
    cuts = rough_quantiles(counts, "value", ends, points=max(CUT_POINTS, 2 * pieces), accuracy=max(CUT_ACCURACY, 10 * pieces))
    ranked = running_totals(counts, "value", ["n"]).withColumn("_cuts", cuts.select("points").scalar())
    return materialized(ranked.withColumn("_piece", bucket_of(F.col("value"), "_cuts", pieces - 1)), "baseline-ranks")


def ks_against(counts: DataFrame, ranks: DataFrame, by: list[str]) -> DataFrame:
    """D of every group of (by, value, n) against the baseline of :func:`baseline_ranks`, exactly.

    Between two of its values a group's own distribution is flat, so the greatest gap is at or just below one of
    them: only there are the baseline's counts looked up, for all groups in one pass over the pieces of the range.
    """
    pieces = split_count(ranks.sparkSession)
    # One row a piece: where the count stands before it.
    ends = materialized(ranks.groupBy("_piece").agg(F.max("cum_n").alias("_upto")), "piece-ends")
    cuts = ranks.agg(F.first("_cuts").alias("c"), F.max("all_n").alias("total"))
    own = running_totals(counts, "value", ["n"], by)
    whole = cuts.select(F.struct("c", "total").alias("_b")).scalar()
    own = own.withColumn("_b", whole).withColumns({"_cuts": F.col("_b.c"), "n_baseline": F.coalesce("_b.total", F.lit(0))})
    own = own.withColumn("_piece", bucket_of(F.col("value"), "_cuts", pieces - 1))
    seen = F.struct("value", "n", "cum_n").alias("_seen")
    line = ranks.select("_piece", "value", F.lit(0).alias("_side"), seen).unionByName(
        own.select("_piece", "value", F.lit(1).alias("_side"), F.struct(*by, "n", "cum_n", "all_n", "n_baseline").alias("_own")),
        allowMissingColumns=True,
    )
    upto = W.partitionBy("_piece").orderBy("value", "_side").rowsBetween(W.unboundedPreceding, 0)
    met = line.withColumn("_seen", F.last("_seen", ignorenulls=True).over(upto)).filter(F.col("_own").isNotNull())
    before = ends.select(F.col("_piece").alias("_p"), "_upto")
    before = before.select((F.col("_p") + 1).alias("_piece"), F.max("_upto").over(W.orderBy("_p")).alias("_before"), F.lead("_p").over(W.orderBy("_p")).alias("_next"))
    spans = before.select(F.explode(F.sequence("_piece", F.coalesce("_next", F.lit(pieces)))).alias("_piece"), "_before")
    met = met.join(spans, "_piece", "left").withColumn("_before", F.coalesce("_before", F.lit(0)))
    at = F.coalesce("_seen.cum_n", "_before")
    below = F.when(F.col("_seen.value") == F.col("value"), at - F.col("_seen.n")).otherwise(at)
    share = lambda top, bottom: top.cast("double") / F.nullif(F.col(bottom).cast("double"), F.lit(0.0))
    gaps = met.select(
        *[F.col("_own")[c].alias(c) for c in by],
        F.col("_own.all_n").alias("n_live"),
        F.col("_own.n_baseline").alias("n_baseline"),
        at.alias("_at"), below.alias("_below"), F.col("_own.cum_n").alias("_cum"), F.col("_own.n").alias("_n"),
    )
    high = F.abs(share(F.col("_at"), "n_baseline") - share(F.col("_cum"), "n_live"))
    low = F.abs(share(F.col("_below"), "n_baseline") - share(F.col("_cum") - F.col("_n"), "n_live"))
    return gaps.groupBy(*by).agg(
        F.max("n_baseline").alias("n_baseline"), F.max("n_live").alias("n_live"), F.max(F.greatest(high, low)).alias("d")
    )


def ks_drift(long: DataFrame, by: list[str], exact: bool = False) -> DataFrame:
    """KS statistic, p-value and drift flag per group; too few live rows give no verdict.

    The p-value is asymptotic and stays in the engine, or with ``exact`` that of :mod:`tidemark.operators.laws`.
    """
    out = ks_distance(long, by)
    enough = F.col("n_live") >= config.MIN_LOGGED_ROWS
    p = kolmogorov_p(F.col("d"), F.col("n_baseline"), F.col("n_live"))
    if exact:
        ship(long.sparkSession)
        out = out.withColumn("_p", laws.p_value(F.col("d"), F.col("n_baseline"), F.col("n_live")))
        p = F.col("_p")
    return out.select(
        *by,
        F.when(enough, F.lit(config.STATUS_CHECKED)).otherwise(F.lit(config.STATUS_FEW_ROWS)).alias("status"),
        "n_live",
        F.when(enough, F.round("d", 4)).alias("ks_stat"),
        F.when(enough, F.round(p, 6)).alias("p_value"),
        F.when(enough, p < config.KS_P_LIMIT).alias("drifted"),
    )


def psi_from_shares(expected: list[Column], actual: list[Column]) -> Column:
    """Sum of (a - e) * ln(a / e) over bins, with shares clipped from below."""
    total = F.lit(0.0)
    for e, a in zip(expected, actual):
        e, a = F.greatest(e, F.lit(PSI_FLOOR)), F.greatest(a, F.lit(PSI_FLOOR))
        total = total + (a - e) * F.ln(a / e)
    return total


def psi(long: DataFrame, by: list[str] | None = None, value: str = "value", live: str = "is_live") -> DataFrame:
    """Population stability index over the baseline's deciles, one row (per group).

    Two passes over the values, written once: exact edges from the baseline, then one count per bin
    and side. A value on an edge belongs above it, and repeated edges leave an empty bin.
    """
    by = by or []
    long = materialized(long.select(*by, value, live), "psi")
    edges = exact_quantiles(long.filter(~F.col(live)), value, DECILES, by, alias="_edges")
    if by:
        rows = join_group_values(long, edges, by, "edges")
    else:
        rows = long.withColumn("_edges", edges.scalar())
    bins = len(DECILES) + 1
    usable = F.col(value).isNotNull() & ~F.isnan(value)
    bin_no = F.when(usable, S.edges_passed(F.col(value), F.col("_edges"), len(DECILES)))
    rows = rows.select(*by, F.col(live).alias("_live"), bin_no.alias("_bin"))
    aggs = [
        F.count_if((F.col("_live") == side) & (F.col("_bin") == b)).alias(f"_{tag}{b}")
        for tag, side in (("e", False), ("a", True))
        for b in range(bins)
    ]
    sums = rows.groupBy(*by).agg(
        F.count_if(~F.col("_live")).alias("n_baseline"), F.count_if(F.col("_live")).alias("n_live"), *aggs
    )
    share = lambda tag, n: [
        F.col(f"_{tag}{b}").cast("double") / F.nullif(F.col(n).cast("double"), F.lit(0.0)) for b in range(bins)
    ]
    value_col = psi_from_shares(share("e", "n_baseline"), share("a", "n_live"))
    enough = F.col("n_live") >= config.MIN_LOGGED_ROWS
    return sums.select(
        *by,
        F.when(enough, F.lit(config.STATUS_CHECKED)).otherwise(F.lit(config.STATUS_FEW_ROWS)).alias("status"),
        "n_live",
        F.when(enough, F.round(value_col, 4)).alias("psi"),
        F.when(enough, S.psi_band(value_col)).alias("interpretation"),
    )


def concept_verdict(ks_drifted: Column, f1_before: Column, f1_after: Column, drop: float = 0.05) -> Column:
    """Inputs unchanged but F1 down means concept drift; inputs changed means data drift."""
    fell = (f1_before - f1_after) > drop
    return (
        F.when(ks_drifted, F.lit("data_drift"))
        .when(fell, F.lit("concept_drift"))
        .otherwise(F.lit("stable"))
    )
