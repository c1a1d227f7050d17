"""Running totals over a global order, without sending that order through one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import count_passed
from tidemark.operators.skew import join_group_values
from tidemark.session import split_count


def bucket_of(value: Column, cuts: str, n: int) -> Column:
    """Number of ``cuts`` (n of them, sorted) that are <= value, found in two steps of ~sqrt(n)."""
    step = max(1, math.isqrt(n))
    coarse = F.array(*[F.get(F.col(cuts), F.lit(i)) for i in range(step - 1, n, step)])
    passed = F.size(F.filter(coarse, lambda c: value >= c)) * step
    fine = F.slice(F.col(cuts), passed + 1, F.lit(step))
    return passed + F.size(F.filter(fine, lambda c: value >= c))


# Places that sketches meet in (or as many as the session has shuffle partitions, if more), and points that each
# place hands on: many where ranks are looked for, few where ranges only have to be of similar size.
SKETCHES = 64
SKETCH_POINTS = 2_000
SKETCH_ACCURACY = 10_000
CUT_POINTS = 200
CUT_ACCURACY = 1_000
# A rough quantile is off by half a point and the sketch's own error; twice that is left over.
BAND = 10 / SKETCH_ACCURACY
# With fewer values a band would be about one rank wide.
FEW = int(2 / BAND)


def rough_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    points: int = SKETCH_POINTS,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Approximate quantiles (``points``) and the number of values ``n``, one row (per group).

    Scan tasks sketch their rows, and sketches meet in many places, not in one. Each hands on a fixed
    number of points, the ends included, with its weight; only these, whatever the table's size, are put in one order.
    """
    by = by or []
    grid = F.array(*[F.lit(i / (points - 1)) for i in range(points)])
    meet = max(SKETCHES, split_count(df.sparkSession))
    places = df.groupBy(*by, F.pmod(F.spark_partition_id(), F.lit(meet)).alias("_place")).agg(
        F.percentile_approx(value, grid, accuracy).alias("_grid"), F.count(value).alias("_n")
    )
    spread = places.filter("_n > 0").select(*by, "_n", F.explode("_grid").alias("_v"))
    ends = F.array(*[F.lit(float(p)) for p in probs])
    # Every point stands for the share of its place: its weight is that place's count.
    total = F.floor(F.sum("_n") / points).alias("n")
    return spread.groupBy(*by).agg(F.percentile("_v", ends, F.col("_n")).alias("points"), total)


def running_totals(
    counts: DataFrame,
    value: str,
    sums: list[str],
    by: list[str] | None = None,
    descending: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Adds ``cum_<s>`` (inclusive, in value order) and ``all_<s>`` for each column in ``sums``.

    ``counts`` has one row per (by, value): ties are collapsed before, so no value is split and
    none is hot. Values are cut into ``pieces`` ranges at approximate quantiles over all groups,
    which leaves at most one range's share of the rows in any (by, range), however the groups
    are sized. Each range keeps its own running sum and adds the total of the group's ranges
    before it. The cut points are one row; the totals join on the key the rows are shuffled by
    for their running sum anyway.
    """
    by = by or []
    n = (pieces or split_count(counts.sparkSession)) - 1
    ends = [(i + 1) / (n + 1) for i in range(n)]
    cuts = rough_quantiles(counts, value, ends, points=max(CUT_POINTS, 2 * n), accuracy=max(CUT_ACCURACY, 10 * n))
    rows = counts.withColumn("_cuts", cuts.select("points").scalar())
    rows = rows.withColumn("_piece", bucket_of(F.col(value), "_cuts", n)).drop("_cuts")

    groups = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    piece_order = F.col("_piece").desc() if descending else F.col("_piece").asc()
    before = groups.orderBy(piece_order).rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(*by, "_piece").agg(*[F.sum(s).alias(s) for s in sums])
    offsets = totals.select(
        *by,
        "_piece",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(s).over(groups).alias(f"all_{s}") for s in sums],
    )
    value_order = F.col(value).desc() if descending else F.col(value).asc()
    local = W.partitionBy(*by, "_piece").orderBy(value_order).rowsBetween(W.unboundedPreceding, 0)
    # A left join, though every row has its match: an inner one would put null tests on the raw
    # rows, and the branches would no longer share the shuffle.
    out = rows.join(offsets, [*by, "_piece"], "left")
    return out.select(
        *counts.columns,
        *[(F.sum(s).over(local) + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *[F.col(f"all_{s}") for s in sums],
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: list[float], by: list[str] | None = None, alias: str = "quantiles"
) -> DataFrame:
    """Exact linear-interpolated quantiles as an array column, one row (per group).

    A quantile sketch first brackets each quantile in a narrow band of ranks. Only the values
    inside the bands (2 * BAND of the rows each) are then counted one by one; all values between
    two bands are counted as one. So the exact ranks are known, the bands hold the answers, and
    little is shuffled. The sketch is accurate to less than half of the band's half width; should a
    rank fall outside its band, the query fails rather than answer wrongly. Few values (up to FEW,
    where a band may be under one rank wide) are all counted one by one.
    NaN and null values are left out.
    """
    by = by or []
    clean = df.select(*by, value).filter(F.col(value).isNotNull() & ~F.isnan(value))
    ends = [max(0.0, min(1.0, p + side)) for p in sorted(probs) for side in (-BAND, BAND)]
    sketch = rough_quantiles(clean, value, ends, by)
    sketch = sketch.select(*by, F.struct(F.col("points").alias("edges"), "n").alias("_band"))
    if by:
        rows = join_group_values(clean, sketch, by, "sketch")
    else:
        rows = clean.withColumn("_band", sketch.select("_band").scalar())
    v = F.col(value)
    band = F.col("_band")["edges"]
    lows = [F.get(band, F.lit(i)) for i in range(0, len(ends), 2)]
    rows = rows.withColumn("_no", count_passed(v, lows))
    few = (F.col("_band")["n"] <= FEW).alias("_few")
    rows = rows.select(*by, value, few, F.get(band, 2 * F.col("_no") - 1).alias("_top"))
    inside = F.col("_few") | F.coalesce(v <= F.col("_top"), F.lit(False))
    kept = F.when(inside, v).otherwise(F.coalesce("_top", F.lit(float("-inf"))))
    counts = (
        rows.select(*by, kept.alias(value), (~inside).cast("bigint").alias("_out"))
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_out").alias("_out"))
    )
    ranked = running_totals(counts, value, ["n", "_out"], by)

    picks = []
    for i, p in enumerate(probs):
        at = (F.col("all_n") - 1) * F.lit(float(p))
        for tag, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n") - F.col("_out"))
            picks.append(F.max(F.when(here, v)).alias(f"_{tag}{i}"))
    frame = ranked.groupBy(*by).agg(F.max("all_n").alias("_n"), *picks)
    values = []
    for i, p in enumerate(probs):
        at = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        missed = F.col("_n").isNotNull() & (lo.isNull() | hi.isNull())
        answer = lo + (hi - lo) * (at - F.floor(at))
        values.append(F.when(missed, F.raise_error(F.lit("quantile outside its band"))).otherwise(answer))
    return frame.select(*by, F.array(*values).alias(alias))
