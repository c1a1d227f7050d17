"""Point-in-time joins, running last values and latest snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.skew import TASK_ROWS, hot_keys, prefixed, same_key, split_by_heat
from tidemark.session import materialized, split_count

TIMELINE = ["_t", "_side", "_seq"]


# Points of the time line of the hottest key, for each of its slices: others' slices end at the nearest one.
POINTS_A_SLICE = 4


def cut_points(rows: DataFrame, by: list[str], order: str, hot: DataFrame) -> DataFrame:
    """``_cuts`` of every hot key, where its slices begin, and ``_again``, those that occur more than once.

    A key gets as many slices as its rows need so that none is above what a task may carry. There are at most twice
    as many slices in all as the table has such loads. Written, so Spark knows its size.
    """
    wanted = F.ceil(F.col("_n") / F.col("_limit")).cast("int")
    needs = prefixed(hot.select(*by, wanted.alias("_k")), by, "_w_")
    points = POINTS_A_SLICE * needs.agg(F.max("_k")).first()[0]
    grid = F.array(*[F.lit(i / points) for i in range(1, points)])
    per_key = rows.groupBy(*by).agg(F.percentile_approx(order, grid, max(10_000, 10 * points)).alias("_all"))
    # Slice i of k begins at the point nearest to i / k of the rows.
    at = lambda i: F.round(i * F.lit(points) / F.col("_k")).cast("int") - 1
    begins = F.transform(F.filter(F.sequence(F.lit(1), F.col("_k")), lambda i: i < F.col("_k")), lambda i: F.get("_all", at(i)))
    joined = per_key.join(needs, same_key(per_key, needs, by, "_w_"))
    cuts = joined.select(*by, begins.alias("_cuts"))
    again = F.filter("_cuts", lambda c, i: (i > 0) & (c == F.get(F.col("_cuts"), i - 1)))
    return materialized(cuts.withColumn("_again", F.array_distinct(again)), "cut-points")


def placed(rows: DataFrame, by: list[str], order: Column, cuts: DataFrame) -> DataFrame:
    """Adds ``_seg``, the slice of its key that a row is in (0 for keys without cuts), and ``_heavy``.

    The slice depends on the value only: equal values never part, and a task run again cuts the
    same way. ``_heavy`` marks values that fill a slice of their own: those cut at more than once.
    """
    side = prefixed(cuts, by, "_c_")
    out = rows.join(side, same_key(rows, side, by, "_c_"), "left").withColumn("_at", order)
    passed = F.size(F.filter("_cuts", lambda c: F.col("_at") >= c))
    heavy = F.exists("_again", lambda c: F.col("_at") == c)
    found = {"_seg": F.when(F.col("_cuts").isNull() | F.col("_at").isNull(), 0).otherwise(passed), "_heavy": F.coalesce(heavy, F.lit(False))}
    return out.withColumns(found).drop("_cuts", "_again", "_at", *[f"_c_{c}" for c in by])


def slices(rows: DataFrame, by: list[str], order: str, hot: DataFrame) -> DataFrame:
    """The ``rows`` of ``hot`` keys with their slice, written, as its several readers should not each place them anew."""
    rows = materialized(rows, "heated")
    return materialized(placed(rows, by, F.col(order), cut_points(rows, by, order, hot)), "hot-rows")


def small(df: DataFrame, name: str) -> DataFrame:
    """A frame with a row or few for each slice, written: from its size Spark knows whether to broadcast it."""
    return materialized(df, name)


def slice_ends(cut: DataFrame, by: list[str], order: list[str], value: Column) -> DataFrame:
    """The last non-null ``value`` of every slice, null where it has none.

    Times first, which combine in a hash table; only rows at a slice's newest time are compared
    as a whole.
    """
    known = value.isNotNull()
    newest = small(cut.groupBy(*by, "_seg").agg(F.max(F.when(known, F.col(order[0]))).alias("_at")), "newest")
    side = prefixed(newest, [*by, "_seg"], "_n_")
    at = same_key(cut, side, [*by, "_seg"], "_n_") & (cut[order[0]] == side["_at"])
    last = cut.join(side, at).filter(known).groupBy(*by, "_seg")
    ends = prefixed(last.agg(F.max_by(value, F.struct(*order)).alias("_end")), [*by, "_seg"], "_l_")
    on = same_key(newest, ends, [*by, "_seg"], "_l_")
    return newest.join(ends, on, "left").select(*by, "_seg", "_end")


def inherit(rows: DataFrame, ends: DataFrame, by: list[str]) -> DataFrame:
    """``_here``, or where that is null what the slices before the row's own end with."""
    before = W.partitionBy(*by).orderBy("_seg").rowsBetween(W.unboundedPreceding, -1)
    carry = ends.select(*by, "_seg", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    carry = prefixed(small(carry, "carry"), [*by, "_seg"], "_e_")
    out = rows.join(carry, same_key(rows, carry, [*by, "_seg"], "_e_"), "left")
    return out.withColumn("_here", F.coalesce("_here", "_carry"))


def last_in_window(rows: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Replaces ``value`` by its last non-null one up to the row; one window per key."""
    upto = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(upto))


def last_in_slices(cut: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """The same for hot keys, cut on ``order[0]``: a window per slice, and one inherited value."""
    local = W.partitionBy(*by, "_seg").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    here = cut.withColumn("_here", F.last(value, ignorenulls=True).over(local))
    ends = slice_ends(cut, by, order, F.col(value))
    return inherit(here, ends, by).withColumn(value, F.col("_here")).select(*cut.columns)


def running_last(
    rows: DataFrame, by: list[str], order: list[str], value: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``value`` replaced by its last non-null one up to and including each row, per key."""
    heat = hot_keys(rows, by, task_rows)
    if heat is None:
        return last_in_window(rows, by, order, value)
    cold, hot = split_by_heat(rows, by, heat)
    sliced = last_in_slices(slices(hot, by, order[0], heat), by, order, value).select(*rows.columns)
    return last_in_window(cold, by, order, value).unionByName(sliced)


def _timeline(
    probes: DataFrame, history: DataFrame, by: list[str], left_on: str, right_on: str, right_seq: str,
    values: list[str], inclusive: bool,
) -> DataFrame:
    """Both sides as one event list per key; at equal times the looked-for side sorts first."""
    first, second = (0, 1) if inclusive else (1, 0)
    snaps = history.select(
        *by,
        F.col(right_on).alias("_t"),
        F.lit(first).alias("_side"),
        F.col(right_seq).cast("bigint").alias("_seq"),
        F.struct(*values).alias("_snap"),
    )
    own = probes.select(
        *by,
        F.col(left_on).alias("_t"),
        F.lit(second).alias("_side"),
        F.lit(None).cast("bigint").alias("_seq"),
        F.struct(*probes.columns).alias("_own"),
    )
    return snaps.unionByName(own, allowMissingColumns=True)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
    right_seq: str,
    values: list[str],
    inclusive: bool = True,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Every left row with the newest right row of its key at or before its own time.

    Left rows without one get nulls. ``right_seq`` decides between right rows of the same time:
    the last write wins. ``inclusive=False`` looks strictly before.

    Both sides go through one shuffle by key as one event list, then a running last value; no
    left row is paired with its history. Keys are counted on the key columns alone, and only the
    rows of hot keys are written. The list of a hot key is cut into slices. Where one time
    fills a slice of its own, its last write and one probe stand for all rows of that time, and
    the left rows get the probe's answer: neither a heavy key nor a heap of equal rows lands in
    one task.
    """
    spec = (by, left_on, right_on, right_seq, values, inclusive)

    def result(rows: DataFrame, columns: list[str]) -> DataFrame:
        return rows.filter(F.col("_own").isNotNull()).select(
            *[F.col("_own")[c].alias(c) for c in columns],
            *[F.col("_snap")[c].alias(c) for c in values],
        )

    timeline = _timeline(left, right, *spec)
    hot = hot_keys(timeline, by, task_rows)
    if hot is None:
        return result(last_in_window(timeline, by, TIMELINE, "_snap"), left.columns)
    cold, heated = split_by_heat(timeline, by, hot)
    plain = result(last_in_window(cold, by, TIMELINE, "_snap"), left.columns)

    cut = slices(heated, by, "_t", hot)
    is_probe = F.col("_own").isNotNull()
    heap = cut.filter(F.col("_heavy"))
    at = [*by, "_t", "_side", "_seg"]
    writes = heap.filter(~is_probe).groupBy(*at).agg(
        F.max_by("_snap", "_seq").alias("_snap"), F.max("_seq").alias("_seq")
    )
    probes = heap.filter(is_probe).select(*at).distinct()
    rows = cut.filter(~F.col("_heavy")).drop("_heavy")
    for part in (writes, probes):
        rows = rows.unionByName(part, allowMissingColumns=True)
    filled = last_in_slices(rows, by, TIMELINE, "_snap")

    asked = heap.filter(is_probe).select(*by, "_t", "_own")
    stand_in = F.col("_own").isNull() & (F.col("_side") == (1 if inclusive else 0))
    answers = small(filled.filter(stand_in).select(*by, "_t", "_snap"), "answers")
    answers = prefixed(answers, [*by, "_t"], "_f_")
    answered = asked.join(answers, same_key(asked, answers, [*by, "_t"], "_f_"), "left")
    parts = (plain, result(filled, left.columns), result(answered, left.columns))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def latest(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order``. Null keys are a key of their own.

    The greatest first order value of each key combines in a hash table, row by row. Only the rows
    that have it are compared as a whole, with a null order last.
    """
    newest = prefixed(df.groupBy(*by).agg(F.max(order[0]).alias("_at")), by, "_n_")
    at = same_key(df, newest, by, "_n_") & df[order[0]].eqNullSafe(newest["_at"])
    rows = df.join(newest, at, "left_semi")
    first = W.partitionBy(*by).orderBy(*[F.desc_nulls_last(c) for c in order])
    return rows.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def pit_join(labels: DataFrame, history: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Labels with the feature snapshot that was true at label time."""
    stamped = history.withColumn("feature_ts", F.col("ts"))
    return asof_join(
        labels,
        stamped,
        by=["entity_id"],
        left_on="label_timestamp",
        right_on="ts",
        right_seq="write_seq",
        values=["feature_ts", "spend", "k"],
        task_rows=task_rows,
    )


def pit_training_set(labels: DataFrame, history: DataFrame) -> DataFrame:
    """As :func:`pit_join`, without the labels that had no snapshot yet."""
    return pit_join(labels, history).filter(F.col("feature_ts").isNotNull())


def dedupe_last_write(history: DataFrame, by: list[str], seq: str = "write_seq") -> DataFrame:
    """One row per key and time: the last write."""
    return latest(history, by, [seq])


def previous_value(
    df: DataFrame, by: list[str], order: str, seq: str, value: str, alias: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``value`` of the row before, per key, in (order, seq) order; null for the first."""
    per_key = W.partitionBy(*by).orderBy(order, seq)
    heat = hot_keys(df, by, task_rows)
    if heat is None:
        return df.withColumn(alias, F.lag(value).over(per_key))
    cold, hot = split_by_heat(df, by, heat)
    cut = slices(hot, by, order, heat)
    local = W.partitionBy(*by, "_seg").orderBy(order, seq)
    here = cut.withColumn("_here", F.lag(F.struct(value)).over(local))
    ends = slice_ends(cut, by, [order, seq], F.struct(value))
    sliced = inherit(here, ends, by).select(*df.columns, F.col("_here")[value].alias(alias))
    return cold.withColumn(alias, F.lag(value).over(per_key)).unionByName(sliced)
