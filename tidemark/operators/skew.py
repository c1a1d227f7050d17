"""Joins and windows that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialized, split_count

# As many rows of one key as a task may carry, however large the table is.
TASK_ROWS = 5_000_000


def hot_keys(df: DataFrame, by: list[str], task_rows: int = TASK_ROWS) -> DataFrame | None:
    """Keys (nulls included) that would overload a task, and what a task may carry; None if no key does.

    A key is hot above ``task_rows`` rows, or above an even share of one partition if that is less
    (``_limit``). So there are at most as many hot keys as the table has such loads. Only the key columns
    are read, counts combine on the map side, and only the hot keys are written, with their rows (``_n``).
    """
    n = split_count(df.sparkSession)
    counts = df.select(*by).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    # Both uses of the counts share one shuffle.
    share = counts.agg((F.sum("_n") / n).alias("share")).scalar()
    loads = counts.withColumn("_limit", F.least(share, F.lit(float(task_rows))))
    hot = materialized(loads.filter(F.col("_n") > F.col("_limit")), "hot-keys")
    return None if hot.isEmpty() else hot


def prefixed(df: DataFrame, columns: list[str], tag: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{tag}{c}" for c in columns})


def same_key(left: DataFrame, right: DataFrame, by: list[str], tag: str, null_safe: bool = True) -> Column:
    """Equality of ``by`` on the left against the columns ``tag + name`` on the right."""
    pairs = [(left[c], right[f"{tag}{c}"]) for c in by]
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])


def split_by_heat(df: DataFrame, by: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary keys and the rows of ``hot`` keys, a written table: Spark knows its size."""
    keys = prefixed(hot.select(*by), by, "_h_")
    on = same_key(df, keys, by, "_h_")
    return df.join(keys, on, "left_anti"), df.join(keys, on, "left_semi")


def lookup_join(
    rows: DataFrame, lookup: DataFrame, by: list[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Join many ``rows`` to a ``lookup`` with one row per key, ``how`` being inner or left.

    A plain equi-join: adaptive execution splits the rows of a key that is too large for a task.
    """
    right = prefixed(lookup, by, "_r_")
    on = same_key(rows, right, by, "_r_", null_safe)
    return rows.join(right, on, how).drop(*[f"_r_{c}" for c in by])


def join_group_values(rows: DataFrame, values: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with the ``values`` of their group (one row per group), all rows kept.

    The values are written first, so Spark knows how many bytes they are: a few are broadcast and the
    rows stay where they are, many meet the rows in a shuffle.
    """
    return rows.join(materialized(values, name), by, "left")
