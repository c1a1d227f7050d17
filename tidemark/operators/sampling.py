"""Splits and samples by hash: repeatable, stable across reruns, no global sort needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.skew import prefixed, same_key
from tidemark.session import materialized


# Hex digits of a hash that each round of the selection tells apart: 4096 cells, twice.
DIGITS = (3, 6)


def least_ranks(rows: DataFrame, by: list[str], rank: str, wanted: Column) -> DataFrame:
    """Per group the greatest ``rank`` among its ``wanted`` smallest: a cut that takes exactly so many rows.

    ``rank`` is a hex hash followed by the key. Cells of its first digits are counted, combined on the map side;
    the cell in which the count is reached is counted again by its next digits, and only the rows of the cell found
    then, some sixteen-millionth of the group, are put in order. ``wanted`` is a column over ``_n``, the
    group's rows. Groups of which nothing is wanted have no cut.
    """
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    goals = materialized(sizes.select(*by, wanted.cast("bigint").alias("_goal")).filter("_goal > 0"), "goals")
    inside = rows
    for digits in DIGITS:
        cells = inside.groupBy(*by, F.substring(rank, 1, digits).alias("_cell")).agg(F.count(F.lit(1)).alias("_m"))
        upto = W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
        side = prefixed(goals, by, "_g_")
        counted = cells.withColumn("_upto", F.sum("_m").over(upto))
        counted = counted.join(side, same_key(counted, side, by, "_g_"))
        found = counted.filter((F.col("_upto") >= F.col("_goal")) & (F.col("_upto") - F.col("_m") < F.col("_goal")))
        rest = (F.col("_goal") - (F.col("_upto") - F.col("_m"))).alias("_goal")
        found = materialized(found.select(*by, "_cell", rest), "cells")
        goals = found.select(*by, "_goal")
        cell = prefixed(found.select(*by, "_cell"), by, "_g_")
        at = same_key(rows, cell, by, "_g_") & (F.substring(rank, 1, digits) == cell["_cell"])
        inside = rows.join(cell, at, "left_semi")
    order = W.partitionBy(*by).orderBy(rank)
    side = prefixed(goals, by, "_g_")
    placed = inside.withColumn("_at", F.row_number().over(order))
    return placed.join(side, same_key(placed, side, by, "_g_") & (placed["_at"] == side["_goal"])).select(*by, F.col(rank).alias("_cut"))


def chosen(rows: DataFrame, by: list[str], rank: str, wanted: Column, name: str) -> DataFrame:
    """``rows`` with a boolean ``name``: whether a row is among the ``wanted`` of its group with the smallest ``rank``."""
    cuts = prefixed(materialized(least_ranks(rows, by, rank, wanted), "rank-cuts"), by, "_c_")
    out = rows.join(cuts, same_key(rows, cuts, by, "_c_"), "left")
    return out.withColumn(name, F.coalesce(F.col(rank) <= F.col("_cut"), F.lit(False))).drop("_cut", *[f"_c_{c}" for c in by])


def split_folds(
    df: DataFrame,
    key: str = "entity_id",
    holdout: float = 0.30,
    test: float = 0.5,
    seeds: tuple[int, int] = (42, 7),
    label: str = "label",
) -> DataFrame:
    """Adds ``fold``: train, calibration or test, each with its exact share of every class.

    Of a class of n rows, round(holdout * n) are held out, those with the smallest hashes of their key, and of these
    k rows round(test * k) are for testing, by another hash. The same rows give the same folds, in any order.
    Rows that agree in class and key stay together.
    """
    rank = lambda seed: F.concat_ws(":", S.seeded_hash(F.col(key), seed), F.col(key).cast("string"))
    share = lambda part: F.floor(F.col("_n") * F.lit(part) + 0.5)
    rows = materialized(df.select("*", rank(seeds[0]).alias("_first"), rank(seeds[1]).alias("_second")), "to-split")
    held = materialized(chosen(rows, [label], "_first", share(holdout), "_held"), "held-out")
    tested = chosen(held.filter("_held"), [label], "_second", share(test), "_tested")
    out = tested.withColumn("fold", F.when(F.col("_tested"), F.lit("test")).otherwise(F.lit("calibration"))).drop("_tested")
    trained = held.filter("not _held").withColumn("fold", F.lit("train"))
    return out.unionByName(trained).drop("_first", "_second", "_held")


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """All rows in a repeatable random order (a range-partitioned sort by hash)."""
    return df.withColumn("shuffle_key", S.seeded_hash(F.col(key), seed)).orderBy("shuffle_key")


def sample_rows(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly min(n, rows) rows: the n smallest hashes, found as a top-k."""
    return df.orderBy(S.seeded_hash(F.col(key), seed), key).limit(n)
