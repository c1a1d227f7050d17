"""What several operators share: row keys, size-checked joins, connected components.

A document is told apart by ``row_key`` *and* its id, as ids may be null or repeat. Rows that agree
in id and text have the same key and are always treated alike.
"""

from __future__ import annotations

import ctypes
import random
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import materialized, ship

# A side is broadcast only if it is known to be this small, else both sides meet in a shuffle.
BROADCAST_BYTES = 32 << 20


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def mapped(rows: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``rows`` through ``run``, an iterator over Arrow batches, on the Python workers."""
    ship(rows.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return rows.mapInArrow(task, schema)


def give_back() -> None:
    """Hands free memory of a worker back to the system: the next task may be another operator's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def sized(side: DataFrame, row_bytes: int) -> DataFrame:
    """``side`` (a written table) marked for broadcast if its rows, counted here, are few enough."""
    return F.broadcast(side) if side.count() * row_bytes <= BROADCAST_BYTES else side


def without_rows(docs: DataFrame, unwanted: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """``docs`` minus the rows whose ``key`` and id are ``_key`` and ``_id`` of ``unwanted``, a written table."""
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_row_key"), F.col(id_col).alias("_row_id"))
    side = sized(unwanted.select("_key", "_id"), 32)
    on = (rows["_row_key"] == side["_key"]) & rows["_row_id"].eqNullSafe(side["_id"])
    return rows.join(side, on, "left_anti").select("_row.*")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges ``a``, ``b`` (longs): connected nodes share a root.

    Randomised contraction: every round each node picks the least of itself and its neighbours,
    in an order that is drawn anew each round (node XOR a constant), and the picks become the
    nodes of the next round. The number of nodes falls by a constant share, however long the
    chains are. Minima combine on the map side, and the joins are plain equi-joins that can be
    split where a node has very many neighbours. Every round is a written table.
    """
    edges = materialized(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(),
        "edges",
    )
    draw = random.Random(20)
    roots = None
    while not edges.isEmpty():
        key = F.lit(draw.getrandbits(64) - 2**63)
        sides = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        picks = sides.groupBy("node").agg(F.min(F.col("other").bitwiseXOR(key)).alias("least"))
        picks = picks.select("node", F.least("least", F.col("node").bitwiseXOR(key)).bitwiseXOR(key).alias("pick"))
        picks = materialized(picks, "picks")
        roots = picks.withColumnRenamed("pick", "root") if roots is None else materialized(
            roots.join(picks.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("pick", "root").alias("root")
            ),
            "roots",
        )
        moved = edges.join(picks.select(F.col("node").alias("a"), F.col("pick").alias("a2")), "a")
        moved = moved.join(picks.select(F.col("node").alias("b"), F.col("pick").alias("b2")), "b")
        moved = moved.filter("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        edges = materialized(moved.distinct(), "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
