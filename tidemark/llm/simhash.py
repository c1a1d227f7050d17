"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``max_distance`` bits have a common neighbour within half of it. So every
distinct fingerprint emits all its variants within that half, variants meet in a shuffle, and what
collides is deduplicated and verified. A variant meets only fingerprints of its own ball (65 for
distance 2), so no group grows with the corpus; copies collapse into one fingerprint before.

Defined cases: null and empty texts, and texts without a word, have fingerprint zero and link like
any other. Texts with fewer words than a shingle hash as a whole. Rows may repeat ids or lack them:
every row gets its own result, the smallest id leaves nulls out, and a group without any id has a
null component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import components, mapped, row_key, without_rows
from tidemark.session import materialized

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
PIECE = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes | None, words_each: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if over half of the shingle hashes have it; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(words_each, len(words))
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends]
    spans = zip(starts, ends[size - 1 :])
    digest, n, counts = xxhash.xxh64_intdigest, len(words) - size + 1, np.zeros(64, np.int64)
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in spans), np.uint64, n)
    for at in range(0, n, PIECE):
        bits = np.unpackbits(hashes[at : at + PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``key`` and ``fp`` (a signed long) of every row, written once."""
    rows = docs.select(
        F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words) for t in batch.column("text")]
            fp = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), fp], ["id", "key", "fp"])

    schema = T.StructType([rows.schema["id"], T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())])
    return materialized(mapped(rows, run, schema), "fingerprints")


def ball(radius: int) -> list[int]:
    """All signed 64-bit masks with up to ``radius`` bits set."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Verified pairs ``a``, ``b`` of distinct ``fp`` that join all fingerprints within ``max_distance``.

    All fingerprints that share a variant are within twice the half radius of each other, so linking
    each to the least of them loses no connection. That holds for even distances, the only ones taken.
    """
    if max_distance % 2:
        raise ValueError("max_distance must be even: both sides search half of it")
    masks = F.explode(F.array(*[F.lit(m) for m in ball(max_distance // 2)])).alias("mask")
    variants = fps.select("fp", masks).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    least = F.min("fp").over(W.partitionBy("variant"))
    pairs = variants.select("fp", least.alias("least")).filter(F.col("fp") != F.col("least"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= max_distance
    return pairs.filter(near).select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row's ``id``, ``key``, ``fp``, the ``root`` fingerprint of its group and the ``component`` id."""
    rows = fingerprints(docs, shingle_words, id_col, text_col)
    # One row per fingerprint, with the least id; heaps of copies combine on the map side.
    distinct = materialized(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    groups = materialized(rooted.join(least, "root").select("fp", "root", "component"), "groups")
    return rows.join(groups, "fp").select("id", "key", "fp", "root", "component")


def one_of_each_group(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of every group of near-duplicates: the one with the smallest id.

    Rows with the same id: the one with the smaller hash stays. Rows equal in id and text are
    reduced to one.
    """
    rows = materialized(near_duplicates(docs, shingle_words, max_distance, id_col, text_col), "near-duplicates")
    first = rows.filter(F.col("id").eqNullSafe(F.col("component")))
    kept = first.groupBy("root").agg(F.min("key").alias("kept"))
    judged = rows.join(kept, "root")
    stays = (F.col("key") == F.col("kept")) & F.col("id").eqNullSafe(F.col("component"))
    rest = judged.filter(~stays).select(F.col("key").alias("_key"), F.col("id").alias("_id"))
    # A key is either kept or not, wherever it occurs.
    key = row_key(id_col, text_col)
    out = without_rows(docs, materialized(rest.distinct(), "near-copies"), key, id_col)
    again = judged.filter(stays).groupBy("key", "id").count().filter("count > 1")
    again = materialized(again.select(F.col("key").alias("_key"), F.col("id").alias("_id")), "repeated-rows")
    if again.isEmpty():
        return out
    once = without_rows(out, again, key, id_col)
    rows = out.select(F.struct("*").alias("_row"), key.alias("_row_key"), F.col(id_col).alias("_row_id"))
    same = (rows["_row_key"] == again["_key"]) & rows["_row_id"].eqNullSafe(again["_id"])
    repeated = rows.join(again, same, "left_semi").dropDuplicates(["_row_key", "_row_id"])
    return once.unionByName(repeated.select("_row.*"))


def op2_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and component, three-word shingles, two bits."""
    groups = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    fp = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return groups.select(F.col("id").alias("doc_id"), fp, F.col("component").alias("component_id"))
