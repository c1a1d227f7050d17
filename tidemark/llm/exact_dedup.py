"""Exact duplicates by a sharded cuckoo-filter index of live digests.

Texts are equal if they are identical without their white space; of equal texts the longest original stays, then the
smallest id. Every row becomes a digest, and digests, not texts, are shuffled. They are counted in a few salted
places each, so a text that a third of all rows share reaches its shard as a handful of rows. A shard inserts them
into its cuckoo filter: a miss makes a live entry, a hit is looked up among the stored keys of the bucket and adds to
the entry found there. Digests that were hit then verify against the content: their texts meet in buckets by digest,
equal ones combined on the map side. Digests that turn out to stand for different texts are deleted from the index,
and their texts are inserted with the content itself as the key.

The index is a table of live entries and filters by shard. :func:`insert` and :func:`delete` make the next version
of it, so texts can come in batches and can be taken out again. Its shards grow in number with the entries.

Defined cases: null and empty texts, and texts of white space alone, are equal to each other. Null ids come after
all others; a group of null ids alone has a null ``keep_id``. Of rows that also agree in id and length exactly one
stays. Other columns of the documents are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BROADCAST_BYTES, row_key, ship, without_rows
from tidemark.llm.cuckoo import LiveKeys
from tidemark.session import materialized

BLANKS = "[\\x20\\x09-\\x0D]+"
SHARD_KEYS = 1 << 10  # entries a shard is meant to hold; they fit a task many times over
SALTS = 16  # places that the rows of one digest are counted in
HOT_SHARE = 1024  # a text with more than this part of the rows is looked up by broadcast: fewer than so many texts
DIGEST_BYTES = 64  # of one digest in a broadcast, generously


def normal(text_col: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), BLANKS, "")


def sha256(normal_text: Column) -> Column:
    return F.unhex(F.sha2(normal_text, 256))


@dataclass(frozen=True)
class Index:
    """One version of the live entries: ``digest``, ``best`` (of the row that stays) and ``copies``, by ``shard``."""

    table: DataFrame
    shards: int

    @property
    def entries(self) -> DataFrame:
        return self.table.filter("digest is not null").select("digest", "best", "copies")

    @property
    def filters(self) -> DataFrame:
        """``shard``, ``buckets`` and the fingerprints (16 bits each) of every shard's filter."""
        return self.table.filter("digest is null").select("shard", "buckets", "slots", "resizes")


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Every row's ``row`` number, ``id``, ``key``, ``chars`` and ``digest``, written once: the numbers stay."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        row_key(id_col, text_col).alias("key"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        digest(normal(text_col)).alias("digest"),
    )
    return materialized(rows, "digests")


def _best(rows: DataFrame) -> Column:
    """What the row that stays has least of: in order the sign of its length, a missing id, the id, its number."""
    fields = (-F.col("chars")).alias("short"), F.col("id").isNull().alias("lost"), F.col("id"), F.col("row")
    return F.struct(*fields).alias("best")


def salted_counts(rows: DataFrame) -> DataFrame:
    """``digest``, the ``best`` row and the ``copies``, at most SALTS rows a digest; map sides combine."""
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")
    placed = rows.select("digest", _best(rows), salt)
    counts = placed.groupBy("digest", "_salt").agg(F.min("best").alias("best"), F.count(F.lit(1)).alias("copies"))
    return counts.drop("_salt")


def _updated(parts: list[tuple[int, DataFrame]], keys: int) -> Index:
    """A new index from live entries (0), digests to delete (1) and counts to insert (2), in this order."""
    shards = 1
    while shards * SHARD_KEYS < keys:
        shards *= 2
    tagged = None
    for order, part in parts:
        rows = part.select("digest", "best", "copies", F.lit(order).alias("step"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    spark = tagged.sparkSession
    rows = tagged.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))
    entry = tagged.schema
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            *[T.StructField(c, entry[c].dataType) for c in ("digest", "best", "copies")],
            T.StructField("buckets", T.IntegerType()),
            T.StructField("slots", T.BinaryType()),
            T.StructField("resizes", T.IntegerType()),
        ]
    )
    names = schema.names

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("step", "ascending"), ("digest", "ascending")])
        column = {c: group.column(c).combine_chunks() for c in group.column_names}
        keys, steps, copies = (column[c].to_pylist() for c in ("digest", "step", "copies"))
        fields = {f: column["best"].field(f).to_pylist() for f in ("short", "lost", "id", "row")}
        rank = [(s, l, 0 if l else i, r) for s, l, i, r in zip(*(fields[f] for f in ("short", "lost", "id", "row")))]
        live, entries = LiveKeys(), {}
        for at, (key, step) in enumerate(zip(keys, steps)):
            if step == 1:
                if live.delete(key):
                    del entries[key]
            elif live.insert(key):
                entries[key] = [at, copies[at]]
            else:
                entry = entries[key]
                entry[1] += copies[at]
                if rank[at] < rank[entry[0]]:
                    entry[0] = at
        n = len(entries)
        taken = pa.array([at for at, _ in entries.values()], pa.int64())
        filled = {
            "shard": pa.array([column["shard"][0].as_py()] * (n + 1), pa.int32()),
            "digest": pa.array([*entries, None], pa.binary()),
            "best": pa.concat_arrays([column["best"].take(taken), pa.nulls(1, column["best"].type)]),
            "copies": pa.array([*(c for _, c in entries.values()), None], pa.int64()),
            "buckets": pa.array([None] * n + [live.filter.mask + 1], pa.int32()),
            "slots": pa.array([None] * n + [b"".join(s.to_bytes(2, "little") for s in live.filter.slots)], pa.binary()),
            "resizes": pa.array([None] * n + [live.resizes], pa.int32()),
        }
        return pa.table([filled[c] for c in names], names=names)

    ship(spark)
    return Index(materialized(rows.groupBy("shard").applyInArrow(run, schema), "live-index"), shards)


def _size(index: Index | None) -> int:
    return index.entries.count() if index else 0


def insert(index: Index | None, rows: DataFrame) -> Index:
    """The index with the digests of ``rows`` (from :func:`digests`) added to what is live."""
    counts = materialized(salted_counts(rows), "digest-counts")
    parts = [(0, index.entries)] if index else []
    return _updated([*parts, (2, counts)], _size(index) + counts.count())


def delete(index: Index, rows: DataFrame) -> Index:
    """The index without the texts whose ``digest`` is in ``rows``, whatever number of copies they had."""
    gone = salted_counts(rows) if "row" in rows.columns else rows.select(
        "digest", F.lit(None).cast(index.table.schema["best"].dataType).alias("best"), F.lit(0).cast("long").alias("copies")
    )
    return _updated([(0, index.entries), (1, gone)], _size(index))


def collisions(docs: DataFrame, hits: DataFrame, text_col: str, digest: Callable, broadcast_bytes: int) -> DataFrame:
    """Of the digests that were hit (a written table), those that stand for more than one content.

    Few hits are broadcast and leave the texts that were not hit where they are. Beyond the bound all texts go to
    their buckets, where those that were not hit have nothing to compare with.
    """
    content = docs.select(normal(text_col).alias("content")).select(digest(F.col("content")).alias("digest"), "content")
    if hits.count() * DIGEST_BYTES <= broadcast_bytes:
        content = content.join(F.broadcast(hits), "digest", "left_semi")
    several = content.distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return materialized(several.select("digest"), "collisions")


def verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every row's ``id``, ``key``, ``digest``, ``keep_id``, ``group_size`` and whether it is ``kept``."""
    rows = digests(docs, id_col, text_col, digest)
    index = insert(None, rows)
    hits = materialized(index.entries.filter("copies > 1").select("digest"), "hits")
    several = collisions(docs, hits, text_col, digest, broadcast_bytes)
    if not several.isEmpty():
        # One digest, different contents: the content becomes the key.
        parted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), digest(normal(text_col)).alias("digest"))
        own = digests(
            parted.join(several, "digest", "left_semi"), "id", "text",
            lambda text: F.concat(digest(text), F.encode(text, "utf-8")),
        ).withColumn("row", -1 - F.col("row"))
        index = insert(delete(index, several), own)
        rows = materialized(rows.join(several, "digest", "left_anti").unionByName(own), "parted-digests")
    return _looked_up(rows, index.entries)


def _looked_up(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Every row with its text's entry. The few texts with very many rows are not shuffled for it."""
    limit = rows.count() / HOT_SHARE
    hot = F.broadcast(entries.filter(F.col("copies") > limit))
    cold = entries.filter(F.col("copies") <= limit)
    rest = rows.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest")
    both = rows.join(hot, "digest").unionByName(rest)
    return both.select(
        "id", "key", "digest", F.col("best.id").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, all its columns as they were."""
    judged = materialized(verdicts(docs, id_col, text_col), "verdicts")
    named = lambda df: materialized(df.select(F.col("key").alias("_key"), F.col("id").alias("_id")).distinct(), "rows")
    stays = judged.filter("kept").select("key", F.col("id").alias("_kept"))
    # Rows that agree in id and text cannot be told apart: all go or, first, all stay.
    twin = (judged["key"] == stays["key"]) & judged["id"].eqNullSafe(stays["_kept"])
    dropped = judged.filter("not kept")
    key = row_key(id_col, text_col)
    out = without_rows(docs, named(dropped.join(stays, twin, "left_anti")), key, id_col)
    again = named(dropped.join(stays, twin, "left_semi"))
    if again.isEmpty():
        return out
    once = without_rows(out, again, key, id_col)
    held = out.select(F.struct("*").alias("_row"), key.alias("_row_key"), F.col(id_col).alias("_row_id"))
    same = (held["_row_key"] == again["_key"]) & held["_row_id"].eqNullSafe(again["_id"])
    repeated = held.join(again, same, "left_semi").dropDuplicates(["_row_key", "_row_id"])
    return once.unionByName(repeated.select("_row.*"))


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents with the row that stays for their text."""
    rows = verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex(F.substring("digest", 1, 32))).alias("text_sha256"),
    )


EXACT_DEDUP_SQL = r"""SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER same AS group_size,
    doc_id = first_value(doc_id) OVER best AS kept, sha256(normal) AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents)
WINDOW same AS (PARTITION BY normal), best AS (PARTITION BY normal ORDER BY chars DESC, doc_id)"""
