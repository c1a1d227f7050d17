"""Sharding by extendible hashing: a directory over hash-prefix bits, split only where too large.

Native: DataFrame functions only. A row's place is a 64-bit hash of its id. The directory starts with
no bits; a prefix that holds more bytes than the limit is split on its next bit, all others stay as
they are. Sizes are counted for ``ROUND_BITS`` bits at a time: a round aggregates the rows of the
prefixes that are still too large into cells, at most 256 for each, and settles every prefix
between in one go. The next round sees only cells that are still too large.

Defined cases: null ids are placed by a hash of their text, null texts are zero bytes, rows with the
same id share a shard. Only rows with one and the same hash can exceed the limit together (or a
single row that does so alone): their shard has all 64 bits and ``fits`` false. Such rows are dealt
into numbered parts of the shard by a running sum of their bytes in the order of a hash of id and text, and
only a part that is a single row exceeds the limit; ``part`` is 0 elsewhere. Rows that agree in id and text
are alike: it does not matter which of them goes where. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import sized
from tidemark.session import materialized

SHARD_BYTES = 64 << 20
ROUND_BITS = 8
ALL_BITS = 64
SHARD_COLUMNS = ["shard", "depth", "shard_bytes", "shard_rows", "fits", "part"]
# Digits of the order hash that name a range of the running sum.
RANGE_DIGITS = 3


def place(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64 characters of 0 and 1, from the first half of an MD5."""
    digest = F.coalesce(F.md5(F.col(id_col).cast("string")), F.md5(F.col(text_col)), F.md5(F.lit("")))
    return F.lpad(F.conv(F.substring(digest, 1, 16), 16, 2), ALL_BITS, "0")


def settled(sizes: DataFrame, depth: int, limit: int) -> DataFrame:
    """Every cell of ``depth + ROUND_BITS`` bits with the shortest prefix beyond ``depth`` that fits, if any.

    ``sizes`` (``cell``, ``n_bytes``, ``n_rows``) comes dealt out by its first ``depth`` bits, which
    at most 256 cells share, so all the windows run where the rows are.
    """
    parent = F.substring("cell", 1, depth)
    rows = sizes.withColumn("parent", parent).repartition("parent") if depth else sizes.withColumn("parent", F.lit(""))
    names = []
    for d in range(depth + 1, depth + ROUND_BITS + 1):
        prefix = W.partitionBy("parent", F.substring("cell", 1, d))
        inside = F.struct(
            F.substring("cell", 1, d).alias("shard"),
            F.lit(d).alias("depth"),
            F.sum("n_bytes").over(prefix).alias("shard_bytes"),
            F.sum("n_rows").over(prefix).alias("shard_rows"),
        )
        rows = rows.withColumn(f"at{d}", inside)
        names.append(f"at{d}")
    fitting = F.coalesce(*[F.when(F.col(n)["shard_bytes"] <= limit, F.col(n)) for n in names])
    last = depth + ROUND_BITS == ALL_BITS
    return rows.select("cell", (F.coalesce(fitting, F.col(names[-1])) if last else fitting).alias("leaf"))


def directory(places: DataFrame, limit: int = SHARD_BYTES) -> list[DataFrame]:
    """One written table a round: ``cell`` and its ``leaf``, null where a later round goes on.

    ``places`` has ``bits`` and ``n_bytes`` of every row.
    """
    rounds: list[DataFrame] = []
    rows = places
    for depth in range(0, ALL_BITS, ROUND_BITS):
        cell = F.substring("bits", 1, depth + ROUND_BITS).alias("cell")
        sizes = rows.groupBy(cell).agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows"))
        cells = materialized(settled(sizes, depth, limit), "shard-directory")
        rounds.append(cells)
        still = cells.filter("leaf is null").select("cell")
        if still.isEmpty():
            break
        rows = rows.join(still, F.substring(rows["bits"], 1, depth + ROUND_BITS) == still["cell"], "left_semi")
    return rounds


def order_hash(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The order of rows within a shard that is cut into parts; equal for rows that agree in id and text."""
    parts = [F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col(text_col), F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def parted(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (``_bits``, ``_order``, ``n_bytes``, ``_seq``; a written table) with their ``part`` of the shard, from 1.

    Rows over half the limit are parts of their own. The bytes of the others are summed up, and
    those that begin in the same half of a limit make a part, which then has no more than the limit.
    Sums run over ranges of the order first, then over its different values within a range; equal rows
    are numbered for each part of the input (the upper bits of ``_seq``), and their sums follow from the numbers.
    """
    large = F.col("n_bytes") * 2 > limit
    rows = rows.withColumn("_from", F.shiftright("_seq", 33))
    same = ["_bits", "_order", "n_bytes"]
    numbers = rows.groupBy(*same, "_from").agg(F.count(F.lit(1)).alias("_n"))
    numbers = materialized(numbers, "overflow-counts")
    groups = numbers.groupBy(*same).agg(F.sum("_n").alias("_n")).withColumn("_range", F.substring("_order", 1, RANGE_DIGITS))
    groups = groups.withColumns(
        {"_s": F.when(large, 0).otherwise(F.col("n_bytes") * F.col("_n")), "_l": F.when(large, F.col("_n")).otherwise(0)}
    )
    groups = materialized(groups, "overflow-groups")
    # At most 4096 ranges of a shard.
    ranges = groups.groupBy("_bits", "_range").agg(F.sum("_s").alias("_s"), F.sum("_l").alias("_l"))
    above = W.partitionBy("_bits").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("_bits", "_range").orderBy("_order", "n_bytes").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*same).orderBy("_from").rowsBetween(W.unboundedPreceding, -1)
    before = lambda c, window: F.coalesce(F.sum(c).over(window), F.lit(0))
    ranges = ranges.select("_bits", "_range", before("_s", above).alias("_s0"), before("_l", above).alias("_l0"))
    groups = groups.join(ranges, ["_bits", "_range"]).select(
        *same, (F.col("_s0") + before("_s", inside)).alias("_s0"), (F.col("_l0") + before("_l", inside)).alias("_l0")
    )
    starts = numbers.select(*same, "_from", before("_n", earlier).alias("_n0")).join(groups, same)
    both = rows.join(starts, [*same, "_from"])
    k = F.col("_n0") + F.row_number().over(W.partitionBy(*same, "_from").orderBy("_seq")) - 1
    # Odd numbers for parts of several rows, even ones for single rows.
    begins = F.col("_s0") + k * F.col("n_bytes")
    part = F.when(large, (F.col("_l0") + k) * 2 + 2).otherwise(F.call_function("div", begins * 2, F.lit(limit)) * 2 + 1)
    return both.withColumn("part", part.cast("bigint")).drop("_from", "_n0", "_s0", "_l0", "_seq", "_order")


def sharded(
    docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` as a struct ``row``, with ``n_bytes`` and the columns of its shard. Rows are not moved."""
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint")
    places = materialized(docs.select(place(id_col, text_col).alias("bits"), size.alias("n_bytes")), "shard-places")
    total = places.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    rows = docs.select(F.struct("*").alias("row"), place(id_col, text_col).alias("_bits"), size.alias("n_bytes"))
    if total["b"] <= limit:
        root = {"shard": "", "depth": 0, "shard_bytes": total["b"], "shard_rows": total["n"]}
        rows = rows.withColumns({name: F.lit(value) for name, value in root.items()})
        rows = rows.withColumns({name: F.col(name).cast("bigint") for name in ("shard_bytes", "shard_rows")})
        rows = rows.withColumn("part", F.lit(0).cast("bigint"))
    else:
        leaves, rounds = [], directory(places, limit)
        leaf = F.col("leaf")
        over = rounds[-1].filter((leaf["depth"] == ALL_BITS) & (leaf["shard_bytes"] > limit) & (leaf["shard_rows"] > 1))
        rows = rows.withColumn("part", F.lit(0).cast("bigint"))
        if len(rounds) * ROUND_BITS == ALL_BITS and not over.isEmpty():
            side = sized(materialized(over.select(F.col("cell").alias("_over")), "overflow-cells"), 80)
            hot = rows.drop("part").withColumn("_seq", F.monotonically_increasing_id())
            hot = hot.join(side, hot["_bits"] == side["_over"], "left_semi")
            hot = hot.withColumn("_order", order_hash(f"row.{id_col}", f"row.{text_col}"))
            rest = rows.join(side, rows["_bits"] == side["_over"], "left_anti")
            rows = rest.unionByName(parted(materialized(hot, "overflow-rows"), limit))
        for i, cells in enumerate(rounds):
            side = cells.select(F.col("cell").alias(f"_cell{i}"), F.col("leaf").alias(f"_leaf{i}"))
            rows = rows.join(side, F.substring(rows["_bits"], 1, (i + 1) * ROUND_BITS) == side[f"_cell{i}"], "left")
            leaves.append(F.col(f"_leaf{i}"))
        rows = rows.withColumn("_leaf", F.coalesce(*leaves)).select("row", "n_bytes", "part", "_leaf.*")
    return rows.withColumn("fits", F.col("shard_bytes") <= limit).select("row", "n_bytes", *SHARD_COLUMNS)


def with_shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with the columns of their shard; a name that is taken gets underscores."""
    taken, names = {c.lower() for c in docs.columns}, []
    for name in SHARD_COLUMNS:
        while name in taken:
            name += "_"
        names.append(name)
    columns = [F.col(c).alias(name) for c, name in zip(SHARD_COLUMNS, names, strict=True)]
    return sharded(docs, limit).select("row.*", *columns)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """The columns of ``docs`` written below ``path``, a folder for each shard or part of one, each from one task."""
    part = F.when(F.col("part") > 0, F.concat(F.lit("-"), F.col("part").cast("string"))).otherwise("")
    rows = sharded(docs, limit).select("row.*", F.concat(F.lit("b"), "shard", part).alias("shard_bits"))
    rows.repartition("shard_bits").write.partitionBy("shard_bits").parquet(path)


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents with their shard, 64 MiB of text at most."""
    rows = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return rows.select(F.col("row")["doc_id"].alias("doc_id"), "n_bytes", *SHARD_COLUMNS)


def sharding_fine(spark, sf_dir: str) -> DataFrame:
    """The same with shards of 64 KiB, so that small tables split too."""
    rows = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 64 << 10)
    return rows.select(F.col("row")["doc_id"].alias("doc_id"), "n_bytes", *SHARD_COLUMNS)


def sql(limit: int) -> str:
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(strlen(text), 0) AS n_bytes,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')) AS sorted,
         lpad(bin(('0x' || substr(coalesce(md5(doc_id::VARCHAR), md5(text), md5('')), 1, 16))::UBIGINT), 64, '0') AS bits
  FROM documents),
s AS (
  SELECT depth, substr(bits, 1, depth) AS shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
  FROM d, (SELECT unnest(range(65))::INTEGER AS depth) GROUP BY 1, 2),
f AS (
  SELECT d.doc_id, d.n_bytes, d.sorted, s.*,
         row_number() OVER (PARTITION BY d.row ORDER BY shard_bytes > {limit},
                            CASE WHEN shard_bytes <= {limit} THEN s.depth ELSE -s.depth END) AS k
  FROM d JOIN s ON s.shard = substr(d.bits, 1, s.depth)),
h AS (SELECT *, shard_bytes <= {limit} AS fits, n_bytes * 2 > {limit} AS large FROM f WHERE k = 1),
r AS (
  SELECT *, coalesce(sum(CASE WHEN large THEN 0 ELSE n_bytes END) OVER o, 0)::BIGINT AS begins,
         coalesce(sum(large::INTEGER) OVER o, 0)::BIGINT AS singles
  FROM h WINDOW o AS (PARTITION BY shard ORDER BY sorted, n_bytes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id, n_bytes, shard, depth, shard_bytes, shard_rows, fits,
       (CASE WHEN fits OR shard_rows = 1 THEN 0 WHEN large THEN singles * 2 + 2 ELSE begins * 2 // {limit} * 2 + 1 END)::BIGINT AS part
FROM r
"""
