"""Mixing sources to target weights by temperature.

Native: DataFrame functions only. A source's weight is its share of all words to the power of an
exponent between 0 (all alike) and 1 (as found), normalised. The exponent is bisected: as high as the
target entropy allows, but not so low that the smallest source repeats more often than the limit,
which wins. The weights then become whole passes over each source and a part of one more: every
pass is a permutation of the source by a hash, cut into blocks by the first digits, and the last
pass ends where the source's budget does.

No source is ever ordered as a whole. Blocks are summed first; only the one block of each source
in which its budget ends is looked at row by row. Blocks get another digit whenever the largest source
has more than ``BLOCK_ROWS`` rows for each, so no block grows with the corpus.

Weights have nine significant digits, however small they are, and budgets are the nearest whole number of
words, so that no source is rounded away.

Defined cases: null sources are a source of their own; a source without words has weight zero
and is left out; rows without words cost nothing. Rows that share their id within a source, or have
none, get places of their own by a hash of their text and a number among equal rows, so that
the permutation stays as fine as the rows. An empty table gives an empty result.

``MIXING_SQL`` states the order for ids that are unique within their source.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import sized
from tidemark.session import materialized

WORDS = r"[^\x20\x09-\x0D]+"
TARGET_ENTROPY = 0.95  # of the highest there is, that of equal weights
MAX_REPETITION = 4.0
BUDGET = 1.0  # words to mix, as a share of all words
SEED = 7
BLOCK_DIGITS = 3  # hexadecimal: 4096 blocks a pass, or more
BLOCK_ROWS = 1 << 16
WEIGHT_DIGITS = 9
STEPS = 40
STEPS_A_JOB = 4


def order_key(epoch: Column, id_col: str, seed: int) -> Column:
    """A row's place in the permutation of one pass; ``tie`` (see ``with_ties``) is left out where null."""
    parts = [F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))]
    return F.md5(F.concat_ws(":", *parts, F.col("tie")))


def with_ties(rows: DataFrame) -> DataFrame:
    """``rows`` (``id``, ``source``, ``text_hash``, ...) with ``tie``: null where no other row has the same source and id.

    Elsewhere it is the hash of the text and a number among rows that agree in all three. These
    are counted for each part of the input, so that no group of copies is numbered in one task.
    """
    seen = rows.groupBy("source", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    seen = materialized(seen.select(F.col("source").alias("_source"), F.col("id").alias("_id")), "repeated-ids")
    if seen.isEmpty():
        return rows.withColumn("tie", F.lit(None).cast("string")).drop("text_hash")
    side = sized(seen, 64)
    on = rows["source"].eqNullSafe(side["_source"]) & rows["id"].eqNullSafe(side["_id"])
    alone = rows.join(side, on, "left_anti").withColumn("tie", F.lit(None).cast("string"))
    # The upper bits of the number are those of the part that the row was read in.
    dealt = rows.withColumn("_seq", F.monotonically_increasing_id())
    on = dealt["source"].eqNullSafe(side["_source"]) & dealt["id"].eqNullSafe(side["_id"])
    shared = dealt.join(side, on, "left_semi").withColumn("_part", F.shiftright("_seq", 33))
    shared = materialized(shared, "repeated-rows")
    same = ["source", "id", "text_hash"]
    counts = shared.groupBy(*same, "_part").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(*same).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).drop("_n")
    before = before.select(*[F.col(c).alias(f"{c}_b") for c in before.columns])
    on = [shared[c].eqNullSafe(before[f"{c}_b"]) for c in [*same, "_part"]]
    number = F.col("_before_b") + F.row_number().over(W.partitionBy(*same, "_part").orderBy("_seq")) - 1
    tie = F.concat_ws(":", "text_hash", number.cast("string"))
    numbered = shared.join(before, reduce(lambda a, b: a & b, on)).withColumn("tie", tie)
    return alone.unionByName(numbered.select(*alone.columns)).drop("text_hash")


def spread(sources: DataFrame, exponents: list[float]) -> list[float]:
    """For every exponent the sums of p^a and of p^a ln p over all sources, in one small job."""
    p, sums = F.col("share"), []
    for i, a in enumerate(exponents):
        power = F.pow(p, F.lit(a))
        sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.ln(p)).alias(f"l{i}")]
    row = sources.agg(*sums).first()
    return [(row[f"z{i}"], row[f"l{i}"]) for i in range(len(exponents))]


def bisected(sources: DataFrame, passes) -> tuple[float, float]:
    """The interval of width 2^-STEPS in which ``passes(a, z, l)`` turns from true to false, within 0 and 1."""
    low, width = 0.0, 1.0
    parts = 1 << STEPS_A_JOB
    for _ in range(STEPS // STEPS_A_JOB):
        width /= parts
        points = [low + i * width for i in range(1, parts)]
        good = [passes(a, z, l) for a, (z, l) in zip(points, spread(sources, points), strict=True)]
        low += width * (good.index(False) if False in good else parts - 1)
    return low, low + width


def exponent(sources: DataFrame, target_entropy: float, max_repetition: float, budget: float) -> float:
    """The exponent for ``sources`` (one row each, ``share`` > 0, a written table)."""
    facts = sources.agg(F.count(F.lit(1)).alias("k"), F.min("share").alias("least")).first()
    if not facts["k"]:
        return 1.0
    target = target_entropy * math.log(facts["k"])
    entropic = lambda a, z, l: math.log(z) - a * l / z >= target
    z, l = spread(sources, [1.0])[0]
    flat = 1.0 if entropic(1.0, z, l) else bisected(sources, entropic)[0]
    repeats = lambda a, z, _: budget * math.pow(facts["least"], a - 1) / z > max_repetition
    z, l = spread(sources, [0.0])[0]
    steep = bisected(sources, repeats)[1] if repeats(0.0, z, l) else 0.0
    return max(flat, steep)


def measured(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    n = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("bigint")
    text_hash = F.xxhash64(F.col(text_col)).alias("text_hash")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n.alias("n_tokens"), text_hash)
    rows = with_ties(materialized(rows, "measured"))
    return materialized(rows, "measured-ties")


def significant(weight: Column, digits: int = WEIGHT_DIGITS) -> Column:
    """``weight`` (above zero) to that many significant digits."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(weight)))
    return F.round(weight * scale) / scale


def block_digits(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> int:
    """How many digits of a key name its block, for the largest source of ``rows``."""
    most = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    digits = BLOCK_DIGITS
    while most > block_rows * 16**digits:
        digits += 1
    return digits


def plan(
    rows: DataFrame,
    target_entropy: float = TARGET_ENTROPY,
    max_repetition: float = MAX_REPETITION,
    budget: float = BUDGET,
    seed: int = SEED,
    digits: int | None = None,
) -> DataFrame:
    """One row per source: its weight, its words to mix, whole passes and where the last one ends.

    ``rows`` has ``id``, ``tie``, ``source`` and ``n_tokens`` of every document. A row is in the last pass if
    its key is below ``cut_block`` or at most ``cut_key``.
    """
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0")
    totals = materialized(totals, "source-tokens")
    whole = totals.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    sources = materialized(totals.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1)))), "sources")
    power = exponent(sources, target_entropy, max_repetition, budget)
    z = spread(sources, [power])[0][0] or 1.0
    weight = significant(F.pow("share", F.lit(power)) / F.lit(z))
    quotas = sources.select("source", "tokens", weight.alias("weight")).withColumn(
        "quota", F.round(F.col("weight") * F.lit(float(math.floor(whole * budget)))).cast("bigint")
    )
    quotas = quotas.withColumn("epochs", F.floor(F.col("quota") / F.col("tokens")))
    quotas = materialized(quotas.withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens")), "quotas")

    side = quotas.select(F.col("source").alias("_source"), "epochs", "rest")
    keyed = rows.join(side, rows["source"].eqNullSafe(side["_source"])).select(
        "source", "n_tokens", "rest", order_key(F.col("epochs"), "id", seed).alias("key")
    )
    keyed = keyed.withColumn("block", F.substring("key", 1, digits or block_digits(rows)))
    # 4096 blocks of each source, or as many as its rows need: two numbers for every BLOCK_ROWS rows.
    blocks = keyed.groupBy("source", "block").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    upto = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    summed = blocks.withColumn("upto", F.sum("n").over(upto))
    ends = summed.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
    ends = ends.select(
        F.col("source").alias("_source"), F.col("block").alias("cut_block"), (F.col("upto") - F.col("n")).alias("before")
    )
    ends = materialized(ends, "cut-blocks")
    on = keyed["source"].eqNullSafe(ends["_source"]) & (keyed["block"] == ends["cut_block"])
    inside = W.partitionBy("source", "cut_block").orderBy("key").rangeBetween(W.unboundedPreceding, 0)
    cut = keyed.join(ends, on).withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside))
    keys = cut.filter(F.col("upto") <= F.col("rest")).groupBy("source").agg(F.max("key").alias("cut_key"))
    keys = keys.withColumnRenamed("source", "_key_source")
    out = quotas.join(ends, quotas["source"].eqNullSafe(ends["_source"]), "left")
    out = out.join(keys, out["source"].eqNullSafe(keys["_key_source"]), "left")
    out = out.select(
        *quotas.columns, F.coalesce("cut_block", F.lit("")).alias("cut_block"), F.coalesce("cut_key", F.lit("")).alias("cut_key")
    )
    return materialized(out, "mixing-plan")


def passes_of(rows: DataFrame, the_plan: DataFrame, seed: int) -> DataFrame:
    """``rows`` (``id``, ``tie``, ``source``, ...) repeated once for each pass that takes them, with ``_epoch`` and ``_key``."""
    side = the_plan.select(F.col("source").alias("_source"), F.col("epochs").alias("_epochs"), "cut_block", "cut_key")
    both = rows.join(side, rows["source"].eqNullSafe(side["_source"]))
    last = order_key(F.col("_epochs"), "id", seed)
    taken = ((last < F.col("cut_block")) | (last <= F.col("cut_key"))).cast("bigint")
    # Not more than the repetition limit, rounded up.
    numbers = F.slice(F.sequence(F.lit(0).cast("bigint"), F.col("_epochs")), 1, (F.col("_epochs") + taken).cast("int"))
    out = both.withColumn("_epoch", F.explode(numbers))
    return out.withColumn("_key", order_key(F.col("_epoch"), "id", seed)).drop(*side.columns)


def mixed(docs: DataFrame, seed: int = SEED, **targets) -> DataFrame:
    """``docs`` (with ``doc_id``, ``text``, ``source``) as the mixture has them: left out, once or repeated."""
    the_plan = plan(measured(docs), seed=seed, **targets)
    text_hash = F.xxhash64("text").alias("text_hash")
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("id"), "source", text_hash)
    return passes_of(with_ties(rows), the_plan, seed).select("_doc.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """The mixture of all documents: a row for every time one is taken, with its place."""
    rows = measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = block_digits(rows)
    out = passes_of(rows, plan(rows, digits=digits), SEED)
    out = out.select("*", F.substring("_key", 1, digits).alias("block"))
    place = W.partitionBy("source", "_epoch", "block").orderBy("_key", "id")
    out = out.repartition("source", "_epoch", "block").withColumn("place", F.row_number().over(place))
    return out.select(
        F.col("id").alias("doc_id"), "source", "n_tokens", F.col("_epoch").alias("epoch"), "block", "place"
    )


MIXING_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY 1 HAVING sum(n_tokens) > 0),
w AS (SELECT sum(tokens)::BIGINT AS whole FROM s),
p AS (SELECT list(tokens / whole::DOUBLE ORDER BY tokens) AS ps, count(*) AS k, min(tokens / whole::DOUBLE) AS least FROM s, w),
flat AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN good THEN mid ELSE lo END, CASE WHEN good THEN hi ELSE mid END FROM (
    SELECT i, lo, hi, mid, ln(z) - mid * l / z >= {TARGET_ENTROPY} * ln(k) AS good FROM (
      SELECT i, lo, hi, (lo + hi) / 2 AS mid, k,
             list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2))) AS z,
             list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2) * ln(x))) AS l
      FROM flat, p WHERE i < {STEPS}))),
steep AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN much THEN mid ELSE lo END, CASE WHEN much THEN hi ELSE mid END FROM (
    SELECT i, lo, hi, mid, {BUDGET} * pow(least, mid - 1) / z > {MAX_REPETITION} AS much FROM (
      SELECT i, lo, hi, (lo + hi) / 2 AS mid, least, list_sum(list_transform(ps, lambda x: pow(x, (lo + hi) / 2))) AS z
      FROM steep, p WHERE i < {STEPS}))),
e AS (
  SELECT greatest(
    CASE WHEN -list_sum(list_transform(ps, lambda x: x * ln(x))) >= {TARGET_ENTROPY} * ln(k) THEN 1.0
         ELSE (SELECT lo FROM flat WHERE i = {STEPS}) END,
    CASE WHEN {BUDGET} / least / k > {MAX_REPETITION} THEN (SELECT hi FROM steep WHERE i = {STEPS}) ELSE 0.0 END)::DOUBLE AS a
  FROM p),
v AS (
  SELECT source, tokens, whole, pow(tokens / whole::DOUBLE, a) / z AS weight
  FROM s, w, (SELECT a, list_sum(list_transform(ps, lambda x: pow(x, a))) AS z FROM e, p)),
u AS (SELECT *, pow(10.0::DOUBLE, {WEIGHT_DIGITS} - 1 - floor(log10(weight))) AS scale FROM v),
q AS (SELECT source, tokens, round(round(weight * scale) / scale * floor(whole * {BUDGET}))::BIGINT AS quota FROM u),
g AS (
  SELECT {BLOCK_DIGITS} + len(list_filter(range({BLOCK_DIGITS}, 15), lambda i: {BLOCK_ROWS} * pow(16, i) < most))::BIGINT AS digits
  FROM (SELECT max(n) AS most FROM (SELECT count(*) AS n FROM d GROUP BY source))),
r AS (SELECT source, quota // tokens AS epochs, quota % tokens AS rest FROM q),
x AS (
  SELECT d.*, epochs, rest, unnest(range(epochs + 1)) AS epoch FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
y AS (SELECT *, md5('{SEED}:' || epoch || ':' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM x),
t AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY key RANGE UNBOUNDED PRECEDING) AS upto FROM y)
SELECT doc_id, source, n_tokens, epoch, substr(key, 1, digits) AS block,
       row_number() OVER (PARTITION BY source, epoch, substr(key, 1, digits) ORDER BY key, doc_id)::INTEGER AS place
FROM t, g WHERE epoch < epochs OR upto <= rest
"""
