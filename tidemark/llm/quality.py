"""Quality rules: counts per text, and a hashed n-gram log-likelihood ratio against trusted texts.

Native: DataFrame functions only. Two multinomials over hashed words and word pairs are counted over
all documents, one from the trusted ones and one from the whole corpus. A document's score is the mean
log-likelihood ratio of its n-grams, and every document is held against the same threshold. The two
models are ``BUCKETS`` numbers each, whatever the corpus, and go along as one constant array.

Defined cases: a null text is an empty one and fails the base rules; a document without n-grams, or
a corpus without trusted documents, scores zero. Rows are judged one by one, so repeated rows
and repeated or missing ids change nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sized
from tidemark.session import materialized

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BUCKETS = 1 << 16
# Added to the expected and to the observed count of a bucket: rare buckets say little.
PRIOR = 5.0
# Mean log-likelihood ratio (nats an n-gram) that a document must reach.
THRESHOLD = -0.25


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+", -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: str, hash_bits: int = 64) -> Column:
    """How many words lie in three-word windows that occur twice or more in the array column ``words``.

    Each window is one long: its hash, with the low bits holding its place. Sorting these puts equal
    windows side by side. Only as many bits as the places need are taken from the hash, so windows that
    have a neighbour of the same hash bits are candidates, and only they are ordered by their words.
    ``hash_bits`` changes how many candidates there are, not the result.
    """
    kept_bits = F.lit((1 << hash_bits) - 1 if hash_bits < 64 else -1).cast("bigint")

    def counted(w: Column, mask: Column) -> Column:
        def window(i: Column) -> Column:
            h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            return h.bitwiseAND(kept_bits).bitwiseAND(mask).bitwiseOR(i.cast("bigint"))

        def spelled(x: Column) -> Column:
            i = x.bitwiseAND(F.bitwise_not(mask)).cast("int")
            # Words hold no space, so different windows have different texts.
            return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("text"), i.alias("place"))

        def candidates(ordered: Column) -> Column:
            def same(x: Column, k: Column) -> Column:
                return F.get(ordered, k).bitwiseXOR(x).bitwiseAND(mask) == 0

            return F.transform(F.filter(ordered, lambda x, j: either(same, x, j)), spelled)

        def repeated(ordered: Column) -> Column:
            def same(x: Column, k: Column) -> Column:
                return F.get(ordered, k)["text"] == x["text"]

            def covered(x: Column) -> Column:
                return F.array(x["place"], x["place"] + 1, x["place"] + 2)

            found = F.filter(ordered, lambda x, j: either(same, x, j))
            return F.size(F.array_distinct(F.flatten(F.transform(found, covered))))

        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)
        found = let(let(F.sort_array(windows), candidates), lambda x: let(F.sort_array(x), repeated))
        return F.when(F.size(w) >= 3, found).otherwise(F.lit(0)).cast("bigint")

    def either(same: Callable[[Column, Column], Column], x: Column, j: Column) -> Column:
        return F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False))

    def masked(w: Column) -> Column:
        return let(F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.length(F.bin(F.size(w)))), lambda m: counted(w, m))

    return let(F.col(words), masked)


def ngrams(words: str, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and word pairs."""
    size = F.lit(buckets).cast("bigint")

    def both(w: Column) -> Column:
        single = F.transform(w, lambda x: F.pmod(F.xxhash64(x), size).cast("int"))
        pair = F.transform(w, lambda x, i: F.pmod(F.xxhash64(x, F.get(w, i + 1)), size).cast("int"))
        return F.concat(single, F.slice(pair, 1, F.greatest(F.size(w) - 1, F.lit(0))))

    return let(F.col(words), both)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as of good quality and never as toxic; written, one row per id."""
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return materialized(good.filter("q = 1 and t = 0 and doc_id is not null").select("doc_id"), "trusted")


def weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """The log-likelihood ratio of every bucket, over all documents: ``buckets`` numbers."""
    trusted = sized(trusted_ids(labels), 16).select(F.col("doc_id").alias("_trusted"))
    text = docs.select("doc_id", words_of("text").alias("words"))
    marked = text.join(trusted, text["doc_id"] == trusted["_trusted"], "left")
    is_target = F.col("_trusted").isNotNull().cast("bigint").alias("is_target")
    grams = marked.select(is_target, ngrams("words", buckets).alias("grams"))
    counts = (
        # Outer: a plain explode would put a test of the array on the scan, with its words split anew each time.
        grams.select("is_target", F.explode_outer("grams").alias("bucket"))
        .filter("bucket is not null")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("is_target").alias("target"))
    )
    counts = materialized(counts, "ngram-counts")
    totals = counts.agg(F.struct(F.sum("raw").alias("raw"), F.sum("target").alias("target"))).scalar()
    expected = F.col("raw") * totals["target"] / totals["raw"]
    ratio = F.when(totals["target"] > 0, F.ln((F.col("target") + PRIOR) / (expected + PRIOR)))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select("bucket", F.coalesce(ratio, F.lit(0.0)).alias("weight"))
    # As many rows as buckets, a fixed number.
    return [r["weight"] for r in full.orderBy("bucket").collect()]


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with the counts of the base rules and ``base_failed``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    rows = docs.select(
        "doc_id",
        words_of("text").alias("words"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words("words").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Counts, base verdict, ``score`` and ``kept`` of every document."""
    docs = docs.select("doc_id", "text")
    # A constant of the plan: a column would be copied into every row.
    model = F.split(F.lit(",".join(map(repr, weights(docs, labels, buckets)))), ",").cast("array<double>")
    rows = base_rules(docs).withColumn("_grams", ngrams("words", buckets))
    total = F.aggregate("_grams", F.lit(0.0), lambda acc, b: acc + F.get(model, b))
    rows = rows.withColumn("score", F.coalesce(F.try_divide(total, F.size("_grams").cast("double")), F.lit(0.0)))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop("words", "_grams")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents against models counted from all documents and all labels."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
