"""Language identification by fusing evidence.

Four independent kinds of evidence are added up as logarithms, and the posterior is their softmax:

* the text: likelihood of its hashed byte trigrams under one multinomial for each language, counted
  over all rows that declare it;
* the language the markup declares, trusted to ``DECLARED_TRUST``;
* the suffix of the address (last label of the host, and a two-letter path segment), by how often
  the suffix comes with each language;
* a prior of the host, smoothed towards that of its domain, which is smoothed towards the whole corpus.

The languages are those that at least ``MIN_DECLARED`` rows declare, by two letters. A text that fits none of them is
rejected, however clearly it fits one better than the others: the best language's likelihood a trigram may stay only
so far under what that language's own texts have on average (``MAX_EXCESS``, and more for short texts).

All counts are grouped aggregations. The multinomials have a fixed size. Tables that grow with the
number of hosts meet the rows in joins, after the texts have been left behind.

Defined cases: null texts are empty; a row whose text has no trigram is rejected, as is one whose best
language stays under ``MIN_CONFIDENCE``. Null, odd and rare declared languages, null addresses and null
hosts are no evidence. Rows are judged one by one, whatever their ids. Ties go to the first
language in order. If no language is declared often enough, nothing can be told: language and confidence are null, and
every row with a trigram is kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped, without_rows
from tidemark.llm.repeats import slices
from tidemark.session import materialized

MIN_DECLARED = 5
BUCKETS = 1 << 13
DECLARED_TRUST = 0.9
# Neighbouring trigrams are far from independent: the text counts for less than their sum.
TEXT_WEIGHT = 0.2
PRIOR_STRENGTH = 50.0
MIN_CONFIDENCE = 0.6
# Nats a trigram that a text may have above its language's entropy, and what comes on top over the root of its length.
MAX_EXCESS = 2.5
SHORT_EXCESS = 10.0
PIECE = 1 << 18
FIELDS = ["id", "key", "declared", "suffix", "host", "domain"]

# Letters in lower case, and all bytes of other characters; everything else is a gap.
FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


def trigrams(raw: np.ndarray) -> np.ndarray:
    """The bucket of the three bytes that begin at each place."""
    b = FOLD[raw].astype(np.uint32)
    mixed = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(0x9E3779B1)
    return mixed >> np.uint32(32 - (BUCKETS - 1).bit_length())


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and bucket of all trigrams, for about PIECE bytes at a time; long texts come in parts."""
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        for at in range(0, max(len(raw) - 2, 0), PIECE):
            found = trigrams(raw[at : at + PIECE + 2])
            held.append(found)
            owners.append(np.full(len(found), i))
            size += len(found)
            if size >= PIECE:
                yield np.concatenate(owners), np.concatenate(held)
                held, owners, size = [], [], 0
    if held:
        yield np.concatenate(owners), np.concatenate(held)


def evidence(docs: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    """``columns`` names the columns for id, text, declared, address and host; null for none."""

    def given(name: str) -> Column:
        return F.col(columns[name]) if columns.get(name) else F.lit(None).cast("string")

    tongue = F.lower(F.substring(given("declared"), 1, 2))
    host = F.lower(F.coalesce(given("host"), F.regexp_extract(given("address"), r"^[A-Za-z]+://([^/:?#]+)", 1)))
    label = F.regexp_extract(host, r"\.([^.]+)$", 1)
    segment = F.regexp_extract(given("address"), r"^[A-Za-z]+://[^/]+/([a-z]{2})(?:[/?#]|$)", 1)
    return docs.select(
        given("id").alias("id"),
        judged_key(columns).alias("key"),
        F.when(tongue.rlike("^[a-z]{2}$"), tongue).alias("declared"),
        F.when(given("address").isNotNull(), F.concat(label, F.lit("/"), F.coalesce(segment, F.lit("")))).alias("suffix"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+(?:\.[^.]+)?)$", 1).alias("domain"),
        F.coalesce(given("text"), F.lit("")).cast("binary").alias("text"),
    )


def judged_key(columns: dict[str, str | None]) -> Column:
    """All that a verdict depends on."""
    return F.xxhash64(*[F.col(c) for c in columns.values() if c])


def languages(rows: DataFrame, least: int = MIN_DECLARED) -> list[str]:
    """What enough rows declare, in order: at most one for each pair of letters."""
    counts = rows.filter("declared is not null").groupBy("declared").count().filter(F.col("count") >= least)
    return sorted(r["declared"] for r in counts.collect())


def trained(rows: DataFrame, tongues: list[str]) -> np.ndarray:
    """Log-likelihoods, a row for each bucket and a column for each language."""
    n = len(tongues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n * BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                tongue = np.array([tongues.index(d) for d in part.column("declared").to_pylist()], np.int64)
                for owner, bucket in pieces(part.column("text").to_pylist()):
                    counts += np.bincount(tongue[owner] * BUCKETS + bucket, minlength=n * BUCKETS)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts[cell])], ["cell", "n"])

    known = rows.filter(F.col("declared").isin(tongues)).select("declared", "text")
    cells = mapped(known, run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.full(n * BUCKETS, 0.5)
    counts[[r["cell"] for r in cells]] += [r["n"] for r in cells]
    counts = counts.reshape(n, BUCKETS)
    return np.log(counts / counts.sum(axis=1, keepdims=True)).T.copy()


def entropies(model: np.ndarray) -> list[float]:
    """How unlikely a trigram of each language is under its own multinomial, on average."""
    return [float(h) for h in -(np.exp(model) * model).sum(axis=0)]


def read_texts(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """The rows without their texts, with the number of trigrams and a log-likelihood for each language."""
    n = model.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                total, many = np.zeros((len(texts), n)), np.zeros(len(texts), np.int64)
                for owner, bucket in pieces(texts):
                    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    total[owner[first]] += np.add.reduceat(model[bucket], first, axis=0)
                    many[owner[first]] += np.diff(np.r_[first, len(owner)])
                sums = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), n).cast(pa.list_(pa.float64()))
                columns = [part.column(f) for f in FIELDS]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(many), sums], [*FIELDS, "n_grams", "likelihood"])

    more = [T.StructField("n_grams", T.LongType()), T.StructField("likelihood", T.ArrayType(T.DoubleType()))]
    return mapped(rows, run, T.StructType([rows.schema[f] for f in FIELDS] + more))


def language_counts(tongues: list[str]) -> list[Column]:
    return [F.sum((F.col("declared") == tongue).cast("double")).alias(tongue) for tongue in tongues]


def shares(counts: list[Column], parent: list[Column]) -> list[Column]:
    """Shares of the languages, smoothed as if ``PRIOR_STRENGTH`` more rows had those of the parent."""
    n = reduce(lambda a, b: a + b, counts) + PRIOR_STRENGTH
    return [(c + PRIOR_STRENGTH * p) / n for c, p in zip(counts, parent, strict=True)]


def priors(rows: DataFrame, tongues: list[str]) -> tuple[list[float], DataFrame, DataFrame]:
    """Shares in the corpus, log priors by ``host``, log weights by ``suffix``; from rows that declare."""
    known = rows.filter(F.col("declared").isin(tongues))
    whole = known.agg(*language_counts(tongues)).first()
    counts = [(whole[t] or 0.0) + 1.0 for t in tongues]
    corpus = [c / sum(counts) for c in counts]
    base = [F.lit(c) for c in corpus]

    hosts = known.filter("host is not null").groupBy("domain", "host").agg(*language_counts(tongues))
    hosts = materialized(hosts, "host-counts")
    domains = hosts.groupBy("domain").agg(*[F.sum(t).alias(t) for t in tongues])
    above = F.array(*shares([F.col(t) for t in tongues], base)).alias("above")
    smooth = hosts.join(domains.select("domain", above), "domain")
    parent = [F.col("above")[i] for i in range(len(tongues))]
    of_host = F.array(*[F.ln(s) for s in shares([F.col(t) for t in tongues], parent)])
    by_host = materialized(smooth.select("host", of_host.alias("host_prior")), "host-priors")

    # How much more often a language comes with a suffix than in the corpus.
    suffixes = known.filter("suffix is not null").groupBy("suffix").agg(*language_counts(tongues))
    lift = [F.ln(s / b) for s, b in zip(shares([F.col(t) for t in tongues], base), base, strict=True)]
    by_suffix = materialized(suffixes.select("suffix", F.array(*lift).alias("suffix_weight")), "suffix-weights")
    return corpus, by_host, by_suffix


def identified(docs: DataFrame, columns: dict[str, str | None], min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``id``, ``key``, ``language``, ``confidence`` and ``kept`` of every row."""
    rows = evidence(docs, columns)
    tongues = languages(rows)
    if not tongues:
        told = F.length("text") > 2
        return rows.select("id", "key", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("confidence"), told.alias("kept"))
    model = trained(rows, tongues)
    read = materialized(read_texts(rows, model), "text-evidence")
    corpus, by_host, by_suffix = priors(read, tongues)
    # Without the texts these rows are small, and plain equi-joins split where one host has very many.
    both = read.join(by_host, "host", "left").join(by_suffix, "suffix", "left")
    off = (1 - DECLARED_TRUST) / max(1, len(tongues) - 1)
    logs = []
    for i, tongue in enumerate(tongues):
        said = F.when(F.col("declared") == tongue, F.lit(DECLARED_TRUST)).otherwise(F.lit(off))
        logs.append(
            TEXT_WEIGHT * F.col("likelihood")[i]
            + F.coalesce(F.when(F.col("declared").isin(tongues), F.ln(said)), F.lit(0.0))
            + F.coalesce(F.col("suffix_weight")[i], F.lit(0.0))
            + F.coalesce(F.col("host_prior")[i], F.lit(float(np.log(corpus[i]))))
        )
    both = both.withColumn("logs", F.array(*logs)).withColumn("most", F.array_max("logs"))
    odds = F.aggregate("logs", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("most")))
    at = F.array_position("logs", F.col("most")).cast("int")
    of_best = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), at)
    # How much less likely a trigram is than in texts of that language.
    excess = -F.element_at("likelihood", at) / F.col("n_grams") - of_best(entropies(model))
    fits = excess <= MAX_EXCESS + SHORT_EXCESS / F.sqrt("n_grams")
    kept = (F.col("n_grams") > 0) & (F.col("confidence") >= min_confidence) & F.coalesce("_fits", F.lit(False))
    out = both.select(
        "id", "key", of_best(tongues).alias("language"), (1 / odds).alias("confidence"), "n_grams",
        F.when(F.col("n_grams") > 0, fits).alias("_fits"),
    )
    return out.withColumn("kept", kept).drop("n_grams", "_fits")


DOCUMENT_COLUMNS = {"id": "doc_id", "text": "text", "declared": "lang", "host": "source"}


def recognised(docs: DataFrame) -> DataFrame:
    """``docs`` (columns as in ``documents``) without the rows whose language stays unclear."""
    verdicts = identified(docs, DOCUMENT_COLUMNS).filter(~F.col("kept"))
    unwanted = materialized(verdicts.select(F.col("key").alias("_key"), F.col("id").alias("_id")).distinct(), "rejected")
    return without_rows(docs, unwanted, judged_key(DOCUMENT_COLUMNS))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """All documents; their ``lang`` is what was declared, their ``source`` the host."""
    rows = identified(spark.read.parquet(f"{sf_dir}/documents.parquet"), DOCUMENT_COLUMNS)
    return rows.select(F.col("id").alias("doc_id"), "language", "confidence", "kept")


def language_id_pages(spark, sf_dir: str) -> DataFrame:
    """All pages, with the language of their markup and their address."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    hidden = r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>"
    rows = pages.select(
        "page_id",
        "url",
        F.regexp_extract("html", r"<html[^>]*?\blang=[\"']?([A-Za-z]+)", 1).alias("declared"),
        F.regexp_replace("html", hidden, " ").alias("text"),
    )
    columns = {"id": "page_id", "text": "text", "declared": "declared", "address": "url"}
    return identified(rows, columns).select(F.col("id").alias("page_id"), "language", "confidence", "kept")
