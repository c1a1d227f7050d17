import re
from collections import Counter

import pytest

from tidemark.llm import quality


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules(spark, folder, documents):
    found = {r["doc_id"]: r for r in quality.op8_quality_rules(spark, folder).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    for r in rows:
        assert tuple(found[r["doc_id"]][c] for c in COLUMNS) == base(r["text"])


@pytest.mark.parametrize("bits", [64, 12, 0])
def test_hashes_that_meet_change_nothing(documents, odd_docs, bits):
    """With few or no hash bits most windows are candidates, and their words decide."""
    for docs in (documents, odd_docs):
        rows = docs.select("text", quality.words_of("text").alias("w"))
        if bits == 0:
            rows = rows.filter("size(w) < 2000")
        found = rows.select("text", quality.repeat_words("w", bits).alias("n")).collect()
        assert found and all(r["n"] == base(r["text"])[4] for r in found)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (0, 1, None), (15, 1, 1), (2, 0, 0), (None, 1, 0), (11, None, 0)], "doc_id long, quality int, toxic int")


def test_odd_rows(odd_docs, labels):
    found = quality.quality_rules(odd_docs, labels).collect()
    got = sorted((tuple([r["doc_id"], *[r[c] for c in COLUMNS]]) for r in found), key=str)
    assert got == sorted(((r["doc_id"], *base(r["text"])) for r in odd_docs.collect()), key=str)
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD) for r in found)


def test_score(spark, labels, odd_docs):
    """The mean log ratio of the n-grams, with counts taken the plain way."""
    import math

    from pyspark.sql import functions as F

    docs = odd_docs.filter("doc_id in (0, 1, 2, 11, 15)")
    grams = docs.select("doc_id", quality.words_of("text").alias("w")).select("doc_id", quality.ngrams("w", 1024).alias("g"))
    by = {r["doc_id"]: r["g"] for r in grams.collect()}
    raw = Counter(b for g in by.values() for b in g)
    target = Counter(by[0])
    share = target.total() / raw.total()
    weight = {b: math.log((target[b] + quality.PRIOR) / (raw[b] * share + quality.PRIOR)) for b in raw}
    for r in quality.quality_rules(docs, labels, buckets=1024).select("doc_id", F.col("score")).collect():
        g = by[r["doc_id"]]
        assert r["score"] == pytest.approx(sum(weight[b] for b in g) / len(g))


def test_clean_documents_stay_and_tables_of_symbols_go(spark):
    folder = "/root/testdata/sf0.01"
    found = quality.op8_quality_rules(spark, folder).filter("not base_failed")
    judged = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    good = judged.filter("quality = 1")
    assert good.filter("kept").count() == good.count()
    bad = judged.filter("quality = 0")
    assert bad.filter("kept").count() < 0.5 * bad.count()


def test_without_trusted_documents_or_rows(odd_docs, no_docs, labels):
    none = quality.quality_rules(odd_docs, labels.limit(0))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert quality.quality_rules(no_docs, labels).count() == 0
