import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid


TONGUES = ["de", "en", "es", "fr"]


def test_documents(spark, folder, documents):
    found = {r["doc_id"]: r for r in langid.op1_language_id(spark, folder).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    assert all(found[r["doc_id"]]["language"] == r["lang"] for r in rows)
    assert all(found[r["doc_id"]]["kept"] for r in rows if (r["text"] or "").strip())


def test_held_out_accuracy(spark):
    """Documents that declare nothing are told by their text, after training on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = docs.withColumn("declared", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    columns = {**langid.DOCUMENT_COLUMNS, "declared": "declared", "host": None}
    found = langid.identified(hidden, columns).withColumnRenamed("id", "doc_id")
    judged = found.join(docs, "doc_id").filter("doc_id % 2 = 1 and n_chars > 40")
    assert judged.filter("language = lang").count() >= 0.99 * judged.count()


def test_pages(spark, folder):
    found = langid.language_id_pages(spark, folder)
    assert found.count() == spark.read.parquet(f"{folder}/pages.parquet").count()
    assert found.filter("kept").count() > 0.9 * found.count()


def test_text_likelihoods(spark, odd_docs):
    """The vectorised sums equal a plain loop over trigrams."""
    columns = langid.DOCUMENT_COLUMNS
    rows = langid.evidence(odd_docs.filter("doc_id in (0, 6, 12, 14)"), columns)
    model = np.log(np.random.default_rng(1).random((langid.BUCKETS, len(TONGUES))))
    got = {r["id"]: r for r in langid.read_texts(rows, model).collect()}
    for r in rows.collect():
        folded = bytes(langid.FOLD[list(r["text"])].tolist())
        sums, n = np.zeros(len(TONGUES)), 0
        for a, b, c in zip(folded, folded[1:], folded[2:]):
            mixed = ((a << 16 | b << 8 | c) * 0x9E3779B1) % 2**32
            sums += model[mixed >> 19]
            n += 1
        assert got[r["id"]]["n_grams"] == n
        assert got[r["id"]]["likelihood"] == pytest.approx(sums.tolist())


def test_priors_are_smoothed_by_level(spark):
    rows = spark.createDataFrame(
        [("en", "com/", "a.x.com", "x.com")] * 30
        + [("de", "com/", "b.x.com", "x.com")] * 10
        + [("fr", "fr/", "c.y.fr", "y.fr")] * 20
        + [(None, "fr/", "c.y.fr", "y.fr")] * 7,
        "declared string, suffix string, host string, domain string",
    )
    corpus, hosts, suffixes = langid.priors(rows, TONGUES)
    counts = {"de": 11, "en": 31, "es": 1, "fr": 21}
    assert corpus == pytest.approx([counts[t] / 64 for t in TONGUES])
    k = langid.PRIOR_STRENGTH
    domain = [(n + k * p) / (40 + k) for n, p in zip((10, 30, 0, 0), corpus)]
    host = [(n + k * p) / (30 + k) for n, p in zip((0, 30, 0, 0), domain)]
    got = {r["host"]: r["host_prior"] for r in hosts.collect()}
    assert got["a.x.com"] == pytest.approx([math.log(p) for p in host])
    lift = [math.log((n + k * p) / (20 + k) / p) for n, p in zip((0, 0, 0, 20), corpus)]
    assert {r["suffix"]: r["suffix_weight"] for r in suffixes.collect()}["fr/"] == pytest.approx(lift)


def test_evidence_of_address_and_markup_decides_short_texts(spark):
    rows = [(i, "un la de en", "fr" if i % 2 else "es", f"https://h{i % 2}.example.{'fr' if i % 2 else 'es'}/x") for i in range(200)]
    rows += [(900, "un la de en", None, "https://new.example.fr/y"), (901, "un la de en", None, "https://new.example.es/y")]
    rows += [(902, "un la de en", "fr", None), (903, "un la de en", "es", None)]
    docs = spark.createDataFrame(rows, "id long, text string, declared string, address string")
    found = langid.identified(docs, {"id": "id", "text": "text", "declared": "declared", "address": "address"})
    got = {r["id"]: r["language"] for r in found.collect()}
    assert [got[i] for i in (900, 901, 902, 903)] == ["fr", "es", "fr", "es"]


def test_odd_rows(odd_docs, no_docs):
    found = langid.identified(odd_docs, langid.DOCUMENT_COLUMNS)
    assert found.count() == odd_docs.count()
    kept = langid.recognised(odd_docs)
    assert kept.columns == odd_docs.columns
    # Rows without any trigram go, and so may what fits no language; all others stay, repeated ones too.
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert 3 not in ids and 4 not in ids
    assert {0, 1, 2, 9, 10, 11, 12} <= set(ids) and ids.count(9) == 3
    assert langid.identified(no_docs, langid.DOCUMENT_COLUMNS).count() == 0
    assert langid.recognised(no_docs).count() == 0


def brute(rows, tongues):
    """Language, confidence and verdict of (id, text, declared, host) rows, from the definitions."""
    bucket = lambda a, b, c: ((a << 16 | b << 8 | c) * 0x9E3779B1) % 2**32 >> 19
    folded = [bytes(langid.FOLD[list((t or "").encode())].tolist()) if t else b"" for _, t, _, _ in rows]
    grams = [[bucket(*g) for g in zip(f, f[1:], f[2:])] for f in folded]
    counts = np.full((len(tongues), langid.BUCKETS), 0.5)
    for (_, _, said, _), found in zip(rows, grams):
        if said in tongues:
            np.add.at(counts[tongues.index(said)], found, 1)
    p = counts / counts.sum(axis=1, keepdims=True)
    entropy = -(p * np.log(p)).sum(axis=1)
    of = lambda keep: np.array([sum(1.0 for r in rows if r[2] == t and keep(r)) for t in tongues])
    corpus = (of(lambda r: True) + 1) / (of(lambda r: True) + 1).sum()
    smooth = lambda n, above: (n + langid.PRIOR_STRENGTH * above) / (n.sum() + langid.PRIOR_STRENGTH)
    domain = lambda host: ".".join(host.split(".")[-2:])
    declared = {r[3] for r in rows if r[2] in tongues and r[3] is not None}
    out = {}
    for (key, _, said, host), found in zip(rows, grams):
        text = np.log(p)[:, found].sum(axis=1)
        logs = langid.TEXT_WEIGHT * text
        if said in tongues:
            off = (1 - langid.DECLARED_TRUST) / max(1, len(tongues) - 1)
            logs = logs + np.log([langid.DECLARED_TRUST if t == said else off for t in tongues])
        prior = corpus
        if host in declared:
            prior = smooth(of(lambda r: r[3] == host), smooth(of(lambda r: r[3] and domain(r[3]) == domain(host)), corpus))
        logs = logs + np.log(prior)
        best = int(logs.argmax())
        sure = float(1 / np.exp(logs - logs.max()).sum())
        n = len(found)
        fits = n > 0 and -text[best] / n - entropy[best] <= langid.MAX_EXCESS + langid.SHORT_EXCESS / math.sqrt(n)
        out[key] = tongues[best], sure, fits and sure >= langid.MIN_CONFIDENCE
    return out


def test_posterior_and_verdict_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [(r[0], r[1][:400] if r[0] % 3 else "qx " + r[1][:5], r[2] if r[0] % 4 else None, r[3] if r[0] % 5 else None) for r in docs.collect()]
    rows += [(10_000 + i, "wkrótce zażółć gęślą jaźń pchnąć w tę łódź jeża " * 3, None, "src1") for i in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = brute(rows, TONGUES)
    got = {r["id"]: r for r in langid.identified(frame, langid.DOCUMENT_COLUMNS).collect()}
    assert len(got) == len(rows)
    for key, (tongue, sure, kept) in want.items():
        assert (got[key]["language"], got[key]["kept"]) == (tongue, kept)
        assert got[key]["confidence"] == pytest.approx(sure, rel=1e-6)


FOREIGN = [
    "Il governo ha annunciato ieri nuove misure per sostenere le famiglie colpite dalla crisi economica e per rilanciare "
    "gli investimenti nelle regioni del sud dove la disoccupazione rimane molto alta",
    "Wczoraj rząd ogłosił nowe środki wsparcia dla rodzin dotkniętych kryzysem gospodarczym oraz plan ożywienia inwestycji "
    "w regionach południowych gdzie bezrobocie pozostaje bardzo wysokie",
    "政府昨天宣布了新的措施以支持受经济危机影响的家庭并在失业率仍然很高的南部地区恢复投资",
    "bcdfg hjklm npqrs tvwxz bdfhj lnprt vxzbc dfghj klmnp qrstv wxzbd fhjln prtvx zcfgk mqswz " * 3,
]


def test_texts_that_fit_no_language_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    foreign = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(FOREIGN)], "doc_id long, text string")
    found = langid.identified(docs.unionByName(foreign, allowMissingColumns=True), langid.DOCUMENT_COLUMNS)
    gone = {r["id"] for r in found.filter("not kept").collect()}
    assert {-1 - i for i in range(len(FOREIGN))} <= gone
    short = {r["doc_id"] for r in docs.filter("octet_length(text) < 60").select("doc_id").collect()}
    assert {i for i in gone if i >= 0} <= short and len(gone) < 10


def test_languages_come_from_the_rows(spark):
    rows = [(i, "ala ma kota i psa", "pl") for i in range(5)] + [(9, "ala ma kota", "cs"), (10, "ala ma kota", "p1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    assert langid.languages(langid.evidence(docs, langid.DOCUMENT_COLUMNS)) == ["pl"]
    assert {r["language"] for r in langid.identified(docs, langid.DOCUMENT_COLUMNS).collect()} == {"pl"}
    none = langid.identified(docs.withColumn("lang", F.lit(None).cast("string")), langid.DOCUMENT_COLUMNS).collect()
    assert all(r["kept"] and r["language"] is None and r["confidence"] is None for r in none)
