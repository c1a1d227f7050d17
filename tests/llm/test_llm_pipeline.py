import corpus_pipeline
from test_llm_decontam import matches, words
from test_llm_simhash import expected

from tidemark.llm import langid, mixing, registry


def test_run_equals_the_plain_way(spark, folder, documents):
    """Every decision of the first three stages by brute force, the mixture by SQL-checked parts."""
    rows = documents.collect()
    recognised = [r for r in rows if len((r["text"] or "").encode()) >= 3]
    groups = expected(recognised)
    kept_ids = {c for _, _, c in groups}
    kept = [r for r in recognised if r["doc_id"] in kept_ids]
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    shingled = {tuple(w[i : i + 5]) for x in items if (w := words(x["text"])) for i in range(len(w) - 4)}
    near = [r for r in kept if any(tuple(w[i : i + 5]) in shingled for w in [words(r["text"])] for i in range(len(w) - 4))]
    leaked = {d for d, _ in matches(near, items)}
    clean = spark.createDataFrame([r for r in kept if r["doc_id"] not in leaked], documents.schema)
    want = sorted(r["doc_id"] for r in mixing.mixed(clean).collect())
    out = corpus_pipeline.run(spark, folder)
    assert sorted(r["doc_id"] for r in out.collect()) == want
    assert out.columns[: len(documents.columns)] == documents.columns


def test_stages_take_odd_and_empty_tables(spark, folder, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        everything = {tuple(r) for r in docs.collect()}
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert {tuple(r)[: len(docs.columns)] for r in out.collect()} <= everything, name


def test_rows_without_text_go_first(odd_docs):
    ids = {r["doc_id"] for r in langid.recognised(odd_docs).collect()}
    assert not {3, 4} & ids


def test_registered():
    names = [n for n in registry.QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in registry.QUERIES and set(registry.SQL) <= set(registry.QUERIES)
