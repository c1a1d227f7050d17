from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam


def words(text):
    return (text or "").encode().lower().split()


def counted(w, size):
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def matches(docs, items):
    """All pairs with a window of 0.8 or more."""
    out = set()
    for d in docs:
        text = words(d["text"])
        for i in items:
            item = words(i["text"])
            if not item:
                continue
            size = min(5, len(item))
            span = min(len(item), len(text))
            want = counted(item, size)
            for a in range(len(text) - span + 1):
                have = counted(text[a : a + span], size)
                shared = (want & have).total()
                if shared and shared / (want.total() + have.total() - shared) >= 0.8:
                    out.add((d["doc_id"], i["item_id"]))
                    break
    return out


def test_query_equals_brute_force(spark, folder, documents):
    found = decontam.op7_benchmark_decontamination(spark, folder).collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    shingled = {s for i in items for s in counted(words(i["text"]), 5)}
    docs = [d for d in documents.collect() if any(s in shingled for s in counted(words(d["text"]), 5))]
    assert {(r["doc_id"], r["item_id"]) for r in found} == matches(docs, items)
    assert all(r["similarity"] >= 0.8 and r["distance"] <= decontam.MAX_DISTANCE for r in found)


@pytest.fixture(scope="module")
def benchmark(spark, odd_rows):
    same = odd_rows[0][1].split()
    rows = [
        (1, " ".join(same[20:60])),
        (2, " ".join(same[40:80])),  # in the near copy with one word changed
        (3, "TWO words"),
        (4, "Word"),
        (5, ""),
        (6, None),
        (None, " ".join(same[:30])),
        (7, " ".join(same) + " and much more of it " * 200),
        (1, " ".join(same[20:60])),
        (8, "be " * 30),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_odd_rows(odd_docs, benchmark, no_docs):
    found = decontam.contamination(odd_docs, benchmark).collect()
    docs = [d for d in odd_docs.collect() if d["doc_id"] not in (12, 13)]
    assert {(r["id"], r["item_id"]) for r in found} == matches(docs, benchmark.collect())
    assert decontam.contamination(no_docs, benchmark).count() == 0
    assert decontam.contamination(odd_docs, benchmark.limit(0)).count() == 0


def test_parts_of_a_large_benchmark_find_the_same(odd_docs, benchmark, monkeypatch):
    whole = decontam.contamination(odd_docs, benchmark)
    monkeypatch.setattr(decontam, "BENCHMARK_BYTES", 300)
    parts = decontam.contamination(odd_docs, benchmark)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_clean_keeps_rows_whole(odd_docs, benchmark):
    kept = decontam.clean(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {0, 1, 2, 6, 7, 10, 11} & set(ids)
    assert {3, 4, 5, 9, 12, 13, 14, 15, None} <= set(ids) and ids.count(9) == 3


def test_index_misses_nothing_within_the_distance():
    import numpy as np

    draw = np.random.default_rng(2)
    items = decontam.Items([0], [draw.integers(1, 1 << 60, 12, np.uint64)], 5)
    base = items.prints[0]
    for distance in range(decontam.MAX_DISTANCE + 1):
        flips = draw.permutation(64)[:distance]
        print_ = base ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0))
        window, _, found = items.candidates(np.array([print_], np.uint64), decontam.MAX_DISTANCE)
        assert window.tolist() == [0] and found.tolist() == [distance]


def test_radius_beyond_the_index_is_refused(odd_docs, benchmark):
    with pytest.raises(ValueError):
        decontam.contamination(odd_docs, benchmark, max_distance=decontam.MAX_DISTANCE + 1)


@pytest.mark.parametrize("kind", ["int", "string", "decimal(9,0)", "date"])
def test_item_ids_of_any_type(spark, odd_docs, kind):
    item = spark.createDataFrame([("word",), ("two words",)], "text string")
    item = item.withColumn("item_id", F.lit("2024-01-01").cast(kind) if kind == "date" else F.lit(7).cast(kind))
    found = decontam.contamination(odd_docs, item.select("item_id", "text"))
    assert found.schema["item_id"].dataType == item.schema["item_id"].dataType
    assert {r["id"] for r in found.collect()} >= {6, 7}
