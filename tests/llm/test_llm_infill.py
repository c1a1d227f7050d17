"""Fill-in-the-middle against plain slicing, and back."""

import hashlib
import random
import re

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark.llm import infill

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def expected(key, text, seed=7, rate=100, spm=50):
    units = LINES.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_text(draw):
    pieces = ["\n", "\n\n", "a", "öl", "€", "😀", "<", "<P", "S>", "<S>", "\r", " ", "line\n", "x" * 9]
    weights = [4, 1, 4, 4, 2, 2, 1, 0.1, 0.1, 0.05, 1, 1, 4, 2]
    return "".join(draw.choices(pieces, weights, k=draw.randrange(60)))


@pytest.mark.parametrize("block", [1, 3, 8, 4096])
def test_cuts_of_odd_texts(block):
    draw = random.Random(block)
    for key in range(400):
        text = odd_text(draw)
        n, form, prefix, middle, output = infill.transform(text.encode(), key, rate=80, block=block)
        assert (n, form, prefix, middle, output.decode()) == expected(key, text, rate=80)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 8, 9, 100])
def test_fenwick_tree(size):
    counts = np.random.default_rng(size).integers(0, 4, size)
    tree, sums = infill.Fenwick(counts), np.cumsum(counts)
    assert all(tree.before(b) == counts[:b].sum() for b in range(size + 1))
    for target in range(1, int(counts.sum()) + 1):
        block = int(np.searchsorted(sums, target))
        assert tree.descend(target) == (block, counts[:block].sum())


def check(docs, rows):
    out = infill.fill_in_middle(docs).withColumn("back", infill.restored())
    got = sorted((tuple(r) for r in out.select("id", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()), key=str)
    assert got == sorted(((i, *expected(i, t or ""), t or "") for i, t in rows), key=str)


def test_documents(spark, documents, folder):
    check(documents, [tuple(r) for r in documents.select("doc_id", "text").collect()])
    query = infill.op13_fill_in_middle(spark, folder)
    assert difference(query, connect(folder), infill.FILL_IN_MIDDLE_SQL) is None
    forms = {r["form"]: r["count"] for r in query.groupBy("form").count().collect()}
    assert forms["psm"] > 50 and forms["spm"] > 50
    assert query.filter(F.col("restored_sha256").isNull()).count() == 0


def test_odd_table(odd_docs, odd_rows):
    check(odd_docs, [(r[0], r[1]) for r in odd_rows])


def test_odd_texts_come_back(spark):
    draw = random.Random(1)
    rows = [(i, odd_text(draw)) for i in range(300)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_batches_of_few_bytes(odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(infill, "OUT_BYTES", 10)
    check(odd_docs, [(r[0], r[1]) for r in odd_rows])


def test_empty_table_and_string_ids(spark, no_docs):
    assert infill.fill_in_middle(no_docs).count() == 0
    check(spark.createDataFrame([("k", "a\nb\nc")], "doc_id string, text string"), [("k", "a\nb\nc")])
