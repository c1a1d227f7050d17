"""Exact dedup against brute force, with digests that collide, in batches, and on odd tables."""

import hashlib
import random
import re

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup
from tidemark.llm.cuckoo import SLOTS, Filter, LiveKeys


def expected(rows):
    """By normalised text: (id, keep_id, size, kept) of every row, as a bag."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for same, members in groups.items():
        ranked = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(same.encode()).hexdigest()
        out += [(m[0], ranked[0][0], len(members), at == 0, sha) for at, m in enumerate(ranked)]
    return sorted(out, key=str)


def got(verdicts):
    rows = verdicts.select("id", "keep_id", "group_size", "kept", F.lower(F.hex(F.substring("digest", 1, 32))))
    return sorted(map(tuple, rows.collect()), key=str)


def weak(text):
    """Sixteen digests for all texts."""
    return F.unhex(F.concat(F.lit("0"), F.substring(F.sha2(text, 256), 1, 1)))


def test_filter_keeps_and_loses_keys():
    live, kept, draw = LiveKeys(1), set(), random.Random(3)
    for _ in range(20_000):
        key = draw.randrange(3000).to_bytes(2, "big")
        if draw.random() < 0.6:
            assert live.insert(key) == (key not in kept)
            kept.add(key)
        else:
            assert live.delete(key) == (key in kept)
            kept.discard(key)
    assert all((k.to_bytes(2, "big") in live) == (k.to_bytes(2, "big") in kept) for k in range(3000))
    assert live.size == len(kept) and live.resizes > 0
    assert sum(map(bool, live.filter.slots)) == len(kept)


def test_filter_fills_well_before_it_grows():
    live = LiveKeys(1024)
    added = 0
    while not live.resizes:
        added += live.insert(added.to_bytes(8, "big"))
    assert added > 0.9 * 1024 * SLOTS


def test_either_bucket_leads_to_the_other():
    filled = Filter(256)
    for n in range(500):
        fingerprint, a, b = filled.places(str(n).encode())
        step = fingerprint * 0x5BD1E995 & filled.mask
        assert fingerprint and a ^ step == b and b ^ step == a


def test_documents(spark, documents, folder):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert got(exact_dedup.verdicts(documents)) == expected(rows)
    query = exact_dedup.op11_exact_dedup(spark, folder)
    assert difference(query, connect(folder), exact_dedup.EXACT_DEDUP_SQL) is None


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, -1])
def test_odd_table(odd_docs, odd_rows, broadcast_bytes):
    out = exact_dedup.verdicts(odd_docs, broadcast_bytes=broadcast_bytes)
    assert got(out) == expected([(r[0], r[1]) for r in odd_rows])


@pytest.mark.parametrize("broadcast_bytes", [1 << 25, -1])
def test_colliding_digests_are_told_apart_by_content(odd_docs, odd_rows, broadcast_bytes):
    out = exact_dedup.verdicts(odd_docs, digest=weak, broadcast_bytes=broadcast_bytes)
    rows = sorted(map(tuple, out.select("id", "keep_id", "group_size", "kept").collect()), key=str)
    assert rows == sorted((r[:4] for r in expected([(r[0], r[1]) for r in odd_rows])), key=str)


def test_small_shards_and_many_hot_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", 8)
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 4)
    draw = random.Random(5)
    rows = [(i, " " * draw.randrange(3) + ("same" if i % 3 == 0 else f"text {draw.randrange(60)}")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(exact_dedup.verdicts(docs)) == expected(rows)


def test_batches_and_deletion(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    live = lambda index: {
        (r["digest"].hex()[:8], r["best"]["id"], r["copies"]) for r in index.entries.collect()
    }
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()[:8]
    one = exact_dedup.insert(None, exact_dedup.digests(frame([(1, "a b"), (2, "ab"), (3, "c")])))
    assert live(one) == {(sha("ab"), 1, 2), (sha("c"), 3, 1)}
    two = exact_dedup.insert(one, exact_dedup.digests(frame([(4, "a  b"), (5, "d"), (0, "c")])))
    assert live(two) == {(sha("ab"), 4, 3), (sha("c"), 0, 2), (sha("d"), 5, 1)}
    gone = exact_dedup.delete(two, exact_dedup.digests(frame([(9, "ab"), (9, "never seen")])))
    assert live(gone) == {(sha("c"), 0, 2), (sha("d"), 5, 1)}
    back = exact_dedup.insert(gone, exact_dedup.digests(frame([(7, "ab")])))
    assert live(back) == {(sha("ab"), 7, 1), (sha("c"), 0, 2), (sha("d"), 5, 1)}
    slots = sum(len(r["slots"]) // 2 - r["slots"].count(b"\0\0") for r in back.filters.collect())
    assert slots <= 3 * 2 and back.filters.count() == back.shards


def test_one_of_each_text_stays(odd_docs, odd_rows, same):
    kept = exact_dedup.without_copies(odd_docs)
    assert kept.schema == odd_docs.schema
    wanted = sorted((r[0] for r in expected([(r[0], r[1]) for r in odd_rows]) if r[3]), key=str)
    assert sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str) == wanted
    same(exact_dedup.without_copies(kept), kept)


def test_empty_table(no_docs):
    assert exact_dedup.verdicts(no_docs).count() == 0
    assert exact_dedup.without_copies(no_docs).count() == 0


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, "xy\t")], "doc_id string, text string")
    out = {r["id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.verdicts(docs).collect()}
    assert out == {"a": ("a", 3, True), "b": ("a", 3, False), None: ("a", 3, False)}
