import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import common, simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance):
    """For each distinct fingerprint the set of those connected to it."""
    values = sorted(set(prints))
    group = {v: {v} for v in values}
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance and group[a] is not group[b]:
                group[a] |= group[b]
                for v in group[a]:
                    group[v] = group[a]
    return group


def expected(rows):
    prints = [plain_fingerprint(r["text"]) for r in rows]
    group = plain_groups(prints, 2)
    out = []
    for r, p in zip(rows, prints):
        ids = [q["doc_id"] for q, f in zip(rows, prints) if f in group[p] and q["doc_id"] is not None]
        out.append((r["doc_id"], f"{p:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def got(df):
    rows = df.select("id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_query_equals_brute_force(spark, folder, documents):
    rows = simhash.op2_simhash_near_dedup(spark, folder).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in rows), key=str) == expected(documents.collect())


def test_odd_rows(odd_docs):
    assert got(simhash.near_duplicates(odd_docs)) == expected(odd_docs.collect())


def test_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_of_each_group(no_docs).count() == 0


@pytest.mark.parametrize("distance", [0, 2, 4])
def test_links_join_all_within_the_distance(spark, distance):
    draw = random.Random(distance)
    values = {draw.getrandbits(64) for _ in range(20)}
    for v in list(values):
        for _ in range(6):
            for _ in range(draw.randrange(4)):
                v ^= 1 << draw.randrange(64)
            values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    pairs = simhash.links(spark.createDataFrame(signed, "fp long"), distance)
    roots = {r["node"] % 2**64: r["root"] for r in common.components(pairs).collect()}
    for v, members in plain_groups(values, distance).items():
        assert len(members) == 1 or {roots[m] for m in members} == {roots[v]}
    assert len(set(roots.values())) == len({frozenset(g) for g in plain_groups(values, distance).values() if len(g) > 1})


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    roots = common.components(spark.createDataFrame(chain + star, "a long, b long")).collect()
    assert len(roots) == 301 + 300
    assert len({r["root"] for r in roots if r["node"] < 1000}) == 1
    assert len({r["root"] for r in roots}) == 2


def test_one_of_each_group_keeps_rows_whole(odd_docs):
    kept = simhash.one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [tuple(r) for r in kept.collect()]
    everything = {tuple(r) for r in odd_docs.collect()}
    assert set(rows) <= everything and len(rows) == len(set(rows))
    groups = simhash.near_duplicates(odd_docs).select("root").distinct().count()
    assert len(rows) == groups
    ids = [r[0] for r in rows]
    assert 0 in ids and 1 not in ids and 8 not in ids
