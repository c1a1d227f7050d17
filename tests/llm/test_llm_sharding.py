from collections import defaultdict

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark.llm import sharding


def shards(docs, limit):
    rows = sharding.sharded(docs, limit).select(F.col("row")["doc_id"].alias("doc_id"), "n_bytes", *sharding.SHARD_COLUMNS)
    return rows.collect()


def checked(rows, limit):
    """Sums agree, shards partition the rows, and only what was too large is split."""
    size, count = defaultdict(int), defaultdict(int)
    for r in rows:
        size[r["shard"]] += r["n_bytes"]
        count[r["shard"]] += 1
    for r in rows:
        assert (size[r["shard"]], count[r["shard"]]) == (r["shard_bytes"], r["shard_rows"])
        assert r["depth"] == len(r["shard"]) and r["fits"] == (r["shard_bytes"] <= limit)
        assert r["fits"] or r["depth"] == 64
    for s in size:
        assert not any(t != s and t.startswith(s) for t in size)
        if s:
            assert sum(n for t, n in size.items() if t.startswith(s[:-1])) > limit
    return size


@pytest.mark.parametrize("limit", [1 << 12, 1 << 14, 1 << 17, 1 << 30])
def test_documents(spark, folder, documents, limit):
    rows = shards(documents, limit)
    assert len(rows) == documents.count()
    assert len(checked(rows, limit)) >= 480_000 // limit


def test_many_rounds(spark):
    """Limits of a few rows need more bits than one round has."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"))
    rows = shards(docs, 10)
    checked(rows, 10)
    assert max(r["depth"] for r in rows) > 2 * sharding.ROUND_BITS


def test_odd_rows(odd_docs, no_docs):
    rows = shards(odd_docs, 500)
    assert len(rows) == odd_docs.count()
    checked(rows, 500)
    assert len({r["shard"] for r in rows if r["doc_id"] == 9}) == 1
    assert not any(r["fits"] for r in rows if r["doc_id"] in (12, 13))
    assert shards(no_docs, 500) == []


def test_one_key_is_split_into_parts(spark, tmp_path):
    """A third of the rows has one id, another third is copies without an id; one row alone is too large."""
    text = "if(id = 1, repeat('y', 5000), if(id % 3 = 2, 'copy', repeat('x', int(id % 40))))"
    docs = spark.range(0, 900, 1, 4).selectExpr("if(id % 3 = 0, 7, if(id % 3 = 2, null, id)) as doc_id", f"{text} as text")
    rows = sharding.sharded(docs, 400).select(F.col("row")["doc_id"].alias("doc_id"), "n_bytes", *sharding.SHARD_COLUMNS)
    parts = defaultdict(list)
    for r in rows.collect():
        parts[r["shard"], r["part"]].append(r["n_bytes"])
        assert (r["part"] > 0) == (r["doc_id"] == 7 or r["doc_id"] is None)
    assert sum(map(len, parts.values())) == 900
    assert all(sum(sizes) <= 400 or len(sizes) == 1 for sizes in parts.values())
    sharding.write_shards(docs, str(tmp_path / "s"), 400)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.select("doc_id", "text").exceptAll(docs).count() == 0 and back.count() == 900
    sizes = back.groupBy("shard_bits").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n"))
    assert sizes.filter("b > 400 and n > 1").count() == 0


def test_parts_equal_sql(spark, folder, tmp_path):
    """Ids that repeat, with equal and different texts, rows without an id, and rows over half the limit."""
    text = "if(id % 5 = 0, 'copy', if(id % 97 = 1, repeat('z', 1500 + int(id)), repeat('xy', int(id % 40))))"
    docs = spark.range(0, 1200, 1, 4).selectExpr("if(id % 3 = 0, 7, if(id % 3 = 2, null, id)) as doc_id", f"{text} as text")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = connect(folder)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    rows = sharding.sharded(spark.read.parquet(str(tmp_path / "documents.parquet")), 2000)
    rows = rows.select(F.col("row")["doc_id"].alias("doc_id"), "n_bytes", *sharding.SHARD_COLUMNS)
    assert rows.agg(F.max("part")).first()[0] > 5
    assert difference(rows, con, sharding.sql(2000)) is None


def test_names_that_are_taken(odd_docs):
    out = sharding.with_shards(odd_docs, 1000)
    assert out.columns == [*odd_docs.columns, "shard_", *sharding.SHARD_COLUMNS[1:]]
    assert {r["shard"] for r in out.select("shard").collect()} == {"s"}


def test_written_shards(spark, documents, tmp_path):
    sharding.write_shards(documents, str(tmp_path / "s"), 1 << 16)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.drop("shard_bits").exceptAll(documents).count() == 0 and back.count() == documents.count()
    sizes = back.groupBy("shard_bits").agg(F.sum(F.octet_length("text")).alias("n"))
    assert sizes.filter(F.col("n") > 1 << 16).count() == 0


def test_native(documents):
    plan = sharding.with_shards(documents, 1 << 14)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
