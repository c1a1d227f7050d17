import math

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark.llm import mixing


def corpus(spark, sizes):
    """``sizes``: documents of ten words each, by source."""
    rows = [(s, i) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "source string, i int").withColumn("doc_id", F.monotonically_increasing_id())
    return docs.withColumn("text", F.lit("one two three four five six seven eight nine ten")).drop("i")


def weights(spark, sizes, **targets):
    rows = mixing.measured(corpus(spark, sizes))
    return {r["source"]: r for r in mixing.plan(rows, **targets).collect()}


def entropy(ps):
    return -sum(p * math.log(p) for p in ps if p)


def test_entropy_is_met_from_below(spark):
    found = weights(spark, {"a": 500, "b": 40, "c": 20, "d": 10}, target_entropy=0.9, max_repetition=100.0)
    reached = entropy([r["weight"] for r in found.values()]) / math.log(4)
    assert reached == pytest.approx(0.9, abs=1e-6)
    assert sum(r["weight"] for r in found.values()) == pytest.approx(1, abs=1e-8)


def test_repetition_limit_wins(spark):
    found = weights(spark, {"a": 500, "b": 40, "c": 20, "d": 10}, target_entropy=1.0, max_repetition=3.0)
    repeats = {s: r["quota"] / r["tokens"] for s, r in found.items()}
    assert max(repeats.values()) == repeats["d"] <= 3.0 + 1e-6
    assert repeats["d"] > 2.99


def test_natural_shares_that_suffice_stay(spark):
    found = weights(spark, {"a": 30, "b": 30, "c": 29}, target_entropy=0.9)
    assert {s: r["weight"] for s, r in found.items()} == pytest.approx({"a": 30 / 89, "b": 30 / 89, "c": 29 / 89})


def test_budgets_are_kept(spark):
    sizes = {"a": 500, "b": 40, "c": 20, "d": 10}
    docs = corpus(spark, sizes)
    out = mixing.mixed(docs, target_entropy=0.9)
    assert out.columns == docs.columns
    found = weights(spark, sizes, target_entropy=0.9)
    taken = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    for s, r in found.items():
        assert 0 <= r["quota"] - 10 * taken[s] < 10
        each = [x["n"] for x in out.filter(F.col("source") == s).groupBy("doc_id").agg(F.count("*").alias("n")).collect()]
        assert set(each) <= {r["epochs"], r["epochs"] + 1}


def test_small_weights_keep_their_digits(spark):
    """A source far below a billionth of the mixture still gets its words."""
    values = [0.123456789123, 1.0, 0.1, 3.00000000049e-13, 9.9999999999e-11, 4.2e-16]
    found = spark.createDataFrame([(v,) for v in values], "w double").select("w", mixing.significant(F.col("w")).alias("s")).collect()
    assert all(r["s"] == pytest.approx(float(f"{r['w']:.8e}"), rel=1e-15) for r in found)


def test_blocks_follow_the_largest_source(spark):
    rows = spark.range(1000).selectExpr("if(id < 900, 'a', 'b') as source")
    assert [mixing.block_digits(rows, n) for n in (1 << 16, 1)] == [3, 3]
    assert mixing.block_digits(rows.limit(0)) == 3
    many = spark.range(5000).selectExpr("'a' as source")
    assert mixing.block_digits(many, 1) == 4


def test_finer_blocks_change_no_quota(spark):
    docs = corpus(spark, {"a": 500, "b": 40, "c": 20, "d": 10})
    rows = mixing.measured(docs)
    taken = [sorted(tuple(r) for r in mixing.passes_of(rows, mixing.plan(rows, digits=n), mixing.SEED).select("id", "_epoch").collect()) for n in (1, 3, 5)]
    assert taken[0] == taken[1] == taken[2]


def test_skewed_sources_equal_sql(spark, tmp_path, folder):
    """With one source far above the others the exponent has to be searched for."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    hot = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.lit("hot")).otherwise(F.col("source")))
    hot = hot.withColumn("source", F.when(F.col("source") != "src4", F.col("source")))
    hot.repartition(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = connect(folder)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(mixing.op3_mixing(spark, str(tmp_path)), con, mixing.MIXING_SQL) is None
    rows = mixing.measured(hot)
    assert 0 < mixing.plan(rows).agg(F.max("epochs")).first()[0]


def test_null_and_repeated_ids_keep_their_budget(spark):
    """Downsampled sources whose rows have no id, share one, or do so in part, with equal and different texts."""
    ids = {"none": "cast(null as bigint)", "one": "7L", "part": "if(i % 3 = 0, null, i)", "few": "i"}
    docs = None
    for source, doc_id in ids.items():
        text = "'one two three four'" if source == "none" else "concat('one two three ', i % 50)"
        rows = spark.range(0, 100 if source == "few" else 1500, 1, 3).withColumnRenamed("id", "i")
        rows = rows.selectExpr(f"{doc_id} as doc_id", f"{text} as text", f"'{source}' as source", "i")
        docs = rows if docs is None else docs.union(rows)
    found = {r["source"]: r for r in mixing.plan(mixing.measured(docs)).collect()}
    assert [found[s]["epochs"] for s in ("none", "one", "part")] == [0, 0, 0]
    taken = mixing.mixed(docs).groupBy("source", "i").agg(F.count("*").alias("n")).collect()
    for s, r in found.items():
        each = [x["n"] for x in taken if x["source"] == s]
        assert 0 <= r["quota"] - 4 * sum(each) < 4
        assert set(each) <= {r["epochs"], r["epochs"] + 1}


def test_permutation_of_copies_is_spread_over_blocks(spark, tmp_path):
    docs = spark.range(4000).selectExpr("cast(null as bigint) as doc_id", "'a b' as text", "'s' as source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = mixing.op3_mixing(spark, str(tmp_path))
    assert out.count() == 4000
    assert out.groupBy("block").count().agg(F.max("count")).first()[0] < 20


def test_odd_rows(odd_docs, no_docs):
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in odd_docs.collect()}
    assert mixing.mixed(no_docs).count() == 0
    assert mixing.mixed(odd_docs.filter("doc_id in (3, 4, 5)")).count() == 0


def test_native(spark, folder):
    """No Python in the plan."""
    plan = mixing.op3_mixing(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
