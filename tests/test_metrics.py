"""Statistics against brute force in numpy, with ties, repeats, NaN, groups and many small pieces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, metrics, running


def frame(spark, score, label, **extra):
    cols = {"score": score, "label": label, **extra}
    rows = list(zip(*[np.asarray(c).tolist() for c in cols.values()]))
    return spark.createDataFrame(rows, list(cols)).withColumn("label", F.col("label").cast("int"))


def data(seed, n=400, digits=2):
    rng = np.random.default_rng(seed)
    score = rng.random(n).round(digits)
    return score, (rng.random(n) < score).astype(int)


def brute_ap(score, label):
    total = 0.0
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        total += label[score == t].sum() / label.sum() * label[hit].sum() / hit.sum()
    return total


def brute_auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("digits", [1, 6])
def test_ap_and_auc(spark, seed, digits):
    score, label = data(seed, digits=digits)
    row = metrics.ranking_metrics(frame(spark, score, label)).first()
    assert row["average_precision"] == pytest.approx(brute_ap(score, label), abs=1e-12)
    assert row["roc_auc"] == pytest.approx(brute_auc(score, label), abs=1e-12)


def test_grouped_metrics(spark):
    parts = [data(s) for s in (3, 4, 5)]
    df = frame(
        spark,
        np.concatenate([p[0] for p in parts]),
        np.concatenate([p[1] for p in parts]),
        g=np.repeat(["a", "b", "c"], 400),
    )
    got = {r["g"]: r for r in metrics.ranking_metrics(df, by=["g"]).collect()}
    for name, (score, label) in zip("abc", parts):
        assert got[name]["average_precision"] == pytest.approx(brute_ap(score, label), abs=1e-12)
        assert got[name]["roc_auc"] == pytest.approx(brute_auc(score, label), abs=1e-12)


def test_one_class_only(spark):
    row = metrics.ranking_metrics(frame(spark, [0.1, 0.2], [0, 0])).first()
    assert (row["average_precision"], row["roc_auc"]) == (0.0, None)


@pytest.mark.parametrize("pieces", [2, 3, 8, 40])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_any_number_of_pieces(spark, pieces, descending):
    rng = np.random.default_rng(pieces)
    values = np.unique(rng.exponential(10, 300).round(2))
    n = rng.integers(1, 50, len(values))
    df = spark.createDataFrame(list(zip(values.tolist(), n.tolist())), "v double, n bigint")
    got = running.running_totals(df, "v", ["n"], descending=descending, pieces=pieces).collect()
    order = np.argsort(-values if descending else values)
    want = dict(zip(values[order].tolist(), np.cumsum(n[order]).tolist()))
    assert {r["v"]: r["cum_n"] for r in got} == want
    assert {r["all_n"] for r in got} == {int(n.sum())}


@pytest.mark.parametrize("n", [1, 2, 11, 1000, 30_000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = rng.exponential(5, n).round(3)
    probs = [0.0, 0.1, 0.25, 0.3 + 1e-17, 0.5, 0.75, 0.9, 0.999, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    df = df.unionByName(spark.createDataFrame([(float("nan"),), (None,)], "v double"))
    got = running.exact_quantiles(df, "v", probs).first()["quantiles"]
    assert got == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-9)


def test_quantiles_of_one_repeated_value_and_of_nothing(spark):
    same = spark.range(5000).select(F.lit(2.5).alias("v"))
    assert running.exact_quantiles(same, "v", [0.1, 0.5, 0.9]).first()["quantiles"] == [2.5] * 3
    none = running.exact_quantiles(same.filter("v > 9"), "v", [0.5]).first()["quantiles"]
    assert none == [None]


def test_quantiles_where_one_value_holds_a_third(spark):
    rng = np.random.default_rng(9)
    values = np.concatenate([np.full(5000, 1.0), rng.random(10_000) * 3])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probs = [i / 20 for i in range(1, 20)]
    got = running.exact_quantiles(df, "v", probs).first()["quantiles"]
    assert got == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-12)


def test_cost_curve_counts_by_definition(spark):
    score, label = data(11)
    score[:5] = metrics.COST_GRID[40]
    curve = metrics.cost_curve(frame(spark, score, label)).orderBy("i").collect()
    assert len(curve) == len(metrics.COST_GRID)
    for row, t in zip(curve, metrics.COST_GRID):
        hit = score >= t
        assert (row["fn"], row["fp"]) == ((~hit & (label == 1)).sum(), (hit & (label == 0)).sum())


def test_first_of_equal_costs_wins(spark):
    df = frame(spark, [0.2, 0.9], [0, 1])
    best = metrics.cheapest(metrics.cost_curve(df), {"x": (1, 1)}).first()
    want = next(t for t in metrics.COST_GRID if t > 0.2)
    assert (best["threshold"], best["cost"]) == (want, 0.0)


def test_confusion_at_a_threshold_is_inclusive(spark):
    row = metrics.confusion(frame(spark, [0.5, 0.49, 0.5], [1, 1, 0]), [0.5]).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 1, 0)


def test_zero_denominators(spark):
    df = frame(spark, [0.1, 0.2], [0, 0], pred=[0, 0])
    row = metrics.precision_recall_f1(df).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def brute_ks(a, b):
    at = np.concatenate([a, b])
    return max(abs((a <= v).mean() - (b <= v).mean()) for v in at)


def long(spark, a, b, feature="f"):
    rows = [(feature, float(v), False) for v in a] + [(feature, float(v), True) for v in b]
    return spark.createDataFrame(rows, "feature string, value double, is_live boolean")


def test_ks(spark):
    rng = np.random.default_rng(5)
    a, b, c = rng.normal(0, 1, 300).round(1), rng.normal(0.8, 1, 200).round(1), rng.normal(0, 1, 150)
    both = long(spark, a, b, "moved").unionByName(long(spark, a, c, "same"))
    got = {r["feature"]: r for r in drift.ks_drift(both, ["feature"]).collect()}
    assert got["moved"]["ks_stat"] == round(brute_ks(a, b), 4) and got["moved"]["drifted"]
    assert got["same"]["ks_stat"] == round(brute_ks(a, c), 4) and not got["same"]["drifted"]


def test_ks_of_equal_samples(spark):
    a = np.arange(100)
    row = drift.ks_drift(long(spark, a, a), ["feature"]).first()
    assert (row["ks_stat"], row["p_value"], row["drifted"]) == (0.0, 1.0, False)


def brute_psi(expected, actual):
    edges = np.quantile(expected, np.linspace(0, 1, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    e = np.clip(np.histogram(expected, edges)[0] / len(expected), 1e-6, None)
    a = np.clip(np.histogram(actual, edges)[0] / len(actual), 1e-6, None)
    return float(((a - e) * np.log(a / e)).sum())


@pytest.mark.parametrize(("shift", "digits"), [(0.0, 6), (0.7, 6), (0.7, 0), (5.0, 1)])
def test_psi_with_repeated_edges_and_empty_bins(spark, shift, digits):
    rng = np.random.default_rng(8)
    e, a = rng.normal(0, 1, 500).round(digits), rng.normal(shift, 1, 400).round(digits)
    assert drift.psi(long(spark, e, a)).first()["psi"] == pytest.approx(brute_psi(e, a), abs=6e-5)


def test_youden_takes_the_highest_of_equals(spark):
    df = frame(spark, [0.9, 0.8, 0.7, 0.6], [1, 0, 1, 0])
    row = metrics.youden_threshold(df).first()
    assert (row["threshold"], row["j"]) == (0.9, 0.5)


def test_reliability_bins_are_left_open(spark):
    rng = np.random.default_rng(2)
    score = rng.random(500).round(1)
    label = (rng.random(500) < score).astype(int)
    edges = np.quantile(score, [i * 0.1 for i in range(1, 10)])
    want = np.searchsorted(edges, score)
    got = {r["bin"]: r for r in metrics.reliability_curve(frame(spark, score, label)).collect()}
    assert {b: r["n_rows"] for b, r in got.items()} == {int(b): int((want == b).sum()) for b in set(want)}
    for b, r in got.items():
        assert r["observed_rate"] == pytest.approx(label[want == b].mean())


def test_missing_scores_reach_no_threshold(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 0), (0.5, 1)], "score double, label int")
    curve = metrics.cost_curve(df).orderBy("i").collect()
    assert (curve[0]["fn"], curve[0]["fp"]) == (1, 0)
    assert (curve[-1]["fn"], curve[-1]["fp"]) == (2, 0)


def test_two_samples_take_the_shared_features(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    b = spark.createDataFrame([(3.0, 4.0)], "x double, z double")
    got = {tuple(r) for r in drift.two_samples(a, b, ["x", "y", "z"]).select("feature", "value", "is_live").collect()}
    assert got == {("x", 1.0, False), ("x", 3.0, True)}
