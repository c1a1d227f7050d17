"""P-values against full enumeration and published critical values."""

import math
from itertools import combinations

import pytest

from tidemark.operators import drift, laws


def enumerated(d, m, n):
    """The share of all ways to place m of m + n ranks whose distance is d or more."""
    hits = total = 0
    for places in combinations(range(m + n), m):
        a, at, worst = set(places), 0, 0
        for s in range(m + n):
            at += s in a
            worst = max(worst, abs(at * n - (s + 1 - at) * m))
        total += 1
        hits += worst >= round(d * m * n)
    return hits / total


@pytest.mark.parametrize(("m", "n"), [(1, 1), (3, 3), (4, 6), (5, 7), (6, 6), (2, 9), (8, 7)])
def test_exact_law_by_enumeration(m, n):
    for step in range(0, m * n + 1):
        d = step / (m * n)
        if round(d * m * n) % math.gcd(m, n) == 0:
            assert laws.exact_two_sample(d, m, n) == pytest.approx(enumerated(d, m, n), abs=1e-12)


# Critical distances of one sample at 5 and 1 percent, from the published tables (their values for
# larger shares double a one-sided law and are not exact).
CRITICAL = {
    10: (0.40925, 0.48893),
    20: (0.29408, 0.35241),
    100: (0.13403, 0.16081),
}


@pytest.mark.parametrize("n", CRITICAL)
def test_finite_law_at_published_values(n):
    for d, p in zip(CRITICAL[n], (0.05, 0.01)):
        assert laws.one_sample(d, n) == pytest.approx(p, abs=6e-5)


def test_finite_law_at_the_value_published_with_the_matrix_method():
    assert laws.matrix_law(0.274, 10) == pytest.approx(0.6284796154565, abs=1e-12)


@pytest.mark.parametrize("n", [500, 3000, 20_000])
def test_matrix_and_series_agree(n):
    for z in (0.4, 0.6, 0.8, 1.0, 1.3, 1.6):
        d = z / math.sqrt(n)
        assert laws.series_law(d, n) == pytest.approx(laws.matrix_law(d, n), abs=5e-7 if n >= 3000 else 1e-5)


def test_exact_law_nears_the_finite_one():
    assert laws.exact_two_sample(0.02, 9000, 10_000) == pytest.approx(laws.one_sample(0.02, round(9000 / 1.9)), abs=0.01)


def test_limits():
    assert laws.two_sample(0.0, 50, 60) == 1.0
    assert laws.two_sample(1.0, 30, 30) == pytest.approx(2 / math.comb(60, 30), abs=1e-12)
    assert laws.two_sample(0.9, 100_000, 100_000) < 1e-100
    assert math.isnan(laws.two_sample(0.1, 0, 5))


def test_report_has_the_laws_of_its_samples(spark):
    rows = [("a", float(i), i % 3 == 0) for i in range(150)] + [("b", float(i), i >= 60) for i in range(120)]
    out = drift.ks_drift(spark.createDataFrame(rows, "feature string, value double, is_live boolean"), ["feature"], exact=True)
    got = {r["feature"]: r for r in out.collect()}
    assert got["a"]["p_value"] == pytest.approx(laws.exact_two_sample(1 / 100 if got["a"]["ks_stat"] == 0.01 else got["a"]["ks_stat"], 100, 50), abs=1e-6)
    assert got["b"]["ks_stat"] == 1.0 and got["b"]["p_value"] == 0.0 and got["b"]["drifted"]
