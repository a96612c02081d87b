"""Tests of counts: known answers and brute force."""

from __future__ import annotations

import math
import subprocess
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from roundscope.functions import stats, tails
from roundscope.operators import contingency as ct

# Hits, trials, rate and interval in percent, exact p-value.
RATES = [
    (283, 489, 57.87, 53.45, 62.17, 0.00057),
    (299, 672, 44.49, 40.78, 48.27, 0.00483),
    (85, 153, 55.56, 47.64, 63.20, 0.19567),
    (276, 515, 53.59, 49.27, 57.86, 0.11257),
    (471, 893, 52.74, 49.46, 56.00, 0.10817),
    (375, 720, 52.08, 48.43, 55.71, 0.27979),
    (327, 682, 47.95, 44.22, 51.70, 0.30119),
    (27, 54, 50.00, 37.11, 62.89, 1.0),
    (18, 44, 40.91, 27.69, 55.59, 0.29122),
]


def test_published_rates(spark):
    df = spark.createDataFrame([(k, n) for k, n, *_ in RATES], "k long, n long")
    out = df.withColumns(stats.wilson("k", "n")).withColumn("p", tails.p_binomial("k", "n")).collect()
    found = {(r.k, r.n): r for r in out}
    for k, n, rate, lo, hi, p in RATES:
        r = found[k, n]
        assert [round(100 * x, 2) for x in (r.rate, r.ci_lo, r.ci_hi)] == [rate, lo, hi]
        assert round(r.p, 5) == p


def test_published_tables(spark):
    df = spark.createDataFrame([(1, 905, 698, 1745, 455), (2, 1409, 572, 773, 1553)], "i long, a long, b long, c long, d long")
    one, two = ct.with_tests(df, one_sided=True).orderBy("i").collect()
    assert [round(x, 3) for x in (one.odds_ratio, one.or_lo, one.or_hi)] == [0.338, 0.293, 0.390]
    assert one.p_chi2 == pytest.approx(1.3774e-51, rel=1e-4)
    assert one.p_fisher == pytest.approx(1.5503e-51, rel=1e-4)
    assert tails.fisher_exact(905, 698, 1745, 455, "greater") == pytest.approx(1.0)
    assert [round(x, 2) for x in (two.odds_ratio, two.or_lo, two.or_hi)] == [4.95, 4.35, 5.64]
    assert two.chi2 == pytest.approx(613.047, abs=1e-3)
    assert two.p_chi2 == pytest.approx(2.432e-135, rel=1e-3)
    assert two.p_fisher == pytest.approx(4.2547e-139, rel=1e-4)


def _fisher(a, b, c, d, greater):
    r, o, col = a + b, c + d, a + c
    p = {k: math.comb(r, k) * math.comb(o, col - k) for k in range(max(0, col - o), min(r, col) + 1)}
    keep = (lambda k: k >= a) if greater else (lambda k: p[k] <= p[a] * (1 + 1e-7))
    return sum(v for k, v in p.items() if keep(k)) / math.comb(r + o, col)


@settings(max_examples=300, deadline=None)
@given(st.tuples(*[st.integers(0, 40)] * 4), st.booleans())
def test_fisher_by_enumeration(cells, greater):
    found = tails.fisher_exact(*cells, "greater" if greater else "two-sided")
    assert found == pytest.approx(_fisher(*cells, greater), rel=1e-9, abs=1e-12)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 80), st.data(), st.sampled_from([0.5, 0.3, 0.9]))
def test_binomial_by_enumeration(n, data, p):
    k = data.draw(st.integers(0, n))
    points = [math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(n + 1)]
    expected = min(1.0, sum(x for x in points if x <= points[k] * (1 + 1e-7)))
    assert tails.binomial_test(k, n, p) == pytest.approx(expected, rel=1e-9)


def test_functions_travel_without_the_package(tmp_path):
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(lambda: (tails.fisher_exact(3, 1, 1, 3), tails.binomial_test(1, 9))))
    code = "import pickle; print(*pickle.load(open('f.pkl', 'rb'))())"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    assert [float(x) for x in found.split()] == [tails.fisher_exact(3, 1, 1, 3), tails.binomial_test(1, 9)]


def test_exact_tests_take_huge_counts():
    assert tails.binomial_test(5 * 10**10 + 300_000, 10**11) == pytest.approx(0.0577798, rel=1e-4)
    assert 0.0 <= tails.fisher_exact(10**10, 10**10 + 300_000, 10**10, 10**10) <= 1.0


def test_zero_cells_and_margins(spark):
    df = spark.createDataFrame([(1, 0, 5, 7, 3), (2, 0, 0, 4, 6), (3, 0, 0, 0, 0)], "i long, a long, b long, c long, d long")
    zero, margin, empty = ct.with_tests(df).orderBy("i").collect()
    a, b, c, d = 0.5, 5.5, 7.5, 3.5
    assert zero.odds_ratio == pytest.approx(a * d / (b * c))
    assert zero.or_lo == pytest.approx(math.exp(math.log(zero.odds_ratio) - 1.96 * math.sqrt(1 / a + 1 / b + 1 / c + 1 / d)))
    assert margin.chi2 is None and margin.p_chi2 is None and margin.p_fisher == 1.0
    assert empty.n == 0 and empty.p_chi2 is None
    floored = spark.createDataFrame([(0, 5, 7, 3)], "a long, b long, c long, d long").select(
        stats.chi2_yates("a", "b", "c", "d", floor=0.5).alias("x"), stats.chi2_yates(F.lit(0.5), "b", "c", "d").alias("y")
    ).first()
    assert floored.x == pytest.approx(floored.y)


def test_floor1_orientation(spark):
    r = spark.createDataFrame([(10, 0, 4, 6)], "a long, b long, c long, d long").select(
        *[c.alias(n) for n, c in stats.odds_ratio("a", "b", "c", "d", zero="floor1").items()]
    ).first()
    assert r.odds_ratio == 60.0
    assert r.or_lo == pytest.approx(60 * math.exp(-1.96 * math.sqrt(1 / 10 + 1 + 1 / 4 + 1 / 6)))


def test_wilson_holds_the_rate_and_ignores_empty(spark):
    df = spark.createDataFrame([(0, 0), (0, 5), (5, 5), (3, 7)], "k long, n long").withColumns(stats.wilson("k", "n"))
    for r in df.collect():
        if r.n == 0:
            assert (r.rate, r.ci_lo, r.ci_hi) == (None, None, None)
        else:
            assert r.ci_lo - 1e-12 <= r.rate <= r.ci_hi + 1e-12


def test_holm(spark):
    p = [0.01, 0.04, 0.03, None, 0.5]
    df = spark.createDataFrame(list(enumerate(p)), "i int, p double")
    found = {r.i: r.p_holm for r in ct.holm(df, "p").collect()}
    assert found[0] == pytest.approx(0.04)
    assert found[2] == pytest.approx(0.09)
    assert found[1] == pytest.approx(0.09)  # 0.08 raised by the step before
    assert found[4] == pytest.approx(0.5)
    assert found[3] is None


def test_stars(spark):
    df = spark.createDataFrame([(1e-4,), (5e-3,), (0.03,), (0.2,), (None,)], "p double")
    assert [r.s for r in df.select(stats.stars("p").alias("s")).collect()] == ["***", "**", "*", "", ""]


def test_cells_add_up_and_leave_out_missing(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (None, 1), (0, None), (0, 0), (0, 0)], "x int, y int")
    r = ct.cells(df, F.col("x") == 1, F.col("y") == 1).first()
    assert (r.a, r.b, r.c, r.d) == (1, 1, 1, 2)
    kept = ct.cells(df, ct.present(F.col("x") == 1), F.col("y") == 1).first()
    assert (kept.a, kept.b, kept.c, kept.d) == (2, 1, 1, 2)


def test_margins_and_percentages(spark, rows):
    df = spark.createDataFrame([("p", "x"), ("p", "y"), ("p", "y"), ("q", "x"), (None, "x")], "r string, c string")
    table = rows(ct.with_margins(df, "r", "c"), "r", "c", "n")
    assert (None, None, 4) in table and ("p", None, 3) in table and (None, "x", 2) in table and ("p", "y", 2) in table
    assert rows(ct.row_pct(df, "r", "c"), "r", "c", "pct") == [("p", "x", 33.33), ("p", "y", 66.67), ("q", "x", 100.0)]
    assert rows(ct.value_counts(df, "c", ["x", "y", "z"]), "c", "n") == [("x", 3), ("y", 2), ("z", 0)]
