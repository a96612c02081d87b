"""Order statistics against brute force, whole and cut into ranges."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roundscope.operators import distribution as dist
from roundscope.operators.spearman import spearman_matrix
from roundscope.plans import analysis as an


def _sample(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        s = "big" if rng.random() < 0.6 else rng.choice(["p", "q"])
        rows.append((s, rng.random() < 0.4, rng.choice([rng.randint(0, 12) / 4, rng.gauss(0, 3)])))
    return rows + [("one", True, 1.0), ("one", True, 2.0), ("big", None, 3.0), ("big", True, None), ("big", False, float("nan"))]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(_sample(), "s string, f boolean, x double")


def _u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


@pytest.mark.parametrize("ranged", [False, True])
def test_mann_whitney_and_quantiles(spark, sample, ranged, monkeypatch):
    if ranged:
        monkeypatch.setattr(dist, "ROWS_PER_RANGE", 20)
        monkeypatch.setattr(dist.prefix_counts, "__defaults__", (20,))
    table = dist.two_samples(sample, "x", F.col("f"), ["s"])
    medians = [dist.quantile("x", "n1", 0.5).alias("m1"), dist.quantile("x", "n0", 0.25).alias("q0")]
    found = {r.s: r for r in dist.mann_whitney(table, "x", ["s"], medians).collect()}
    assert set(found) == {"big", "p", "q"}  # "one" has no second sample
    for s, r in found.items():
        a = [x for k, f, x in _sample() if k == s and f is True and x is not None and x == x]
        b = [x for k, f, x in _sample() if k == s and f is False and x is not None and x == x]
        assert (r.n1, r.n0) == (len(a), len(b))
        assert r.U == pytest.approx(_u(a, b))
        assert 0 <= r.cles <= 1 and r.rbc == pytest.approx(2 * r.cles - 1)
        assert r.U + _u(b, a) == pytest.approx(len(a) * len(b))
        assert r.m1 == pytest.approx(np.median(a)) and r.q0 == pytest.approx(np.percentile(b, 25))
        n, ties = len(a) + len(b), pd.Series(a + b).value_counts()
        sd = math.sqrt(len(a) * len(b) / 12 * (n + 1 - (ties**3 - ties).sum() / (n * (n - 1))))
        z = (max(r.U, len(a) * len(b) - r.U) - len(a) * len(b) / 2 - 0.5) / sd
        assert r.p_two == pytest.approx(min(1, math.erfc(z / math.sqrt(2))))
        up = (r.U - len(a) * len(b) / 2 - 0.5) / sd
        assert r.p_greater == pytest.approx(0.5 * math.erfc(up / math.sqrt(2)))


def test_all_values_tied_are_no_evidence(spark):
    df = spark.createDataFrame([(True, 1.0), (False, 1.0)], "f boolean, x double")
    r = dist.mann_whitney(dist.two_samples(df, "x", F.col("f")), "x").first()
    assert (r.U, r.p_two, r.p_greater) == (0.5, 1.0, 1.0)


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([(True, -0.0), (False, 0.0)], "f boolean, x double")
    assert dist.mann_whitney(dist.two_samples(df, "x", F.col("f")), "x").first().U == 0.5


def test_summary(spark, sample):
    table = dist.two_samples(sample, "x", F.col("f"), ["s"])
    found = {(r.s, r["sample"]): r for r in dist.summary(table, "x", {"yes": "n1", "no": "n0"}, ["s"]).collect()}
    for (s, label), r in found.items():
        x = [v for k, f, v in _sample() if k == s and f is (label == "yes") and v is not None and v == v]
        assert (r.n or 0) == len(x)
        if x:
            assert r["mean"] == pytest.approx(np.mean(x))
            assert [r.q1, r.median, r.q3] == pytest.approx(list(np.percentile(x, [25, 50, 75])))
        assert r["std"] is None if len(x) < 2 else r["std"] == pytest.approx(np.std(x, ddof=1))
    whole = dist.summary(dist.two_samples(sample, "x", F.col("f")), "x", {"yes": "n1"}).first()
    assert whole.n == sum(1 for _, f, v in _sample() if f and v is not None and v == v)


def test_histogram(spark, rows):
    values = [0.0, 0.1, 0.5, 1.0, 1.9999, 2.0, None, float("nan")]
    h = rows(dist.histogram(spark.createDataFrame([(v,) for v in values], "x double"), "x", 4), "bin", "bin_lo", "n")
    assert h == [(1, 0.0, 2), (2, 0.5, 1), (3, 1.0, 1), (4, 1.5, 2)]
    flat = rows(dist.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 2), "bin", "bin_lo", "n")
    assert flat == [(1, 2.5, 0), (2, 3.0, 2)]


def _features(n=120):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 6, n).astype(float)
    b = a + rng.normal(0, 2, n)
    c = np.where(rng.random(n) < 0.5, np.nan, rng.normal(0, 1, n) + a)
    e = np.where(np.isnan(c), np.nan, rng.integers(0, 3, n))
    g = np.where(rng.random(n) < 0.3, np.nan, -b)
    return pd.DataFrame({"a": a, "b": b, "c": c, "e": e, "g": g, "const": 1.0})


@pytest.mark.parametrize("per_range", [1_000_000, 15])
def test_spearman(spark, per_range):
    pdf = _features()
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    found = {(r.f1, r.f2): r for r in spearman_matrix(df, list(pdf.columns), per_range).collect()}
    expected = pdf.corr(method="spearman")
    assert len(found) == 36
    for (f, g), r in found.items():
        assert r.n == (pdf[f].notna() & pdf[g].notna()).sum()
        if math.isnan(expected.loc[f, g]):
            assert r.rho is None
        else:
            assert r.rho == pytest.approx(expected.loc[f, g], abs=1e-12)
        assert r.rho == found[g, f].rho
    assert found["a", "a"].rho == 1.0


def test_infinite_values_count_as_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, float("inf")), (4.0, float("nan"))], "x double, y double")
    found = {(r.f1, r.f2): (r.rho, r.n) for r in spearman_matrix(df, ["x", "y"]).collect()}
    assert found["x", "y"] == (pytest.approx(-1.0), 2)


def test_durations(spark):
    rounds = spark.createDataFrame(
        [("m", "d", 1, 0, 64), ("m", "d", 2, 0, 128), ("m", "d", 3, 0, 192), ("m", "e", 1, 0, None), ("m", "x", 1, 0, 5)],
        "match_id string, demo_file string, round int, start long, end long",
    )
    header = spark.createDataFrame([("m", "d", 64.0), ("m", "e", 64.0), ("m", "x", None)], "match_id string, demo_file string, tickrate double")
    bomb = spark.createDataFrame(
        [("m", "d", 2, "Planted"), ("m", "d", 2, "planted"), ("m", "d", 3, "defused")],
        "match_id string, demo_file string, round int, event string",
    )
    out = an.round_durations(rounds, header, bomb)
    assert sorted((r["round"], r.planted, r.dur_s) for r in out.collect()) == [(1, False, 1.0), (2, True, 2.0), (3, False, 3.0)]
    assert an.duration_by(out.withColumn("map_name", F.lit("m")).filter("round <> 2")).count() == 0
