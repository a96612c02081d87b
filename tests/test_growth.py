"""Steps that must not pass through one task, and what replaced them by value."""

from __future__ import annotations

import glob
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roundscope.operators.spearman import few_valued, spearman_matrix
from roundscope.plans import source_queries
from roundscope.session import shared_folder
from roundscope.sources.warehouse import match_folder, stem


def test_matches_of_a_damaged_build_are_written_by_many_tasks(spark, tmp_path, rows):
    lines = spark.range(3000).select(
        (F.col("id") % 1000).alias("l_orderkey"), (F.col("id") / 1000).cast("int").alias("l_linenumber"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
    )
    lines.repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    place = f"{shared_folder(spark).removeprefix('file:')}/damaged-build-*"
    before = set(glob.glob(place))
    found = source_queries.damaged_build(spark, str(tmp_path))
    assert rows(found, "kind", "name", "n") == [("merged", "first", 1000), ("merged", "last", 1000), ("rejected", "events_shots", 1)]
    (made,) = set(glob.glob(place)) - before
    for match in ("first", "broken", "last"):
        assert len(glob.glob(f"{made}/matches/{match}/events_shots/*.parquet")) == 3


@pytest.mark.parametrize(
    "path, folder, name",
    [
        ("file:/d/events_bomb/m 1/events_shots/part-0.c000.parquet", "m 1", "part-0.c000"),
        ("file:/d/m/events_shots/events_shots/x/.hidden", "m", ".hidden"),
        ("/m.dem/events_shots/a.b/", "m.dem", "a"),
        ("m/events_shots/a//", "m", ""),
    ],
)
def test_folders_and_stems_of_paths(spark, path, folder, name):
    df = spark.createDataFrame([(path,)], "path string")
    old = F.regexp_extract("path", "([^/]+)/events_shots/", 1)
    old_stem = F.regexp_replace(F.regexp_extract("path", r"([^/]+)/?$", 1), r"(?<=.)\.[^.]*$", "")
    got = df.select(match_folder(F.col("path"), F.lit("events_shots")), stem(F.col("path")), old, old_stem).first()
    assert tuple(got) == (folder, name, folder, name)


def test_long_paths_cost_no_pattern(spark):
    plan = spark.range(1).select(match_folder(F.lit("a"), F.lit("t"))).limit(1)
    assert "regexp" not in plan._jdf.queryExecution().analyzed().toString()


def test_few_valued_features_fit_the_limit_together():
    assert few_valued({0: 5, 1: 2, 2: 100, 3: 3}, 10) == [0, 1, 3]
    assert few_valued({0: 5, 1: 2}, 1) == []


@pytest.mark.parametrize("limit", [0, 1, 10, 1_000_000])
def test_spearman_by_broadcast_and_by_shuffle(spark, limit):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 4, 200).astype(float)
    b = np.where(rng.random(200) < 0.3, np.nan, a + rng.normal(0, 1, 200))
    c = np.where(rng.random(200) < 0.2, np.nan, rng.integers(0, 5, 200))
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "none": np.nan, "const": 1.0})
    df = spark.createDataFrame(pdf)
    found = {(r.f1, r.f2): r.rho for r in spearman_matrix(df, list(pdf.columns), broadcast_values=limit).collect()}
    expected = pdf.corr(method="spearman")
    assert len(found) == 25
    for (f, g), rho in found.items():
        if math.isnan(expected.loc[f, g]):
            assert rho is None
        else:
            assert rho == pytest.approx(expected.loc[f, g], abs=1e-12)


def test_rows_of_few_valued_features_are_not_shuffled(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("x"), (F.col("id") % 5).alias("y"))
    plan = spearman_matrix(df, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_row" not in plan
    assert "hashpartitioning(_row" in spearman_matrix(df, ["x", "y"], broadcast_values=0)._jdf.queryExecution().executedPlan().toString()
