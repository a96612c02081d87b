"""Exact order statistics at scale: prefix counts, quantiles, summaries, histograms, rank tests.

Values are collapsed to one row per distinct value first. The collapsed table is kept in the
shared folder and cut into value ranges, so that a running count never passes a whole stratum
through one task however large the stratum is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tails
from ..session import stored
from .columns import null_safe_join

# Distinct values one task may order; above it the values are cut into ranges.
ROWS_PER_RANGE = 1_000_000


def collapse(df: DataFrame, value: str, by: Sequence[str], weights: Mapping[str, Column]) -> DataFrame:
    """One row per stratum and distinct value with weight sums, kept in the shared folder.

    NaN counts as missing; missing values form one row of their own. Adding zero turns -0.0 into
    0.0, so that the two are one value.
    """
    number = F.col(value).cast("double") + F.lit(0.0)
    number = F.when(~F.isnan(number), number).alias(value)
    sums = [F.sum(w.cast("bigint")).alias(name) for name, w in weights.items()]
    return stored(df.groupBy(*by, number).agg(*sums))


def _range_of(edges: Sequence[float], value: str) -> Column:
    """How many of the ascending edges are at or below the value, by halving steps over one array literal."""
    if not edges:
        return F.lit(0)
    bounds = F.array(*[F.lit(float(e)) for e in edges])
    steps = F.array(*[F.lit(2**k) for k in reversed(range(len(edges).bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda n, step: F.when(F.get(bounds, n + step - 1) <= F.col(value), n + step).otherwise(n),
    )


def prefix_counts(
    table: DataFrame, value: str, by: Sequence[str], columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add ``<c>_below`` (sum of c over smaller values of the stratum) and ``<c>_total``.

    ``table`` holds one row per stratum and value and is stored, as it is read several times; rows
    without a value are left out.
    """
    by, columns = list(by), list(columns)
    kept = table.filter(F.col(value).isNotNull())
    distinct = kept.count()
    ranges = math.ceil(distinct / rows_per_range)
    edges: list[float] = []
    if ranges > 1:
        # A fixed number of literals, so that a recomputed task places every value alike.
        edges = sorted(set(kept.approxQuantile(value, [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    ranged = kept.withColumn("_range", _range_of(edges, value))

    before = Window.unboundedPreceding
    if not edges:
        group = Window.partitionBy(*by)
        running = group.orderBy(value).rowsBetween(before, -1)
        return kept.withColumns(
            {f"{c}_below": F.coalesce(F.sum(c).over(running), F.lit(0)) for c in columns}
            | {f"{c}_total": F.sum(c).over(group) for c in columns}
        )
    in_range = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(before, -1)
    within = ranged.withColumns({f"{c}_below": F.coalesce(F.sum(c).over(in_range), F.lit(0)) for c in columns})
    # One row per stratum and range.
    sums = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    stratum = Window.partitionBy(*by)
    earlier = stratum.orderBy("_range").rowsBetween(before, -1)
    offsets = sums.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}_before") for c in columns],
        *[F.sum(f"_{c}").over(stratum).alias(f"{c}_total") for c in columns],
    )
    return null_safe_join(within, offsets, [*by, "_range"], "inner").select(
        *kept.columns,
        *[(F.col(f"{c}_below") + F.col(f"_{c}_before")).alias(f"{c}_below") for c in columns],
        *[f"{c}_total" for c in columns],
    )


def quantile(value: str, column: str, q: float) -> Column:
    """Linearly interpolated quantile as an aggregate over the rows of ``prefix_counts``."""
    position = (F.col(f"{column}_total") - 1) * F.lit(q)
    below, upto = F.col(f"{column}_below"), F.col(f"{column}_below") + F.col(column)

    def at(rank: Column) -> Column:
        return F.max(F.when((below <= rank) & (rank < upto), F.col(value)))

    low, high = at(F.floor(position)), at(F.ceil(position))
    share = F.max(position - F.floor(position))
    return low + (high - low) * share


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def quantiles(df: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles per stratum, one column per named probability, with the count of known values."""
    table = prefix_counts(collapse(df, value, by, {"n": F.lit(1)}), value, by, ["n"])
    wanted = [quantile(value, "n", q).alias(name) for name, q in probabilities.items()]
    return table.groupBy(*by).agg(F.sum("n").alias("count"), *wanted)


def two_samples(df: DataFrame, value: str, flag: Column, by: Sequence[str] = ()) -> DataFrame:
    """Prefix counts of a value for the rows with the flag (n1) and without it (n0)."""
    split = {"n1": F.when(flag, 1).otherwise(0), "n0": F.when(~flag, 1).otherwise(0)}
    known = df.filter(flag.isNotNull())
    return prefix_counts(collapse(known, value, by, split), value, by, ["n1", "n0"])


def summary(table: DataFrame, value: str, samples: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """n, mean, standard deviation (n − 1) and quartiles of each sample of ``two_samples``: one row
    per stratum and label of ``samples``."""
    by = list(by)
    x = F.col(value)
    names = list(samples.values())
    means = [F.try_divide(F.sum(x * F.col(s)), F.sum(s)).alias(f"{s}_mean") for s in names]

    # The spread is summed around the mean: one number per stratum, or just one.
    center = table.groupBy(*by).agg(*means)
    if by:
        centred = null_safe_join(table, center, by, "inner")
    else:
        centred = table.withColumns({f"{s}_mean": F.lit(m).cast("double") for s, m in zip(names, center.first())})

    aggregates = []
    for s in names:
        gap = x - F.col(f"{s}_mean")
        aggregates += [
            F.sum(s).alias(f"{s}_n"),
            F.max(f"{s}_mean").alias(f"{s}_mean"),
            F.sqrt(F.try_divide(F.sum(gap * gap * F.col(s)), F.sum(s) - 1)).alias(f"{s}_std"),
            *[quantile(value, s, q).alias(f"{s}_{name}") for name, q in QUARTILES.items()],
        ]
    rows = [
        F.struct(F.lit(label).alias("sample"), *[F.col(f"{s}_{c}").alias(c) for c in ("n", "mean", "std", *QUARTILES)])
        for label, s in samples.items()
    ]
    return centred.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*rows)))


def mann_whitney(table: DataFrame, value: str, by: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """Mann–Whitney U of the flagged sample against the other, from ``two_samples``.

    U counts pairs with the flagged value larger, ties as one half. p-values come from the normal
    law with average ranks, tie correction and continuity correction. Strata with an empty sample
    are left out. ``extra`` aggregates of the table are carried along.
    """
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    t = n1 + n0
    sums = table.groupBy(*by).agg(
        F.sum("n1").alias("n1"),
        F.sum("n0").alias("n0"),
        F.sum(n1 * (F.col("n0_below") + n0 / 2)).alias("U"),
        F.sum(t * t * t - t).alias("_ties"),
        *extra,
    )
    sums = sums.filter((F.col("n1") > 0) & (F.col("n0") > 0))
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    n = a + b
    sd = F.sqrt(a * b / 12 * (n + 1 - F.col("_ties") / (n * (n - 1))))
    # All values tied: no spread, no evidence, p = 1.
    sd = F.when(sd > 0, sd)
    larger = F.greatest(F.col("U"), a * b - F.col("U"))
    out = sums.withColumns(
        {
            "_z_two": (larger - a * b / 2 - 0.5) / sd,
            "_z_up": (F.col("U") - a * b / 2 - 0.5) / sd,
            "cles": F.col("U") / (a * b),
            "rbc": 2 * F.col("U") / (a * b) - 1,
        }
    )
    out = out.withColumns({"_two": tails.p_normal("_z_two"), "_up": tails.p_normal("_z_up")})
    return out.withColumns(
        {"p_greater": F.coalesce("_up", F.lit(1.0)), "p_two": F.least(F.lit(1.0), 2 * F.col("_two"))}
    ).drop("_ties", "_z_two", "_z_up", "_two", "_up")


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the least and the greatest value; the last bin includes the greatest."""
    table = collapse(df, value, (), {"n": F.lit(1)}).dropna(subset=[value])
    lo, hi = table.agg(F.min(value), F.max(value)).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:  # a single value gets a unit-wide span around it
        lo, hi = lo - 0.5, hi + 0.5
    placed = F.least(F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)).cast("int")
    found = table.groupBy(placed.alias("bin")).agg(F.sum("n").alias("n"))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edge = [(F.lit(lo) + F.lit((hi - lo) / bins) * k) for k in (F.col("bin") - 1, F.col("bin"))]
    return grid.join(found, "bin", "left").fillna(0, ["n"]).select("bin", edge[0].alias("bin_lo"), edge[1].alias("bin_hi"), "n")
