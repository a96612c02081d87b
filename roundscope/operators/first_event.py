"""First events of a round and the answers to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import differs
from ..session import broadcast_within, measured, stored
from .columns import null_safe_join


def first_with_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows at the least ``order`` of their group: tied rows all stay."""
    first = df.groupBy(*keys).agg(F.min(order).alias(order))
    return df.join(first, [*keys, order], "inner").select(*df.columns)


def first_counts(df: DataFrame, keys: Sequence[str], order: str, category, values: Sequence[str]) -> DataFrame:
    """Per group the least ``order`` and how many of its rows have each category value (``n_<value>``)
    or another or none (``n_other``).

    The same information as ``first_with_ties`` when only the category matters, by two aggregates
    that combine before they shuffle instead of a join back to all rows.
    """
    category = F.col(category) if isinstance(category, str) else category
    counts = [F.count_if(category == v).alias(f"n_{v}") for v in values]
    listed = F.coalesce(category.isin(list(values)), F.lit(False))
    counts.append(F.count_if(~listed).alias("n_other"))
    per_order = df.filter(F.col(order).isNotNull()).groupBy(*keys, order).agg(*counts)
    at_first = [F.min_by(f"n_{v}", order).alias(f"n_{v}") for v in (*values, "other")]
    return per_order.groupBy(*keys).agg(F.min(order).alias(order), *at_first)


def next_opposite(df: DataFrame, keys: Sequence[str], order: str, side: str) -> DataFrame:
    """Per group: t0 and side0 of the first event, and t1, the first later event of another side.

    side0 is the first known side. A missing side counts as another side. t1 is NULL when no such
    event follows. The events are only aggregated per (group, side). That small table is stored; if
    another side is tied with the first event in some groups, the events are read once more for
    just these.
    """
    keys = list(keys)
    known = df
    for c in (*keys, order):
        known = known.filter(F.col(c).isNotNull())
    per_side = known.groupBy(*keys, side).agg(F.min(order).alias("_first"))
    group = Window.partitionBy(*keys)  # one row per side
    with_first = stored(
        per_side.withColumns(
            {
                "t0": F.min("_first").over(group),
                "side0": F.min(F.when(F.col(side).isNotNull(), F.struct("_first", side))).over(group)[side],
            }
        )
    )
    other = differs(F.col(side), F.col("side0"))
    firsts = with_first.groupBy(*keys).agg(
        F.min("t0").alias("t0"),
        F.max("side0").alias("side0"),
        F.min(F.when(other & (F.col("_first") > F.col("t0")), F.col("_first"))).alias("t1"),
    )
    tied = with_first.filter(other & (F.col("_first") == F.col("t0"))).select(*keys, side, F.col("t0").alias("_t0"))
    ties = measured(tied)
    if not ties.rows:
        return firsts
    after_tie = (
        null_safe_join(known, broadcast_within(tied, ties), [*keys, side], "inner")
        .filter(F.col(order) > F.col("_t0"))
        .groupBy(*keys)
        .agg(F.min(order).alias("_after_tie"))
    )
    return firsts.join(after_tie, keys, "left").select(*keys, "t0", "side0", F.least("t1", "_after_tie").alias("t1"))


def response_curve(df: DataFrame, delay: str, horizon: int = 12, points: Sequence[int] | None = None) -> DataFrame:
    """Share of all rows whose delay is at most T, for T = 1 … horizon. Rows without a delay count
    in the denominator."""
    bin_of = F.when(F.col(delay) <= horizon, F.greatest(F.ceil(F.col(delay)), F.lit(1)).cast("int"))
    bins = df.groupBy(F.coalesce(bin_of, F.lit(horizon + 1)).alias("T")).agg(F.count(F.lit(1)).alias("n"))
    # horizon + 1 rows from here on; the last one holds everything slower or unanswered.
    grid = df.sparkSession.range(1, horizon + 2).select(F.col("id").cast("int").alias("T"))
    filled = grid.join(bins, "T", "left").fillna(0, ["n"])
    total = F.sum("n").over(Window.partitionBy())
    so_far = F.sum("n").over(Window.orderBy("T").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    curve = filled.select("T", so_far.alias("n_within"), F.try_divide(so_far, total).alias("ret_rate")).filter(F.col("T") <= horizon)
    return curve.filter(F.col("T").isin(list(points))) if points else curve
